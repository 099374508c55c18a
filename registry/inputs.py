"""The given tables in the shape of the lake's inputs.

Every input is a projection of whole tables, row by row: no table is regrouped to make a document,
so a supplier or an order with any share of the rows costs no task more than another.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chuvisco.schemas import DOCUMENT, WEATHER, Layout, Metric
from chuvisco.sinks import staged
from chuvisco.sinks.staging import WORK_FOLDER

# A line's document has its own name, since a supplier has many lines in a month.
LINES = replace(WEATHER, document=("codigo_ibge", "ano", "mes", "remessa"))
LINE_DOCUMENT = "remessa STRING, " + DOCUMENT
LINE_ENVELOPE = ("remessa", "codigo_ibge", "payload")

EVENTS = Layout(
    entity="user_id",
    document=("user_id",),
    metrics=(Metric(name="value", values="value", unit="unit", table="value", label="valor"),),
)


def name_shared_folder(spark: SparkSession) -> None:
    """Give a local session that names no shared folder one of its own."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.startswith("local["):
        if spark.conf.get(WORK_FOLDER, None) is None:
            spark.conf.set(WORK_FOLDER, tempfile.mkdtemp(prefix="shared-"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The directories that documents are landed and merged in.
MONTH = ("ano", "mes")
#: Documents of a month of hourly readings (some 36 KB each) that a task makes where they are to lie together.
MONTHS_A_TASK = 2048


def dealt(rows: DataFrame, by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """The rows of a table dealt out anew, as one row group is one task's, whatever the number of rows and cores.

    Given ``by``, rows equal in these columns come together and, unless ``parts`` tasks are asked for, lie in their order;
    whatever is made of them row by row then needs no shuffle of its own to lie there.
    """
    if parts is not None:
        return rows.repartition(parts, *by)
    rows = rows.hint("rebalance", *[F.col(c) for c in by])
    return rows.sortWithinPartitions(*by) if by else rows


def line_documents(
    spark: SparkSession, sf_dir: str, entity: str = "l_suppkey", by: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """One document per order line, with one reading per unit of its line number; ``by`` and ``parts`` as in :func:`dealt`.

    Readings lie six hours apart from the day of shipping on, so some go on into the next month or year. Lines of 10 % discount have no
    humidity, untaxed lines lack the first value of it, and returned lines the last wind speed.
    """
    day = F.to_date("l_shipdate")
    keys = {
        "remessa": F.concat_ws("-", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", day.cast("string")),
        "codigo_ibge": F.col(entity),
        "ano": F.year(day),
        "mes": F.month(day),
    }
    lines = dealt(table(spark, sf_dir, "lineitem").withColumns({c: keys[c] for c in by}), by, parts)
    positions = F.sequence(F.lit(0), F.col("l_linenumber") - 1)
    discount = F.round(F.col("l_discount") * 100)
    cents = F.round(F.col("l_extendedprice") * 100)

    def each(value) -> Column:
        return F.transform(positions, value)

    def wall_clock(i: Column) -> Column:
        hour = F.lpad((i % 4 * 6).cast("string"), 2, "0")
        return F.concat(F.date_add(day, F.floor(i / 4).cast("int")).cast("string"), F.lit("T"), hour, F.lit(":00"))

    humidity = F.when(
        discount != 10, each(lambda i: F.when((F.col("l_tax") != 0) | (i > 0), F.col("l_quantity") + i))
    )
    wind = F.slice(
        each(lambda i: discount * (i + 1)),
        F.lit(1),
        F.col("l_linenumber") - F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
    )
    hourly = F.struct(
        each(wall_clock).alias("time"),
        humidity.alias("relativehumidity_2m"),
        each(lambda i: cents - i).alias("temperature_2m"),
        wind.alias("windspeed_10m"),
    )
    units = F.struct(
        F.lit("iso8601").alias("time"),
        F.lit("%").alias("relativehumidity_2m"),
        F.when(F.col("l_linestatus") == "F", "°F").otherwise("°C").alias("temperature_2m"),
        F.lit("km/h").alias("windspeed_10m"),
    )
    payload = F.struct(
        F.col("l_quantity").alias("elevation"),
        F.col("l_partkey").cast("double").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.col("l_linestatus").alias("timezone"),
        F.col("l_returnflag").alias("timezone_abbreviation"),
        (F.col("l_linenumber") * -3600).cast("long").alias("utc_offset_seconds"),
        hourly.alias("hourly"),
        units.alias("hourly_units"),
    )
    columns = {c: F.col(c) if c in by else key for c, key in keys.items()} | {"payload": payload}
    return lines.select(*[columns[c].alias(c) for c in ("remessa", "codigo_ibge", "payload", "ano", "mes")])


def month_documents(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> DataFrame:
    """A document of one month of hourly readings per customer, under the default key of entity, year and month; those equal in
    ``by`` lie together.

    Every third customer lacks each fifth value of humidity, every tenth has no wind.
    """
    key, last = F.col("c_custkey"), F.last_day("first").cast("date")
    months = {"ano": (2008 + key % 3).cast("int"), "mes": (1 + F.floor(key / 3) % 12).cast("int")}
    customers = table(spark, sf_dir, "customer").withColumns(months)
    if by:
        # a document is several hundred times its customer, so tasks are counted in documents
        parts = 1 + customers.count() // MONTHS_A_TASK
        customers = customers.repartitionByRange(parts, *by, key).sortWithinPartitions(*by)
    else:
        customers = dealt(customers)
    dated = customers.withColumn("first", F.make_date("ano", "mes", F.lit(1)))
    positions = F.sequence(F.lit(0), F.dayofmonth(last) * 24 - 1)

    def each(value) -> Column:
        return F.transform(positions, value)

    def wall_clock(i: Column) -> Column:
        day = F.date_add(F.col("first"), F.floor(i / 24).cast("int")).cast("string")
        return F.concat(day, F.lit("T"), F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":00"))

    cents = F.round(F.col("c_acctbal") * 100)
    hourly = F.struct(
        each(wall_clock).alias("time"),
        each(lambda i: F.when((key % 3 != 0) | (i % 5 != 0), ((key * 7 + i) % 100).cast("double"))).alias("relativehumidity_2m"),
        each(lambda i: cents - i).alias("temperature_2m"),
        F.when(key % 10 != 0, each(lambda i: (i % 30).cast("double"))).alias("windspeed_10m"),
    )
    units = F.struct(
        F.lit("iso8601").alias("time"),
        F.lit("%").alias("relativehumidity_2m"),
        F.lit("°C").alias("temperature_2m"),
        F.lit("km/h").alias("windspeed_10m"),
    )
    payload = F.struct(
        F.col("c_acctbal").alias("elevation"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.lit("UTC").alias("timezone_abbreviation"),
        F.lit(0).cast("long").alias("utc_offset_seconds"),
        hourly.alias("hourly"),
        units.alias("hourly_units"),
    )
    return dated.select(key.alias("codigo_ibge"), payload.alias("payload"), "ano", "mes")


def stored_documents(spark: SparkSession, sf_dir: str, entity: str = "l_suppkey") -> DataFrame:
    """The documents of the order lines as a Parquet table, as operators find them in a lake."""
    return staged(line_documents(spark, sf_dir, entity), "documents")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each supplier."""
    supplier = table(spark, sf_dir, "supplier").withColumn("codigo_uf", F.col("s_nationkey").cast("long"))
    return supplier.join(states(spark, sf_dir), "codigo_uf").select(F.col("s_suppkey").alias("codigo_ibge"), "regiao")


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as municipalities of their nation; nation 0 has no capital flag."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("codigo_ibge"),
        F.col("c_name").alias("nome"),
        F.col("c_acctbal").alias("latitude"),
        (F.col("c_acctbal") / 2).alias("longitude"),
        F.nullif("c_nationkey", F.lit(0)).alias("capital"),
        F.col("c_nationkey").cast("long").alias("codigo_uf"),
        F.col("c_custkey").alias("siafi_id"),
        F.col("c_nationkey").cast("long").alias("ddd"),
        F.col("c_mktsegment").alias("fuso_horario"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as states of their region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("codigo_uf"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("uf"),
        F.col("n_name").alias("nome"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("r_name").alias("regiao"),
    )


def orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings of an entity, laid out by year."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderkey").alias("codigo_ibge"),
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderpriority").alias("prioridade"),
    )
