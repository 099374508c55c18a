"""Documents with parallel arrays to hourly rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.operators.documents import Span, of_days, within, within_any
from chuvisco.schemas import WEATHER, Layout


def explode_time(docs: DataFrame, layout: Layout = WEATHER, distinct: str | None = None) -> DataFrame:
    """One row per reading time, with its position and the document's attributes.

    ``time`` becomes a timestamp without zone: the text is local wall-clock time, which no daylight
    saving rule may shift. Text that is no timestamp becomes null.

    ``distinct`` removes repetition: ``"documents"`` compares documents before they are exploded,
    ``"rows"`` compares the rows that come out.
    """
    attributes = [F.col(path).alias(_leaf(path)) for path in layout.attributes]
    arrays = docs.select(*layout.keys, F.col(layout.time).alias("time"), *attributes)
    names = [_leaf(path) for path in layout.attributes]
    rows = _explode(arrays, "time", layout.keys, names, distinct)
    rows = rows.withColumn("time", _wall_clock("time"))
    return rows.distinct() if distinct == "rows" else rows


def explode_metric(
    docs: DataFrame, name: str, layout: Layout = WEATHER, distinct: str | None = None
) -> DataFrame:
    """One row per value of a metric, with its position and unit. ``distinct`` as in :func:`explode_time`."""
    metric = layout.metric(name)
    unit = f"unit_{name}"
    arrays = docs.select(*layout.keys, F.col(metric.values).alias(name), F.col(metric.unit).alias(unit))
    rows = _explode(arrays, name, layout.keys, [unit], distinct)
    return rows.distinct() if distinct == "rows" else rows


def components(docs: DataFrame, layout: Layout = WEATHER, distinct: str | None = None) -> dict[str, DataFrame]:
    """The refined tables of a layout by name: the time table and one table per metric.

    On a columnar input each table reads its own array only, so writing all of them reads the
    input about once.
    """
    tables = {layout.time_table: explode_time(docs, layout, distinct)}
    for metric in layout.metrics:
        tables[metric.table] = explode_metric(docs, metric.name, layout, distinct)
    return tables


def stacked_components(docs: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """The rows of all refined tables of a layout in one pass over the documents, with the table's name in ``tabela``.

    Each row has the columns of every table, null but for those of its own; :func:`component_of` gives a table back. Written
    with ``partition_by=("tabela", ...)``, one scan and one write make all tables, and reading one opens its directory alone.
    """
    names = [_leaf(path) for path in layout.attributes]
    metrics = [m.name for m in layout.metrics]
    flat = docs.select(
        *layout.keys,
        F.col(layout.time).alias("time"),
        *[F.col(m.values).alias(m.name) for m in layout.metrics],
        *[F.col(m.unit).alias(f"unit_{m.name}") for m in layout.metrics],
        *[F.col(path).alias(_leaf(path)) for path in layout.attributes],
    )
    element = {c: flat.schema[c].dataType.elementType for c in ("time", *metrics)}

    def rows(table: str, values: str) -> Column:
        def row(value: Column, i: Column) -> Column:
            cells = [value.alias(c) if c == values else F.lit(None).cast(kind).alias(c) for c, kind in element.items()]
            return F.struct(F.lit(table).alias("tabela"), i.alias("idx"), *cells)

        return F.coalesce(F.transform(values, row), F.array().cast(_rows_type(element)))

    every = F.concat(rows(layout.time_table, "time"), *[rows(m.table, m.name) for m in layout.metrics])
    own = {f"unit_{m.name}": m.table for m in layout.metrics} | dict.fromkeys(names, layout.time_table)
    return flat.select(*layout.keys, *own, F.inline(every)).select(
        "tabela",
        *layout.keys,
        "idx",
        _wall_clock("time").alias("time"),
        *metrics,
        *[F.when(F.col("tabela") == table, F.col(c)).alias(c) for c, table in own.items()],
    )


def component_of(stacked: DataFrame, name: str, layout: Layout = WEATHER) -> DataFrame:
    """One of the tables that :func:`stacked_components` put together, with the columns it has in :func:`components`."""
    if name == layout.time_table:
        columns = ["time", *[_leaf(path) for path in layout.attributes]]
    else:
        (metric,) = [m.name for m in layout.metrics if m.table == name]
        columns = [metric, f"unit_{metric}"]
    return stacked.filter(F.col("tabela") == name).select(*layout.keys, "idx", *columns)


def settle_hours(
    hourly: DataFrame, layout: Layout = WEATHER, order_by: Sequence[str] | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """One reading per entity and time where documents overlap: the one of the last document by ``order_by``.

    The order is that of the layout's document columns by default; name a column the layout carries as an attribute to go by
    arrival. Of several readings of one document at one time the one of the last position stays, and what is left equal
    is decided by value. A null in the later reading stands. Readings without a readable time are kept, equal ones once.

    The choice is an aggregate: each task passes on one candidate per entity and time, however many documents hold it.

    ``keep`` names the columns that are asked for besides entity, time and order. Columns are compared in turn, so those behind
    the last one of them cannot change it, and are left out.
    """
    order = [c for c in order_by or layout.document if c != layout.entity]
    later = [*order, *[c for c in ("idx",) if c in hourly.columns]]
    rest = [c for c in hourly.columns if c not in (layout.entity, "time", *later)]
    alone = F.when(F.col("time").isNull(), F.struct(*later, *rest)).alias("_alone")
    carried = rest if keep is None else rest[: 1 + max((rest.index(c) for c in keep if c in rest), default=-1)]
    last = F.max(F.struct(*later, *carried)).alias("_last")
    columns = [c for c in hourly.columns if c in (layout.entity, "time", *later, *carried)]
    return hourly.groupBy(layout.entity, "time", alone).agg(last).select(layout.entity, "time", "_last.*").select(*columns)


def hourly_wide(
    docs: DataFrame,
    layout: Layout = WEATHER,
    start: date | str | None = None,
    end: date | str | None = None,
    distinct: str | None = None,
    sort: bool = False,
    spans: Sequence[Span] | None = None,
) -> DataFrame:
    """One row per position at which every array of a document has an element.

    The arrays are walked in step inside the document, which takes neither join nor shuffle. As an
    inner join by position would, it stops at the shortest array and leaves out a document that has
    no entity or lacks an array. Null elements stay.

    ``start`` and ``end`` keep an inclusive range of days, ``spans`` several: documents of other days are skipped if
    they carry their days, and readings outside are dropped from the array before rows are made.
    """
    _check_distinct(distinct)
    if spans is None and not (start is None and end is None):
        spans = [(start, end)]
    elif spans is not None and not (start is None and end is None):
        raise ValueError("spans take the place of start and end")
    docs = docs if spans is None else of_days(docs, spans)
    arrays = {"time": layout.time} | {m.name: m.values for m in layout.metrics}
    carried = {f"unit_{m.name}": m.unit for m in layout.metrics}
    carried |= {_leaf(path): path for path in layout.attributes}

    narrow = docs.filter(F.col(layout.entity).isNotNull()).select(
        *layout.keys, *[F.col(path).alias(name) for name, path in (arrays | carried).items()]
    )
    if distinct == "documents":
        narrow = narrow.distinct()
    length = F.coalesce(F.least(*[F.size(name) for name in arrays]), F.lit(0))
    readings = F.arrays_zip(*arrays)
    if spans is None:
        rows = (
            narrow.withColumn("_length", length)
            .select(*layout.keys, *carried, "_length", F.posexplode(readings).alias("idx", "_reading"))
            .filter(F.col("idx") < F.col("_length"))
            .withColumn("_reading", F.col("_reading").withField("time", _wall_clock("_reading.time")))
        )
    else:

        def placed(reading: Column, idx: Column) -> Column:
            return F.struct(idx.alias("idx"), reading.withField("time", reading["time"].try_cast("timestamp_ntz")).alias("_reading"))

        def kept(reading: Column) -> Column:
            return (reading["idx"] < length) & within_any(reading["_reading"]["time"].cast("date"), spans)

        rows = narrow.select(*layout.keys, *carried, F.inline(F.filter(F.transform(readings, placed), kept)))
    rows = rows.select(*layout.keys, "idx", "_reading.time", *[F.col(f"_reading.{m.name}") for m in layout.metrics], *carried)
    if distinct == "rows":
        rows = rows.distinct()
    return rows.orderBy("time", *layout.keys, "idx") if sort else rows


def between_days(
    rows: DataFrame, day: Column, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Keep rows whose day is in the inclusive range; an open end sets no bound."""
    return rows if start is None and end is None else rows.filter(within(day, start, end))


def _explode(arrays: DataFrame, values: str, keys, carried, distinct: str | None) -> DataFrame:
    _check_distinct(distinct)
    if distinct == "documents":
        arrays = arrays.distinct()
    return arrays.select(*keys, F.posexplode(values).alias("idx", values), *carried)


def _check_distinct(distinct: str | None) -> None:
    if distinct not in (None, "documents", "rows"):
        raise ValueError(f"distinct is None, 'documents' or 'rows', not {distinct!r}")


def _rows_type(element: dict[str, T.DataType]) -> T.ArrayType:
    cells = [T.StructField(c, kind) for c, kind in element.items()]
    return T.ArrayType(T.StructType([T.StructField("tabela", T.StringType()), T.StructField("idx", T.IntegerType()), *cells]))


def _wall_clock(column: str) -> Column:
    return F.col(column).try_cast("timestamp_ntz")


def _leaf(path: str) -> str:
    return path.rsplit(".", 1)[-1]
