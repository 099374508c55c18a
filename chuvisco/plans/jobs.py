"""The jobs of the lake.

Each takes its period as an argument and can be run again: what it writes replaces what an earlier
run for the same period wrote.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.functions.metadata import MUNICIPALITY_COLUMNS, annotate
from chuvisco.functions.periods import period_path
from chuvisco.functions.stamp import stamp
from chuvisco.operators.daily import daily_parts, daily_rollup, merge_parts
from chuvisco.operators.dimension import build_refined, build_trusted
from chuvisco.operators.documents import ARRIVAL, DAYS, distinct_documents, latest_documents, months_of, with_days, within_any
from chuvisco.operators.hourly import components, hourly_wide
from chuvisco.schemas import DOCUMENT, MUNICIPALITIES, STATES, WEATHER, Layout, as_struct
from chuvisco.sinks import holds_files, path_exists, remove_path, staged, write_table
from chuvisco.sources import list_files, read_csv, read_table, split_documents, unread_files
from chuvisco.sources.files import FILE


@dataclass(frozen=True)
class Lake:
    """Paths of the lake below ``root``, and the format of its dimension tables."""

    root: str
    fmt: str = "parquet"

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def merged(self, name: str) -> str:
        return f"{self.root}/merged/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def ledger(self, name: str) -> str:
        return f"{self.root}/ledger/{name}"

    def refined(self, name: str) -> str:
        return f"{self.root}/refined/{name}"

    def trusted(self, name: str) -> str:
        return f"{self.root}/trusted/{name}"


def run_dimension(spark: SparkSession, lake: Lake) -> DataFrame:
    """Landed state and municipality CSV to the refined and the trusted dimension; returns the latter."""
    states = read_csv(spark, lake.raw("municipios/estados.csv.gz"), STATES)
    municipalities = read_csv(spark, lake.raw("municipios/municipios.csv.gz"), MUNICIPALITIES)
    refined = annotate(build_refined(municipalities, states), MUNICIPALITY_COLUMNS)
    write_table(refined, lake.refined("municipios"), lake.fmt, replace_schema=True)

    refined = read_table(spark, lake.refined("municipios"), lake.fmt)
    trusted = annotate(build_trusted(refined), MUNICIPALITY_COLUMNS)
    write_table(trusted, lake.trusted("municipios"), lake.fmt, replace_schema=True)
    return read_table(spark, lake.trusted("municipios"), lake.fmt)


def compact(
    docs: DataFrame,
    lake: Lake,
    layout: Layout = WEATHER,
    latest: bool = False,
    arrange: str | None = "gather",
    keep_arrival: bool = False,
) -> None:
    """Documents with ``ano`` and ``mes`` to the merged Parquet table, replacing the months they cover.

    Repeated documents are dropped. ``latest`` also settles differing deliveries of one document,
    in favour of the last. The table keeps the first and last day of each document's readings, by
    which later scans skip documents. ``arrange`` is as for :func:`write_table`. ``keep_arrival`` keeps
    the file and stamp of the last delivery, against which a later one can be settled.
    """
    docs = latest_documents(docs, layout) if latest else distinct_documents(docs, in_place=True)
    docs = docs if keep_arrival else docs.drop(*ARRIVAL)
    write_table(with_days(docs, layout), lake.merged("clima"), partition_by=("ano", "mes"), sort_by=DAYS, arrange=arrange)


def compact_month(
    spark: SparkSession,
    lake: Lake,
    when: date,
    layout: Layout = WEATHER,
    schema=DOCUMENT,
    latest: bool = False,
    incremental: bool = False,
) -> None:
    """The month's landed JSON documents, in ``YYYY/MM`` of the raw tree, to the merged table.

    They all go to one directory, so dropping repeated ones is the only shuffle. A month without
    documents, or without a folder, leaves no directory. Records that cannot be read as documents go
    to the month's directory of the quarantine table, with the file and the text.

    ``incremental`` reads only files that are not in the ledger of files read, and settles their documents
    with the month's merged ones; without new files nothing is read or written. A file that has gone or was
    written anew, or a month not yet in the ledger, is read from all its files. The ledger is written last,
    so a run that fails is made up for by the next one. A run that is not incremental leaves the month out of the ledger.
    """
    folder, ledger = period_path(lake.raw("clima"), when), lake.ledger("clima")
    period = {"ano": F.lit(when.year), "mes": F.lit(when.month)}
    listing = new = held = None
    if incremental and holds_files(spark, folder):
        listing = staged(list_files(spark, folder).select(*FILE), "listing")
        known, held = _held_month(spark, ledger, when), _held_month(spark, lake.merged("clima"), when)
        settled = not latest or held is None or set(ARRIVAL) <= set(held.columns)
        if known is not None and settled and unread_files(known, listing).isEmpty():
            # a list as long as the new files, which the reader is given by name
            new = [_literal(r.arquivo) for r in unread_files(listing, known).collect()]
            if not new:
                return
    if new is None:
        _remove_month(spark, ledger, when.year, when.month)
    docs = None
    if path_exists(spark, folder):
        docs, broken = split_documents(spark, new or folder, schema, arrival=latest)
        docs, broken = docs.withColumns(period), broken.withColumns(period)
        if new:
            docs = staged(docs if held is None else docs.unionByName(held.select(*docs.columns)), "documents")
            before = _held_month(spark, lake.quarantine("clima"), when)
            if before is not None:
                # a run that failed may have left records of the new files there
                broken = broken.unionByName(before.join(broken.select("documento").distinct(), "documento", "left_anti"))
        _replace_month(spark, broken, lake.quarantine("clima"), when)
    else:
        _remove_month(spark, lake.quarantine("clima"), when.year, when.month)
    if docs is None or docs.isEmpty():
        _remove_month(spark, lake.merged("clima"), when.year, when.month)
    else:
        compact(docs, lake, layout, latest, arrange=None, keep_arrival=latest and incremental)
    if listing is not None:
        write_table(listing.withColumns(period), ledger, partition_by=("ano", "mes"))


def refresh_month(
    spark: SparkSession,
    lake: Lake,
    when: date,
    layout: Layout = WEATHER,
    schema=DOCUMENT,
    latest: bool = False,
    incremental: bool = False,
    parts: bool = False,
) -> DataFrame:
    """Bring a landed month through merged and refined to the daily table; returns that table.

    Refined rows come from one document each, so only the month's partition is rewritten, by the
    tasks that read the documents. A day can take readings from several documents, and documents can
    cross the ends of months. So the daily rows of every month that the landed documents hold days of,
    or held before, are made anew from all documents with days in those months. A single reading far
    away adds its month, not those in between.

    ``incremental`` is as for :func:`compact_month`. With ``parts`` the daily rows come from the stored parts of
    :func:`refresh_days`, so that documents of other months are not exploded again.
    """
    touched = set() if parts else _months_held(spark, lake, when, layout)
    compact_month(spark, lake, when, layout, schema, latest, incremental)
    if not parts:
        touched |= _months_held(spark, lake, when, layout)
    month = _month_of(_merged(spark, lake), when)
    empty = month is None or month.isEmpty()
    names = [layout.time_table, *[m.table for m in layout.metrics]]
    tables = {} if empty else components(month.drop(*DAYS), layout)
    for name in names:
        if empty:
            _remove_month(spark, lake.refined(f"clima/{name}"), when.year, when.month)
        else:
            write_table(tables[name], lake.refined(f"clima/{name}"), partition_by=("ano", "mes"), arrange=None)
    if parts:
        return refresh_days(spark, lake, layout, schema)
    if touched:
        _write_days(spark, lake, layout, touched)
    return _daily(spark, lake, layout, as_struct(schema)[layout.entity].dataType)


def refresh_days(spark: SparkSession, lake: Lake, layout: Layout = WEATHER, schema=DOCUMENT) -> DataFrame:
    """Bring the daily table up to date with the merged one, from the parts each document adds to each day; returns it.

    The parts (:func:`~chuvisco.operators.daily.daily_parts`) are kept in the months of their documents, with a ledger of the
    merged files they were made from. Only documents of months whose files are others now are exploded, however those came,
    changed or went. The months those have days in, or had, are merged anew from the parts; without changes nothing
    is read but the listing. The first run makes the parts of all documents, and the whole daily table.

    Daily rows are written before the parts and these before the ledger, so a run that fails is made up for by the next one.
    """
    path, ledger, merged = lake.refined("clima/partes"), lake.ledger("partes"), _merged(spark, lake)
    known, kept = _table(spark, ledger), _table(spark, path)
    period = ("ano", "mes")
    if merged is None:
        now = None if known is None else known.limit(0)
    else:
        now = staged(list_files(spark, lake.merged("clima")).select(*FILE, *period), "listing")
    changed = [now] if known is None else [unread_files(now, known), unread_files(known, now)]
    if now is not None:
        # year and month pairs, as many as the calendar has at most
        stale = _pairs(reduce(DataFrame.unionByName, [files.select(*period) for files in changed]))
    else:
        stale = set()
    if stale:
        of_stale, new = _in_months(stale), None
        if merged is not None:
            new = staged(daily_parts(hourly_wide(merged.filter(of_stale), layout), layout), "parts")
        parts = [rows for rows in (new, None if kept is None else kept.filter(~of_stale)) if rows is not None]
        moved = [rows for rows in (new, None if kept is None else kept.filter(of_stale)) if rows is not None]
        touched = set().union(*[_pairs(_days_of(rows)) for rows in moved])
        everything = known is None
        if parts and (touched or everything):
            rows = reduce(DataFrame.unionByName, parts)
            rows = rows if everything else rows.filter(within_any(F.col("data"), _spans(touched)))
            _write_days(spark, lake, layout, None if everything else touched, merge_parts(rows, layout))
        here = set() if new is None else _pairs(new)
        if here:
            write_table(new, path, partition_by=period, sort_by=("data", layout.entity), arrange="range")
        files = _pairs(now)
        if files & stale:
            write_table(now.filter(of_stale), ledger, partition_by=period)
        for ano, mes in stale - here:
            _remove_month(spark, path, ano, mes)
        for ano, mes in stale - files:
            _remove_month(spark, ledger, ano, mes)
    return _daily(spark, lake, layout, as_struct(schema)[layout.entity].dataType)


def backfill(
    spark: SparkSession, lake: Lake, years: Iterable[int] | None = None, layout: Layout = WEATHER, schema=DOCUMENT
) -> DataFrame:
    """Daily rows of the given years, or of all, from the merged documents; returns the daily table.

    All are made in one pass and laid out by the year and month of the day. Of the merged table, only
    documents with days in the years asked for are read, wherever these lie. Readings whose time
    cannot be read have no day and are in no partition. No years are no work, and a lake without
    documents has an empty table; ``schema``, that of landed documents, names the entity's type for it.
    """
    if years is None:
        _write_days(spark, lake, layout)
    else:
        chosen = {(year, month) for year in set(years) for month in range(1, 13)}
        if chosen:
            _write_days(spark, lake, layout, chosen)
    return _daily(spark, lake, layout, as_struct(schema)[layout.entity].dataType)


#: Year and month.
Month = tuple[int, int]


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table(spark, path) if holds_files(spark, path) else None


def _merged(spark: SparkSession, lake: Lake) -> DataFrame | None:
    return _table(spark, lake.merged("clima"))


def _held_month(spark: SparkSession, path: str, when: date) -> DataFrame | None:
    """A month's directory of a table, by the columns its own files have."""
    rows = _table(spark, f"{path}/ano={when.year}/mes={when.month}")
    return None if rows is None else rows.withColumns({"ano": F.lit(when.year), "mes": F.lit(when.month)})


def _literal(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _pairs(rows: DataFrame) -> set[Month]:
    """The distinct years and months of rows, as many as the calendar has at most."""
    return {(r.ano, r.mes) for r in rows.select("ano", "mes").distinct().collect()}


def _days_of(parts: DataFrame) -> DataFrame:
    """Year and month of the day of each part that has one."""
    return parts.filter(F.col("data").isNotNull()).select(F.year("data").alias("ano"), F.month("data").alias("mes"))


def _in_months(months: set[Month]) -> Column:
    """Whether a row is of one of the months, by its partition columns."""
    years = {year: sorted(mes for ano, mes in months if ano == year) for year, _ in months}
    return reduce(Column.__or__, [(F.col("ano") == year) & F.col("mes").isin(*held) for year, held in sorted(years.items())])


def _month_of(merged: DataFrame | None, when: date) -> DataFrame | None:
    return None if merged is None else merged.filter((F.col("ano") == when.year) & (F.col("mes") == when.month))


def _months_held(spark: SparkSession, lake: Lake, when: date, layout: Layout) -> set[Month]:
    """The months in which a month's merged documents have readings, as many as the calendar has at most."""
    month = _month_of(_merged(spark, lake), when)
    return set() if month is None else {(r.ano, r.mes) for r in months_of(month, layout).collect()}


def _spans(months: set[Month]) -> list[tuple[date, date]]:
    """The ranges of days that are a set of months, neighbours together."""
    spans: list[tuple[date, date]] = []
    for year, month in sorted(months):
        first = date(year, month, 1)
        last = (first + timedelta(days=31)).replace(day=1) - timedelta(days=1) if (year, month) < (9999, 12) else date.max
        if spans and spans[-1][1] + timedelta(days=1) == first:
            spans[-1] = spans[-1][0], last
        else:
            spans.append((first, last))
    return spans


def _daily(spark: SparkSession, lake: Lake, layout: Layout, entity: T.DataType) -> DataFrame:
    """The daily table by its declared columns, which need no file to be there."""
    fields = [T.StructField(layout.entity, entity), T.StructField("data", T.DateType())]
    for metric in layout.metrics:
        fields += [T.StructField(f"{metric.label}_{part}", T.DoubleType()) for part in ("media", "minima", "maxima")]
    fields += [T.StructField("gerado_em", T.TimestampType()), T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType())]
    path, schema = lake.trusted("clima"), T.StructType(fields)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_table(spark, path, schema=schema)


def _write_days(
    spark: SparkSession, lake: Lake, layout: Layout, months: set[Month] | None = None, daily: DataFrame | None = None
) -> None:
    """The daily rows of the given months, or of all, in the order of month, entity and day; months left without rows go.

    They are ``daily``, or else made from the merged documents."""
    path, full, merged = lake.trusted("clima"), set(), None if daily is not None else _merged(spark, lake)
    if merged is not None:
        daily = daily_rollup(hourly_wide(merged, layout, spans=None if months is None else _spans(months)), layout)
    if daily is not None:
        daily = daily.filter(F.col("data").isNotNull())
        made = stamp(daily.withColumns({"ano": F.year("data"), "mes": F.month("data")}))
        before = staged(list_files(spark, path).select(*FILE), "listing") if holds_files(spark, path) else None
        write_table(made, path, partition_by=("ano", "mes"), sort_by=(layout.entity, "data"), arrange="range")
        if holds_files(spark, path):
            # months with rows are those with a file that was not there
            after = list_files(spark, path)
            full = _pairs(after if before is None else unread_files(after, before))
    if holds_files(spark, path):
        there = _pairs(read_table(spark, path))
        for ano, mes in (there if months is None else there & months) - full:
            _remove_month(spark, path, ano, mes)


def _replace_month(spark: SparkSession, rows: DataFrame, path: str, when: date) -> None:
    """The rows of a month's directory; without any, there is none."""
    rows = staged(rows, "month")
    if rows.isEmpty():
        _remove_month(spark, path, when.year, when.month)
    else:
        write_table(rows, path, partition_by=("ano", "mes"), arrange=None)


def _remove_month(spark: SparkSession, path: str, ano: int, mes: int) -> None:
    remove_path(spark, f"{path}/ano={ano}/mes={mes}")
