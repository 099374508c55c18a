"""Repeated deliveries of documents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.schemas import WEATHER, Layout

ARRIVAL = ("recebido_em", "documento")
DAYS = ("primeiro_dia", "ultimo_dia")

#: First and last day of a range.
Span = tuple[date | str | None, date | str | None]
MOST_SPANS = 64
#: Hashes that documents share, at most, for which copies are looked for where the documents are.
MOST_COPIES = 1 << 17


def distinct_documents(docs: DataFrame, ignore: Sequence[str] = ARRIVAL, in_place: bool = False) -> DataFrame:
    """Keep one of several documents equal in every column but those of ``ignore``.

    Copies are dropped before the shuffle where they meet in a task, so a document delivered
    very often does not load one task.

    ``in_place`` suits documents of which few have copies: their hashes are counted first, at once, and only documents
    whose hash stands twice are shuffled and compared; all others stay in the tasks that read them. ``docs`` are read
    once for that and again with the result, so both must give the same rows. Beyond ``MOST_COPIES`` such hashes, or
    where hashes do not follow equality (maps, variants, collations), all documents are shuffled.
    """
    docs = docs.drop(*ignore)
    if not in_place or not _hashed(docs.schema):
        return docs.distinct()
    mark = F.xxhash64(*docs.columns).alias("_mark")
    twice = docs.select(mark).groupBy("_mark").count().filter(F.col("count") > 1).select("_mark")
    # no more than can go to every task
    found = twice.limit(MOST_COPIES + 1).collect()
    if not found:
        return docs
    if len(found) > MOST_COPIES:
        return docs.distinct()
    found = F.broadcast(docs.sparkSession.createDataFrame(found, twice.schema))
    marked = docs.select("*", mark)
    alone, copies = [marked.join(found, "_mark", how).select(*docs.columns) for how in ("left_anti", "left_semi")]
    return alone.unionAll(copies.distinct())


def _hashed(kind: T.DataType) -> bool:
    """Whether equal values of a type have equal hashes."""
    if isinstance(kind, T.StructType):
        return all(_hashed(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashed(kind.elementType)
    if isinstance(kind, T.StringType):
        return kind.isUTF8BinaryCollation()
    return not isinstance(kind, (T.MapType, T.VariantType))


def latest_documents(
    docs: DataFrame, layout: Layout = WEATHER, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Keep the last delivery of each document, by the ``order_by`` columns and then by content.

    Many documents may lie in one file and share its stamp; of differing ones the largest by value
    stays, whatever order they are read in. The choice is an aggregate, not a window: each task
    passes on one candidate per document, so the number of deliveries of one document is no limit.
    """
    rest = [c for c in docs.columns if c not in (*layout.keys, *order_by)]
    newest = F.max(F.struct(*order_by, *rest)).alias("newest")
    return docs.groupBy(*layout.keys).agg(newest).select(*layout.keys, "newest.*").select(*docs.columns)


def with_days(docs: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """``docs`` with the first and the last day of their readings, null where no time can be read.

    In a stored table these columns let a scan skip documents of other days.
    """
    days = F.transform(F.col(layout.time), lambda time: time.try_cast("timestamp_ntz").cast("date"))
    return docs.withColumns({DAYS[0]: F.array_min(days), DAYS[1]: F.array_max(days)})


def months_of(docs: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """The distinct months ``(ano, mes)`` in which documents have readings. What tasks pass on is a row per month."""
    month = F.transform(F.col(layout.time), lambda time: F.trunc(time.try_cast("timestamp_ntz").cast("date"), "MM"))
    months = docs.select(F.explode(F.array_distinct(month)).alias("month")).filter(F.col("month").isNotNull())
    return months.select(F.year("month").alias("ano"), F.month("month").alias("mes")).distinct()


def of_days(docs: DataFrame, spans: Sequence[Span]) -> DataFrame:
    """Documents that can hold readings of one of the inclusive ranges of days (None: no bound), by the columns of
    :func:`with_days`; all, if they are not there.

    The condition reaches the scan, which skips files and row groups by it. Beyond ``MOST_SPANS`` ranges the ones with the
    smallest gaps between them are taken together, so that it stays short.
    """
    if not set(DAYS) <= set(docs.columns):
        return docs
    ranges = [within(F.col(DAYS[1]), start, None) & within(F.col(DAYS[0]), None, end) for start, end in _fewer(spans)]
    return docs.filter(reduce(Column.__or__, ranges, F.lit(False)))


def within(day: Column, start: date | str | None = None, end: date | str | None = None) -> Column:
    """Whether a day is in an inclusive range; an open end sets no bound."""
    inside = F.lit(True)
    if start is not None:
        inside &= day >= F.lit(start).cast("date")
    if end is not None:
        inside &= day <= F.lit(end).cast("date")
    return inside


def within_any(day: Column, spans: Sequence[Span]) -> Column:
    return reduce(Column.__or__, [within(day, *span) for span in spans], F.lit(False))


def _fewer(spans: Sequence[Span]) -> list[Span]:
    if len(spans) <= MOST_SPANS:
        return list(spans)
    spans = sorted(spans)
    gaps = sorted(range(1, len(spans)), key=lambda i: spans[i - 1][1] - spans[i][0])[: MOST_SPANS - 1]
    cuts = [0, *sorted(gaps), len(spans)]
    return [(spans[a][0], max(end for _, end in spans[a:b])) for a, b in zip(cuts, cuts[1:])]
