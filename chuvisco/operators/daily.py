"""Hourly rows to one row per entity and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chuvisco.operators.hourly import _wall_clock, between_days
from chuvisco.schemas import WEATHER, Layout


def daily_rollup(
    hourly: DataFrame,
    layout: Layout = WEATHER,
    start: date | str | None = None,
    end: date | str | None = None,
    sort: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean, minimum and maximum of every metric per entity and day of ``time``.

    Columns are ``<label>_media``, ``<label>_minima`` and ``<label>_maxima``. Nulls are left out; a day
    of nulls only is kept, with null results. ``by`` adds grouping columns. One shuffle, of rows
    that each task has already summed up per entity and day.
    """
    rows = hourly.withColumn("data", F.col("time").cast("date"))
    rows = between_days(rows, F.col("data"), start, end)
    measures: list[Column] = []
    for metric in layout.metrics:
        measures += [
            F.avg(metric.name).alias(f"{metric.label}_media"),
            F.min(metric.name).alias(f"{metric.label}_minima"),
            F.max(metric.name).alias(f"{metric.label}_maxima"),
        ]
    daily = rows.groupBy(layout.entity, "data", *by).agg(*measures)
    return daily.orderBy(layout.entity, "data") if sort else daily


def daily_parts(hourly: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """What each document adds to each day: ``<label>_soma``, ``<label>_n``, ``<label>_minima`` and ``<label>_maxima`` of every
    metric per document and day.

    Days made of these by :func:`merge_parts` equal those of :func:`daily_rollup`, but a document that comes, changes or goes
    only changes its own rows. Nulls count in no ``n``; without values the other parts are null. Readings without a
    readable time are a part without a day.
    """
    measures: list[Column] = []
    for metric in layout.metrics:
        measures += [
            F.sum(metric.name).alias(f"{metric.label}_soma"),
            F.count(metric.name).alias(f"{metric.label}_n"),
            F.min(metric.name).alias(f"{metric.label}_minima"),
            F.max(metric.name).alias(f"{metric.label}_maxima"),
        ]
    return hourly.withColumn("data", F.col("time").cast("date")).groupBy(*layout.keys, "data").agg(*measures)


def merge_parts(parts: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """Days per entity from the rows of :func:`daily_parts`, with the columns of :func:`daily_rollup`. One shuffle, of rows
    that each task has already merged per entity and day."""
    measures: list[Column] = []
    for metric in layout.metrics:
        measures += [
            F.try_divide(F.sum(f"{metric.label}_soma"), F.sum(f"{metric.label}_n")).alias(f"{metric.label}_media"),
            F.min(f"{metric.label}_minima").alias(f"{metric.label}_minima"),
            F.max(f"{metric.label}_maxima").alias(f"{metric.label}_maxima"),
        ]
    return parts.groupBy(layout.entity, "data").agg(*measures)


def align_components(
    tables: Mapping[str, DataFrame], layout: Layout = WEATHER, keys: Sequence[str] | None = None
) -> DataFrame:
    """Bring the refined tables of a layout together by position: the inner join of all on ``keys``.

    The tables are stacked and grouped by ``keys`` (document and position by default), one shuffle
    instead of a chain of joins. ``keys`` must single out a reading in each table; if they do not,
    the query fails rather than pairing readings of different documents.
    """
    keys = tuple(keys or (*layout.keys, "idx"))
    columns = ["time", *[m.name for m in layout.metrics]]
    sources = [tables[layout.time_table], *[tables[m.table] for m in layout.metrics]]
    rows = _stack(sources, columns, keys)
    if set(layout.keys) <= set(keys):
        # the readings of a document go together: next to each other, their keys take hardly any room in the shuffle
        rows = rows.repartition(*layout.keys)
    return _aligned(rows, columns, keys)


def align_documents(docs: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """:func:`align_components` of :func:`~chuvisco.operators.components` of ``docs``, without making the tables.

    The readings of one position of a document lie in that document's arrays, so they are zipped where the document is
    and no reading is shuffled. Only the keys are counted, with one shuffle, so that the query fails as the join does when
    several documents with the same keys have readings of one table; the few keys found so go to every task.
    """
    keys = layout.keys
    columns = ["time", *[m.name for m in layout.metrics]]
    keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    arrays = docs.filter(keyed).select(
        *keys, F.col(layout.time).alias("time"), *[F.col(m.values).alias(m.name) for m in layout.metrics]
    )
    held = arrays.select(*keys, *[(F.size(c) > 0).alias(c) for c in columns]).groupBy(*keys)
    shared = held.agg(F.greatest(*[F.count_if(c) for c in columns]).alias("_held")).filter(F.col("_held") > 1)
    message = F.lit(f"several readings of one table share {', '.join((*keys, 'idx'))}")
    arrays = arrays.join(F.broadcast(shared.select(*keys, F.lit(True).alias("_shared"))), list(keys), "left")
    arrays = arrays.filter(F.when(F.col("_shared"), F.raise_error(message)).otherwise(F.lit(True)))
    complete = F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]), F.least(*[F.size(c) for c in columns]))
    zipped = F.slice(F.arrays_zip(*[F.col(c) for c in columns]), 1, F.coalesce(complete, F.lit(0)))
    rows = arrays.select(*keys, F.posexplode(zipped).alias("idx", "_at"))
    return rows.select(
        *keys, "idx", *[_wall_clock("_at.time").alias("time") if c == "time" else F.col(f"_at.{c}").alias(c) for c in columns]
    )


def align_stacked(stacked: DataFrame, layout: Layout = WEATHER) -> DataFrame:
    """:func:`align_components` over the rows that :func:`~chuvisco.operators.stacked_components` put together: one scan.

    Over a table that ``write_buckets`` stored by the document's key (or a part of it) the rows are grouped where they lie,
    without a shuffle.
    """
    keys = (*layout.keys, "idx")
    tables = [layout.time_table, *[m.table for m in layout.metrics]]
    columns = ["time", *[m.name for m in layout.metrics]]
    bit = F.coalesce(*[F.when(F.col("tabela") == name, F.lit(2**i)) for i, name in enumerate(tables)])
    keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rows = stacked.filter(F.col("tabela").isin(tables) & keyed).select(*keys, bit.alias("_source"), *columns)
    return _aligned(rows, columns, keys)


def _aligned(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row for the rows of each key, if every source has one; it fails if a source has several."""
    aligned = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.bit_or("_source").alias("_sources"),
        *[F.max(c).alias(c) for c in columns],
    )
    repeated = F.col("_rows") > F.bit_count("_sources")
    complete = F.col("_sources") == 2 ** len(columns) - 1
    message = F.lit(f"several readings of one table share {', '.join(keys)}")
    return aligned.filter(F.when(repeated, F.raise_error(message)).otherwise(complete)).select(*keys, *columns)


def rollup_components(
    tables: Mapping[str, DataFrame],
    layout: Layout = WEATHER,
    keys: Sequence[str] | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    sort: bool = False,
) -> DataFrame:
    """Daily rollup of the inner join of the refined tables on ``keys``, without making the joined rows.

    By default the tables are aligned by document and position, which must be unique.

    Keys that are given need not be. With entity and position only, a position of one document meets
    that position of every other document of the entity, and the join has the product of the tables'
    row counts per key. The result is the same here at linear cost: each table is summed up per key
    first, and a value counts as often as the join would repeat it, which is the product of the
    other tables' counts.
    """
    if keys is None:
        return daily_rollup(align_components(tables, layout), layout, start, end, sort)
    keys = tuple(keys)
    metrics = layout.metrics
    count = len(metrics)

    stacked = _stack([tables[m.table] for m in metrics], [m.name for m in metrics], keys)
    sums: list[Column] = []
    for i, metric in enumerate(metrics):
        sums += [
            F.count_if(F.col("_source") == 2**i).cast("double").alias(f"_n{i}"),
            F.count(metric.name).alias(f"_c{i}"),
            F.sum(metric.name).alias(f"_s{i}"),
            F.min(metric.name).alias(f"_lo{i}"),
            F.max(metric.name).alias(f"_hi{i}"),
        ]
    slots = stacked.groupBy(*keys).agg(*sums).filter(F.least(*[F.col(f"_n{i}") for i in range(count)]) > 0)

    times = tables[layout.time_table].select(*keys, F.col("time").cast("date").alias("data"))
    times = between_days(times, F.col("data"), start, end)
    times = times.groupBy(*keys, "data").agg(F.count(F.lit(1)).cast("double").alias("_t"))

    measures: list[Column] = []
    for i, metric in enumerate(metrics):
        weight = reduce(mul, [F.col(f"_n{j}") for j in range(count) if j != i], F.col("_t"))
        mean = F.try_divide(F.sum(weight * F.col(f"_s{i}")), F.sum(weight * F.col(f"_c{i}")))
        measures += [
            mean.alias(f"{metric.label}_media"),
            F.min(f"_lo{i}").alias(f"{metric.label}_minima"),
            F.max(f"_hi{i}").alias(f"{metric.label}_maxima"),
        ]
    daily = times.join(slots, list(keys)).groupBy(layout.entity, "data").agg(*measures)
    return daily.orderBy(layout.entity, "data") if sort else daily


def _stack(sources: Sequence[DataFrame], columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Union of the tables over ``keys``, each with its own column filled and one bit of ``_source`` set.

    Rows with a null key join nothing and are left out.
    """
    keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    parts = [
        source.filter(keyed).select(
            *keys,
            F.lit(2**i).alias("_source"),
            *[F.col(c) if c == columns[i] else F.lit(None).alias(c) for c in columns],
        )
        for i, source in enumerate(sources)
    ]
    return reduce(DataFrame.unionAll, parts)
