"""Update-or-insert by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chuvisco.sinks import path_exists, remove_file, replace_table, staged, write_table
from chuvisco.sources import read_table

#: Formats whose tables are their files, so that some files can be replaced and the others left.
FILES = ("parquet", "orc")


def merge_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with every row whose key is in ``new`` replaced, and the other rows of ``new`` added.

    All columns of ``old`` are replaced; ``new`` must have them. Null keys match nothing. Rows of
    ``new`` with the same key make the query fail: they are counted where they are brought together
    by key, so the check takes no job of its own.

    A key that fills ``old`` is no hot spot: the replacing join is a plain left join, whose left
    side adaptive execution splits, and the inserting one sees each old key once per task.
    """
    keys = list(keys)
    missing = [c for c in old.columns if c not in new.columns]
    if missing:
        raise ValueError(f"new rows lack columns {missing}")
    new = new.select(*[F.col(f.name).cast(f.dataType) for f in old.schema])
    unkeyed = new.filter(reduce(Column.__or__, [F.col(k).isNull() for k in keys]))
    replacement = _one_per_key(new.dropna(subset=keys), keys)
    current = F.struct(*old.columns)
    updated = old.join(replacement, keys, "left").select(F.coalesce("_new", current).alias("_row")).select("_row.*")
    inserted = replacement.join(old.select(*keys).distinct(), keys, "left_anti").select("_new.*")
    return updated.unionByName(inserted).unionByName(unkeyed)


def _one_per_key(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row of ``new`` as ``_new`` beside its key; the query fails on a key that has several."""
    grouped = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*new.columns)).alias("_new"))
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    message = F.concat(F.lit("several rows have the key "), shown)
    return grouped.select(*keys, F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_new")).alias("_new"))


def upsert_table(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    sort_by: Sequence[str] = (),
) -> None:
    """Upsert ``new`` into the table at ``path``, which is made if it is not there.

    ``partition_by`` columns must be among the keys. ``new`` is read from a working copy, as it is
    gone through several times.

    Of a table of plain files, only those that hold a key of ``new`` are read whole and replaced, see
    :func:`files_holding`; the others stay as they are, and rows of new keys come in files of their
    own. Merged rows are written to a working copy first and then beside the old files, which go last:
    a merge that fails leaves the table as it was. If the removal of old files fails, the error names
    those that are still there; their rows are in the new ones already.

    In other formats the partitions that ``new`` touches are overwritten, or without partitions the
    merged table takes the place of the old one.
    """
    outside = [c for c in partition_by if c not in keys]
    if outside:
        raise ValueError(f"partition columns {outside} are not keys")
    spark = new.sparkSession
    new = staged(new, "new")
    if not path_exists(spark, path):
        none = new.limit(0)
        replace_table(merge_upsert(none, new, keys), path, fmt, partition_by=partition_by, sort_by=sort_by)
        return
    old = read_table(spark, path, fmt)
    if fmt in FILES:
        held = files_holding(old, new, keys)
        merged = staged(merge_upsert(old.filter(F.col("_metadata.file_path").isin(held)), new, keys), "upsert")
        write_table(merged, path, fmt, mode="append", partition_by=partition_by, sort_by=sort_by)
        for i, file in enumerate(held):
            if not remove_file(spark, file):
                raise OSError(f"replaced files that could not be removed: {held[i:]}")
        return
    if not partition_by:
        replace_table(merge_upsert(old, new, keys), path, fmt, sort_by=sort_by)
        return
    merged = staged(merge_upsert(_touched(old, new, partition_by), new, keys), "upsert")
    write_table(merged, path, fmt, partition_by=partition_by, sort_by=sort_by)


def files_holding(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of a table that hold a row with a key of ``new``.

    Only the keys are read, and only where the range of each of them, one row on the driver, does not
    rule out a directory or a stretch of a file; a key sorted by within files, or a time that grows
    from load to load, makes this a look at few files. The list is as long as the files to replace.
    """
    types = {f.name: f.dataType for f in old.schema}
    wanted = new.select(*[F.col(k).cast(types[k]) for k in keys]).dropna()
    ends = [(F.min(k).alias(f"min_{i}"), F.max(k).alias(f"max_{i}")) for i, k in enumerate(keys)]
    ranges = wanted.agg(*[e for pair in ends for e in pair]).first()
    between = [F.col(k).between(F.lit(ranges[f"min_{i}"]), F.lit(ranges[f"max_{i}"])) for i, k in enumerate(keys)]
    held = old.filter(reduce(Column.__and__, between)).select(*keys, F.col("_metadata.file_path").alias("_file"))
    found = held.join(wanted.distinct(), list(keys), "left_semi").select("_file").distinct()
    return sorted(r._file for r in found.collect())


def _touched(old: DataFrame, new: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``old`` in partitions that occur in ``new``, by one plan for any number of them.

    The range of each partition column, one row on the driver, is a condition that lets the scan
    skip the directories outside; a semi-join on the columns leaves out those in between. Partitions
    of a null come from a branch of their own, as equality does not find them.
    """
    touched = new.select(*partition_by).distinct()
    ends = [(F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}")) for i, c in enumerate(partition_by)]
    ranges = touched.agg(*[e for pair in ends for e in pair]).first()
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in partition_by])
    between = [F.col(c).between(F.lit(ranges[f"min_{i}"]), F.lit(ranges[f"max_{i}"])) for i, c in enumerate(partition_by)]
    within = reduce(Column.__and__, between, whole)
    known = old.filter(within).join(touched.filter(within), list(partition_by), "left_semi").select(*old.columns)

    renamed = touched.filter(~whole).toDF(*[f"_{c}" for c in partition_by])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by])
    return known.unionByName(old.filter(~whole).join(renamed, same, "left_semi"))
