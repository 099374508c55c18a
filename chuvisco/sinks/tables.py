"""Table writes."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.sinks.staging import COMPRESSION, move_path, path_exists, remove_path


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    arrange: str | None = "gather",
    replace_schema: bool = False,
) -> None:
    """Write a table, by default replacing what it holds.

    With ``partition_by``, an overwrite replaces the partitions present in ``df`` and leaves the
    others as they are. ``arrange`` says how rows are brought to the tasks that write them:

    - ``"gather"``: by partition directory, see :func:`gather`;
    - ``"range"``: in the order of ``partition_by`` and ``sort_by`` over all files, so that each file
      holds one stretch of the keys and a filter on them opens few files;
    - ``None``: as they are, without a shuffle, for rows of one directory or already in place.

    ``sort_by`` orders rows inside each file, which makes row-group statistics selective.
    ``replace_schema`` lets a Delta table change its columns; Parquet always takes the new ones.
    """
    order = tuple(dict.fromkeys((*partition_by, *sort_by)))
    if arrange == "range":
        df = df.repartitionByRange(*order)
    elif arrange == "gather" and partition_by:
        df = gather(df, partition_by)
    elif arrange not in ("gather", None):
        raise ValueError(f"arrange is 'gather', 'range' or None, not {arrange!r}")
    if sort_by:
        df = df.sortWithinPartitions(*order)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite" and not replace_schema:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    writer.save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **how) -> None:
    """Write a whole table beside ``path`` and put it in its place when all of it is there.

    ``df`` may read the table it replaces. A write that fails leaves the old table as it was; between
    the two renames the old one still lies next to ``path`` under a name of its own.
    """
    spark, mark = df.sparkSession, uuid4().hex
    beside, before = f"{path.rstrip('/')}-new-{mark}", f"{path.rstrip('/')}-old-{mark}"
    try:
        write_table(df, beside, fmt, **how)
    except BaseException:
        remove_path(spark, beside)
        raise
    if path_exists(spark, path):
        move_path(spark, path, before)
    move_path(spark, beside, path)
    remove_path(spark, before)


def gather(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of a partition directory together, so that each task writes to few of them.

    Adaptive execution splits a directory that is far larger than the rest over several tasks and
    joins small ones, so neither one slow task nor a swarm of small files comes out.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])
