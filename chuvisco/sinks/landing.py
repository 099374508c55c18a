"""Raw landing files: gzip JSON documents and gzip CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from chuvisco.sinks.tables import gather


def land_documents(
    docs: DataFrame,
    path: str,
    envelope: Sequence[str] = ("codigo_ibge", "payload"),
    partition_by: Sequence[str] = (),
    documents_per_file: int | None = None,
    mode: str = "append",
    arrange: str | None = "gather",
) -> None:
    """Write documents as gzip JSON lines holding the ``envelope`` columns.

    ``documents_per_file=1`` gives one object per document; without it Spark packs a task's
    documents in one file, which suits large landings. ``partition_by`` columns go to directories.
    ``arrange`` is ``"gather"``, see :func:`~chuvisco.sinks.tables.gather`, or ``None`` for documents that already lie by
    directory, which are written where they are, without a shuffle.
    """
    if arrange not in ("gather", None):
        raise ValueError(f"arrange is 'gather' or None, not {arrange!r}")
    rows = docs.select(*dict.fromkeys((*envelope, *partition_by)))
    if partition_by and arrange == "gather":
        rows = gather(rows, partition_by)
    writer = (
        rows.write.mode(mode)
        .option("compression", "gzip")
        .option("ignoreNullFields", False)
    )
    if documents_per_file is not None:
        writer = writer.option("maxRecordsPerFile", documents_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def land_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write headed gzip CSV in UTF-8."""
    df.write.mode(mode).option("compression", "gzip").option("header", True).option("encoding", "UTF-8").csv(path)
