"""Files as rows, and which of them a reader has not had yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What tells one file, or one state of a file, from another.
FILE = ("arquivo", "tamanho", "escrito_em")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The files below ``path`` whose names match ``pattern``: address, size and time of writing, with the
    ``column=value`` directories as columns. No content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    about = {"arquivo": "path", "tamanho": "length", "escrito_em": "modificationTime"}
    places = [c for c in files.columns if c not in ("path", "length", "modificationTime", "content")]
    return files.select(*[F.col(old).alias(new) for new, old in about.items()], *places)


def unread_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of a listing that a ledger, itself an earlier listing, does not have, or has in another state."""
    return listing.join(ledger.select(*FILE).distinct(), list(FILE), "left_anti")
