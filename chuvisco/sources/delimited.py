"""CSV scans with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chuvisco.schemas import as_struct


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, check_header: bool = False
) -> DataFrame:
    """Read headed CSV (plain or gzip) with a declared schema.

    Columns are bound by position, so a file may have more columns than the schema declares; the
    further ones are not parsed into rows. ``check_header`` compares the declared names with one
    header first and raises ``ValueError`` when a column would be bound to the wrong name; each task
    then compares the header of the file it reads with that one, and the query fails if it differs.
    """
    declared = as_struct(schema)
    if check_header:
        wrong = header_mismatch(spark, path, declared)
        if wrong:
            raise ValueError(f"header does not match the declared columns, found/declared: {wrong}")
        further = spark.read.option("header", True).csv(path).columns[len(declared) :]
        whole = T.StructType([*declared, *[T.StructField(name, T.StringType()) for name in further]])
        checked = spark.read.schema(whole).option("header", True).option("enforceSchema", False).csv(path)
        return checked.select(*declared.names)
    return spark.read.schema(declared).option("header", True).csv(path)


def header_mismatch(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType
) -> list[tuple[str | None, str]]:
    """Pairs (name in the header, declared name) that differ over the declared columns."""
    found: list[str | None] = list(spark.read.option("header", True).csv(path).columns)
    declared = as_struct(schema).names
    found += [None] * (len(declared) - len(found))
    return [(have, want) for have, want in zip(found, declared) if have != want]
