"""Scans of columnar tables, and named views over them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.schemas import as_struct
from chuvisco.sources.files import list_files


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    years: Iterable[int] | None = None,
    year_column: str = "ano",
    base_path: str | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Read a table directory, several, or a glob of them.

    ``years`` keeps those years; on a table partitioned by ``year_column`` the other directories are
    not opened. ``base_path`` keeps the ``column=value`` directories above a glob as columns.
    ``fmt`` is any batch format on the class path, e.g. ``"delta"`` where its jar is present.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(as_struct(schema))
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    table = reader.load(path)
    if years is not None:
        table = table.filter(F.col(year_column).isin(*years))
    return table


def read_declared(
    spark: SparkSession, path: str, schema: str | T.StructType, partition_by: Sequence[str] = ("ano", "mes")
) -> DataFrame:
    """A Parquet table by its declared columns, whatever types its directories were written with.

    A reader takes one type for all files, and a month whose values were all whole numbers was stored as longs. Here
    the schema of each partition directory is looked up, directories with equal ones are read together, and their columns,
    nested ones too, cast to the declared types by name; one that is not there is null. The files of a directory
    must have one schema, as those of one write have. The lookups are one per directory, the plan one branch per schema.
    """
    declared = as_struct(schema)
    address = F.regexp_replace("arquivo", "/[^/]*$", "")
    # as many as the table has partitions
    folders = sorted(r[0] for r in list_files(spark, path, "*.parquet").select(address).distinct().collect())
    alike: dict[str, list[str]] = {}
    for folder in folders:
        alike.setdefault(spark.read.parquet(folder).schema.json(), []).append(folder)
    if not alike:
        return spark.createDataFrame([], declared)
    parts = []
    for found, group in alike.items():
        held = T.StructType.fromJson(json.loads(found))
        rows = spark.read.option("basePath", path).parquet(*group)
        have = T.StructType([*held, *[rows.schema[c] for c in partition_by if c in rows.columns and c not in held.names]])
        parts.append(rows.select(*[_as_declared(have, field) for field in declared]))
    return reduce(DataFrame.unionAll, parts)


def _as_declared(have: T.StructType, field: T.StructField, within: Column | None = None) -> Column:
    if field.name not in have.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value = F.col(f"`{field.name}`") if within is None else within.getField(field.name)
    return _cast(value, have[field.name].dataType, field.dataType).alias(field.name)


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in another type, structs by the names of their fields."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        inner = F.struct(*[_as_declared(have, field, value) for field in want])
        return F.when(value.isNotNull(), inner)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda element: _cast(element, have.elementType, want.elementType))
    return value.cast(want)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make each table known to ``spark.sql`` under its name, for the session."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
