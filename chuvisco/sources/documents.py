"""Scans of landed JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.schemas import DOCUMENT, as_struct

# Year and month directories, as ``2023/07`` or ``ano=2023/mes=07``.
# Those nearest to the file count, as any folder above the lake may be a number too.
_PERIOD_DIRS = r"^.*/(?:ano=)?(\d{4})/(?:mes=)?(\d{1,2})/"
_YEAR_DIR = r"^.*/(?:ano=)?(\d{4})/"
# Arrival stamp in a file name: ``{entity}_{yyyymmddHHMMSS}_{uuid}``.
_NAME_STAMP = r"_(\d{14})_"
# Name of the column that takes a record which cannot be read.
_BROKEN = "_registro"


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType = DOCUMENT,
    recursive: bool = False,
    period: str | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Read JSON-lines documents with a declared schema, which saves the inference pass over the files.

    ``recursive`` reads a whole tree of sub-directories. Directories named ``column=value`` below
    ``path`` become columns when it is off.

    ``period`` is ``"month"`` or ``"year"`` to add ``ano`` (and ``mes``) from the names of the directories nearest to the
    file; a document is only known apart from another of the same entity by its period.

    ``arrival`` adds ``documento`` (file name) and ``recebido_em`` (the stamp in the file name, or
    else the time the file was written), by which re-deliveries are ordered.
    """
    reader = spark.read.schema(as_struct(schema))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    docs = reader.json(path)
    places = _places(period, arrival)
    return docs.withColumns(places) if places else docs


def split_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType = DOCUMENT,
    recursive: bool = False,
    period: str | None = None,
    arrival: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Documents as :func:`read_documents` gives them, and the records that cannot be read by ``schema``.

    Every line that is not blank is in one of the two. A record is broken if it is no JSON object, is cut off, or has a
    value of another type than declared; whichever columns are then asked for, the whole of it decides. Broken ones
    are rows ``(documento, inicio, registro)``, with the period columns of documents: the address of the file, the byte
    at which the stretch starts that one task reads of it, and the text.
    """
    declared = as_struct(schema)
    whole = T.StructType([*declared, T.StructField(_BROKEN, T.StringType())])
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(path)
    places = {c: F.col(c) for c in lines.columns if c != "value"} | _places(period, False)
    arrivals = _places(None, arrival)
    source = {"_documento": F.col("_metadata.file_path"), "_inicio": F.col("_metadata.file_block_start"), "_texto": F.col("value")}
    # as a generator's columns, what is read from a line is worked out once
    read = F.inline(F.array(F.from_json("value", whole, {"columnNameOfCorruptRecord": _BROKEN})))
    records = lines.filter(F.trim("value") != "").select(
        *[column.alias(name) for name, column in (source | places | arrivals).items()], read
    )
    broken = F.col(_BROKEN).isNotNull() | ~F.ltrim("_texto").startswith("{")
    docs = records.filter(~broken).select(*declared.names, *places, *arrivals)
    left = [F.col(f"_{c}").alias(c) for c in ("documento", "inicio")]
    return docs, records.filter(broken).select(*left, F.col("_texto").alias("registro"), *places)


def _places(period: str | None, arrival: bool) -> dict[str, Column]:
    """The columns that come from a file's address."""
    places = {}
    if period is not None:
        location = F.col("_metadata.file_path")
        pattern = _PERIOD_DIRS if period == "month" else _YEAR_DIR
        places["ano"] = _directory_number(location, pattern, 1)
        if period == "month":
            places["mes"] = _directory_number(location, pattern, 2)
    if arrival:
        name = F.col("_metadata.file_name")
        stamped = F.regexp_extract(name, _NAME_STAMP, 1)
        written = F.date_format(F.col("_metadata.file_modification_time"), "yyyyMMddHHmmss")
        places |= {"documento": name, "recebido_em": F.when(stamped != "", stamped).otherwise(written)}
    return places


def _directory_number(location, pattern: str, group: int):
    return F.regexp_extract(location, pattern, group).try_cast("int")
