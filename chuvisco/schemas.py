"""Declared schemas of the lake and the layout that names a document's parts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and order of the landed CSV files. Coordinates are read as doubles so
# that the text sent back to the weather service keeps every digit.
STATES = "codigo_uf LONG, uf STRING, nome STRING, latitude DOUBLE, longitude DOUBLE, regiao STRING"
MUNICIPALITIES = "codigo_ibge LONG, nome STRING, latitude DOUBLE, longitude DOUBLE, capital INT, codigo_uf LONG"
MUNICIPALITIES_WIDE = MUNICIPALITIES + ", siafi_id LONG, ddd LONG, fuso_horario STRING"

# The weather document. Every metric is a double, whatever the file holds, so that a
# month of whole numbers and a month with decimals have one type.
DOCUMENT = (
    "codigo_ibge LONG, "
    "payload STRUCT<"
    "elevation: DOUBLE, latitude: DOUBLE, longitude: DOUBLE, "
    "timezone: STRING, timezone_abbreviation: STRING, utc_offset_seconds: LONG, "
    "hourly: STRUCT<time: ARRAY<STRING>, relativehumidity_2m: ARRAY<DOUBLE>, "
    "temperature_2m: ARRAY<DOUBLE>, windspeed_10m: ARRAY<DOUBLE>>, "
    "hourly_units: STRUCT<time: STRING, relativehumidity_2m: STRING, "
    "temperature_2m: STRING, windspeed_10m: STRING>>"
)


@dataclass(frozen=True)
class Metric:
    """One array of a document: its path, and the names it takes further on."""

    name: str  # column of the hourly tables
    values: str  # path of the array
    unit: str  # path of the unit text
    table: str  # name of its refined table
    label: str  # prefix of its daily columns


@dataclass(frozen=True)
class Layout:
    """Where the parts of a document are.

    ``document`` lists the columns that tell one document from another; positions are only
    comparable between arrays of the same document.
    """

    metrics: tuple[Metric, ...]
    entity: str = "codigo_ibge"
    document: tuple[str, ...] = ("codigo_ibge", "ano", "mes")
    time: str = "payload.hourly.time"
    time_table: str = "temporalidade"
    attributes: tuple[str, ...] = field(default=())

    @property
    def keys(self) -> tuple[str, ...]:
        """Entity and document columns, each once."""
        return tuple(dict.fromkeys((self.entity, *self.document)))

    def metric(self, name: str) -> Metric:
        for metric in self.metrics:
            if metric.name == name:
                return metric
        raise KeyError(f"no metric {name!r}; have {[m.name for m in self.metrics]}")


# Metric, refined-table and daily-column names.
WEATHER = Layout(
    metrics=(
        Metric(
            name="relativehumidity_2m",
            values="payload.hourly.relativehumidity_2m",
            unit="payload.hourly_units.relativehumidity_2m",
            table="humidade",
            label="humidade_relativa",
        ),
        Metric(
            name="temperature_2m",
            values="payload.hourly.temperature_2m",
            unit="payload.hourly_units.temperature_2m",
            table="temperatura",
            label="temperatura",
        ),
        Metric(
            name="windspeed_10m",
            values="payload.hourly.windspeed_10m",
            unit="payload.hourly_units.windspeed_10m",
            table="velocidade_do_vento",
            label="velocidade_do_vento",
        ),
    ),
    attributes=(
        "payload.elevation",
        "payload.latitude",
        "payload.longitude",
        "payload.timezone",
        "payload.timezone_abbreviation",
        "payload.utc_offset_seconds",
    ),
)


def as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def assert_schema(df: DataFrame, expected: str | T.StructType) -> DataFrame:
    """Return ``df`` if its columns have the expected names, order and types, else raise ``ValueError``.

    Nullability is not compared: every file source reports its columns as nullable.
    """
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in as_struct(expected)]
    if have != want:
        wrong = [pair for pair in zip(have, want) if pair[0] != pair[1]]
        raise ValueError(f"schema differs: {len(have)} columns for {len(want)}; found/expected {wrong}")
    return df
