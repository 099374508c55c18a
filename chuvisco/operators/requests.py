"""What to ask the weather service for, as rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chuvisco.functions.periods import month_bounds, year_bounds

# Address and parameters of the weather archive.
ENDPOINT = "https://archive-api.open-meteo.com/v1/era5"
VARIABLES = "temperature_2m,relativehumidity_2m,windspeed_10m"
TIMEZONE = "America/Sao_Paulo"


def extraction_requests(
    places: DataFrame,
    start: date,
    end: date | None = None,
    grain: str = "month",
    where: Column | str | None = None,
    prefix: str = "raw/clima",
    sort: bool = False,
) -> DataFrame:
    """One request per place and period from the period of ``start`` to that of ``end``.

    ``places`` has ``codigo_ibge``, ``regiao``, ``latitude`` and ``longitude``. Periods are made by
    a generator in each row, so there is no join. ``where`` chooses places (a null condition drops
    the place). ``sort`` orders by region, place and period; a region is free to span many tasks.
    """
    if grain not in ("month", "year"):
        raise ValueError(f"grain is 'month' or 'year', not {grain!r}")
    if where is not None:
        places = places.filter(where)
    unit, step = ("MM", "INTERVAL 1 MONTH") if grain == "month" else ("YYYY", "INTERVAL 1 YEAR")
    first, last = [F.trunc(F.lit(day).cast("date"), unit) for day in (start, end or start)]
    period = F.explode(F.sequence(first, last, F.expr(step))).alias("periodo")
    rows = places.select("codigo_ibge", "regiao", "latitude", "longitude", period)

    lower, upper = (month_bounds if grain == "month" else year_bounds)(F.col("periodo"))
    directory = F.date_format("periodo", "yyyy/MM" if grain == "month" else "yyyy")
    requests = rows.select(
        "codigo_ibge",
        "regiao",
        F.year("periodo").alias("ano"),
        *([F.month("periodo").alias("mes")] if grain == "month" else []),
        lower.alias("data_inicial"),
        upper.alias("data_final"),
        F.concat(F.lit(f"{prefix}/"), directory).alias("prefixo"),
        request_url(F.col("latitude"), F.col("longitude"), lower, upper).alias("url"),
    )
    return requests.orderBy("regiao", "codigo_ibge", "data_inicial") if sort else requests


def request_url(latitude: Column, longitude: Column, first: Column, last: Column) -> Column:
    """Address of the hourly readings of a point between two days."""
    parameters = {
        "latitude": latitude,
        "longitude": longitude,
        "start_date": first,
        "end_date": last,
        "hourly": F.lit(VARIABLES),
        "timezone": F.lit(TIMEZONE),
    }
    pairs = [F.concat(F.lit(f"{name}="), value.cast("string")) for name, value in parameters.items()]
    return F.concat(F.lit(f"{ENDPOINT}?"), F.concat_ws("&", *pairs))


def pending_requests(
    requests: DataFrame, landed: DataFrame, keys: Sequence[str] = ("codigo_ibge", "ano", "mes")
) -> DataFrame:
    """The requests for which nothing has landed yet."""
    return requests.join(landed.select(*keys).distinct(), list(keys), "left_anti")
