"""Hand-made weather documents."""

from chuvisco.schemas import DOCUMENT


def document(codigo, ano, mes, times, humidity, temperature, wind, elevation=1.0, unit="°C"):
    payload = {
        "elevation": elevation,
        "latitude": -2.123456789,
        "longitude": -50.5,
        "timezone": "America/Sao_Paulo",
        "timezone_abbreviation": "-03",
        "utc_offset_seconds": -10800,
        "hourly": {
            "time": times,
            "relativehumidity_2m": humidity,
            "temperature_2m": temperature,
            "windspeed_10m": wind,
        },
        "hourly_units": {
            "time": "iso8601",
            "relativehumidity_2m": "%",
            "temperature_2m": unit,
            "windspeed_10m": "km/h",
        },
    }
    return (codigo, payload, ano, mes)


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENT + ", ano INT, mes INT")


def hours(day, count, first=0):
    return [f"{day}T{h:02d}:00" for h in range(first, first + count)]


def two_months(spark):
    """One entity with two documents whose positions both start at zero."""
    return documents(
        spark,
        document(1, 2023, 7, hours("2023-07-01", 3), [50.0, 51.0, 52.0], [20.0, 21.0, 22.0], [1.0, 2.0, 3.0]),
        document(1, 2023, 8, hours("2023-08-01", 3), [60.0, 61.0, 62.0], [100.0, 101.0, 102.0], [4.0, 5.0, 6.0]),
    )
