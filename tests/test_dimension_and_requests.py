"""Municipality dimension and extraction requests."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chuvisco.functions import month_bounds, period_path, reference_date, year_bounds
from chuvisco.operators import build_refined, build_trusted, extraction_requests, pending_requests
from chuvisco.schemas import MUNICIPALITIES, STATES

PLACES = "codigo_ibge LONG, regiao STRING, latitude DOUBLE, longitude DOUBLE, e_capital BOOLEAN"


def states(spark):
    return spark.createDataFrame(
        [(52, "GO", "Goiás", -15.9, -49.8, "Centro-Oeste"), (11, "RO", "Rondônia", -10.8, -63.3, "Norte")], STATES
    )


def municipalities(spark, *rows):
    return spark.createDataFrame([(c, f"m{c}", 1.0, 2.0, capital, uf) for c, capital, uf in rows], MUNICIPALITIES)


def places(spark):
    return spark.createDataFrame(
        [
            (3, "Sul", -30.123456789, -51.5, True),
            (1, "Sul", -29.0, -50.0, False),
            (2, "Norte", -2.5, -60.0, None),
        ],
        PLACES,
    )


def test_dimension_flag_has_three_values_and_unknown_states_drop_out(spark):
    found = build_refined(
        municipalities(spark, (1, 1, 52), (2, 0, 52), (3, None, 52), (4, 2, 52), (5, 1, 99), (6, 1, None)),
        states(spark),
        stamped=False,
    )
    assert found.columns == "codigo_ibge nome latitude longitude e_capital uf nome_estado regiao".split()
    flags = {r.codigo_ibge: r.e_capital for r in found.collect()}
    assert flags == {1: True, 2: False, 3: None, 4: False}


def test_dimension_drops_equal_rows_only(spark):
    found = build_refined(municipalities(spark, (1, 1, 52), (1, 1, 52), (1, 1, 11)), states(spark))
    assert sorted(r.uf for r in found.collect()) == ["GO", "RO"]
    assert found.columns[-1] == "gerado_em"


def test_trusted_has_no_coordinates(spark):
    trusted = build_trusted(build_refined(municipalities(spark, (1, 1, 52)), states(spark)))
    assert trusted.columns == "codigo_ibge nome e_capital uf nome_estado regiao gerado_em".split()


def test_small_states_are_broadcast_and_large_ones_are_not(spark, settings, tmp_path):
    for name, table in (("m", municipalities(spark, (1, 1, 52))), ("e", states(spark))):
        table.write.parquet(str(tmp_path / name))

    def plan():
        stored = [spark.read.parquet(str(tmp_path / name)) for name in ("m", "e")]
        return build_refined(*stored)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    settings(spark__sql__autoBroadcastJoinThreshold="8")
    assert "SortMergeJoin" in plan()


def test_stamp_takes_no_part_in_distinct(spark):
    plan = build_refined(municipalities(spark, (1, 1, 52)), states(spark))._jdf.queryExecution().optimizedPlan().toString()
    top, below = plan.split("\n", 1)
    assert "gerado_em" in top and "gerado_em" not in below


def test_period_helpers(spark):
    assert reference_date(datetime(2023, 8, 1, 20, 30)) == date(2023, 7, 31)
    assert reference_date(datetime(2024, 3, 1)) == date(2024, 2, 29)
    assert period_path("raw/clima/", date(2023, 7, 31)) == "raw/clima/2023/07"
    assert period_path("raw/clima", date(2023, 7, 31), "year") == "raw/clima/2023"
    day = F.lit("2024-02-10").cast("date")
    row = spark.range(1).select(*month_bounds(day), *year_bounds(day)).first()
    assert tuple(row) == (date(2024, 2, 1), date(2024, 2, 29), date(2024, 1, 1), date(2024, 12, 31))


def test_month_request(spark):
    found = extraction_requests(places(spark), date(2024, 2, 29), sort=True).collect()
    assert [r.codigo_ibge for r in found] == [2, 1, 3]
    assert found[2].asDict() == {
        "codigo_ibge": 3,
        "regiao": "Sul",
        "ano": 2024,
        "mes": 2,
        "data_inicial": date(2024, 2, 1),
        "data_final": date(2024, 2, 29),
        "prefixo": "raw/clima/2024/02",
        "url": "https://archive-api.open-meteo.com/v1/era5?latitude=-30.123456789&longitude=-51.5"
        "&start_date=2024-02-01&end_date=2024-02-29"
        "&hourly=temperature_2m,relativehumidity_2m,windspeed_10m&timezone=America/Sao_Paulo",
    }


def test_requests_over_several_periods(spark):
    months = extraction_requests(places(spark), date(2023, 11, 30), date(2024, 1, 1))
    assert {(r.ano, r.mes) for r in months.collect()} == {(2023, 11), (2023, 12), (2024, 1)}
    assert months.count() == 9
    years = extraction_requests(places(spark), date(2015, 6, 1), date(2022, 1, 1), grain="year")
    assert years.count() == 24 and "mes" not in years.columns
    first = years.orderBy("codigo_ibge", "ano").first()
    assert (first.data_inicial, first.data_final, first.prefixo) == (date(2015, 1, 1), date(2015, 12, 31), "raw/clima/2015")
    assert "Join" not in months._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="grain"):
        extraction_requests(places(spark), date(2015, 1, 1), grain="day")


def test_condition_on_places_drops_null(spark):
    found = extraction_requests(places(spark), date(2024, 2, 1), where="NOT e_capital")
    assert [r.codigo_ibge for r in found.collect()] == [1]


def test_pending_are_those_not_landed(spark):
    requests = extraction_requests(places(spark), date(2024, 1, 1), date(2024, 2, 1))
    landed = spark.createDataFrame([(1, 2024, 1)] * 3 + [(3, 2024, 2), (9, 2024, 1)], "codigo_ibge LONG, ano INT, mes INT")
    left = sorted((r.codigo_ibge, r.mes) for r in pending_requests(requests, landed).collect())
    assert left == [(1, 2), (2, 1), (2, 2), (3, 1)]
