"""Documents to hourly rows and days."""

import random
from collections import defaultdict
from datetime import date, datetime
from itertools import product

import pytest
from build import document, documents, hours, two_months
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chuvisco.operators import (
    align_components,
    components,
    daily_rollup,
    distinct_documents,
    explode_metric,
    explode_time,
    hourly_wide,
    latest_documents,
    rollup_components,
)
from chuvisco.schemas import WEATHER, Layout

BY_POSITION = ("codigo_ibge", "idx")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_explode_keeps_position_unit_and_null_elements(spark):
    docs = documents(spark, document(1, 2023, 7, hours("2023-07-01", 2), [50.0, 51.0], [None, 6.0], [1.0, 2.0]))
    found = explode_metric(docs, "temperature_2m")
    assert found.columns == ["codigo_ibge", "ano", "mes", "idx", "temperature_2m", "unit_temperature_2m"]
    assert [tuple(r) for r in found.orderBy("idx").collect()] == [
        (1, 2023, 7, 0, None, "°C"),
        (1, 2023, 7, 1, 6.0, "°C"),
    ]


def test_explode_time_carries_attributes_and_has_no_zone(spark, settings):
    settings(spark__sql__session__timeZone="America/Sao_Paulo")
    docs = documents(spark, document(1, 2018, 11, ["2018-11-04T00:00", "xx"], [1.0, 1.0], [1.0, 1.0], [1.0, 1.0]))
    found = explode_time(docs)
    assert found.schema["time"].dataType == T.TimestampNTZType()
    first, second = found.orderBy("idx").collect()
    assert first.time == datetime(2018, 11, 4, 0, 0)  # skipped by the clock change in São Paulo
    assert second.time is None
    assert (first.latitude, first.utc_offset_seconds) == (-2.123456789, -10800)


def test_unknown_metric_and_distinct_mode_are_errors(spark):
    with pytest.raises(KeyError):
        explode_metric(two_months(spark), "pressure")
    with pytest.raises(ValueError):
        explode_time(two_months(spark), distinct="all")
    with pytest.raises(ValueError):
        hourly_wide(two_months(spark), distinct="all")


@pytest.mark.parametrize("array", [None, []])
def test_document_without_an_array_is_left_out(spark, array):
    docs = documents(
        spark,
        document(1, 2023, 7, hours("2023-07-01", 2), array, [1.0, 2.0], [1.0, 2.0]),
        document(2, 2023, 7, hours("2023-07-01", 1), [50.0], [1.0], [1.0]),
    )
    assert rows(hourly_wide(docs), "codigo_ibge") == [(2,)]
    assert rows(align_components(components(docs)), "codigo_ibge") == [(2,)]
    assert rows(rollup_components(components(docs), keys=BY_POSITION), "codigo_ibge") == [(2,)]
    assert explode_metric(docs, "relativehumidity_2m").count() == 1


def test_short_array_ends_the_rows(spark):
    docs = documents(
        spark, document(1, 2023, 7, hours("2023-07-01", 3), [1.0, 2.0, 3.0], [7.0, 8.0], [4.0, 5.0, 6.0])
    )
    wanted = [(0, 1.0, 7.0, 4.0), (1, 2.0, 8.0, 5.0)]
    metrics = [m.name for m in WEATHER.metrics]
    assert rows(hourly_wide(docs), "idx", *metrics) == wanted
    assert rows(align_components(components(docs)), "idx", *metrics) == wanted


def test_document_without_entity_joins_nothing(spark):
    one = hours("2023-07-01", 1), [1.0], [1.0], [1.0]
    docs = documents(spark, document(None, 2023, 7, *one), document(None, 2023, 7, *one), document(3, 2023, 7, *one))
    assert rows(hourly_wide(docs), "codigo_ibge") == [(3,)]
    assert rows(align_components(components(docs)), "codigo_ibge") == [(3,)]


def test_positions_of_two_documents_stay_apart(spark):
    docs = two_months(spark)
    wanted = [(date(2023, 7, 1), 21.0), (date(2023, 8, 1), 101.0)]
    assert rows(daily_rollup(hourly_wide(docs)), "data", "temperatura_media") == wanted
    assert rows(rollup_components(components(docs)), "data", "temperatura_media") == wanted


def test_join_by_position_only_mixes_documents_as_the_join_does(spark):
    docs = two_months(spark)
    tables = components(docs)
    joined = tables[WEATHER.time_table].select(*BY_POSITION, "time")
    for metric in WEATHER.metrics:
        joined = joined.join(tables[metric.table].select(*BY_POSITION, metric.name), list(BY_POSITION))
    assert joined.filter(F.col("time").cast("date") == "2023-07-01").count() == 24
    found = rollup_components(tables, keys=BY_POSITION)
    assert rows(found, "data", "temperatura_media") == [(date(2023, 7, 1), 61.0), (date(2023, 8, 1), 61.0)]
    assert rows(found, *found.columns) == rows(daily_rollup(joined), *found.columns)


def test_rollup_by_position_equals_brute_force_on_uneven_documents(spark):
    """Documents of unequal number and length per entity, with nulls and missing arrays."""
    rng = random.Random(5)
    made = []
    for number in range(60):
        entity, n = rng.choice([1, 1, 1, 2, 3, 4]), rng.randint(1, 5)

        def array():
            kind = rng.random()
            if kind < 0.1:
                return None
            return [rng.choice([None, 1.0, 2.0, 4.0, 9.0]) for _ in range(rng.randint(0, n))]

        times = [f"2023-07-0{rng.randint(1, 3)}T{h:02d}:00" for h in range(n)]
        made.append(document(entity, 2023, number, times, array(), array(), array()))
    at = defaultdict(lambda: ([], [], [], []))
    for codigo, payload, _, _ in made:
        hourly = payload["hourly"]
        for slot, name in enumerate(("time", "relativehumidity_2m", "temperature_2m", "windspeed_10m")):
            for idx, value in enumerate(hourly[name] or []):
                at[codigo, idx][slot].append(value)
    days = defaultdict(lambda: ([], [], []))
    for (codigo, _), lists in at.items():
        for time, *values in product(*lists):
            for kept, value in zip(days[codigo, date.fromisoformat(time[:10])], values):
                kept.append(value)
    wanted = {}
    for key, lists in days.items():
        results = []
        for values in lists:
            known = [v for v in values if v is not None]
            results += [sum(known) / len(known), min(known), max(known)] if known else [None] * 3
        wanted[key] = results
    found = {(r[0], r[1]): list(r[2:]) for r in rollup_components(components(documents(spark, *made)), keys=BY_POSITION).collect()}
    assert found.keys() == wanted.keys()
    for key, results in wanted.items():
        assert found[key] == pytest.approx(results), key


def test_aligning_refuses_repeated_positions(spark):
    docs = two_months(spark)
    with pytest.raises(Exception, match="several readings of one table share codigo_ibge, idx"):
        align_components(components(docs), keys=BY_POSITION).collect()


def test_nulls_are_left_out_and_a_day_of_nulls_is_kept(spark):
    docs = documents(
        spark,
        document(1, 2023, 7, hours("2023-07-01", 2) + hours("2023-07-02", 1), [1.0] * 3, [None, 6.0, None], [1.0] * 3),
    )
    temperature = ["data", "temperatura_media", "temperatura_minima", "temperatura_maxima"]
    wanted = [(date(2023, 7, 1), 6.0, 6.0, 6.0), (date(2023, 7, 2), None, None, None)]
    assert rows(daily_rollup(hourly_wide(docs)), *temperature) == wanted
    assert rows(rollup_components(components(docs), keys=BY_POSITION), *temperature) == wanted


def test_bad_time_makes_a_day_without_date(spark):
    docs = documents(spark, document(1, 2023, 7, ["xx", "2023-07-01T01:00"], [1.0, 3.0], [1.0, 3.0], [1.0, 3.0]))
    found = {r.data: r.temperatura_media for r in daily_rollup(hourly_wide(docs)).collect()}
    assert found == {None: 1.0, date(2023, 7, 1): 3.0}
    assert rows(daily_rollup(hourly_wide(docs), start="2023-01-01"), "data") == [(date(2023, 7, 1),)]


def test_day_range_takes_both_ends(spark):
    docs = documents(
        spark,
        *[document(1, 2023, m, hours(f"2023-{m:02d}-01", 1), [1.0], [float(m)], [1.0]) for m in (6, 7, 8, 9)],
    )
    for found in (
        daily_rollup(hourly_wide(docs), start="2023-07-01", end=date(2023, 8, 1)),
        daily_rollup(hourly_wide(docs, start="2023-07-01", end="2023-08-01")),
        rollup_components(components(docs), start="2023-07-01", end="2023-08-01"),
        rollup_components(components(docs), keys=BY_POSITION, start="2023-07-01", end="2023-08-01"),
    ):
        assert rows(found, "data") == [(date(2023, 7, 1),), (date(2023, 8, 1),)]


def test_sorted_results_are_in_order(spark):
    docs = documents(
        spark,
        *[
            document(c, 2023, 7, hours(f"2023-07-{d:02d}", 1), [1.0], [1.0], [1.0])
            for c, d in ((3, 1), (1, 2), (2, 5), (1, 1))
        ],
    )
    daily = [(r.codigo_ibge, r.data.day) for r in daily_rollup(hourly_wide(docs), sort=True).collect()]
    assert daily == [(1, 1), (1, 2), (2, 5), (3, 1)]
    times = [r.time for r in hourly_wide(docs, sort=True).collect()]
    assert times == sorted(times)


def test_repeated_documents_count_once(spark):
    docs = two_months(spark)
    twice = docs.unionAll(docs)
    once = rows(explode_metric(docs, "windspeed_10m"), "mes", "idx", "windspeed_10m")
    for found in (
        explode_metric(distinct_documents(twice), "windspeed_10m"),
        explode_metric(twice, "windspeed_10m", distinct="documents"),
        explode_metric(twice, "windspeed_10m", distinct="rows"),
    ):
        assert rows(found, "mes", "idx", "windspeed_10m") == once
    assert explode_time(twice, distinct="documents").count() == 6
    assert explode_time(twice, distinct="rows").count() == 6
    assert hourly_wide(twice, distinct="documents").count() == 6
    assert hourly_wide(twice, distinct="rows").count() == 6


def test_distinct_rows_also_drop_what_differing_documents_share(spark):
    docs = documents(
        spark,
        document(1, 2023, 7, hours("2023-07-01", 2), [1.0, 1.0], [5.0, 6.0], [1.0, 1.0]),
        document(1, 2023, 7, hours("2023-07-01", 2), [1.0, 1.0], [5.0, 7.0], [1.0, 1.0]),
    )
    assert explode_metric(docs, "temperature_2m", distinct="documents").count() == 4
    found = explode_metric(docs, "temperature_2m", distinct="rows")
    assert rows(found, "idx", "temperature_2m") == [(0, 5.0), (1, 6.0), (1, 7.0)]


def test_last_delivery_wins(spark):
    one = hours("2023-07-01", 1), [1.0]
    docs = documents(
        spark, *[document(1, 2023, 7, *one, [t], [1.0]) for t in (5.0, 7.0, 6.0)], document(2, 2023, 7, *one, [9.0], [1.0])
    )
    stamps = F.when(F.col("payload.hourly.temperature_2m")[0] == 7.0, "20230801000002").otherwise("20230801000001")
    deliveries = docs.withColumn("recebido_em", stamps).withColumn("documento", F.lit("x"))
    found = hourly_wide(latest_documents(deliveries))
    assert rows(found, "codigo_ibge", "temperature_2m") == [(1, 7.0), (2, 9.0)]


def test_in_step_takes_no_join_and_one_shuffle(spark, plan_after_run):
    plan = daily_rollup(hourly_wide(two_months(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_aligning_takes_one_shuffle_for_all_tables(spark):
    plan = align_components(components(two_months(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_stored_documents_are_read_by_the_arrays_needed(spark, tmp_path):
    two_months(spark).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = explode_metric(docs, "windspeed_10m")._jdf.queryExecution().executedPlan().toString()
    assert "windspeed_10m" in plan and "temperature_2m" not in plan


def test_layout_of_other_names(spark):
    layout = Layout(metrics=WEATHER.metrics[1:2], entity="station", document=("station",))
    docs = two_months(spark).withColumnRenamed("codigo_ibge", "station").filter("mes = 7")
    found = daily_rollup(hourly_wide(docs, layout), layout)
    assert found.columns == ["station", "data", "temperatura_media", "temperatura_minima", "temperatura_maxima"]
    assert rows(found, "temperatura_media") == [(21.0,)]
