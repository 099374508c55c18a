"""Jobs from landing to the last table."""

import gzip
import os
import re
import shutil
from datetime import date

import pytest
from build import document, documents, hours, two_months

from chuvisco.functions import dictionary, period_path
from chuvisco.operators import hourly_wide, of_days
from chuvisco.operators.documents import MOST_SPANS, _fewer
from chuvisco.plans import Lake, backfill, compact, compact_month, refresh_month, run_dimension
from chuvisco.schemas import MUNICIPALITIES_WIDE, STATES
from chuvisco.sinks import land_csv, land_documents
from chuvisco.plans.jobs import _spans
from chuvisco.sources import read_table, split_documents


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def land(docs, lake, when):
    land_documents(docs.filter((docs.ano == when.year) & (docs.mes == when.month)), period_path(lake.raw("clima"), when))


def daily(table):
    return sorted((r.codigo_ibge, r.ano, str(r.data), r.temperatura_media) for r in table.collect())


def test_dimension_job(spark, lake):
    states = [(52, "GO", "Goiás", -15.9, -49.8, "Centro-Oeste")]
    places = [(1, "a", 1.5, 2.5, 1, 52, 9, 62, "z"), (2, "b", 1.5, 2.5, 0, 99, 9, 62, "z")]
    land_csv(spark.createDataFrame(states, STATES), lake.raw("municipios/estados.csv.gz"))
    land_csv(spark.createDataFrame(places, MUNICIPALITIES_WIDE), lake.raw("municipios/municipios.csv.gz"))
    for _ in range(2):  # a second run replaces the first
        trusted = run_dimension(spark, lake)
        assert [r.nome_estado for r in trusted.collect()] == ["Goiás"]
    assert dictionary(trusted).count() == 7
    refined = read_table(spark, lake.refined("municipios"))
    assert (refined.first().latitude, dictionary(refined).count()) == (1.5, 9)


def test_months_follow_one_another(spark, lake):
    docs = two_months(spark)
    july, august = date(2023, 7, 31), date(2023, 8, 31)
    land(docs, lake, july)
    assert daily(refresh_month(spark, lake, july)) == [(1, 2023, "2023-07-01", 21.0)]
    land(docs, lake, august)
    both = [(1, 2023, "2023-07-01", 21.0), (1, 2023, "2023-08-01", 101.0)]
    assert daily(refresh_month(spark, lake, august)) == both
    land(docs, lake, august)  # the same document under a new name
    assert daily(refresh_month(spark, lake, august)) == both
    times = read_table(spark, lake.refined("clima/temporalidade"))
    assert sorted((r.mes, r.idx) for r in times.collect()) == [(m, i) for m in (7, 8) for i in range(3)]
    assert {t: read_table(spark, lake.refined(f"clima/{t}")).count() for t in ("humidade", "temperatura", "velocidade_do_vento")} == {
        "humidade": 6,
        "temperatura": 6,
        "velocidade_do_vento": 6,
    }


def test_a_year_keeps_the_others(spark, lake):
    docs = documents(
        spark,
        document(1, 2022, 12, hours("2022-12-31", 2), [1.0, 1.0], [1.0, 3.0], [1.0, 1.0]),
        document(1, 2023, 1, hours("2023-01-01", 2), [1.0, 1.0], [5.0, 7.0], [1.0, 1.0]),
    )
    for when in (date(2022, 12, 1), date(2023, 1, 1)):
        land(docs, lake, when)
        table = refresh_month(spark, lake, when)
    assert daily(table) == [(1, 2022, "2022-12-31", 2.0), (1, 2023, "2023-01-01", 6.0)]


def test_last_delivery_of_a_month_wins(spark, lake, tmp_path):
    one = hours("2023-07-01", 1), [1.0]
    when = date(2023, 7, 1)
    for n, value in enumerate((5.0, 7.0)):
        staged = tmp_path / f"one{n}"
        land_documents(documents(spark, document(1, 2023, 7, *one, [value], [1.0])).coalesce(1), str(staged))
        folder = tmp_path / "lake" / "raw" / "clima" / "2023" / "07"
        folder.mkdir(parents=True, exist_ok=True)
        (part,) = staged.glob("*.json.gz")
        (folder / f"1_2023080120300{n}_x.json.gz").write_bytes(part.read_bytes())
    compact_month(spark, lake, when, latest=True)
    merged = read_table(spark, lake.merged("clima"))
    assert merged.columns == ["codigo_ibge", "payload", "primeiro_dia", "ultimo_dia", "ano", "mes"]
    assert [r.payload.hourly.temperature_2m for r in merged.collect()] == [[7.0]]
    compact_month(spark, lake, when)
    assert read_table(spark, lake.merged("clima")).count() == 2


def test_backfill_by_year_of_the_day(spark, lake):
    compact(
        documents(
            spark,
            document(1, 2021, 1, hours("2021-06-01", 2), [1.0, 1.0], [1.0, 3.0], [1.0, 1.0]),
            document(1, 2022, 1, ["2022-12-31T23:00", "2023-01-01T00:00"], [1.0, 1.0], [5.0, 7.0], [1.0, 1.0]),
            document(1, 2023, 1, ["2023-01-01T01:00"], [1.0], [9.0], [1.0]),
        ),
        lake,
    )
    every = [
        (1, 2021, "2021-06-01", 2.0),
        (1, 2022, "2022-12-31", 5.0),
        (1, 2023, "2023-01-01", 8.0),
    ]
    assert daily(backfill(spark, lake, years=[2021])) == every[:1]
    assert daily(backfill(spark, lake, years=[2023])) == [every[0], every[2]]
    table = backfill(spark, lake)
    assert daily(table) == every
    assert "gerado_em" in table.columns
    plan = hourly_wide(read_table(spark, lake.merged("clima")), start=date(2023, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ultimo_dia,2023-01-01)" in plan


def test_a_day_has_one_row_whatever_documents_hold_it(spark, lake):
    docs = documents(
        spark,
        document(1, 2023, 12, ["2023-12-31T23:00", "2024-01-01T00:00"], [1.0, 1.0], [1.0, 2.0], [1.0, 1.0]),
        document(1, 2024, 1, ["2024-01-01T01:00", "2024-02-01T00:00"], [1.0, 1.0], [4.0, 8.0], [1.0, 1.0]),
    )
    wanted = [(1, 2023, "2023-12-31", 1.0), (1, 2024, "2024-01-01", 3.0), (1, 2024, "2024-02-01", 8.0)]
    for when in (date(2023, 12, 1), date(2024, 1, 1), date(2023, 12, 1)):
        land(docs, lake, when)
        table = refresh_month(spark, lake, when)
    assert daily(table) == wanted
    assert daily(backfill(spark, lake)) == wanted


def test_a_month_without_documents_leaves_nothing(spark, lake, tmp_path):
    docs, july = two_months(spark), date(2023, 7, 1)
    for when in (july, date(2023, 8, 1)):
        land(docs, lake, when)
        refresh_month(spark, lake, when)
    for file in (tmp_path / "lake" / "raw" / "clima" / "2023" / "07").glob("*.json.gz"):
        file.write_bytes(b"")
        file.rename(file.with_suffix(".bak"))
    assert daily(refresh_month(spark, lake, july)) == [(1, 2023, "2023-08-01", 101.0)]
    assert {r.mes for r in read_table(spark, lake.refined("clima/humidade")).collect()} == {8}
    assert {r.mes for r in read_table(spark, lake.merged("clima")).collect()} == {8}


def test_jobs_over_an_empty_lake(spark, lake):
    when = date(2023, 7, 1)
    for table in (backfill(spark, lake), backfill(spark, lake, years=[2000, 2022]), backfill(spark, lake, years=[]), refresh_month(spark, lake, when)):
        assert table.count() == 0
        assert {"codigo_ibge", "data", "temperatura_media", "ano", "mes"} <= set(table.columns)
    os.makedirs(period_path(lake.raw("clima"), when))  # a folder without files
    assert refresh_month(spark, lake, when).count() == 0


def test_documents_without_a_readable_time(spark, lake):
    when = date(2023, 7, 1)
    land(documents(spark, document(1, 2023, 7, ["soon", None], [1.0, 1.0], [1.0, 3.0], [1.0, 1.0])), lake, when)
    assert refresh_month(spark, lake, when).count() == 0
    assert backfill(spark, lake).count() == 0
    assert read_table(spark, lake.refined("clima/temperatura")).count() == 2


def test_a_month_whose_folder_has_gone(spark, lake, tmp_path):
    land(two_months(spark), lake, date(2023, 7, 1))
    refresh_month(spark, lake, date(2023, 7, 1))
    shutil.rmtree(tmp_path / "lake" / "raw" / "clima" / "2023")
    assert refresh_month(spark, lake, date(2023, 7, 1)).count() == 0
    assert backfill(spark, lake).count() == 0  # the merged table has no file left
    assert backfill(spark, lake, years=[2023]).count() == 0


def daily_files(tmp_path):
    return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "lake" / "trusted" / "clima").rglob("*.parquet")}


def test_a_stray_reading_adds_its_month_alone(spark, lake, tmp_path):
    for year, month in ((1970, 1), (1990, 5), (2023, 6), (2023, 7)):
        land(documents(spark, document(2, year, month, hours(f"{year}-{month:02}-02", 2), [1.0] * 2, [4.0, 6.0], [1.0] * 2)), lake, date(year, month, 1))
        refresh_month(spark, lake, date(year, month, 1))
    before = daily_files(tmp_path)
    stray = document(1, 2023, 7, ["1970-01-01T00:00", *hours("2023-07-01", 1)], [1.0] * 2, [8.0, 10.0], [1.0] * 2)
    land(documents(spark, stray), lake, date(2023, 7, 1))
    table = refresh_month(spark, lake, date(2023, 7, 1))
    assert daily(table) == [
        (1, 1970, "1970-01-01", 8.0), (1, 2023, "2023-07-01", 10.0),
        (2, 1970, "1970-01-02", 5.0), (2, 1990, "1990-05-02", 5.0), (2, 2023, "2023-06-02", 5.0), (2, 2023, "2023-07-02", 5.0),
    ]
    kept = {file for file, stamp in before.items() if daily_files(tmp_path).get(file) == stamp}
    assert {re.search(r"ano=(\d+)/mes=(\d+)", f).groups() for f in kept} == {("1990", "5"), ("2023", "6")}


def test_scattered_years_open_no_document_between(spark, lake):
    years = [2000, 2005, 2010, 2022]
    docs = [document(1, y, 3, hours(f"{y}-03-01", 2), [1.0] * 2, [y + 0.0] * 2, [1.0] * 2) for y in years]
    compact(documents(spark, *docs), lake)
    assert daily(backfill(spark, lake, years=[2000, 2022])) == [(1, 2000, "2000-03-01", 2000.0), (1, 2022, "2022-03-01", 2022.0)]
    merged = read_table(spark, lake.merged("clima"))
    spans = _spans({(y, m) for y in (2000, 2022) for m in range(1, 13)})
    assert spans == [(date(2000, 1, 1), date(2000, 12, 31)), (date(2022, 1, 1), date(2022, 12, 31))]
    read = of_days(merged, spans)
    assert sorted(r.ano for r in read.collect()) == [2000, 2022]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(ultimo_dia" in plan


def test_many_ranges_are_taken_together_at_their_smallest_gaps():
    months = {(1900 + i, 1 + i % 12) for i in range(150)}
    fewer = _fewer(_spans(months))
    assert len(fewer) == MOST_SPANS
    assert all(any(a <= start and end <= b for a, b in fewer) for start, end in _spans(months))


def test_broken_records_go_to_quarantine(spark, lake, tmp_path):
    when, folder = date(2023, 7, 1), tmp_path / "lake" / "raw" / "clima" / "2023" / "07"
    docs = two_months(spark)
    land(docs, lake, when)
    good = max(folder.glob("*.gz"), key=lambda f: f.stat().st_size)
    line = gzip.decompress(good.read_bytes()).decode().strip()
    broken = [line[:40], '{"codigo_ibge": "one"}', "[" + line + "]", "17", "no json"]
    (folder / "more.json").write_text("\n".join([line.replace('"codigo_ibge":1', '"codigo_ibge":2'), *broken, "", "  ", line.replace('"codigo_ibge":1', '"codigo_ibge":3')]))
    table = refresh_month(spark, lake, when)
    assert [r[0] for r in daily(table)] == [1, 2, 3]
    held = read_table(spark, lake.quarantine("clima"))
    assert sorted(r.registro for r in held.collect()) == sorted(broken)
    assert {(r.documento.rsplit("/", 1)[1], r.inicio, r.ano, r.mes) for r in held.collect()} == {("more.json", 0, 2023, 7)}
    (folder / "more.json").unlink()
    for crc in folder.glob(".more*"):
        crc.unlink()
    assert [r[0] for r in daily(refresh_month(spark, lake, when))] == [1]
    assert not any((tmp_path / "lake" / "quarantine").rglob("*.parquet"))


@pytest.mark.parametrize("columns", [["codigo_ibge"], ["payload"], []])
def test_whether_a_record_is_broken_does_not_depend_on_the_columns_asked_for(spark, tmp_path, columns):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"codigo_ibge": 1, "payload": 3}\n{"codigo_ibge": "x"}\n{"codigo_ibge": 4}\n')
    docs, broken = split_documents(spark, str(tmp_path / "d"), period="month", arrival=True)
    assert {"ano", "mes", "documento", "recebido_em"} <= set(docs.columns)
    assert docs.select(*columns).count() == len(docs.select(*columns).collect()) == 1 and broken.count() == 2
