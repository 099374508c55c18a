"""Parts of days, files read once, hours settled, tables in one pass, and directories of differing types."""

import os
from datetime import date

import pytest
from build import document, documents, hours

from chuvisco import operators as ops
from chuvisco.operators.hourly import component_of, components, settle_hours, stacked_components
from chuvisco.plans import Lake, backfill, compact_month, refresh_days, refresh_month
from chuvisco.schemas import DOCUMENT, WEATHER
from chuvisco.sinks import land_documents, write_table
from chuvisco.sources import list_files, read_declared, read_table, unread_files
from chuvisco.functions import period_path


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def land(docs, lake, when):
    land_documents(docs.filter((docs.ano == when.year) & (docs.mes == when.month)), period_path(lake.raw("clima"), when))


def rows(table):
    return sorted(tuple(r) for r in table.select("codigo_ibge", "data", "temperatura_media", "humidade_relativa_maxima").collect())


def plain(spark, lake):
    """The days of all merged documents, made without parts."""
    return ops.daily_rollup(ops.hourly_wide(read_table(spark, lake.merged("clima")))).filter("data IS NOT NULL")


def one(code, year, month, first, temperatures, humidity=None):
    n = len(temperatures)
    return document(code, year, month, hours(first, n), humidity or [1.0] * n, temperatures, [1.0] * n)


JUNE, JULY = date(2023, 6, 1), date(2023, 7, 1)


def test_days_of_parts_equal_the_rollup(spark):
    docs = documents(
        spark,
        one(1, 2023, 7, "2023-07-01", [1.0, 2.0, 4.0]),
        one(1, 2023, 8, "2023-07-01", [8.0, None, 16.0]),
        one(2, 2023, 7, "2023-07-01", [None, None]),
        document(3, 2023, 7, ["soon", None], [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]),
        document(4, 2023, 7, [], [], [], []),
    )
    hourly = ops.hourly_wide(docs)
    parts = ops.daily_parts(hourly)
    assert parts.count() == 4
    merged = ops.merge_parts(parts)
    wanted = ops.daily_rollup(hourly)
    assert merged.columns == wanted.columns
    assert merged.exceptAll(wanted).count() == wanted.exceptAll(merged).count() == 0
    assert ops.merge_parts(ops.daily_parts(hourly.limit(0))).count() == 0


def test_documents_that_come_change_and_go(spark, lake, tmp_path):
    assert refresh_days(spark, lake).count() == 0  # an empty lake
    june = documents(spark, one(1, 2023, 6, "2023-06-30", [2.0, 4.0]), one(2, 2023, 6, "2023-07-01", [6.0], [9.0]))
    july = documents(spark, one(1, 2023, 7, "2023-07-01", [10.0]), one(2, 2023, 7, "2023-07-01", [8.0]), one(3, 2023, 7, "1970-01-01", [8.0]))
    for docs, when in ((june, JUNE), (july, JULY)):
        land(docs, lake, when)
        compact_month(spark, lake, when)
    assert rows(refresh_days(spark, lake)) == rows(plain(spark, lake))
    assert rows(plain(spark, lake))[-2:] == [(2, date(2023, 7, 1), 7.0, 9.0), (3, date(1970, 1, 1), 8.0, 1.0)]

    parts = tmp_path / "lake" / "refined" / "clima" / "partes"
    before = {f: f.stat().st_mtime_ns for f in parts.rglob("*.parquet")}
    daily = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake" / "trusted").rglob("*.parquet")}
    refresh_days(spark, lake)  # nothing has changed
    assert {f: f.stat().st_mtime_ns for f in parts.rglob("*.parquet")} == before
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "lake" / "trusted").rglob("*.parquet")} == daily

    write_table(documents(spark, one(1, 2023, 7, "2023-07-01", [20.0]), one(4, 2023, 7, "2023-07-02", [1.0])), lake.merged("clima"), partition_by=("ano", "mes"))
    assert rows(refresh_days(spark, lake)) == rows(plain(spark, lake))  # one replaced, one added, two gone
    assert not (tmp_path / "lake" / "trusted" / "clima" / "ano=1970" / "mes=1").exists()
    kept = {f for f in parts.rglob("*.parquet") if f in before}
    assert kept and all("mes=6" in str(f) and f.stat().st_mtime_ns == before[f] for f in kept)
    assert rows(backfill(spark, lake)) == rows(plain(spark, lake))

    table = refresh_month(spark, lake, date(2023, 8, 1), parts=True)  # a month that is not there
    assert rows(table) == rows(plain(spark, lake))


def test_all_documents_gone(spark, lake, tmp_path):
    land(documents(spark, one(1, 2023, 7, "2023-07-01", [10.0])), lake, JULY)
    assert refresh_month(spark, lake, JULY, parts=True).count() == 1
    for file in (tmp_path / "lake" / "raw" / "clima" / "2023" / "07").glob("*.json.gz"):
        file.rename(tmp_path / file.name)
    assert refresh_month(spark, lake, JULY, parts=True).count() == 0
    assert refresh_days(spark, lake).count() == 0


def test_files_are_read_once(spark, lake, tmp_path):
    folder = tmp_path / "lake" / "raw" / "clima" / "2023" / "07"
    first, second = one(1, 2023, 7, "2023-07-01", [1.0]), one(2, 2023, 7, "2023-07-02", [2.0])
    merged = tmp_path / "lake" / "merged" / "clima"

    def entities():
        return sorted(r.codigo_ibge for r in read_table(spark, lake.merged("clima")).collect())

    def compacted():
        compact_month(spark, lake, JULY, incremental=True)
        return {f: f.stat().st_mtime_ns for f in merged.rglob("*.parquet")}

    land(documents(spark, first).coalesce(1), lake, JULY)
    (folder / "broken.json").write_text('{"codigo_ibge": 7, "payl\n')
    files = compacted()
    assert entities() == [1]
    assert compacted() == files  # a second run reads and writes nothing
    old = next(folder.glob("*.json.gz"))
    # what was read is not read again: the old file's bytes are no longer readable, its size and time are as they were
    stat = old.stat()
    old.write_bytes(b"x" * stat.st_size)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    (folder / "new {1}.json").write_text("")
    land(documents(spark, second, first).coalesce(1), lake, JULY)
    compacted()
    assert entities() == [1, 2]
    assert read_table(spark, lake.quarantine("clima")).count() == 1
    (folder / "broken2.json").write_text("nothing\n")
    compacted()
    assert entities() == [1, 2]
    assert sorted(r.registro for r in read_table(spark, lake.quarantine("clima")).collect()) == ["nothing", '{"codigo_ibge": 7, "payl']
    old.rename(tmp_path / "gone.gz")  # all that is left is read anew
    compacted()
    assert entities() == [1, 2]
    compact_month(spark, lake, JULY)
    assert not (tmp_path / "lake" / "ledger" / "clima" / "ano=2023" / "mes=7").exists()


def test_later_files_are_settled_with_earlier_ones(spark, lake, tmp_path):
    folder = tmp_path / "lake" / "raw" / "clima" / "2023" / "07"
    folder.mkdir(parents=True)

    def arrive(name, value):
        land_documents(documents(spark, one(1, 2023, 7, "2023-07-01", [value])).coalesce(1), str(tmp_path / name))
        (file,) = (tmp_path / name).glob("*.json.gz")
        file.rename(folder / f"1_{name}_x.json.gz")

    def value():
        compact_month(spark, lake, JULY, latest=True, incremental=True)
        return [r.payload.hourly.temperature_2m for r in read_table(spark, lake.merged("clima")).collect()]

    arrive("20230801000000", 1.0)
    assert value() == [[1.0]]
    arrive("20230803000000", 3.0)
    assert value() == [[3.0]]
    arrive("20230802000000", 2.0)  # delivered before the one that is held
    assert value() == [[3.0]]
    compact_month(spark, lake, JULY)  # keeps neither stamps nor ledger
    assert value() == [[3.0]]


def test_listing(spark, tmp_path):
    (tmp_path / "ano=2023").mkdir()
    for name in ("a.json", "b c{}.json", "c.csv"):
        (tmp_path / "ano=2023" / name).write_text(name)
    listing = list_files(spark, str(tmp_path), "*.json")
    assert sorted((r.arquivo.rsplit("/", 1)[1], r.tamanho, r.ano) for r in listing.collect()) == [("a.json", 6, 2023), ("b c{}.json", 10, 2023)]
    assert unread_files(listing, listing).count() == 0
    assert unread_files(listing, listing.limit(0)).count() == 2


def test_one_reading_per_hour(spark):
    docs = documents(
        spark,
        one(1, 2023, 7, "2023-07-01", [1.0, 2.0, 3.0]),
        document(1, 2023, 8, [*hours("2023-07-01", 2, 1), "2023-07-01T01:00", "soon", None], [1.0] * 5, [None, 20.0, 11.0, 5.0, 6.0], [1.0] * 5),
        one(2, 2023, 7, "2023-07-01", [7.0]),
    )
    hourly = ops.hourly_wide(docs)
    settled = settle_hours(hourly)
    assert settled.columns == hourly.columns
    found = sorted((r.codigo_ibge, str(r.time)[11:13] if r.time else "", r.mes, r.temperature_2m) for r in settled.collect())
    assert found == [(1, "", 8, 5.0), (1, "", 8, 6.0), (1, "00", 7, 1.0), (1, "01", 8, 11.0), (1, "02", 8, 20.0), (2, "00", 7, 7.0)]
    assert settle_hours(hourly.limit(0)).count() == 0
    earlier = settle_hours(hourly, order_by=("elevation",))  # equal everywhere: the last position, then the larger row
    assert earlier.count() == settled.count()


def test_tables_in_one_pass(spark, tmp_path):
    docs = documents(
        spark,
        one(1, 2023, 7, "2023-07-01", [1.0, None, 3.0]),
        document(2, 2023, 7, None, None, [4.0], []),
        document(None, 2023, 7, ["soon"], [1.0, 2.0], None, None),
    )
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.schema(docs.schema).parquet(str(tmp_path / "docs"))
    stacked = stacked_components(stored)
    assert stacked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    write_table(stacked, str(tmp_path / "tables"), partition_by=("tabela", "ano", "mes"))
    back = read_table(spark, str(tmp_path / "tables"))
    for name, wanted in components(docs).items():
        for table in (component_of(stacked, name), component_of(back, name)):
            assert table.columns == wanted.columns
            assert table.exceptAll(wanted).count() == wanted.exceptAll(table).count() == 0
    assert stacked_components(stored.limit(0)).count() == 0


def test_directories_of_differing_types(spark, tmp_path):
    path = str(tmp_path / "table")
    docs = documents(spark, one(1, 2023, 6, "2023-06-01", [1.5, 2.5]), one(1, 2023, 7, "2023-07-01", [3.0, None]))
    write_table(docs.filter("mes = 6"), path, partition_by=("ano", "mes"))
    write_table(docs.filter("mes = 7").selectExpr("codigo_ibge", """named_struct(
        'latitude', payload.latitude, 'longitude', payload.longitude, 'timezone', payload.timezone, 'timezone_abbreviation', payload.timezone_abbreviation,
        'utc_offset_seconds', payload.utc_offset_seconds, 'hourly', named_struct('time', payload.hourly.time,
        'relativehumidity_2m', payload.hourly.relativehumidity_2m, 'temperature_2m', CAST(payload.hourly.temperature_2m AS ARRAY<LONG>),
        'windspeed_10m', payload.hourly.windspeed_10m), 'hourly_units', payload.hourly_units) AS payload""", "ano", "mes"), path, partition_by=("ano", "mes"))
    table = read_declared(spark, path, DOCUMENT + ", ano INT, mes INT")
    assert [f.dataType for f in table.schema] == [f.dataType for f in docs.schema]
    found = sorted((r.mes, r.payload.elevation, r.payload.hourly.temperature_2m) for r in table.collect())
    assert found == [(6, 1.0, [1.5, 2.5]), (7, None, [3.0, None])]
    assert ops.hourly_wide(table, WEATHER).count() == 4
    (tmp_path / "none").mkdir()
    assert read_declared(spark, str(tmp_path / "none"), "a LONG").count() == 0
