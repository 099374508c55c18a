"""Refined tables stored by document, and alignment where they lie."""

from uuid import uuid4

import pytest
from build import document, documents, hours

from chuvisco import operators as ops
from chuvisco.schemas import WEATHER
from chuvisco.sinks import open_buckets, write_buckets

KEYS = ("codigo_ibge", "ano", "mes")


@pytest.fixture
def name(spark):
    made = f"refined_{uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def some(spark, *months, value=0.0):
    return documents(
        spark,
        *[
            document(code, 2023, m, hours(f"2023-{m:02d}-01", 5), [1.0 * code] * 5, [None, 2.0, 3.0, value, 1.0 * m], [4.0, 5.0])
            for code in range(1, 9)
            for m in months
        ],
        document(99, 2023, months[0], [], [], [], []),
    )


def same(one, other):
    assert one.columns == other.columns
    return one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_alignment_of_buckets_has_no_exchange(spark, tmp_path, name, plan_after_run):
    docs = some(spark, 5, 6, 7)
    stacked = ops.stacked_components(docs)
    wanted = ops.align_components(ops.components(docs))
    assert wanted.count() == 8 * 3 * 2
    assert same(ops.align_stacked(stacked), wanted)
    table = write_buckets(stacked, name, str(tmp_path / "t"), KEYS, 4, sort_by=("idx",), partition_by=("tabela",))
    aligned = ops.align_stacked(table)
    assert same(aligned, wanted)
    plan = plan_after_run(aligned).split("Initial Plan")[0]
    assert "Exchange" not in plan and "Bucketed: true" in plan and plan.count("FileScan") == 1
    daily = ops.daily_rollup(aligned)
    assert same(daily, ops.rollup_components(ops.components(docs)))
    assert plan_after_run(daily).split("Initial Plan")[0].count("Exchange") == 1


def test_a_month_is_replaced_alone(spark, tmp_path, name, plan_after_run):
    path = str(tmp_path / "t")
    how = {"keys": ("codigo_ibge",), "buckets": 4, "sort_by": ("idx",), "partition_by": ("tabela", "ano", "mes")}
    table = write_buckets(ops.stacked_components(some(spark, 6, 7)), name, path, **how)
    files = "_metadata.file_path"
    before = {r[0] for r in table.filter("mes = 6").select(files).distinct().collect()}
    new = some(spark, 7, value=9.0)
    table = write_buckets(ops.stacked_components(new), name, path, **how)
    assert {r[0] for r in table.filter("mes = 6").select(files).distinct().collect()} == before
    wanted = some(spark, 6).unionAll(new)
    assert same(ops.align_stacked(table), ops.align_components(ops.components(wanted)))
    assert "Exchange" not in plan_after_run(ops.align_stacked(table))


def test_a_table_is_opened_by_another_catalog(spark, tmp_path, name, plan_after_run):
    path = str(tmp_path / "it's")
    how = {"keys": ("codigo_ibge",), "buckets": 4, "sort_by": ("idx",), "partition_by": ("tabela", "ano", "mes")}
    docs = some(spark, 6, 7)
    schema = write_buckets(ops.stacked_components(docs), name, path, **how).schema
    spark.sql(f"DROP TABLE {name}")
    table = open_buckets(spark, name, path, schema, **how)
    aligned = ops.align_stacked(table)
    assert same(aligned, ops.align_components(ops.components(docs)))
    assert "Exchange" not in plan_after_run(aligned)


def test_odd_tables(spark, tmp_path, name):
    empty = ops.stacked_components(some(spark, 6).limit(0))
    table = write_buckets(empty, name, str(tmp_path / "t"), KEYS, 4, partition_by=("tabela",))
    assert ops.align_stacked(table).count() == 0
    with pytest.raises(ValueError, match="partition"):
        write_buckets(empty, "x", "x", KEYS, 4, partition_by=("ano",))
    with pytest.raises(ValueError, match="none"):
        write_buckets(empty, "x", "x", (), 4)
    twice = some(spark, 6).unionAll(some(spark, 6))
    with pytest.raises(Exception, match="several readings"):
        ops.align_stacked(ops.stacked_components(twice), WEATHER).count()
    unknown = ops.stacked_components(documents(spark, document(None, 2023, 6, hours("2023-06-01", 1), [1.0], [1.0], [1.0])))
    assert ops.align_stacked(unknown).count() == 0
