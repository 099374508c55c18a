"""Aligning by position where the documents lie (F1, F2, F5)."""

import pytest
from build import document, documents, hours

from chuvisco.operators import align_components, align_documents, components, daily_rollup
from chuvisco.schemas import WEATHER


def _odd(spark):
    return documents(
        spark,
        document(1, 2023, 7, hours("2023-07-01", 3), [1.0, 2.0, 3.0], [7.0, 8.0], [4.0, 5.0, 6.0]),
        document(1, 2023, 8, ["xx", "2023-08-01T01:00"], [None, 2.0], [1.0, None], [1.0, 3.0]),
        document(2, 2023, 7, None, [1.0], [1.0], [1.0]),
        document(3, 2023, 7, [], [], [], []),
        document(None, 2023, 7, hours("2023-07-01", 1), [1.0], [1.0], [1.0]),
        document(4, 2023, 7, hours("2023-07-01", 2), [5.0, 6.0], [5.0, 6.0], [5.0, 6.0]),
    )


def test_same_rows_as_the_join_of_the_tables(spark):
    docs = _odd(spark)
    columns = [*WEATHER.keys, "idx", "time", *[m.name for m in WEATHER.metrics]]
    wanted = align_components(components(docs)).select(*columns)
    found = align_documents(docs)
    assert found.columns == wanted.columns
    assert found.schema == wanted.schema
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)
    assert sorted(daily_rollup(found).collect(), key=str) == sorted(daily_rollup(wanted).collect(), key=str)


def test_documents_sharing_keys_fail_as_the_join_does(spark):
    one = hours("2023-07-01", 1), [1.0], [1.0], [1.0]
    docs = documents(spark, document(1, 2023, 7, *one), document(1, 2023, 7, hours("2023-07-01", 1), [2.0], [2.0], [2.0]))
    with pytest.raises(Exception, match="several readings of one table share"):
        align_documents(docs).collect()


def test_readings_are_not_shuffled(spark):
    plan = align_documents(_odd(spark))._jdf.queryExecution().executedPlan().toString()
    # keys are counted and the few shared ones broadcast; arrays and readings stay where they are
    assert plan.count("Exchange hashpartitioning") <= 1
    assert "ArrayType" not in plan[plan.index("Exchange hashpartitioning") :].split("\n")[0]
    assert plan.index("Generate") < plan.index("Exchange")
