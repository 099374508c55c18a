"""Settled readings by the columns asked for alone (F15, F16)."""

from pyspark.sql import functions as F

from build import document, documents, hours
from chuvisco.operators import hourly_wide, settle_hours


def test_columns_that_are_not_asked_for_change_nothing(spark):
    one = hours("2023-07-01", 2)
    rows = hourly_wide(
        documents(
            spark,
            document(1, 2023, 7, one, [1.0, None], [2.0, 3.0], [4.0, 5.0]),
            document(1, 2023, 7, one, [1.0, None], [2.0, 3.0], [4.0, 5.0], elevation=9.0, unit="°F"),
            document(1, 2023, 6, one, [8.0, 8.0], [8.0, 8.0], [8.0, 8.0]),
            document(1, 2023, 6, [None, "x"], [8.0, 8.0], [8.0, 8.0], [8.0, 8.0]),
            document(1, 2023, 6, [None, "x"], [8.0, 8.0], [8.0, 8.0], [8.0, 8.0], elevation=9.0),
            document(1, 2023, 6, [None, "x"], [8.0, 8.0], [8.0, 8.0], [8.0, 8.0], elevation=9.0),
        )
    )
    asked = ["temperature_2m", "relativehumidity_2m"]
    kept = settle_hours(rows, keep=asked)
    assert "elevation" not in kept.columns and "unit_temperature_2m" not in kept.columns
    columns = ["codigo_ibge", "time", "ano", "mes", "idx", *asked]
    found = [sorted(map(repr, r.select(*columns).collect())) for r in (kept, settle_hours(rows))]
    assert found[0] == found[1] and len(found[0]) == 6
    plan = kept._jdf.queryExecution().executedPlan().toString()
    last = plan[plan.index("max(struct") :].split(")")[0]
    assert "temperature_2m" in last and "elevation" not in last
    assert kept.filter(F.col("time").isNull()).count() == 4
