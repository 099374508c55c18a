"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the table directory, ``BENCH_CPUS`` the number of cores. Each query is run to a
sink that takes every row and keeps none, once to warm up and ``BENCH_RUNS`` times timed; the best
time counts. Queries on documents start from the stored documents, whose making is timed as
``store_documents``. ``yardstick`` compares the daily rollup of documents walked in step with the
same result from the four exploded tables, stacked and through a chain of joins.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from chuvisco.operators import align_components, components, daily_rollup, hourly_wide
from registry.inputs import LINES, name_shared_folder, stored_documents
from registry.queries import ENTITIES, ON_DOCUMENTS, QUERIES

WHOLE = (
    "daily_rollup_events",
    "month_documents_daily",
    "dimension_refined",
    "dimension_by_region",
    "csv_landing",
    "documents_landing",
    "documents_compacted",
    "partition_overwrite",
    "table_years",
    "upsert",
    "upsert_table",
    "monthly_requests",
    "pending_requests",
    "backfill_job",
)


def joined(tables: dict[str, DataFrame]) -> DataFrame:
    keys = [*LINES.keys, "idx"]
    names = [LINES.time_table, *[m.table for m in LINES.metrics]]
    return reduce(lambda left, right: left.join(right, keys), [tables[n] for n in names])


def seconds(run, runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    name_shared_folder(spark)
    stored = {}

    def store(entity: str) -> None:
        stored[entity] = stored_documents(spark, sf_dir, entity)

    times = {"store_documents": seconds(lambda: store("l_suppkey"), runs)}
    store("l_orderkey")
    for name, operator in ON_DOCUMENTS.items():
        docs = stored[ENTITIES.get(name, "l_suppkey")]
        times[name] = seconds(lambda operator=operator, docs=docs: drain(operator(docs)), runs)
    for name in WHOLE:
        times[name] = seconds(lambda query=QUERIES[name]: drain(query(spark, sf_dir)), runs)

    docs = stored["l_suppkey"]
    shapes = {
        "in_step": lambda: daily_rollup(hourly_wide(docs, LINES), LINES),
        "stacked_tables": lambda: daily_rollup(align_components(components(docs, LINES), LINES), LINES),
        "joined_tables": lambda: daily_rollup(joined(components(docs, LINES)), LINES),
    }
    yardstick = {name: seconds(lambda s=shape: drain(s()), runs) for name, shape in shapes.items()}

    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "yardstick": yardstick,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
