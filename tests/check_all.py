"""Compare every registered query with its SQL: ``python tests/check_all.py [sf_dir] [query ...]``."""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from oracle import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wrong = 0
    for name, query in contract.queries().items():
        if chosen and name not in chosen or name not in contract.oracle_sql():
            continue
        t0 = time.time()
        try:
            found = differences(query(spark, sf_dir), con, contract.oracle_sql()[name])
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        wrong += bool(found)
        print(f"{'DIFFERS' if found else 'equal  '} {name} {time.time() - t0:.1f}s {' '.join(found)}", flush=True)
    print(f"{wrong} differ")
