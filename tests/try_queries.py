"""python tests/try_queries.py MODULE [name ...]: compare registered queries while developing."""

import importlib
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from compare import compare  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

SF = os.environ.get("TRY_SF", "/root/testdata/sf0.01")


def main() -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = importlib.import_module(f"tierwise.plans.catalog.{sys.argv[1]}").QUERIES
    for name, (fn, sql) in queries.items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        begun = time.time()
        try:
            df = fn(spark, SF)
            said = f"rows {df.count()}" if sql is None else compare(df, sql, SF) or "ok"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{name}: {said} ({time.time() - begun:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
