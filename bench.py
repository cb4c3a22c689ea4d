"""Time every query and print one JSON line.

All queries run twice into a sink that reads every row and keeps none; the
second round counts. ``queries`` are timed on tables derived on the fly from
``BENCH_SF_DIR``, as the checks run them. ``stored_queries`` are the same
queries on the tables after ``extract`` has written them as Parquet.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from acquaint.plans.extraction import extract_tables
from acquaint.session import recommended_builder
from acquaint.sources import read_parquet_tables
from workload import registry
from workload.standins import social_tables


def session(cpus: str) -> SparkSession:
    spark = (
        recommended_builder().master(f"local[{cpus}]")
        .appName("acquaint-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(queries: dict[str, Callable[[], DataFrame]]) -> dict[str, float]:
    times = {}
    for query in queries.values():
        drain(query())
    for name, query in queries.items():
        times[name] = seconds(lambda query=query: drain(query()))
        print(f"{name} {times[name]}", file=sys.stderr)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    derived = timed(
        {n: lambda q=q: q(spark, sf_dir) for n, q in registry.queries().items()}
    )
    # On a cluster, name a folder in BENCH_TABLES_DIR that all executors share.
    with tempfile.TemporaryDirectory(prefix="acquaint-bench-") as folder:
        root = f"{os.environ.get('BENCH_TABLES_DIR', folder)}/tables-{os.getpid()}"
        extraction = seconds(lambda: extract_tables(social_tables(spark, sf_dir), root))
        tables = read_parquet_tables(spark, root)
        stored = timed(
            {n: lambda n=n: registry.on_tables(n, tables) for n in registry.queries()}
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "all_queries_total",
                "value": round(sum(derived.values()), 3),
                "unit": "sec",
                "queries": derived,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "stored_value": round(sum(stored.values()), 3),
                "stored_queries": stored,
                "extract_tables": extraction,
            }
        )
    )


if __name__ == "__main__":
    main()
