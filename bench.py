"""Seconds for each query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Every query is run to the end into Spark's ``noop`` sink, once to warm up and
then three times; the best time counts. ``value`` is the sum. ``--all-cores`` prints
the rates of the digests on all cores instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.queries import QUERIES, table
from acceptance.settings import KEY
from maskwright import ALGORITHMS, hash_fields

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def workloads() -> dict:
    """All registered queries but those of the training-data subpackage, which take minutes."""
    return QUERIES


def seconds(query, spark: SparkSession) -> float:
    times = []
    for _ in range(1 + RUNS):
        start = time.perf_counter()
        query(spark, FOLDER).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return min(times[1:])


def all_cores(spark: SparkSession) -> dict:
    """Million rows and MB of text per second for each digest, on copies of two tables that
    keep all cores busy."""
    lines = spark.read.parquet(*[f"{FOLDER}/lineitem.parquet"] * 24).select("l_orderkey")
    texts = spark.read.parquet(*[f"{FOLDER}/documents.parquet"] * 16).select("text")
    rows = lines.count() / 1e6
    megabytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] / 1e6

    def fastest(df: DataFrame, path: str, algorithm: str) -> float:
        def query(*_):
            return hash_fields(df, {path: "."}, key=KEY, algorithm=algorithm)

        return seconds(query, spark)

    return {
        a.id: {
            "million_rows_per_sec": round(rows / fastest(lines, "/l_orderkey", a.id), 2),
            "mb_of_text_per_sec": round(megabytes / fastest(texts, "/text", a.id)),
        }
        for a in ALGORITHMS
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("maskwright bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if sys.argv[1:] == ["--all-cores"]:
        print(json.dumps(all_cores(spark)))
        return
    chosen = sys.argv[1:] or list(workloads())
    times = {name: round(seconds(workloads()[name], spark), 4) for name in chosen}
    rows = table(spark, FOLDER, "lineitem").count()
    result = {
        "metric": "total seconds of all queries, noop sink, best of 3",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {
            name: round(rows / t) for name, t in times.items() if name.startswith("lineitem")
        },
        "cpus": CPUS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
