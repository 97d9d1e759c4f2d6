"""Arrow UDFs whose Python workers give back what a task has gathered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches() -> None:
    """Have Spark send 1,000 rows at a time to Python in this session, where the number is
    still the 10,000 that Spark starts with: rows here are whole texts, and a worker holds
    a batch, its results and their copies."""
    spark = SparkSession.active()
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, "1000")


def task_udf(make: Callable[[], Callable[[pa.Array], pa.Array]], kind: str):
    """A UDF to ``kind`` by the function that ``make`` makes for each task.

    Caches that the function keeps end with the task, so a worker that goes on to other
    stages does not carry them along.
    """

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for batch in batches:
            yield function(batch)
        del function
        pa.default_memory_pool().release_unused()

    small_batches()
    return F.arrow_udf(work, kind)
