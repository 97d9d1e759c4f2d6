"""The same operators on streams of files: append only, and stateless but for distinct pairs.

Operators take and return DataFrames, so they apply to a streaming one as they
are. What differs is here: the source, the sink, distinct pairs, and routing batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from maskwright.sources.records import RECORDS, UNIT
from maskwright.sources.routing import (
    Routed,
    line_options,
    split_by_unit,
    split_files,
    unit_column,
    with_places,
)


def stream_records(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    *,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    unit: bool = False,
) -> DataFrame:
    """Records of files as they arrive; ``files_per_trigger=1`` gives one unit at a time."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    df = _limited(reader, files_per_trigger).load(path)
    return df.select("*", unit_column().alias(UNIT)) if unit else df


def stream_lines(
    spark: SparkSession,
    path: str,
    *,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    folders: bool = False,
) -> DataFrame:
    """Lines of text files as they arrive, each with its file or folder, for
    ``start_routing``; ``options`` as in ``read_lines``."""
    reader = spark.readStream.format("text").options(**line_options(options))
    return with_places(_limited(reader, files_per_trigger).load(path), options, folders)


def stream_files(
    spark: SparkSession,
    path: str,
    *,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int = 100,
) -> DataFrame:
    """Paths of files as they arrive, for ``start_routing_files``. Nothing is read yet."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).options(**(options or {}))
    return _limited(reader, files_per_trigger).load(path).select("path")


def _limited(reader, files_per_trigger: int | None):
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def start_writing(
    df: DataFrame,
    path: str,
    fmt: str,
    *,
    checkpoint: str,
    available_now: bool = False,
    options: Mapping[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append the stream to files. ``available_now`` stops when the input is used up.

    The progress of each batch has its ``record_count``, under ``observedMetrics``.

    ``state_partitions`` is for streams with state, such as distinct pairs. Each batch commits
    all partitions of the state, however few rows it has, so as many as there are cores do;
    without it Spark takes ``spark.sql.shuffle.partitions``. The session has that setting back
    once the stream is started; a checkpoint keeps the number that it began with.
    """
    counted = df.observe(RECORDS, F.count(F.lit(1)).alias("record_count"))
    writer = counted.writeStream.format(fmt).outputMode("append").options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    with _shuffle_partitions(df.sparkSession, state_partitions):
        return _triggered(writer, available_now).start()


@contextmanager
def _shuffle_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """That setting for as long as a stream takes to copy the session."""
    if number is None:
        yield
        return
    before = spark.conf.get(_SHUFFLE_PARTITIONS)
    spark.conf.set(_SHUFFLE_PARTITIONS, str(number))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_PARTITIONS, before)


_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PAIR = "__pair"


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs of a streaming dictionary, or any rows, each once over all batches and restarts.

    The state holds 32 bytes for each pair seen, SHA-256 of its columns, in the keys of Spark's
    state store: kept on disk by RocksDB, whose filters tell most new pairs without a look-up, and
    whose keys decide. It grows with the distinct pairs. Sessions that name no other store
    get RocksDB, as the one on the heap would hold all of it in memory.
    """
    spark = pairs.sparkSession
    if spark.conf.get(_STATE_STORE, _ON_HEAP).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_STORE, _ROCKS_DB)
    name = _PAIR
    while name in pairs.columns:
        name += "_"
    # As JSON, so that no two pairs look alike.
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    known = pairs.withColumn(name, F.unhex(F.sha2(text, 256)))
    return known.dropDuplicates([name]).drop(name)


def start_routing(
    lines: DataFrame,
    fmt: str,
    schema: T.StructType,
    *,
    success_path: str,
    failure_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda records: records,
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Route each arriving file as a whole: transformed records or unchanged lines.

    Both go to Parquet, in one ``query_id=q/batch_id=n`` folder for each micro-batch.
    The id of a query is in its checkpoint, so a batch that is run again after a failure
    overwrites its own folder and every record is there once, while another query may
    write to the same place. A batch is read three times and never cached, as it may be
    the whole backlog.
    """

    def routed(batch: DataFrame) -> Routed:
        return split_by_unit(batch, fmt, schema, options=options)

    return _start(lines, routed, success_path, failure_path, checkpoint, transform, available_now)


def start_routing_files(
    files: DataFrame,
    fmt: str,
    schema: T.StructType,
    *,
    success_path: str,
    failure_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda records: records,
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """The same for the files of ``stream_files`` whose records are not their lines: XML,
    CSV with a header, JSON over several lines. A batch has as many paths as the stream
    allows."""

    def routed(batch: DataFrame) -> Routed:
        paths = [row["path"] for row in batch.collect()]
        return split_files(batch.sparkSession, paths, fmt, schema, options=options)

    return _start(files, routed, success_path, failure_path, checkpoint, transform, available_now)


def _start(
    source: DataFrame,
    routed: Callable[[DataFrame], Routed],
    success_path: str,
    failure_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    available_now: bool,
) -> StreamingQuery:
    def route(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        found = routed(batch)
        folder = f"query_id={_query_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}"
        for df, path in ((transform(found.success), success_path), (found.failure, failure_path)):
            df.write.mode("overwrite").parquet(f"{path}/{folder}")

    writer = source.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave a query, which stays the same when it is started again."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer
