"""Whole jobs: read files, route them, hash, write, count, publish."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.operators import hash_fields, key_hash_dictionary
from maskwright.operators.dictionary import count_of_pairs
from maskwright.sources.quoted import read_quoted_lines
from maskwright.sources.records import UNIT, conform, read_records, write_records
from maskwright.sources.routing import (
    LINE,
    Routed,
    read_lines,
    split_by_unit,
    split_files,
    split_readable,
    unit_column,
)
from maskwright.sources.unit_schemas import groups_by_schema

_LINE_FORMATS = ("json", "csv")
_ROUTED_FORMATS = ("json", "csv", "xml")
_WHOLE_FORMATS = ("parquet", "orc", "avro")


@dataclass(frozen=True)
class Source:
    """Files to read. JSON, CSV and XML need a schema to tell bad records by; Parquet, ORC
    and Avro need one to set bad files aside, and without one a bad file ends the job.

    With ``discover`` every JSON file, or CSV file with a header, is read by a schema of its own.
    Records go to a folder ``schema=...`` of the sink for each schema found."""

    path: str
    fmt: str
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    discover: bool = False


@dataclass(frozen=True)
class Sink:
    """Where records go, and the unchanged lines of failed files, as Parquet. Of columnar
    files that failed only the names go there. ``counts_path`` gets the number of records
    written for each good file, as Parquet (unit, record_count).

    With ``manifest_path`` a job publishes all of these at once: they are written to a folder of
    the job's own in each path, which readers of the path pass over, and a last row in
    the manifest makes them part of what ``read_published`` reads. A job that ends before that
    leaves nothing to be seen."""

    path: str
    fmt: str
    failure_path: str | None = None
    counts_path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str = "errorifexists"
    manifest_path: str | None = None


@dataclass(frozen=True)
class Done:
    """Records written, and files that failed as a whole."""

    record_count: int
    failed_units: int


def hash_files(
    spark: SparkSession,
    source: Source,
    sink: Sink,
    mapping: Mapping[str, str],
    *,
    key: str,
    target: T.StructType | None = None,
    **settings,
) -> Done:
    """Files in, files with hashed fields out; ``settings`` as in ``hash_fields``.

    ``target`` is the schema to write. Its fields exist, as nulls, before the
    hashing, so that a mapping can fill them; others are dropped after it.
    """

    def hashed(records: DataFrame) -> DataFrame:
        if target is None:
            return hash_fields(records, mapping, key=key, **settings)
        wide = conform(records, target, keep_extra=True)
        return conform(hash_fields(wide, mapping, key=key, **settings), target)

    return _run(spark, source, sink, hashed, lambda schema: F.lit(1).cast("bigint"))


def dictionary_of_files(
    spark: SparkSession,
    source: Source,
    sink: Sink,
    paths: Mapping[str, str],
    *,
    key: str,
    **settings,
) -> Done:
    """Files in, their token dictionary out; ``settings`` as in ``key_hash_dictionary``."""
    return _run(
        spark,
        source,
        sink,
        lambda df: key_hash_dictionary(df, paths, key=key, **settings),
        lambda schema: count_of_pairs(schema, paths, settings.get("attributes")),
    )


@dataclass(frozen=True)
class Published:
    """What the jobs of a manifest have written: records, a table for each format and schema;
    the lines of failed files, and counts; None for what no job has written."""

    tables: list[DataFrame]
    failure: DataFrame | None
    counts: DataFrame | None

    @property
    def records(self) -> DataFrame | None:
        if len(self.tables) > 1:
            raise ValueError("the jobs of the manifest have written records of several kinds")
        return self.tables[0] if self.tables else None


_MANIFEST = (
    "job string, fmt string, options map<string,string>, path string, schema string, "
    "failure_path string, counts_path string, record_count bigint, failed_units bigint"
)


def read_published(spark: SparkSession, manifest_path: str) -> Published:
    """The records, failures and counts of all jobs that have published in a manifest."""
    # A row for each job and schema.
    rows = spark.read.schema(_MANIFEST).json(manifest_path).collect()
    kinds: dict[tuple, list[str]] = {}
    for row in rows:
        if row["path"]:
            kind = row["fmt"], row["schema"], tuple(sorted(row["options"].items()))
            kinds.setdefault(kind, []).append(row["path"])

    def parquet(name: str) -> DataFrame | None:
        paths = {row[name] for row in rows if row[name]}
        return spark.read.parquet(*sorted(paths)) if paths else None

    tables = [
        spark.read.format(fmt)
        .schema(T.StructType.fromJson(json.loads(schema)))
        .options(**dict(options))
        .load(paths)
        for (fmt, schema, options), paths in kinds.items()
    ]
    return Published(tables, parquet("failure_path"), parquet("counts_path"))


def _staged(sink: Sink, job: str) -> Sink:
    """The sink with a folder of the job's own in each path."""

    def own(path: str | None) -> str | None:
        return path and f"{path.rstrip('/')}/_job-{job}"

    return replace(
        sink,
        path=own(sink.path),
        failure_path=own(sink.failure_path),
        counts_path=own(sink.counts_path),
    )


def _run(
    spark: SparkSession,
    source: Source,
    sink: Sink,
    operator: Callable[[DataFrame], DataFrame],
    made_of: Callable[[T.StructType], Column],
) -> Done:
    """``made_of`` is the number of records that one record gives, by the schema of it."""
    if sink.manifest_path is None:
        return _write(spark, source, sink, operator, made_of)[0]
    job = uuid.uuid4().hex
    own = _staged(sink, job)
    done, written = _write(spark, source, own, operator, made_of)
    failure = own.failure_path if done.failed_units else None
    counts = own.counts_path if written else None
    rows = [
        (job, sink.fmt, dict(sink.options), path, schema, failure, counts, done.record_count, done.failed_units)
        for path, schema in (written or {None: None}).items()
    ]
    # One file: it is there as a whole or not at all.
    manifest = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
    write_records(manifest, sink.manifest_path, "json", mode="append")
    return done


def _write(
    spark: SparkSession,
    source: Source,
    sink: Sink,
    operator: Callable[[DataFrame], DataFrame],
    made_of: Callable[[T.StructType], Column],
) -> tuple[Done, dict[str, str]]:
    """What was done, and for each path that records were written to their schema as JSON."""
    groups = _groups(spark, source, made_of)
    _may_fail(sum(routed.failed_units for _, routed in groups), sink)
    total, failed, written, mode = 0, 0, {}, sink.mode
    for folder, routed in groups:
        path = f"{sink.path}{folder}"
        if routed.records.columns:
            records = operator(routed.records)
            count = write_records(records, path, sink.fmt, mode=sink.mode, options=sink.options)
            written[path] = records.schema.json()
            total += count
            if source.fmt in _WHOLE_FORMATS and source.schema is not None:
                expected = routed.counts.agg(F.sum("record_count")).first()[0] or 0
                if count != expected:
                    raise RuntimeError(
                        f"{count} records written of {expected}: files changed or could not be "
                        f"read after they were checked; {path} is not whole"
                    )
            if sink.counts_path is not None:
                write_records(routed.counts, sink.counts_path, "parquet", mode=mode)
        if routed.failed_units:
            failure = routed.failure
            if source.fmt in _WHOLE_FORMATS:
                failure = failure.select(UNIT)
            write_records(failure, sink.failure_path, "parquet", mode="append" if failed else sink.mode)
            failed += routed.failed_units
        # Later groups add to what the first one has written.
        mode = "append"
    return Done(total, failed), written


def _groups(
    spark: SparkSession, source: Source, made_of: Callable[[T.StructType], Column]
) -> list[tuple[str, Routed]]:
    """Routed records, and the folder of the sink for them, for each schema."""
    if not source.discover:
        return [("", _route(spark, source, made_of))]
    fmt, options = source.fmt, source.options
    if source.schema is not None or fmt not in _LINE_FORMATS or _needs_files(fmt, options):
        raise ValueError("schemas are found in JSON lines, and in CSV with a header, without one given")
    read = read_quoted_lines if fmt == "csv" else read_lines
    groups = []
    for group in groups_by_schema(read(spark, source.path, options=options), fmt, options=options):
        if group.schema is None:
            nothing = spark.createDataFrame([], T.StructType())
            units = group.lines.select(UNIT).distinct().count()
            counts = spark.createDataFrame([], f"{UNIT} string, record_count bigint")
            failure = group.lines.select(UNIT, LINE)
            groups.append(("", Routed(nothing, nothing, failure, units, counts)))
            continue
        made = made_of(group.schema)
        routed = split_by_unit(group.lines, fmt, group.schema, options=options, made=made)
        name = hashlib.sha256(group.schema.json().encode()).hexdigest()[:16]
        groups.append((f"/schema={name}", routed))
    return groups


def _route(
    spark: SparkSession, source: Source, made_of: Callable[[T.StructType], Column]
) -> Routed:
    path, fmt, schema, options = source.path, source.fmt, source.schema, source.options
    if fmt in _ROUTED_FORMATS or fmt in _WHOLE_FORMATS and schema is not None:
        if not isinstance(schema, T.StructType):
            raise ValueError("a schema is needed to tell good records from bad ones")
        made = made_of(schema)
        if fmt in _WHOLE_FORMATS:
            return split_readable(spark, path, fmt, schema, options=options, made=made)
        if fmt not in _LINE_FORMATS or _needs_files(fmt, options):
            return split_files(spark, path, fmt, schema, options=options, made=made)
        read = read_quoted_lines if fmt == "csv" and _quotes(options) else read_lines
        lines = read(spark, path, options=options)
        return split_by_unit(lines, fmt, schema, options=options, made=made)
    # Without a schema nothing can fail but the job.
    records = read_records(spark, path, fmt, schema=schema, options=options)
    placed = records.select(unit_column().alias(UNIT), made_of(records.schema).alias("made"))
    counts = placed.groupBy(UNIT).agg(F.sum("made").alias("record_count"))
    return Routed(records, records, records.where(F.lit(False)), 0, counts)


def _may_fail(failed: int, sink: Sink) -> None:
    if failed and sink.failure_path is None:
        raise ValueError(f"{failed} files failed and there is no failure_path")


def _settings(options: Mapping[str, str]) -> dict[str, str]:
    return {name.lower(): str(value).lower() for name, value in options.items()}


def _needs_files(fmt: str, options: Mapping[str, str]) -> bool:
    """Whether records are more or other than lines that Spark can split by itself."""
    settings = _settings(options)
    encoding = settings.get("encoding", settings.get("charset", "utf-8"))
    if encoding.startswith(("utf-16", "utf-32", "utf16", "utf32")):
        return True
    if fmt != "csv":
        return settings.get("multiline") == "true"
    # Records in quotes can be cut out if lines end as usual and one character quotes.
    plain = settings.get("linesep", "\n") == "\n" and len(settings.get("quote", '"')) == 1
    return _quotes(options) and not plain


def _quotes(options: Mapping[str, str]) -> bool:
    settings = _settings(options)
    return "true" in (settings.get("header"), settings.get("multiline"))
