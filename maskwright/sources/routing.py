"""All-or-nothing routing: a unit with one unreadable record fails as a whole.

A unit is an input file, or a folder of part files. Lines are read as text and
parsed by ``from_json``/``from_csv``, so that a failed unit comes out as the
unchanged lines it came in as.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import orc, parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.plans.paths import name_folding, quoted
from maskwright.sources.records import UNIT, parser_options, reader_options
from maskwright.sources.scratch import shared_folder

LINE = "line"
BLOCK = "block"
#: Whether a line is a file's header and no record.
HEADER = "header_line"
_RECORD = "__record"
_CORRUPT = "__corrupt"
_SALT = "__salt"
PARTITION = "__partition"
_ID = "__id"
_FILE = "__file"

# Failed units are broadcast up to this number, as hashes of 8 bytes each, and joined by
# a shuffle beyond it, where each unit is spread over this many groups.
BROADCAST_UNITS = 2_000_000
SALTS = 256


@dataclass(frozen=True)
class Routed:
    """``success``: the records of good units, with their unit; ``records``: the
    same without it. ``failure``: the raw lines of failed units, with their unit.
    ``failed_units``: how many of those there are. ``counts``: the number of records of each
    good unit, or of what ``made`` says each record gives; known when the units are."""

    success: DataFrame
    records: DataFrame
    failure: DataFrame
    failed_units: int
    counts: DataFrame


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    *,
    options: Mapping[str, str] | None = None,
    folders: bool = False,
) -> DataFrame:
    """The lines of text files, each with its unit and the start of its block there.

    Of ``options`` those count that say which files are read, where their lines end
    and how they are encoded. The columns of partition folders come along.
    """
    lines = spark.read.options(**line_options(options)).text(path)
    return with_places(lines, options, folders)


def line_options(options: Mapping[str, str] | None) -> dict[str, str]:
    """The options of a reader of lines; it reads bytes, which are decoded afterwards."""
    given = reader_options(options)
    encoding = _encoding(options)
    if encoding not in ("UTF-8", "UTF8", "US-ASCII", "ISO-8859-1", "WINDOWS-1252"):
        raise ValueError(f"lines in {encoding} can't be routed; use split_files")
    return {k: v for k, v in given.items() if k.lower() not in ("encoding", "charset")}


def _encoding(options: Mapping[str, str] | None) -> str:
    named = {k.lower(): v for k, v in (options or {}).items()}
    return str(named.get("encoding", named.get("charset", "UTF-8"))).upper()


def with_places(
    lines: DataFrame, options: Mapping[str, str] | None = None, folders: bool = False
) -> DataFrame:
    """Lines as Spark's text source gives them, in the form that routing takes."""
    line = F.col("value")
    if not _encoding(options).startswith("UTF"):
        line = F.decode(line.cast("binary"), _encoding(options))
    parts = [F.col(quoted(name)) for name in lines.columns if name != "value"]
    partition = [F.struct(*parts).alias(PARTITION)] if parts else []
    return lines.select(*place_columns(folders), line.alias(LINE), *partition)


def place_columns(folders: bool = False) -> list[Column]:
    block = F.col("_metadata.file_block_start").alias(BLOCK)
    return [unit_column(folders).alias(UNIT), block]


def unit_column(folders: bool = False) -> Column:
    """The file a row comes from, or the folder of that file."""
    file = F.col("_metadata.file_path")
    return F.regexp_replace(file, "/[^/]*$", "") if folders else file


def split_by_unit(
    lines: DataFrame,
    fmt: str,
    schema: T.StructType,
    *,
    options: Mapping[str, str] | None = None,
    made: Column | None = None,
) -> Routed:
    """Split lines of JSON or CSV records into those of good and of failed units.

    ``made``, over the fields of a record, says how many it counts for in ``counts``.
    Fields that are columns of partition folders are taken from these; folder columns
    that are not in the schema come after its fields.
    """
    checked = _with_corrupt(schema)
    partition = _partition(lines)
    folded = name_folding()
    own = {folded(name) for name in partition}
    in_lines = T.StructType([f for f in checked.fields if folded(f.name) not in own])
    record = _parse(fmt, in_lines, _permissive(parser_options(options)))
    kept = lines.where(is_record(fmt, options))
    if HEADER in lines.columns:
        kept = kept.where(~F.col(HEADER))
    parsed = kept.withColumn(_RECORD, record)
    return _route(parsed, F.lit(True), schema, lines, partition, made=made)


def _partition(lines: DataFrame) -> list[str]:
    return lines.schema[PARTITION].dataType.names if PARTITION in lines.columns else []


def is_record(fmt: str, options: Mapping[str, str] | None) -> Column:
    """Whether a line is more than what the format's own reader passes over."""
    if fmt != "csv":
        return F.rtrim(F.col(LINE), F.lit(" \t\r\n")) != ""
    # Everything up to the space, as in Java's trim.
    blank = F.lit("".join(map(chr, range(33))))
    kept = F.rtrim(F.col(LINE), blank) != ""
    comment = {k.lower(): v for k, v in (options or {}).items()}.get("comment")
    return kept & ~F.col(LINE).startswith(comment) if comment else kept


def split_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: T.StructType,
    *,
    options: Mapping[str, str] | None = None,
    folders: bool = False,
    made: Column | None = None,
) -> Routed:
    """The same for files whose records are not their lines: CSV with a header,
    JSON over several lines, XML."""
    checked, given = _with_corrupt(schema), _permissive(options)
    record = F.struct("*").alias(_RECORD)

    def loaded_by(read_as: T.StructType, mode: str) -> DataFrame:
        reader = spark.read.format(fmt).schema(read_as).options(**{**given, "mode": mode})
        return reader.load(path).select(*place_columns(folders), record)

    kept = None
    if _reads_again(fmt, options):
        parsed, kept = loaded_by(schema, given["mode"]), loaded_by(schema, "DROPMALFORMED")
    else:
        parsed = loaded_by(checked, given["mode"])
    # Spark converts only the fields a query uses, and finds only their errors.
    # This comparison always holds, but makes it convert all of them.
    texts = [F.col(_RECORD)[field.name].cast("string") for field in schema.fields]
    all_read = F.xxhash64(*texts) >= F.lit(-(2**63))
    named = {name_folding()(field.name) for field in schema.fields}
    loaded = [n for n in parsed.schema[_RECORD].dataType.names if n != _CORRUPT]
    extra = [name for name in loaded if name_folding()(name) not in named]
    found = {k: v for k, v in reader_options(options).items() if k.lower() != "linesep"}
    lines = read_lines(spark, path, options=found, folders=folders)
    return _route(parsed, all_read, schema, lines, [], extra, made, kept)


def _reads_again(fmt: str, options: Mapping[str, str] | None) -> bool:
    """Whether the format's reader reads a file again for the text of each bad record in it.

    That takes time in the square of these. So their text is not asked for: a unit has failed
    if a reader that drops bad records gives fewer than one that keeps them.
    """
    many = {k.lower(): str(v).lower() for k, v in (options or {}).items()}.get("multiline")
    return fmt.lower() == "xml" or (fmt.lower() == "json" and many == "true")


#: Files without any record that are at most so large are opened to see whether that is so.
NO_RECORDS = 16 << 20


def split_readable(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: T.StructType,
    *,
    options: Mapping[str, str] | None = None,
    made: Column | None = None,
) -> Routed:
    """The records of files that can be read to their end, and the names of the others.

    For Parquet, ORC and Avro, whose files are bad as a whole if they are; ``failure`` has no
    lines. Each task reads the values of its files as far as they go. A file is good if that
    gives as many records as the file says it has; a file without records is opened to
    see that it has none. So one pass finds any number of bad files.

    Files are read past their faults here and later on, so ``counts`` must be compared with what
    is written: a fault of the storage itself would leave records out.
    """
    if not isinstance(schema, T.StructType) or not schema.fields:
        raise ValueError("a schema is needed to tell good files from bad ones")
    shared_folder(spark)
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    records = reader.option("ignoreCorruptFiles", "true").load(path)
    own = F.col("_metadata.file_path")
    # A file's own number of records needs no values, only what stands at its end.
    told = records.groupBy(own.alias(_FILE)).agg(F.count(F.lit(1)).alias("told"))
    values = F.xxhash64(*(F.col(quoted(name)).cast("string") for name in schema.names))
    found = records.select(
        own.alias(_FILE), values.alias("values"), (F.lit(1) if made is None else made).alias("made")
    )
    found = found.groupBy(_FILE).agg(
        F.count(F.lit(1)).alias("found"),
        F.sum("made").cast("bigint").alias("record_count"),
        # Makes the tasks read all values.
        F.max("values").alias("values"),
    )
    listed = _files(spark, path, options)
    units = (
        listed.select(own.alias(_FILE), F.col("_metadata.file_size").alias("size"))
        .join(told, _FILE, "left")
        .join(found, _FILE, "left")
        .withColumn("failed", ~F.coalesce(F.col("told") == F.col("found"), F.lit(False)))
        .checkpoint()
    )
    silent = units.where("told IS NULL AND found IS NULL")
    if silent.take(1):
        units = _opened(listed, fmt, silent, units).checkpoint()
    made = F.coalesce("record_count", F.lit(0)).alias("record_count")
    units = units.select(F.col(_FILE).alias(UNIT), "failed", made)
    placed = records.select(own.alias(UNIT), F.struct("*").alias(_RECORD))
    names = units.select(UNIT, F.lit(None).cast("string").alias(LINE))
    fields = [F.col(_RECORD)[name].alias(name) for name in records.columns]
    return _routed(units, placed, names, fields)


def _files(
    spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None
) -> DataFrame:
    """The files themselves. Their content is read only where it is selected."""
    return spark.read.format("binaryFile").options(**reader_options(options)).load(path)


def _opened(listed: DataFrame, fmt: str, silent: DataFrame, units: DataFrame) -> DataFrame:
    """Units whose silent files have failed only if they hold something else than no records."""

    def empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [
                name
                for name, content in zip(*(c.to_pylist() for c in batch.columns))
                if _has_no_records(fmt, content)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], [_ID])

    small = listed.where(F.col("length") <= NO_RECORDS)
    small = small.select(F.col("_metadata.file_path").alias(_FILE), "content")
    contents = small.join(silent.select(_FILE), _FILE, "left_semi")
    none = contents.mapInArrow(empty, f"{_ID} string")
    return units.join(none, F.col(_FILE) == F.col(_ID), "left").withColumn(
        "failed", F.col("failed") & F.col(_ID).isNull()
    )


def _has_no_records(fmt: str, content: bytes) -> bool:
    source = pa.BufferReader(content)
    try:
        if fmt == "parquet":
            return parquet.read_metadata(source).num_rows == 0
        if fmt == "orc":
            return orc.ORCFile(source).nrows == 0
    except (pa.ArrowException, OSError, ValueError):
        return False
    return content.startswith(b"Obj\x01")


def _route(
    parsed: DataFrame,
    all_read: Column,
    schema: T.StructType,
    lines: DataFrame,
    partition: list[str],
    extra: list[str] | None = None,
    made: Column | None = None,
    kept: DataFrame | None = None,
) -> Routed:
    """A first job finds the failed units. Each task reduces its lines to one flag and one count
    for each unit before anything is shuffled, so one huge file is no hot spot. What it
    finds is written to the checkpoint folder. ``kept`` are the same records without bad ones, for
    formats that are read without marks at these.
    """
    shared_folder(lines.sparkSession)
    fields = _fields(schema, partition)
    fields += [F.col(_RECORD)[name].alias(name) for name in extra or []]
    marked = all_read if kept is not None else F.col(_RECORD)[_CORRUPT].isNotNull() & all_read
    flagged = parsed.select(F.col(UNIT).alias(_FILE), marked.alias(_CORRUPT), *fields)
    counted = F.sum(F.lit(1) if made is None else made).cast("bigint")
    units = flagged.groupBy(F.col(_FILE).alias(UNIT)).agg(
        F.count_if(_CORRUPT).alias("marked"), counted.alias("record_count")
    )
    if kept is None:
        units = units.withColumn("failed", F.col("marked") > 0)
    else:
        whole = kept.groupBy(UNIT).agg(F.count_if(all_read).alias("whole"))
        fewer = F.col("marked") > F.coalesce("whole", F.lit(0))
        units = units.join(whole, UNIT, "left").withColumn("failed", fewer)
    units = units.select(UNIT, "failed", "record_count")
    return _routed(units.checkpoint(), parsed, lines, fields)


def _routed(
    units: DataFrame, parsed: DataFrame, lines: DataFrame, fields: list[Column]
) -> Routed:
    """Records and lines parted by what is known of all units (unit, failed, record_count). Their
    number decides the plan: no join without failed units, a broadcast of hashes, or a
    salted, shuffled join of very many.
    """
    named = F.xxhash64(UNIT)
    every, names, count = units.agg(
        F.count(UNIT), F.count_distinct(named), F.coalesce(F.count_if("failed"), F.lit(0))
    ).first()
    bad = units.where("failed").select(UNIT)
    if not count:
        good, failure = parsed, lines.where(F.lit(False))
    elif count <= BROADCAST_UNITS and names == every:
        # No two units share a hash, so hashes stand for units.
        ids = F.broadcast(bad.select(named.alias(_ID)))
        good = parsed.join(ids, named == F.col(_ID), "left_anti")
        failure = lines.join(ids, named == F.col(_ID), "left_semi")
    else:
        # Every group gets the whole list, so which group a row is in does not matter.
        on = [UNIT, _SALT]
        bad = bad.select(UNIT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(_SALT))
        good = salted(parsed).join(bad, on, "left_anti")
        failure = salted(lines).join(bad, on, "left_semi")
    return Routed(
        good.select(UNIT, *fields),
        good.select(*fields),
        failure.select(UNIT, LINE),
        count,
        units.where("NOT failed").select(UNIT, "record_count"),
    )


def salted(df: DataFrame) -> DataFrame:
    """A group for each row, the same whenever it is computed: by its place in the
    unit, so that copies of one line spread too, and by the line or record."""
    spread = [F.col(name) for name in (BLOCK, LINE) if name in df.columns]
    if LINE not in df.columns:
        # A file that can't be split has one block only.
        spread.append(F.to_json(_RECORD))
    return df.withColumn(_SALT, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))


def _fields(schema: T.StructType, partition: list[str]) -> list[Column]:
    folded = name_folding()
    folders = {folded(name): name for name in partition}
    columns = []
    for field in schema.fields:
        name = folders.pop(folded(field.name), None)
        value = F.col(_RECORD)[field.name] if name is None else F.col(PARTITION)[name]
        columns.append((value if name is None else value.cast(field.dataType)).alias(field.name))
    return columns + [F.col(PARTITION)[name].alias(name) for name in folders.values()]


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if not isinstance(schema, T.StructType) or not schema.fields:
        raise ValueError("a schema is needed to tell good records from bad ones")
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _permissive(options: Mapping[str, str] | None) -> dict[str, str]:
    return {
        **(options or {}),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
    }


def _parse(fmt: str, schema: T.StructType, options: Mapping[str, str]) -> Column:
    if fmt == "json":
        return F.from_json(LINE, schema, options)
    if fmt == "csv":
        return F.from_csv(LINE, schema.toDDL(), options)
    raise ValueError(f"lines are json or csv records, not {fmt!r}; use split_files")
