"""Reading, shaping, counting and writing record sets in any Spark format."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.plans.paths import field_named, name_folding, quoted

UNIT = "unit"
RECORDS = "records"


# Options that say which files are read and where their lines end. Readers of lines get
# these, parsers of lines the others.
READER_OPTIONS = frozenset(
    name.lower()
    for name in (
        "basePath", "encoding", "charset", "ignoreCorruptFiles", "ignoreMissingFiles", "lineSep",
        "modifiedAfter", "modifiedBefore", "pathGlobFilter", "recursiveFileLookup",
        "maxFilesPerTrigger", "maxBytesPerTrigger", "latestFirst", "maxFileAge", "fileNameOnly",
    )
)


def reader_options(options: Mapping[str, str] | None) -> dict[str, str]:
    return {k: v for k, v in (options or {}).items() if k.lower() in READER_OPTIONS}


def parser_options(options: Mapping[str, str] | None) -> dict[str, str]:
    return {k: v for k, v in (options or {}).items() if k.lower() not in READER_OPTIONS}


def read_records(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    *,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    unit: bool = False,
) -> DataFrame:
    """Records of any format that Spark can read: csv, json, parquet, orc, xml, text, avro.

    ``unit`` adds the input file of each record as a column of that name.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        raise _explained(error, fmt) from None
    return df.select("*", F.col("_metadata.file_path").alias(UNIT)) if unit else df


def _explained(error: Exception, fmt: str) -> Exception:
    if fmt == "avro":
        return ValueError("reading or writing avro needs the spark-avro module on the class path")
    return error


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, *, unit: bool = False
) -> DataFrame:
    """CSV without a header line, its columns in the order of the schema."""
    return read_records(spark, path, "csv", schema=schema, options={"header": "false"}, unit=unit)


def conform(df: DataFrame, target: T.StructType, *, keep_extra: bool = False) -> DataFrame:
    """The table with exactly the target's fields: missing ones null, others cast.

    ``keep_extra`` leaves the table's other columns behind them, so that fields
    can still be computed from those before a last ``conform`` drops them.
    Structs, also those in arrays, are matched field by field by name.
    """
    folded = name_folding()
    columns = []
    for field in target.fields:
        own = field_named(df.schema, field.name, folded)
        value = own and _conformed(F.col(quoted(own.name)), own.dataType, field.dataType, folded)
        columns.append(_or_null(value, field))
    if keep_extra:
        extra = [name for name in df.columns if not field_named(target, name, folded)]
        columns += [F.col(quoted(name)) for name in extra]
    return df.select(*columns)


def _or_null(value: Column | None, field: T.StructField) -> Column:
    missing = value is None
    return (F.lit(None).cast(field.dataType) if missing else value).alias(field.name)


def _conformed(
    value: Column, own: T.DataType, target: T.DataType, folded: Callable[[str], str]
) -> Column:
    if own == target:
        return value
    if isinstance(own, T.StructType) and isinstance(target, T.StructType):
        fields = []
        for field in target.fields:
            match = field_named(own, field.name, folded)
            inner = match and _conformed(
                value.getField(match.name), match.dataType, field.dataType, folded
            )
            fields.append(_or_null(inner, field))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(own, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(
            value,
            lambda element: _conformed(element, own.elementType, target.elementType, folded),
        )
    return value.cast(target)


def with_record_count(df: DataFrame, name: str = RECORDS) -> tuple[DataFrame, Observation]:
    """The table and an observation of its ``record_count``, filled by the first action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("record_count")), observation


def count_by_unit(df: DataFrame, unit: str = UNIT) -> DataFrame:
    """Records of each unit. Partial counts go through the shuffle, not records."""
    return df.groupBy(unit).agg(F.count(F.lit(1)).alias("record_count"))


def write_records(
    df: DataFrame,
    path: str,
    fmt: str,
    *,
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> int:
    """Write the table and return the number of records written, in one pass."""
    counted, observation = with_record_count(df)
    writer = counted.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(path)
    except AnalysisException as error:
        raise _explained(error, fmt) from None
    return observation.get["record_count"]
