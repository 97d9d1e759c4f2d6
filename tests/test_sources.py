from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright import hash_fields
from maskwright.sources import (
    MEMBER,
    MEMBER_INPUT,
    conform,
    count_by_unit,
    members,
    read_delimited,
    read_records,
    schema_from_avro,
    with_record_count,
    write_records,
)
from maskwright.sources.scratch import new_folder, shared_folder
from tests.fixtures import KEY

ROWS = [(1, "Ann", "x, \"y\""), (2, None, "line"), (3, "  ", "é")]
SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("note", "string")


@pytest.mark.parametrize(
    "fmt, options",
    [
        ("csv", {"header": "true"}),
        ("json", {}),
        ("parquet", {}),
        ("orc", {}),
        ("xml", {"rowTag": "r", "ignoreSurroundingSpaces": "false"}),
    ],
)
def test_round_trips(spark, tmp_path, fmt, options):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = f"{tmp_path}/{fmt}"
    assert write_records(df, path, fmt, options=options) == 3
    back = read_records(spark, path, fmt, schema=SCHEMA, options=options, unit=True)
    rows = [r[:2] for r in back.collect() if r.id != 3]
    assert sorted(rows) == [(1, "Ann"), (2, None)]
    assert back.where(F.col("unit").contains(f"/{fmt}/")).count() == 3
    assert {r.note for r in back.collect()} == {r[2] for r in ROWS}


def test_text(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    assert write_records(df, f"{tmp_path}/t", "text") == 2
    lines = read_records(spark, f"{tmp_path}/t", "text")
    assert sorted(r.value for r in lines.collect()) == ["a", "b"]


def test_avro_says_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    try:
        spark.read.format("avro").schema(SCHEMA).load(str(tmp_path))
        there = True
    except AnalysisException:
        there = False

    def write():
        return write_records(df, f"{tmp_path}/a", "avro")

    if there:
        assert write() == len(ROWS)
        read = read_records(spark, f"{tmp_path}/a", "avro", schema=SCHEMA)
        assert sorted(map(tuple, read.collect())) == sorted(ROWS)
        return
    with pytest.raises(ValueError, match="spark-avro"):
        write()
    with pytest.raises(ValueError, match="spark-avro"):
        read_records(spark, str(tmp_path), "avro", schema=SCHEMA)


def test_partitioned_write_and_modes(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert write_records(df, f"{tmp_path}/p", "parquet", partition_by=["id"]) == 3
    assert write_records(df, f"{tmp_path}/p", "parquet", mode="append") == 3
    with pytest.raises(Exception, match="exists"):
        write_records(df, f"{tmp_path}/p", "parquet")


def test_member_example(spark, tmp_path):
    fields = [{"name": name, "type": ["null", "string"]} for name in MEMBER.names]
    avro = json.dumps({"name": "member", "type": "record", "fields": fields})
    assert schema_from_avro(avro) == MEMBER

    source = members(spark, 1000, seed=1)
    assert source.schema.names == MEMBER_INPUT.names
    write_records(source, f"{tmp_path}/m", "csv", options={"header": "false"})
    records = conform(read_delimited(spark, f"{tmp_path}/m", MEMBER_INPUT), MEMBER)
    mapping = {"/hashed_first_name": "/first_name", "/hashed_last_name": "/last_name"}
    hashed = hash_fields(records, mapping, key=KEY)
    assert hashed.schema == MEMBER
    row = hashed.agg(
        F.count("*").alias("n"),
        F.count_distinct("first_name").alias("first"),
        F.count_distinct("hashed_first_name").alias("hashed"),
        F.max(F.length("hashed_last_name")).alias("length"),
    ).first()
    assert (row.n, row.length) == (1000, 64) and row.first == row.hashed == 20


def test_avro_types():
    inner = [{"name": "e", "type": {"type": "bytes"}}]
    avro = {
        "type": "record",
        "name": "r",
        "fields": [
            {"name": "a", "type": "long"},
            {"name": "b", "type": ["null", {"type": "array", "items": ["null", "double"]}]},
            {"name": "c", "type": {"type": "map", "values": "boolean"}},
            {"name": "d", "type": {"type": "record", "name": "s", "fields": inner}},
        ],
    }
    assert schema_from_avro(avro) == T.StructType(
        [
            T.StructField("a", T.LongType(), False),
            T.StructField("b", T.ArrayType(T.DoubleType(), True), True),
            T.StructField("c", T.MapType(T.StringType(), T.BooleanType(), False), False),
            T.StructField("d", T.StructType([T.StructField("e", T.BinaryType(), False)]), False),
        ]
    )
    for bad in ('"string"', '{"type":"record","fields":[{"name":"x","type":["int","string"]}]}',
                '{"type":"record","fields":[{"name":"x","type":"duration"}]}'):
        with pytest.raises(ValueError):
            schema_from_avro(bad)


def test_members_are_repeatable(spark):
    first = members(spark, 500, seed=3)
    again = members(spark, 500, seed=3).repartition(7)
    assert sorted(first.collect()) == sorted(again.collect())
    assert first.exceptAll(members(spark, 500, seed=4)).count() == 500
    assert first.where(~F.col("phone_number").rlike(r"^\d{3}-\d{3}-\d{4}$")).count() == 0
    assert first.where(~F.col("member_id").rlike(r"^\d{16}$")).count() == 0
    assert first.select("member_id").distinct().count() == 500
    own = members(spark, 50, first_names=["A"], last_names=["B", "C"]).distinct()
    assert {r.first_name for r in own.collect()} == {"A"}
    assert {r.parent_name for r in own.collect()} == {"B", "C"}


def test_conform(spark):
    df = spark.sql(
        "SELECT 1 AS ID, 'x' AS extra, named_struct('p', 1, 'q', 2) AS s, "
        "array(named_struct('p', 1)) AS l, CAST(NULL AS STRUCT<p: INT>) AS n"
    )
    target = T.StructType.fromDDL(
        "id string, added double, s struct<q: bigint, r: string>, "
        "l array<struct<r: string, p: int>>, n struct<p: string>"
    )
    result = conform(df, target)
    assert result.schema.simpleString() == target.simpleString()
    assert result.first() == ("1", None, (2, None), [(None, 1)], None)
    assert conform(df, target, keep_extra=True).columns == [*target.names, "extra"]


def test_counts(spark, tmp_path):
    df = spark.range(30).select("id", (F.col("id") % 3).alias("g"))
    counted, observation = with_record_count(df.where("id < 20"))
    counted.write.format("noop").mode("overwrite").save()
    assert observation.get["record_count"] == 20
    df.coalesce(1).write.partitionBy("g").parquet(f"{tmp_path}/c")
    units = count_by_unit(read_records(spark, f"{tmp_path}/c", "parquet", unit=True)).collect()
    assert sorted(u.record_count for u in units) == [10, 10, 10]


def test_scratch_is_below_the_checkpoint_folder(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_folder(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_folder(spark) == configured
