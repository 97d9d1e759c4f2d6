from __future__ import annotations

import pytest
from pyspark.sql import types as T

from maskwright import hash_fields
from maskwright.sources import read_lines, routing, split_by_unit, split_files
from maskwright.sources.routing import LINE
from maskwright.streaming import (
    start_routing,
    start_routing_files,
    start_writing,
    stream_files,
    stream_lines,
    stream_records,
)
from tests.fixtures import KEY

SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("size", "integer")

JSON = {
    "good.json": '{"id":1,"name":"a","size":1}\n\n{"id":2}\n',
    "cut.json": '{"id":3,"name":"b"}\n{"id":4,"na\n  \n{"id":5}\n',
    "type.json": '{"id":6}\n{"id":7,"size":"large"}\n',
    "blank.json": "\n  \n",
}
CSV = {
    "good.csv": "1,a,1\n2,b,2\n",
    "short.csv": "3,c,3\n4,d\n",
    "type.csv": "5,e,5\n6,f,many\n",
}


def put(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def outcome(routed):
    failed = sorted((r.unit.rsplit("/", 1)[1], r[LINE]) for r in routed.failure.collect())
    return sorted(r.id for r in routed.success.collect()), failed


def lines_of(files, *names):
    return sorted((n, line) for n in names for line in files[n].rstrip("\n").split("\n"))


@pytest.mark.parametrize("limit", [routing.BROADCAST_UNITS, 0])
def test_json(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(routing, "BROADCAST_UNITS", limit)
    routed = split_by_unit(read_lines(spark, put(tmp_path / "j", JSON)), "json", SCHEMA)
    assert routed.failed_units == 2
    assert outcome(routed) == ([1, 2], lines_of(JSON, "cut.json", "type.json"))
    plan = routed.success._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (limit > 0)
    assert routed.success.columns == ["unit", "id", "name", "size"]


def test_copies_of_a_line_spread_over_groups(spark, tmp_path):
    bad = "x" * 79
    files = {"hot.json": f"{bad}\n" * 100_000, "good.json": '{"id":1}\n'}
    folder = put(tmp_path / "h", files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        salted = routing.salted(read_lines(spark, folder).where(f"line = '{bad}'"))
        groups = salted.groupBy("__salt").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(groups) > 30 and max(g["count"] for g in groups) < 15_000


@pytest.mark.parametrize("limit", [routing.BROADCAST_UNITS, 0])
def test_maps_and_lists(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(routing, "BROADCAST_UNITS", limit)
    schema = T.StructType.fromDDL("m map<string,int>, l array<int>, s struct<a: int>")
    files = {"a.json": '{"m":{"k":1},"l":[1],"s":{"a":2}}\n', "b.json": '{"m":{"k":"x"}}\n'}
    folder = put(tmp_path / "m", files)
    for routed in (
        split_by_unit(read_lines(spark, folder), "json", schema),
        split_files(spark, folder, "json", schema),
    ):
        assert routed.records.collect() == [({"k": 1}, [1], (2,))]
        assert routed.failure.columns == ["unit", "line"] and routed.failure.count() == 1


def test_records_of_one_block_spread_over_groups(spark, tmp_path):
    text = "id,name,size\n" + "".join(f"{i},n{i},1\n" for i in range(5000))
    folder = put(tmp_path / "one", {"a.csv": text, "b.csv": "id,name,size\nx,y,z\n"})
    reader = spark.read.schema(SCHEMA).option("header", "true").csv(f"{folder}/a.csv")
    parsed = reader.selectExpr("'u' AS unit", "0L AS block", "struct(*) AS __record")
    groups = routing.salted(parsed).groupBy("__salt").count().collect()
    assert len(groups) == routing.SALTS and max(g["count"] for g in groups) < 60


def test_lines_without_blocks(spark, monkeypatch):
    monkeypatch.setattr(routing, "BROADCAST_UNITS", 0)
    rows = [("a", '{"id":1}'), ("b", "{"), ("b", "{}")]
    lines = spark.createDataFrame(rows, "unit string, line string")
    routed = split_by_unit(lines, "json", SCHEMA)
    assert [r.id for r in routed.records.collect()] == [1]
    assert sorted(routed.failure.collect()) == [("b", "{"), ("b", "{}")]


def test_csv(spark, tmp_path):
    routed = split_by_unit(read_lines(spark, put(tmp_path / "c", CSV)), "csv", SCHEMA)
    assert outcome(routed) == ([1, 2], lines_of(CSV, "short.csv", "type.csv"))
    rows = routed.success.orderBy("id").collect()
    assert [r[1:] for r in rows] == [(1, "a", 1), (2, "b", 2)]


def test_csv_options(spark, tmp_path):
    files = {"a.csv": "1;x;2\n", "b.csv": "1,x,2\n"}
    lines = read_lines(spark, put(tmp_path / "c", files))
    routed = split_by_unit(lines, "csv", SCHEMA, options={"sep": ";"})
    assert outcome(routed) == ([1], lines_of(files, "b.csv"))


def test_nothing_fails(spark, tmp_path):
    files = {"good.json": JSON["good.json"]}
    routed = split_by_unit(read_lines(spark, put(tmp_path / "g", files)), "json", SCHEMA)
    assert routed.failed_units == 0 and outcome(routed) == ([1, 2], [])
    assert "Join" not in routed.success._jdf.queryExecution().optimizedPlan().toString()


def test_folders_as_units(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "one", {"a": '{"id":1}\n', "b": '{"id":2}\n'})
    put(tmp_path / "in" / "two", {"a": '{"id":3}\n', "b": '{"id":\n'})
    routed = split_by_unit(read_lines(spark, f"{tmp_path}/in/*", folders=True), "json", SCHEMA)
    assert outcome(routed) == ([1, 2], [("two", '{"id":'), ("two", '{"id":3}')])


@pytest.mark.parametrize("limit", [routing.BROADCAST_UNITS, 0])
def test_files_with_a_header(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(routing, "BROADCAST_UNITS", limit)
    files = {name: "id,name,size\n" + text for name, text in CSV.items()}
    path = put(tmp_path / "h", files)
    routed = split_files(spark, path, "csv", SCHEMA, options={"header": "true"})
    assert outcome(routed) == ([1, 2], lines_of(files, "short.csv", "type.csv"))


def test_records_over_several_lines(spark, tmp_path):
    files = {
        "good.json": '[{"id":1,\n"name":"a"},\n{"id":2}]\n',
        "type.json": '[{"id":3},\n{"id":4,"size":"x"}]\n',
        "cut.json": '[{"id":5},\n{"id"\n',
    }
    path = put(tmp_path / "m", files)
    routed = split_files(spark, path, "json", SCHEMA, options={"multiLine": "true"})
    assert outcome(routed) == ([1, 2], lines_of(files, "type.json", "cut.json"))


def test_a_field_may_be_named_unit(spark, tmp_path):
    schema = T.StructType().add("unit", "string").add("line", "string")
    folder = put(tmp_path / "u", {"a.json": '{"unit":"m","line":"x"}\n'})
    for routed in (
        split_by_unit(read_lines(spark, folder), "json", schema),
        split_files(spark, folder, "json", schema),
    ):
        assert routed.records.collect() == [("m", "x")]


def test_settings_are_checked(spark, tmp_path):
    lines = read_lines(spark, put(tmp_path / "s", JSON))
    with pytest.raises(ValueError, match="schema"):
        split_by_unit(lines, "json", None)
    with pytest.raises(ValueError, match="split_files"):
        split_by_unit(lines, "xml", SCHEMA)


def hashed(df):
    return hash_fields(df, {"/name": "/name"}, key=KEY)


def test_stream_of_records(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": JSON["good.json"]})
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run():
        records = stream_records(spark, source, "json", SCHEMA, files_per_trigger=1, unit=True)
        query = start_writing(
            hashed(records), out, "parquet", checkpoint=checkpoint, available_now=True
        )
        query.awaitTermination()
        metrics = [p["observedMetrics"] for p in query.recentProgress]
        return [m["records"]["record_count"] for m in metrics if m]

    assert run() == [2]
    assert spark.read.parquet(out).count() == 2
    for name in ("b.json", "c.json"):
        (tmp_path / "in" / name).write_text('{"id":9,"name":"x"}\n')
    assert run() == [1, 1]
    batch = hashed(spark.read.schema(SCHEMA).json(source))
    assert sorted(spark.read.parquet(out).drop("unit").collect(), key=str) == sorted(
        batch.collect(), key=str
    )
    assert run() == []


@pytest.mark.parametrize("algorithm", ["crc32c", "crc32"])
def test_stream_through_every_operator(spark, tmp_path, algorithm):
    from maskwright import hash_lookup, key_hash_dictionary, nest_fields, project_fields

    source = put(tmp_path / "in", {"a.json": JSON["good.json"]})
    operators = [
        lambda df: hash_fields(df, {"/name": "/name"}, key=KEY, algorithm=algorithm),
        lambda df: key_hash_dictionary(df, {"a": "/name"}, key=KEY, algorithm=algorithm),
        lambda df: hash_lookup(df, ["name"], key=KEY),
        lambda df: nest_fields(df, {"/both": ["/id", "/name"]}),
        lambda df: project_fields(df, "/name"),
    ]
    for number, operator in enumerate(operators):
        records = stream_records(spark, source, "json", SCHEMA)
        out = f"{tmp_path}/{number}"
        query = start_writing(
            operator(records), f"{out}/data", "parquet", checkpoint=f"{out}/c", available_now=True
        )
        query.awaitTermination()
        batch = operator(spark.read.schema(SCHEMA).json(source))
        assert sorted(spark.read.parquet(f"{out}/data").collect(), key=str) == sorted(
            batch.collect(), key=str
        )


def test_stream_routing(spark, tmp_path):
    source = put(tmp_path / "in", JSON)
    success, failure = f"{tmp_path}/success", f"{tmp_path}/failure"

    def run(checkpoint):
        query = start_routing(
            stream_lines(spark, source, files_per_trigger=1),
            "json",
            SCHEMA,
            success_path=success,
            failure_path=failure,
            checkpoint=checkpoint,
            transform=hashed,
            available_now=True,
        )
        query.awaitTermination()

    # Another query, with a checkpoint of its own, leaves what is there alone.
    for number, checkpoint in enumerate((f"{tmp_path}/c1", f"{tmp_path}/c2"), 1):
        run(checkpoint)
        good = spark.read.parquet(success)
        assert sorted(r.id for r in good.collect()) == sorted([1, 2] * number)
        assert good.select("query_id").distinct().count() == number
        bad = spark.read.parquet(failure)
        names = lines_of(JSON, "cut.json", "type.json")
        found = sorted((r.unit.rsplit("/", 1)[1], r[LINE]) for r in bad.collect())
        assert found == sorted(names * number)
    # The last batch once more, as after a failure before it was committed.
    commits = sorted((tmp_path / "c2" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    (tmp_path / "c2" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()
    run(f"{tmp_path}/c2")
    assert sorted(r.id for r in spark.read.parquet(success).collect()) == [1, 1, 2, 2]
    assert spark.read.parquet(failure).count() == 2 * len(names)


def test_stream_of_files_that_are_no_lines(spark, tmp_path):
    files = {name: "id,name,size\n" + text for name, text in CSV.items()}
    source = put(tmp_path / "in", files)
    success, failure = f"{tmp_path}/success", f"{tmp_path}/failure"
    query = start_routing_files(
        stream_files(spark, source, files_per_trigger=2),
        "csv",
        SCHEMA,
        success_path=success,
        failure_path=failure,
        checkpoint=f"{tmp_path}/c",
        options={"header": "true"},
        available_now=True,
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(success).collect()) == [1, 2]
    bad = spark.read.parquet(failure).collect()
    assert sorted((r.unit.rsplit("/", 1)[1], r[LINE]) for r in bad) == lines_of(
        files, "short.csv", "type.csv"
    )


def test_blank_lines_are_no_records(spark, tmp_path):
    folder = put(tmp_path / "b", {"a.json": '{"id":1}\n\t\n \t\r\n', "b.json": '{"id":2}\n'})
    routed = split_by_unit(read_lines(spark, folder), "json", SCHEMA)
    assert outcome(routed) == ([1, 2], [])
    rows = sorted(routed.records.collect())
    assert rows == sorted(spark.read.schema(SCHEMA).json(folder).collect())
    folder = put(tmp_path / "c", {"a.csv": "1,a,1\n\t \n\x01\n#2,b,2\n"})
    options = {"comment": "#"}
    routed = split_by_unit(read_lines(spark, folder), "csv", SCHEMA, options=options)
    assert routed.records.collect() == spark.read.schema(SCHEMA).csv(folder, comment="#").collect()


def test_partition_folders(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for k in (1, 2):
        put(tmp_path / "p" / f"k={k}", {"a.json": f'{{"id":{k}}}\n'})
    folder = f"{tmp_path}/p"
    with_k = T.StructType().add("k", "string").add("id", "integer")
    for schema in (SCHEMA, with_k):
        expected = spark.read.schema(schema).json(folder)
        for routed in (
            split_by_unit(read_lines(spark, folder), "json", schema),
            split_files(spark, folder, "json", schema),
        ):
            assert sorted(routed.records.columns) == sorted(expected.columns)
            got = routed.records.select(expected.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("fmt", ["xml", "json"])
def test_a_file_of_bad_records_is_not_read_once_for_each(spark, tmp_path, fmt):
    records = range(300)
    if fmt == "xml":
        text = "<rs>" + "".join(f"<r><a>x{i}</a></r>" for i in records) + "</rs>"
        options = {"rowTag": "r"}
    else:
        text = "[" + ",".join(f'{{"a": "x{i}"}}' for i in records) + "]"
        options = {"multiLine": "true"}
    path = tmp_path / f"bad.{fmt}"
    path.write_text(text)
    files = spark._jvm.org.apache.hadoop.fs.FileSystem

    def read():
        every = files.getAllStatistics()
        return sum(one.getBytesRead() for one in every if one.getScheme() == "file")

    before = read()
    routed = split_files(spark, str(path), fmt, T.StructType.fromDDL("a bigint"), options=options)
    assert routed.failed_units == 1 and routed.counts.count() == 0
    assert read() - before < 40 * len(text)
