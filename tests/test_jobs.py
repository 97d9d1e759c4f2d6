from __future__ import annotations

import pytest
from pyspark.sql import types as T

from maskwright.jobs import Done, Sink, Source, dictionary_of_files, hash_files, read_published
from maskwright.sources import MEMBER, MEMBER_INPUT, members, write_records
from maskwright.sources.routing import read_lines, split_by_unit, split_readable
from tests.fixtures import DIGESTS, KEY, VALUE
from tests.test_routing import CSV, JSON, SCHEMA, put


def test_csv_members_to_json(spark, tmp_path):
    write_records(members(spark, 200), f"{tmp_path}/in", "csv", options={"header": "false"})
    done = hash_files(
        spark,
        Source(f"{tmp_path}/in", "csv", MEMBER_INPUT),
        Sink(f"{tmp_path}/out", "json"),
        {"/hashed_first_name": "/first_name", "/hashed_last_name": "/last_name"},
        key=KEY,
        target=MEMBER,
    )
    assert done == Done(200, 0)
    written = spark.read.schema(MEMBER).json(f"{tmp_path}/out")
    assert written.where("length(hashed_first_name) = 64 AND first_name <> ''").count() == 200


def test_a_source_field_may_be_missing_from_the_target(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": f'{{"name":"{VALUE}"}}\n'})
    target = T.StructType().add("token", "string")
    done = hash_files(
        spark,
        Source(source, "json", T.StructType().add("name", "string")),
        Sink(f"{tmp_path}/out", "parquet"),
        {"/token": "/name"},
        key=KEY,
        target=target,
        algorithm="crc32c",
    )
    assert done.record_count == 1
    written = spark.read.parquet(f"{tmp_path}/out")
    assert written.collect() == [(DIGESTS["hash-crc32c"],)] and written.columns == ["token"]


def test_failed_files_are_set_aside(spark, tmp_path):
    source = Source(put(tmp_path / "in", JSON), "json", SCHEMA)
    sink = Sink(f"{tmp_path}/out", "orc", failure_path=f"{tmp_path}/failed")
    done = hash_files(spark, source, sink, {"/name": "/name"}, key=KEY)
    assert done == Done(2, 2)
    assert sorted(r.id for r in spark.read.orc(sink.path).collect()) == [1, 2]
    assert spark.read.parquet(sink.failure_path).count() == 6
    with pytest.raises(ValueError, match="2 files failed"):
        hash_files(spark, source, Sink(f"{tmp_path}/more", "orc"), {"/name": "/name"}, key=KEY)
    assert not (tmp_path / "more").exists()


def test_dictionary_of_files_with_a_header(spark, tmp_path):
    files = {name: "id,name,size\n" + text for name, text in CSV.items()}
    done = dictionary_of_files(
        spark,
        Source(put(tmp_path / "in", files), "csv", SCHEMA, {"header": "true"}),
        Sink(f"{tmp_path}/out", "parquet", failure_path=f"{tmp_path}/failed"),
        {"n": "/name", "s": "/size"},
        key=KEY,
        hash_name="token",
    )
    # Written records are pairs: two for each of two good rows.
    assert done == Done(4, 2)
    assert spark.read.parquet(f"{tmp_path}/out").columns == ["token", "plaintext"]


def test_columnar_files(spark, tmp_path):
    spark.createDataFrame([(VALUE,)], "v string").write.parquet(f"{tmp_path}/in")
    sink = Sink(f"{tmp_path}/out", "csv")
    source = Source(f"{tmp_path}/in", "parquet")
    assert hash_files(spark, source, sink, {"/v": "/v"}, key=KEY) == Done(1, 0)
    assert spark.read.csv(sink.path).first()[0] == DIGESTS["hash-sha256"]


def test_counts_by_unit(spark, tmp_path):
    def counts(path):
        rows = spark.read.parquet(path).collect()
        return {r.unit.rsplit("/", 1)[1]: r.record_count for r in rows}

    files = {**JSON, "two.json": '{"id":8,"name":"x"}\n{"id":9,"name":""}\n{"id":10}\n'}
    source = Source(put(tmp_path / "in", files), "json", SCHEMA)
    paths = {name: f"{tmp_path}/{name}" for name in ("a", "fa", "ca", "b", "fb", "cb", "c", "cc")}
    sink = Sink(paths["a"], "json", paths["fa"], paths["ca"])
    assert hash_files(spark, source, sink, {"/name": "/name"}, key=KEY) == Done(5, 2)
    assert counts(paths["ca"]) == {"good.json": 2, "two.json": 3}
    sink = Sink(paths["b"], "json", paths["fb"], paths["cb"])
    done = dictionary_of_files(spark, source, sink, {"i": "/id", "n": "/name"}, key=KEY)
    # Pairs, without those of null and empty values.
    assert done == Done(7, 2) and counts(paths["cb"]) == {"good.json": 3, "two.json": 4}
    spark.read.json(paths["a"]).coalesce(1).write.parquet(f"{tmp_path}/p")
    sink = Sink(paths["c"], "orc", counts_path=paths["cc"])
    assert hash_files(spark, Source(f"{tmp_path}/p", "parquet"), sink, {"/name": "."}, key=KEY).record_count == 5
    assert list(counts(paths["cc"]).values()) == [5]


def test_a_schema_is_needed(spark, tmp_path):
    source = Source(put(tmp_path / "in", JSON), "json")
    with pytest.raises(ValueError, match="schema"):
        hash_files(spark, source, Sink("x", "orc"), {"/a": "/a"}, key=KEY)



@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_reader_options_hold_in_jobs(spark, tmp_path, fmt):
    def line(number, name):
        return f'{{"id":{number},"name":"{name}"}}' if fmt == "json" else f"{number},{name},"

    def job(name, options):
        source = Source(f"{tmp_path}/{name}", fmt, SCHEMA, options)
        sink = Sink(f"{tmp_path}/{name}-out", "parquet", failure_path=f"{tmp_path}/{name}-bad")
        done = hash_files(spark, source, sink, {"/size": "/name"}, key=KEY)
        written = spark.read.parquet(sink.path)
        return done, sorted((r["id"], r["name"]) for r in written.collect())

    put(tmp_path / "deep", {f"a.{fmt}": line(1, "x") + "\n"})
    put(tmp_path / "deep" / "more", {f"b.{fmt}": line(2, "y") + "\n"})
    assert job("deep", {"recursiveFileLookup": "true"}) == (Done(2, 0), [(1, "x"), (2, "y")])
    put(tmp_path / "glob", {f"a.{fmt}": line(1, "x") + "\n", "b.log": line(2, "y") + "\n"})
    assert job("glob", {"pathGlobFilter": f"*.{fmt}"}) == (Done(1, 0), [(1, "x")])
    put(tmp_path / "sep", {f"a.{fmt}": ";".join([line(1, "x"), line(2, "y")])})
    assert job("sep", {"lineSep": ";"}) == (Done(2, 0), [(1, "x"), (2, "y")])
    (tmp_path / "latin").mkdir()
    (tmp_path / "latin" / f"a.{fmt}").write_bytes((line(1, "é") + "\n").encode("latin-1"))
    assert job("latin", {"encoding": "ISO-8859-1"}) == (Done(1, 0), [(1, "é")])


def test_partition_folders_in_jobs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        put(tmp_path / "in" / f"k={k}", {"a.json": f'{{"id":{k},"name":"n"}}\n'})
    sink = Sink(f"{tmp_path}/out", "parquet")
    hash_files(spark, Source(f"{tmp_path}/in", "json", SCHEMA), sink, {"/name": "/name"}, key=KEY)
    assert sorted((r.id, r.k) for r in spark.read.parquet(sink.path).collect()) == [(1, 1), (2, 2)]


def test_dictionary_honours_options(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": '{"id":1,"name":"x"};{"id":2,"name":"y"}'})
    done = dictionary_of_files(
        spark,
        Source(source, "json", SCHEMA, {"lineSep": ";"}),
        Sink(f"{tmp_path}/out", "parquet"),
        {"n": "/name"},
        key=KEY,
    )
    assert done == Done(2, 0)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_bad_columnar_files_are_set_aside(spark, tmp_path, fmt):
    folder = tmp_path / "in"
    for number in range(3):
        rows = [(number * 100 + i, VALUE) for i in range(50)]
        part = spark.createDataFrame(rows, "id int, v string").coalesce(1)
        part.write.mode("append").format(fmt).save(str(folder))
    files = sorted(folder.glob("part-*"))
    # One is no such file at all, one is damaged inside.
    (folder / f"junk.{fmt}").write_bytes(b"no such file" * 50)
    octets = bytearray(files[0].read_bytes())
    octets[4 : len(octets) // 2] = bytes(len(octets) // 2 - 4)
    files[0].write_bytes(bytes(octets))
    (folder / f".{files[0].name}.crc").unlink(missing_ok=True)
    lost = {r.id for r in spark.read.format(fmt).load(list(map(str, files[1:]))).collect()}
    schema = T.StructType().add("id", "integer").add("v", "string")
    source = Source(str(folder), fmt, schema)
    sink = Sink(f"{tmp_path}/out", "parquet", failure_path=f"{tmp_path}/bad")
    assert hash_files(spark, source, sink, {"/v": "/v"}, key=KEY) == Done(100, 2)
    written = spark.read.parquet(sink.path).collect()
    assert {r.id for r in written} == lost and {r.v for r in written} == {DIGESTS["hash-sha256"]}
    bad = {r.unit.rsplit("/", 1)[1] for r in spark.read.parquet(sink.failure_path).collect()}
    assert bad == {f"junk.{fmt}", files[0].name}
    with pytest.raises(ValueError, match="2 files failed"):
        hash_files(spark, source, Sink(f"{tmp_path}/no", "parquet"), {"/v": "/v"}, key=KEY)


def test_columnar_files_that_are_all_good_or_all_bad(spark, tmp_path):
    spark.createDataFrame([(1, VALUE, "x")], "id int, v string, k string").write.partitionBy(
        "k"
    ).parquet(f"{tmp_path}/in")
    schema = T.StructType().add("id", "integer").add("v", "string")
    source = Source(f"{tmp_path}/in", "parquet", schema)
    assert hash_files(spark, source, Sink(f"{tmp_path}/out", "json"), {"/v": "/v"}, key=KEY) == Done(1, 0)
    assert spark.read.json(f"{tmp_path}/out").first()["k"] == "x"
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.parquet").write_bytes(b"PAR1 not really PAR1")
    sink = Sink(f"{tmp_path}/none", "json", failure_path=f"{tmp_path}/names")
    source = Source(f"{tmp_path}/bad", "parquet", schema)
    assert hash_files(spark, source, sink, {"/v": "/v"}, key=KEY) == Done(0, 1)


def test_any_number_of_bad_columnar_files(spark, tmp_path):
    folder = tmp_path / "many files"
    spark.range(80).repartition(4).write.parquet(str(folder))
    for i in range(60):
        (folder / f"bad {i}.parquet").write_bytes(b"PAR1 not really PAR1")
    schema = T.StructType([T.StructField("id", T.LongType())])
    routed = split_readable(spark, str(folder), "parquet", schema)
    failed = [r.unit for r in routed.failure.collect()]
    assert routed.failed_units == len(failed) == 60 and all("bad" in name for name in failed)
    assert sorted(r.id for r in routed.records.collect()) == list(range(80))
    assert sum(r.record_count for r in routed.counts.collect()) == 80


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_good_files_without_records(spark, tmp_path, fmt):
    """No records are no fault, but what is no such file is one, however small."""
    folder = tmp_path / "in"
    empty = spark.createDataFrame([], "id int, v string").coalesce(1)
    empty.write.format(fmt).save(str(folder))
    spark.createDataFrame([(1, "x")], "id int, v string").write.mode("append").format(fmt).save(str(folder))
    (folder / f"junk.{fmt}").write_bytes(b"PAR1 ORC")
    schema = T.StructType().add("id", "integer").add("v", "string")
    routed = split_readable(spark, str(folder), fmt, schema)
    assert [r.unit.rsplit("/", 1)[1] for r in routed.failure.collect()] == [f"junk.{fmt}"]
    assert [tuple(r) for r in routed.success.select("id", "v").collect()] == [(1, "x")]


def test_columns_of_other_types_are_a_files_own_fault(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "x")], "id int, v string").write.parquet(folder)
    spark.createDataFrame([("no number", "y")], "id string, v string").write.mode("append").parquet(folder)
    schema = T.StructType().add("id", "integer").add("v", "string")
    routed = split_readable(spark, folder, "parquet", schema)
    assert routed.failed_units == 1 and routed.records.collect() == [(1, "x")]


def test_checking_columnar_files_holds_no_names_in_the_driver(spark, tmp_path):
    """What is told apart stays a table: the plan of the records has a join, no list of files."""
    folder = tmp_path / "in"
    spark.range(10).write.parquet(str(folder))
    (folder / "bad file.parquet").write_bytes(b"nothing")
    schema = T.StructType([T.StructField("id", T.LongType())])
    routed = split_readable(spark, str(folder), "parquet", schema)
    plan = routed.records._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "bad file" not in plan


def test_records_that_vanish_after_the_check_are_an_error(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    spark.range(100).repartition(2).write.parquet(str(folder))
    schema = T.StructType([T.StructField("id", T.LongType())])

    def spoiled(*args, **settings):
        routed = split_readable(*args, **settings)
        file = sorted(folder.glob("part-*"))[0]
        (folder / f".{file.name}.crc").unlink()
        file.write_bytes(b"gone" * 100)
        return routed

    monkeypatch.setattr("maskwright.jobs.split_readable", spoiled)
    sink = Sink(f"{tmp_path}/out", "parquet", f"{tmp_path}/bad", manifest_path=f"{tmp_path}/jobs")
    with pytest.raises(RuntimeError, match="not whole"):
        hash_files(spark, Source(str(folder), "parquet", schema), sink, {"/id": "/id"}, key=KEY)
    assert not (tmp_path / "jobs").exists()


# One publication.


def published(spark, sink):
    found = read_published(spark, sink.manifest_path)
    rows = sorted(r.id for r in found.records.collect())
    lines = found.failure.count() if found.failure is not None else 0
    return rows, lines, sorted(r.record_count for r in found.counts.collect())


def test_a_job_publishes_all_or_nothing(spark, tmp_path, monkeypatch):
    source = Source(put(tmp_path / "in", JSON), "json", SCHEMA)
    sink = Sink(
        f"{tmp_path}/out", "orc", f"{tmp_path}/bad", f"{tmp_path}/counts", manifest_path=f"{tmp_path}/jobs"
    )
    calls = []

    def ends(df, path, fmt, **settings):
        # The job ends between two of its writes: after none, one, two or three.
        if len(calls) == stop:
            raise KeyboardInterrupt
        calls.append(path)
        return write_records(df, path, fmt, **settings)

    monkeypatch.setattr("maskwright.jobs.write_records", ends)
    for stop in range(4):
        calls.clear()
        with pytest.raises(KeyboardInterrupt):
            hash_files(spark, source, sink, {"/name": "/name"}, key=KEY)
        assert len(calls) == stop and not (tmp_path / "jobs").exists()
        # Nor do readers of the paths themselves see anything.
        if (tmp_path / "out").exists():
            assert spark.read.schema(SCHEMA).orc(sink.path).collect() == []
    stop = 99
    assert hash_files(spark, source, sink, {"/name": "/name"}, key=KEY) == Done(2, 2)
    assert published(spark, sink) == ([1, 2], 6, [2])
    # A second job adds to the first one.
    again = Source(put(tmp_path / "more", {"a.json": '{"id":7,"name":"x"}\n'}), "json", SCHEMA)
    assert hash_files(spark, again, sink, {"/name": "/name"}, key=KEY) == Done(1, 0)
    assert published(spark, sink) == ([1, 2, 7], 6, [1, 2])
    other = Sink(f"{tmp_path}/out", "json", manifest_path=sink.manifest_path)
    hash_files(spark, again, other, {"/name": "/name"}, key=KEY)
    with pytest.raises(ValueError, match="several kinds"):
        read_published(spark, sink.manifest_path).records


def test_counts_come_with_routing(spark, tmp_path):
    """The plan of the counts reads what routing has found, not the input."""
    routed = split_by_unit(read_lines(spark, put(tmp_path / "in", JSON)), "json", SCHEMA)
    plan = routed.counts._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.lower() and "from_json" not in plan
    assert [r.record_count for r in routed.counts.collect()] == [2]


def test_quoted_records_with_a_header_in_jobs(spark, tmp_path):
    files = {
        "a.csv": 'id,name,size\n1,"a\nb",1\n2,"c,""d""",2\n',
        "cut.csv": 'id,name,size\n3,"x\ny",z\n',
        "open.csv": 'id,name,size\n5,"never\nclosed',
    }
    source = Source(put(tmp_path / "in", files), "csv", SCHEMA, {"header": "true", "escape": '"'})
    sink = Sink(f"{tmp_path}/out", "parquet", f"{tmp_path}/bad", f"{tmp_path}/counts")
    done = hash_files(spark, source, sink, {"/size": "/size"}, key=KEY)
    written = sorted((r.id, r["name"]) for r in spark.read.parquet(sink.path).collect())
    assert done.failed_units >= 1 and written[:2] == [(1, "a\nb"), (2, 'c,"d"')]
    bad = spark.read.parquet(sink.failure_path).collect()
    lines = sorted(r["line"] for r in bad if r["unit"].endswith("cut.csv"))
    # Unchanged, with the header.
    assert lines == ['3,"x\ny",z', "id,name,size"]
