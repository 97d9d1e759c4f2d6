"""Plans as a cluster should run them."""

from __future__ import annotations

from itertools import groupby

import pytest
from pyspark.sql import functions as F

from acceptance.queries import QUERIES
from maskwright import hash_fields, key_hash_dictionary
from tests.fixtures import KEY

FOLDER = "/root/testdata/sf0.001"
# These count or route by unit, which takes a shuffle of counts or flags; records that go over
# lines meet at the edges of blocks.
BY_UNIT = (
    "record_count",
    "count_by_unit",
    "failure_split",
    "split_files_csv",
    "split_files_xml",
    "stream_routing",
    "stream_hash",
    "hash_files_parquet",
    "log_records",
)
NARROW = [name for name in QUERIES if name not in BY_UNIT]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, FOLDER))


def test_native_digests_stay_in_codegen(spark):
    for name in ("keyed_sha256", "sha384", "sha512", "crc32", "lookup_struct"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert text.lstrip().startswith("*(1)") and "Python" not in text


def test_only_needed_columns_are_read_and_hashed(spark):
    customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
    mapping = {"/c_name": "/c_name", "/c_mktsegment": "/c_mktsegment"}
    text = plan(hash_fields(customer, mapping, key=KEY).select("c_mktsegment"))
    assert "ReadSchema: struct<c_mktsegment:string>" in text and text.count("sha2(") == 1
    pairs = key_hash_dictionary(customer, {"a": "/c_name"}, key=KEY)
    assert "ReadSchema: struct<c_name:string>" in plan(pairs)


def test_filters_on_other_columns_reach_the_scan(spark):
    customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
    hashed = hash_fields(customer, {"/c_name": "/c_name"}, key=KEY).where("c_nationkey = 3")
    assert "EqualTo(c_nationkey,3)" in plan(hashed)


def test_a_chained_digest_is_computed_once(spark):
    text = plan(QUERIES["sequential_chain"](spark, FOLDER))
    assert text.count("sha2(") == 2


def test_many_mappings_make_one_projection(spark):
    names = [f"c{i}" for i in range(60)]
    df = spark.range(1).select(*[F.col("id").cast("string").alias(n) for n in names])
    hashed = hash_fields(df, {f"/{n}": f"/{n}" for n in names}, key=KEY)
    assert hashed._jdf.queryExecution().analyzed().toString().count("Project") == 2


def test_arrow_digests_share_one_python_pass(spark):
    customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
    mapping = {"/c_name": "/c_name", "/c_mktsegment": "/c_mktsegment"}
    hashed = hash_fields(customer, mapping, key=KEY, algorithm="crc32c")
    assert plan(hashed).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["lineitem_sha512", "lineitem_sha384", "lineitem_sha256"])
def test_lines_of_a_supplier_stand_together_in_each_task(spark, tmp_path, name):
    rows = spark.range(0, 900, 1, 3).selectExpr(
        "id AS l_orderkey", "id % 50 AS l_partkey", "if(id % 9 = 0, null, id % 7) AS l_suppkey",
        "cast(id % 4 AS int) AS l_linenumber", "id * 2 AS l_tax",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = QUERIES[name](spark, str(tmp_path))
    parts = [part for part in lines.rdd.glom().collect() if part]
    assert sum(map(len, parts)) == 900 and "Exchange" not in plan(lines)
    for part in parts:
        runs = [token for token, _ in groupby(part, key=lambda row: row["l_suppkey"])]
        assert len(runs) == len(set(runs)) == 8
