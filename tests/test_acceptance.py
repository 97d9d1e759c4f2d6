"""The driver contract: every query next to its DuckDB equivalent."""

from __future__ import annotations

import hashlib
import base64

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from acceptance.settings import KEY
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["c_custkey", "c_name"]


@pytest.mark.parametrize("name", ["sha384", "sha512"])
def test_wide_digests_against_hashlib(spark, name):
    part = spark.read.parquet(f"{FOLDER}/part.parquet").select("p_partkey", "p_name")
    texts = {r.p_partkey: r.p_name for r in part.collect()}
    for row in contract.queries()[name](spark, FOLDER).collect():
        text = texts[row.p_partkey]
        message = KEY + text + base64.b64encode(text.encode()).decode()
        assert row.p_name == hashlib.new(name, message.encode()).hexdigest()


@pytest.mark.parametrize(
    "name, function",
    [
        ("farm_fingerprint64", "farmHashFingerprint64"),
        ("farm_fingerprint64_long_text", "farmHashFingerprint64"),
        ("crc32c_long_text", "crc32c"),
    ],
)
def test_other_digests_against_an_independent_library(spark, name, function):
    table, id, value = (
        ("documents", "doc_id", "text") if "long" in name else ("part", "p_partkey", "p_name")
    )
    hashing = getattr(spark._jvm.com.google.common.hash.Hashing, function)()
    utf8 = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(id, value).collect()
    texts = {r[id]: r[value] for r in rows}
    for row in contract.queries()[name](spark, FOLDER).select(F.col(id), value).collect():
        text = texts[row[id]]
        message = KEY + text + base64.b64encode(text.encode()).decode()
        assert row[value] == hashing.hashString(message, utf8).toString()
