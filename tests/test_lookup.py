from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from maskwright import hash_fields, hash_lookup, hash_lookup_map, key_hash_dictionary
from tests.fixtures import DIGESTS, KEY, SHA256_NULL_KEY, VALUE


def test_struct(spark):
    schema = "a string, b string, c string, d string, e int"
    df = spark.createDataFrame([(VALUE, None, "", " ", 3)], schema)
    found = hash_lookup(df, ["a", "b", "c", "d", "e"], key="null", into="found")
    row = found.first().found.asDict()
    assert (row["a"], row["b"], row["c"], row["d"]) == (SHA256_NULL_KEY, None, "", " ")
    assert len(row["e"]) == 64
    assert hash_lookup(df, [], key=KEY).first().lookup is not None


def test_two_names_one_value(spark):
    df = spark.createDataFrame([(VALUE,)], "v string")
    found = hash_lookup(df, {"the-first-key": "v", "the-second-key": F.col("v")}, key="null")
    assert found.first().lookup.asDict() == {
        "the-first-key": SHA256_NULL_KEY,
        "the-second-key": SHA256_NULL_KEY,
    }


def test_map(spark):
    values = {"the-key": VALUE, "the-null-key": None, "the-empty-key": ""}
    df = spark.createDataFrame([(values,), ({},), (None,)], "m map<string,string>")
    rows = df.select(hash_lookup_map("m", "null").alias("m")).collect()
    assert rows[0].m == {**values, "the-key": SHA256_NULL_KEY}
    assert rows[1].m == {} and rows[2].m is None


def test_map_of_numbers(spark):
    df = spark.sql("SELECT map('a', 1) AS m, '1' AS v")
    texts = hash_lookup_map(F.create_map(F.lit("a"), "v"), KEY)
    row = df.select(hash_lookup_map("m", KEY).alias("m"), texts.alias("n")).first()
    assert row.m == row.n


def test_a_key_is_needed(spark):
    df = spark.createDataFrame([(VALUE,)], "v string")
    assert hash_lookup(df, ["v"], key=KEY).first().lookup.v == DIGESTS["hash-sha256"]
    for key in ("", None):
        with pytest.raises(ValueError, match="key"):
            hash_lookup(df, ["v"], key=key)
        with pytest.raises(ValueError, match="key"):
            hash_lookup_map("v", key)
    with pytest.raises(ValueError, match="into"):
        hash_lookup(df, ["v"], key=KEY, into="")


def test_types_without_a_text_form_are_refused(spark):
    df = spark.sql("SELECT array(1) AS a, struct(1) AS s, X'00' AS b, map('k', 1) AS m")
    for name in df.columns:
        with pytest.raises(ValueError, match="no plain text form"):
            hash_lookup(df, [name], key=KEY)


def test_timestamps_have_one_text_form(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    tokens = set()
    try:
        for session in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            # The second is in an hour that New York has twice.
            df = spark.sql(
                "SELECT t, array(t) AS a, map('k', t) AS m FROM VALUES "
                "(timestamp_micros(1700000000123000)), (timestamp_micros(1699165800000000)), "
                "(timestamp_micros(-62000000000000001)) AS x(t)"
            )
            hashed = hash_fields(df, {"/t": ".", "/a[*]": ".", "/m[*]": "."}, key=KEY)
            found = [(r.t, r.a[0], r.m["k"]) for r in hashed.collect()]
            looked = [r.lookup.t for r in hash_lookup(df, ["t"], key=KEY).collect()]
            pairs = key_hash_dictionary(df, {"t": "/t", "u": "/a[*]"}, key=KEY).collect()
            assert all(len(set(row)) == 1 for row in found)
            assert [row[0] for row in found] == looked
            assert {p.hash for p in pairs} == set(looked)
            texts = {p.plaintext for p in pairs}
            assert "2023-11-14 22:13:20.123" in texts and "2023-11-05 06:30:00" in texts
            tokens.add(tuple(looked))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(tokens) == 1 and len(set(tokens.pop())) == 3
