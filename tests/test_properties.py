from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskwright import hash_fields, key_hash_dictionary, keyed_hash
from maskwright.functions.checksums import Crc32c
from maskwright.functions.message import BLANK_CHARACTERS
from maskwright.plans.paths import parse, root_of
from tests.fixtures import KEY

TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=90)
VALUES = st.lists(st.none() | TEXT | st.text(BLANK_CHARACTERS, max_size=4), max_size=25)
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def expected(value):
    if value is None or not value.strip(BLANK_CHARACTERS):
        return value
    message = KEY + value + base64.b64encode(value.encode()).decode()
    return hashlib.sha256(message.encode()).hexdigest()


@few
@given(values=VALUES)
def test_tokens(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", keyed_hash("v", KEY).alias("t")).collect()
    assert [r.t for r in sorted(rows)] == [expected(v) for v in values]


@few
@given(values=VALUES)
def test_arrow_tokens(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(3)
    for r in df.select("i", keyed_hash("v", KEY, "adler32").alias("t")).collect():
        value = values[r.i]
        if value is None or not value.strip(BLANK_CHARACTERS):
            assert r.t == value
        else:
            message = KEY + value + base64.b64encode(value.encode()).decode()
            assert r.t == zlib.adler32(message.encode()).to_bytes(4, "little").hex()


@few
@given(lists=st.lists(st.none() | VALUES, max_size=6))
def test_arrays(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    rows = sorted(hash_fields(df, {"/v[*]": "."}, key=KEY).collect())
    assert [r.v for r in rows] == [v and [expected(x) for x in v] for v in lists]
    pairs = key_hash_dictionary(df, {"v": "/v[*]"}, key=KEY).collect()
    flat = [x for v in lists for x in v or [] if x]
    assert sorted((r.hash, r.plaintext) for r in pairs) == sorted((expected(x), x) for x in flat)


@settings(max_examples=200, deadline=None)
@given(messages=st.lists(st.binary(min_size=4, max_size=300), min_size=1, max_size=12))
def test_crc32c_bit_by_bit(messages):
    def slow(message):
        register = 0xFFFFFFFF
        for byte in message:
            register ^= byte
            for _ in range(8):
                register = register >> 1 ^ (0x82F63B78 if register & 1 else 0)
        return register ^ 0xFFFFFFFF

    size = np.array([len(m) for m in messages])
    data = np.frombuffer(b"".join(messages), np.uint8)
    found = Crc32c()(data, np.cumsum(size) - size, size)
    assert found.tolist() == [slow(m) for m in messages]


NAMES = st.sampled_from(["a", "b", "a b", "x.y"])


@settings(max_examples=100, deadline=None)
@given(names=st.lists(NAMES, min_size=1, max_size=4))
def test_paths_lead_to_their_fields(names):
    from pyspark.sql import types as T

    schema = T.StringType()
    for name in reversed(names):
        schema = T.StructType([T.StructField(name, schema)])
    quoted = "/" + "/".join(f"'{name}'" for name in names)
    for text in ("/" + "/".join(names), quoted):
        (place,) = parse(text).places(schema)
        assert [step.name for step in place.steps] == names and place.type == T.StringType()
        (up,) = parse("..").places(schema, place)
        assert up.steps == place.steps[:-1]
        (same,) = parse(".").places(schema, place)
        assert same.steps == place.steps
    assert root_of(schema).is_root


@few
@given(values=VALUES)
def test_rows_are_kept(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    hashed = hash_fields(df, {"/v": "/v", "/w": "/v"}, key=KEY, algorithm="crc32c")
    assert hashed.count() == len(values)
    assert sorted(r.i for r in hashed.select(F.col("i")).collect()) == list(range(len(values)))
