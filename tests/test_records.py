from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from maskwright import hash_fields, keyed_hash, nest_fields, project_fields
from tests.fixtures import DIGESTS, KEY, SHA256_123_FOO_WAY, SHA512_123_FOO_WAY, VALUE

SHA256 = DIGESTS["hash-sha256"]
NATIVE_AND_ARROW = ["sha256", "crc32", "crc32c", "adler32", "farmHashFingerprint64"]


@pytest.fixture
def person(spark):
    rows = [(VALUE, "123 Foo Way", 35)]
    return spark.createDataFrame(rows, "name string, address string, age int")


@pytest.fixture
def nested(spark):
    schema = (
        "id int, name string, tags array<string>, codes array<int>, props map<string,string>, "
        "kin array<struct<name string, age int, pets array<struct<name string>>>>, "
        "home struct<street string, geo struct<lat double, street string>>"
    )
    rows = [
        (
            1,
            "Ann",
            ["a", "", None],
            [1, 2],
            {"x": "1", "y": None},
            [("Bo", 3, [("Rex",), ("Tom",)]), ("Cy", 4, None), None],
            ("Main", (1.5, "Side")),
        ),
        (2, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def token(spark, value, algorithm="sha256"):
    return spark.range(1).select(keyed_hash(F.lit(value), KEY, algorithm).alias("t")).first().t


def test_one_field(spark):
    df = spark.createDataFrame([(VALUE, "", 35)], "name string, address string, age int")
    assert hash_fields(df, {"/name": "/name"}, key=KEY).collect() == [(SHA256, "", 35)]


def test_two_fields(person):
    hashed = hash_fields(person, {"/name": "/name", "/address": "/address"}, key=KEY)
    assert hashed.collect() == [(SHA256, SHA256_123_FOO_WAY, 35)]


def test_sha512(person):
    mapping = {"/name": "/name", "/address": "/address"}
    hashed = hash_fields(person, mapping, key=KEY, algorithm="hash-sha512")
    assert hashed.collect() == [(DIGESTS["hash-sha512"], SHA512_123_FOO_WAY, 35)]


def test_unknown_paths_do_nothing(person):
    mapping = {"/name": "/name", "/address": "/address"}
    unknown = {"/dog": "/dog", "/car": "/cat", "/yes": "/okay"}
    hashed = hash_fields(person, {**mapping, **unknown}, key=KEY)
    assert hashed.columns == person.columns
    assert hashed.collect() == [(SHA256, SHA256_123_FOO_WAY, 35)]


def test_another_field(person):
    hashed = hash_fields(person, {"/token": "/name"}, key=KEY)
    assert hashed.columns == ["name", "address", "age", "token"]
    assert hashed.collect() == [(VALUE, "123 Foo Way", 35, SHA256)]


def test_missing_source_makes_null(person):
    hashed = hash_fields(person, {"/name": "/absent", "/age": "/absent"}, key=KEY)
    assert hashed.collect() == [(None, "123 Foo Way", None)]


@pytest.mark.parametrize("algorithm", NATIVE_AND_ARROW)
def test_mappings_apply_in_order(spark, person, algorithm):
    mapping = {"/name": "/address", "/address": "/name"}
    row = hash_fields(person, mapping, key=KEY, algorithm=algorithm).first()
    address = token(spark, VALUE, algorithm)
    assert (row.address, row.name) == (address, token(spark, address, algorithm))


def test_a_later_mapping_sees_new_columns(spark, person):
    hashed = hash_fields(person, {"/a": "/name", "/b": "/a", "/c/d": "/b"}, key=KEY)
    row = hashed.first()
    assert row.b == token(spark, SHA256)
    assert "c" not in hashed.columns


def test_wildcards_see_new_columns(spark, person):
    df = person.select("name")
    row = hash_fields(df, {"/Z": "/name", "//z": "."}, key=KEY).first()
    # In order of text: "//z" comes before "/Z", when there is no such column yet.
    assert row.Z == SHA256
    row = hash_fields(df, {"/a": "/name", "/~": "/a"}, key=KEY).first()
    assert row["~"] == token(spark, SHA256)
    row = hash_fields(df.withColumn("z", F.struct("name")), {"/a": "/name", "/z/*": "/a"}, key=KEY)
    assert row.first().z.name == token(spark, SHA256)


def test_int_becomes_a_token(spark, person):
    hashed = hash_fields(person, {"/age": "/age"}, key=KEY)
    assert dict(hashed.dtypes)["age"] == "string"
    assert hashed.first().age == token(spark, "35")


def test_attributes(person):
    mapping = {"/token": "/${field}"}
    hashed = hash_fields(person, mapping, key=KEY, attributes={"field": "name"})
    assert hashed.first().token == SHA256
    with pytest.raises(ValueError, match="no attribute named 'field'"):
        hash_fields(person, mapping, key=KEY)


@pytest.mark.parametrize("algorithm", NATIVE_AND_ARROW)
def test_nested_fields(spark, nested, algorithm):
    def t(value):
        return token(spark, value, algorithm)

    mapping = {
        "/home/geo/street": "../../street",
        "/home/new": "/name",
        "/kin[*]/name": "../age",
        "/kin[*]/pets[*]/name": ".",
        "/props[*]": ".",
        "/tags[*]": ".",
        "/codes[0]": ".",
    }
    hashed = hash_fields(nested, mapping, key=KEY, algorithm=algorithm)
    first, second = hashed.orderBy("id").collect()
    assert first.tags == [t("a"), "", None]
    assert first.codes == [t("1"), "2"]
    assert first.props == {"x": t("1"), "y": None}
    assert first.home == ("Main", (1.5, t("Main")), t("Ann"))
    assert first.kin == [
        (t("3"), 3, [(t("Rex"),), (t("Tom"),)]),
        (t("4"), 4, None),
        None,
    ]
    assert second == (2, None, None, None, None, None, None)


@pytest.mark.parametrize("algorithm", ["sha256", "crc32c"])
def test_descendants_take_one_source(spark, nested, algorithm):
    t = token(spark, "Main", algorithm)
    hashed = hash_fields(nested, {"//name": "/home/street"}, key=KEY, algorithm=algorithm)
    row = hashed.orderBy("id").first()
    assert row.name == t
    assert row.kin == [(t, 3, [(t,), (t,)]), (t, 4, None), None]


@pytest.mark.parametrize("algorithm", ["sha256", "crc32c"])
def test_single_entries(spark, nested, algorithm):
    def t(value):
        return token(spark, value, algorithm)

    mapping = {
        "/tags[0]": ".",
        "/tags[-1]": "/name",
        "/props['x']": ".",
        "/kin[1]/name": ".",
        "/first": "/tags[1]",
        "/second": "/kin[0]/name",
        "/third": "/props['x']",
        "/~": "/kin[9]/name",
    }
    row = hash_fields(nested, mapping, key=KEY, algorithm=algorithm).orderBy("id").first()
    assert row.tags == [t("a"), "", t("Ann")]
    assert row.kin[0].name == "Bo" and row.kin[1].name == t("Cy") and row.kin[2] is None
    assert row.first == "" and row.second == t("Bo")
    assert row.props == {"x": t("1"), "y": None} and row.third == t(t("1"))
    assert row["~"] is None


def test_relative_sources_read_old_values(spark, nested):
    row = hash_fields(nested, {"/home/*": "../street"}, key=KEY)
    row = row.orderBy("id").first()
    assert row.home == (token(spark, "Main"), token(spark, "Main"))


def test_many_sources_are_refused(nested):
    for source in ("/*", "/tags[*]", "//name"):
        with pytest.raises(ValueError, match="nest_fields"):
            hash_fields(nested, {"/name": source}, key=KEY)


def test_values_without_text_are_refused(nested):
    for source in ("/home", "/tags", "/props", "/kin[0]"):
        with pytest.raises(ValueError, match="no plain text form"):
            hash_fields(nested, {"/name": source}, key=KEY)
    binary = nested.select(F.lit(b"1").alias("name"))
    with pytest.raises(ValueError, match="no plain text form"):
        hash_fields(binary, {"/name": "/name"}, key=KEY)


def test_the_whole_row_is_refused(person):
    with pytest.raises(ValueError, match="project_fields"):
        hash_fields(person, {"/": "/name"}, key=KEY)


def test_settings_are_checked(person):
    with pytest.raises(ValueError, match="key"):
        hash_fields(person, {"/name": "/name"}, key="")
    with pytest.raises(ValueError, match="no path to hash"):
        hash_fields(person, {}, key=KEY)
    with pytest.raises(ValueError, match="unknown hash algorithm"):
        hash_fields(person, {"/name": "/name"}, key=KEY, algorithm="hash-md5")
    for path in ("name", "", "/a//", "/a[", "/a[x]", "/[0]", ".name", "//"):
        with pytest.raises(ValueError, match="not a field path"):
            hash_fields(person, {path: "/name"}, key=KEY)


def test_odd_column_names(spark):
    df = spark.createDataFrame([("v", ("w",))], "`a.b` string, `c d` struct<`e.f`: string>")
    row = hash_fields(df, {"/a.b": ".", "/'c d'/e.f": ".", "/`": "/a.b"}, key=KEY).first()
    assert row["a.b"] == token(spark, "v") and row["c d"]["e.f"] == token(spark, "w")
    assert row["`"] == token(spark, row["a.b"]) or row["`"] == token(spark, "v")


def test_names_follow_the_session(spark, person):
    assert hash_fields(person, {"/NAME": "/Name"}, key=KEY).first().name == SHA256
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        hashed = hash_fields(person, {"/NAME": "/name"}, key=KEY)
        assert hashed.columns == ["name", "address", "age", "NAME"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_rows_keep_number_and_order(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("v"))
    for algorithm in ("sha256", "crc32c"):
        hashed = hash_fields(df, {"/v": "/v"}, key=KEY, algorithm=algorithm)
        assert [r.id for r in hashed.collect()] == list(range(1000))


def test_a_column_without_a_type(spark):
    df = spark.sql("SELECT NULL AS v, 'a' AS w")
    assert hash_fields(df, {"/v": "/v"}, key=KEY).first().v is None


def test_one_source_for_a_whole_array(spark, nested):
    for algorithm in ("sha256", "crc32c"):
        t = token(spark, "Ann", algorithm)
        hashed = hash_fields(nested, {"/tags[*]": "/name"}, key=KEY, algorithm=algorithm)
        assert hashed.orderBy("id").first().tags == [t, t, t]


def test_nest_fields(nested):
    result = nest_fields(
        nested, {"/both": ["/id", "/name"], "/geo": "/home/geo/*", "/home/up": "../street"}
    )
    row = result.orderBy("id").first()
    assert row.both == (1, "Ann") and row.both.asDict() == {"id": 1, "name": "Ann"}
    assert row.geo == (1.5, "Side")
    assert row.home.up.street == "Main"


def test_nest_fields_last_of_a_name_counts(nested):
    row = nest_fields(nested, {"/s": ["/home/street", "/home/geo/street"]}).orderBy("id").first()
    assert row.s.asDict() == {"street": "Side"}
    row = nest_fields(nested, {"/name": "/absent"}).orderBy("id").first()
    assert row.name is None
    with pytest.raises(ValueError, match="single fields"):
        nest_fields(nested, {"/s": "/tags[*]"})


def test_project_fields(nested):
    result = project_fields(nested, ["/name", "/home/geo/lat", "/tags[0]"])
    assert result.orderBy("name").collect()[-1].asDict() == {"name": "Ann", "lat": 1.5, "tags": "a"}
    assert project_fields(nested, "/absent") is nested
    assert project_fields(nested, "/*").columns == nested.columns


@pytest.mark.parametrize("algorithm", ["sha256", "crc32c"])
def test_columns_named_like_helpers_stay(spark, algorithm):
    df = spark.createDataFrame(
        [(["a", "b"], "mine", "own", "x")],
        "tags array<string>, __digests_0 string, __DIGESTS_0_ string, __digests_1 string",
    )
    out = hash_fields(df, {"/tags[*]": ".", "/__digests_1": "."}, key=KEY, algorithm=algorithm)
    assert out.columns == df.columns
    row = out.first()
    assert (row["__digests_0"], row["__DIGESTS_0_"]) == ("mine", "own")
    plain = df.select(
        *(keyed_hash(F.lit(v), KEY, algorithm).alias(v) for v in ("a", "b", "x"))
    ).first()
    assert (row["tags"], row["__digests_1"]) == ([plain["a"], plain["b"]], plain["x"])
