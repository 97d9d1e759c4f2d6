from __future__ import annotations

from maskwright import (
    ALGORITHMS,
    hash_fields,
    hash_lookup_map,
    hide_keys,
    keyed_hash,
    register_sql_functions,
)
from tests.fixtures import DIGESTS, KEY, VALUE


def test_functions(spark):
    names = register_sql_functions(spark, KEY)
    assert len(names) == len(ALGORITHMS) == 7
    for algorithm, name in zip(ALGORITHMS, names):
        values = f"VALUES ('{VALUE}'), (NULL), (''), (' '), ('it''s') AS t(v)"
        rows = spark.sql(f"SELECT v, {name}(v) AS t FROM {values}")
        found = {r.v: r.t for r in rows.collect()}
        assert found[VALUE] == DIGESTS[algorithm.id]
        assert (found[None], found[""], found[" "]) == (None, "", " ")
        column = rows.select("v", keyed_hash("v", KEY, algorithm.id).alias("t"))
        assert {r.v: r.t for r in column.collect()} == found


def test_any_key_works(spark):
    for key in ("it's \\ a \"key\" ${x}", "é中", "a\nb"):
        register_sql_functions(spark, key)
        df = spark.createDataFrame([(VALUE,)], "v string")
        token = df.select(keyed_hash("v", key).alias("t")).first().t
        assert spark.sql("SELECT keyed_sha256({v}) AS t", v=f"{VALUE}").first().t == token


def test_functions_in_queries(spark):
    register_sql_functions(spark, KEY)
    spark.createDataFrame([(VALUE, 1), (VALUE, 2)], "v string, n int").createOrReplaceTempView("t")
    row = spark.sql("SELECT keyed_sha512(v) AS h, sum(n) AS n FROM t GROUP BY 1").collect()
    assert row == [(DIGESTS["hash-sha512"], 3)]


def test_hidden_keys(spark, capsys):
    setting = "spark.sql.redaction.string.regex"
    before = spark.conf.get(setting, None)
    try:
        spark.conf.set(setting, "other")
        for _ in range(2):
            hide_keys(spark)
        assert spark.conf.get(setting).count("0x") == 1
        df = spark.createDataFrame([(VALUE,)], "v string")
        register_sql_functions(spark, KEY)
        for algorithm in ("sha256", "crc32c"):
            for hashed in (
                hash_fields(df, {"/v": "/v"}, key=KEY, algorithm=algorithm),
                df.selectExpr(f"keyed_{algorithm}(v) AS v"),
            ):
                hashed.explain(True)
                hashed.explain("formatted")
                assert hashed.first().v == DIGESTS["hash-" + algorithm]
        printed = capsys.readouterr().out
        assert "redacted" in printed and KEY not in printed
        assert KEY.encode().hex() not in printed.lower()
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)


def test_the_key_is_in_no_name_and_no_function(spark, tmp_path, capsys):
    df = spark.createDataFrame([(VALUE, {"a": VALUE})], "v string, m map<string,string>")
    secret = (KEY, KEY.encode().hex(), KEY.encode().hex().upper())
    plain = df.select(*(keyed_hash("v", KEY, a.id) for a in ALGORITHMS[:1]), hash_lookup_map("m", KEY))
    assert plain.columns == ["keyed_hash", "hash_lookup"]
    for algorithm in ALGORITHMS:
        assert df.select(keyed_hash("v", KEY, algorithm.id)).columns == ["keyed_hash"]
    plain.write.parquet(f"{tmp_path}/out")
    written = "".join(
        p.read_bytes().decode("latin-1") for p in (tmp_path / "out").glob("*.parquet")
    )
    said = spark.read.parquet(f"{tmp_path}/out").schema.json() + written
    for name in register_sql_functions(spark, KEY):
        spark.sql(f"EXPLAIN EXTENDED SELECT {name}(v) FROM {{df}}", df=df).show(truncate=False)
        for row in spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}").collect():
            said += str(row)
    said += capsys.readouterr().out
    assert "keyed_sha256" in said and not any(text in said for text in secret)
