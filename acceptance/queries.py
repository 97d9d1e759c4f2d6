"""One query for each operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.settings import ATTRIBUTES, KEY, SEED
from maskwright import (
    ALGORITHMS,
    hash_fields,
    hash_lookup,
    hash_lookup_map,
    key_hash_dictionary,
    keyed_hash,
    nest_fields,
    project_fields,
    register_sql_functions,
)
from maskwright.jobs import Sink, Source, hash_files, read_published
from maskwright.sources import (
    MEMBER,
    MEMBER_INPUT,
    conform,
    count_by_unit,
    member_columns,
    read_delimited,
    read_lines,
    read_records,
    split_by_unit,
    split_files,
    write_records,
)
from maskwright.sources.logs import read_logs
from maskwright.sources.routing import LINE
from maskwright.sources.scratch import new_folder
from maskwright.streaming import (
    distinct_pairs,
    start_routing,
    start_writing,
    stream_lines,
    stream_records,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())]
)


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hashed_part(spark: SparkSession, folder: str, algorithm: str, **settings) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return hash_fields(part, {"/p_name": "/p_name"}, key=KEY, algorithm=algorithm, **settings)


def edge_values() -> Column:
    """Every kind of value: null, empty, blank, a no-break space (not blank), a name."""
    kind = F.col("c_custkey") % 5
    return (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, "")
        .when(kind == 2, "  ")
        .when(kind == 3, "\u00a0")
        .otherwise(F.col("c_name"))
    )


# Digests.


@query
def keyed_sha256(spark, folder):
    customer = table(spark, folder, "customer")
    return customer.select("c_custkey", keyed_hash("c_name", KEY).alias("c_name"))


@query
def long_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return hash_fields(documents, {"/text": "/text"}, key=KEY)


@query
def blank_guard(spark, folder):
    edges = table(spark, folder, "customer").select("c_custkey", edge_values().alias("v"))
    return hash_fields(edges, {"/v": "/v"}, key=KEY)


@query
def adler32_blank_guard(spark, folder):
    edges = table(spark, folder, "customer").select("c_custkey", edge_values().alias("v"))
    return hash_fields(edges, {"/v": "/v"}, key=KEY, algorithm="hash-adler32")


@query
def crc32(spark, folder):
    return hashed_part(spark, folder, "hash-crc32")


@query
def crc32c(spark, folder):
    return hashed_part(spark, folder, "hash-crc32c")


@query
def adler32(spark, folder):
    return hashed_part(spark, folder, "hash-adler32")


@query
def crc32_reference_dispatch(spark, folder):
    return hashed_part(spark, folder, "hash-crc32", reference_crc32=True)


@query
def sha384(spark, folder):
    return hashed_part(spark, folder, "hash-sha384")


@query
def sha512(spark, folder):
    return hashed_part(spark, folder, "hash-sha512")


@query
def farm_fingerprint64(spark, folder):
    return hashed_part(spark, folder, "hash-farmHashFingerprint64")


@query
def farm_fingerprint64_names(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    algorithm = "hash-farmHashFingerprint64"
    return hash_fields(customer, {"/c_name": "/c_name"}, key=KEY, algorithm=algorithm)


@query
def farm_fingerprint64_long_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return hash_fields(
        documents, {"/text": "/text"}, key=KEY, algorithm="hash-farmHashFingerprint64"
    )


@query
def crc32c_long_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return hash_fields(documents, {"/text": "/text"}, key=KEY, algorithm="hash-crc32c")


# Row-for-row operators.


@query
def multi_in_place(spark, folder):
    mapping = {"/c_name": "/c_name", "/c_mktsegment": "/c_mktsegment"}
    return hash_fields(table(spark, folder, "customer"), mapping, key=KEY)


@query
def hash_to_new_column(spark, folder):
    supplier = table(spark, folder, "supplier")
    target = T.StructType.fromDDL(
        "s_suppkey bigint, s_name string, note string, hashed_s_name string"
    )
    return hash_fields(conform(supplier, target), {"/hashed_s_name": "/s_name"}, key=KEY)


@query
def sequential_chain(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    mapping = {"/c_mktsegment": "/c_name", "/c_name": "/c_mktsegment"}
    # In order: c_mktsegment becomes H(c_name), then c_name becomes H of that.
    return hash_fields(customer, mapping, key=KEY)


@query
def missing_source_nulls(spark, folder):
    return hash_fields(table(spark, folder, "customer"), {"/c_name": "/absent"}, key=KEY)


@query
def missing_pair_noop(spark, folder):
    mapping = {"/dog": "/dog", "/car": "/cat"}
    return hash_fields(table(spark, folder, "customer"), mapping, key=KEY)


@query
def int_source(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return hash_fields(customer, {"/c_nationkey": "/c_nationkey"}, key=KEY)


@query
def nested_paths(spark, folder):
    person = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("home"),
    )
    people = table(spark, folder, "customer").select("c_custkey", person.alias("person"))
    mapping = {"/person/name": "/person/name", "/person/home/nation": "."}
    hashed = hash_fields(people, mapping, key=KEY)
    return hashed.select("c_custkey", "person.name", "person.segment", "person.home.nation")


@query
def array_paths(spark, folder):
    documents = table(spark, folder, "documents")
    words = documents.select("doc_id", F.split("text", " ").alias("words"))
    hashed = hash_fields(words, {"/words[*]": "."}, key=KEY)
    return hashed.withColumn("words", F.array_join("words", "|"))


@query
def array_paths_arrow(spark, folder):
    words = table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    hashed = hash_fields(words, {"/words[*]": "."}, key=KEY, algorithm="hash-adler32")
    return hashed.withColumn("words", F.array_join("words", "|"))


def coordinates() -> Column:
    """A map of names to values, built from an order."""
    return F.create_map(
        F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")
    )


@query
def map_paths(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", coordinates().alias("m"))
    hashed = hash_fields(orders, {"/m[*]": "."}, key=KEY)
    return hashed.select(
        "o_orderkey", F.col("m")["status"].alias("status"), F.col("m")["priority"].alias("priority")
    )


@query
def relative_path(spark, folder):
    person = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    people = table(spark, folder, "customer").select("c_custkey", person.alias("person"))
    hashed = hash_fields(people, {"/person/*": "../segment"}, key=KEY)
    return hashed.select("c_custkey", "person.name", "person.segment")


@query
def descendant_paths(spark, folder):
    nested = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("inner"),
    )
    hashed = hash_fields(nested, {"//name": "/c_custkey"}, key=KEY)
    return hashed.select(
        "c_custkey", F.col("name").alias("outer_name"), F.col("inner.name").alias("inner_name")
    )


@query
def nest_fields_(spark, folder):
    customer = table(spark, folder, "customer")
    nested = nest_fields(customer, {"/person": ["/c_name", "/c_mktsegment"]})
    return nested.select(
        "c_custkey",
        F.col("person.c_name").alias("name"),
        F.col("person.c_mktsegment").alias("segment"),
    )


@query
def project_fields_(spark, folder):
    return project_fields(table(spark, folder, "customer"), ["/c_name", "/c_mktsegment"])


@query
def attribute_mapping(spark, folder):
    customer = table(spark, folder, "customer")
    hashed = hash_fields(customer, {"/token": "/${column}"}, key=KEY, attributes=ATTRIBUTES)
    return hashed.select("c_custkey", "token")


# The token dictionary.


@query
def dictionary(spark, folder):
    paths = {"a": "/c_name", "b": "/c_mktsegment"}
    return key_hash_dictionary(table(spark, folder, "customer"), paths, key=KEY)


@query
def dictionary_edges(spark, folder):
    edges = table(spark, folder, "customer").withColumn("v", edge_values())
    paths = {"a": "/v", "b": "/c_mktsegment", "c": "/absent"}
    return key_hash_dictionary(edges, paths, key=KEY)


@query
def dictionary_names(spark, folder):
    customer = table(spark, folder, "customer")
    return key_hash_dictionary(
        customer, {"a": "/c_name"}, key=KEY, hash_name="token", plaintext_name="clear"
    )


@query
def dictionary_of_words(spark, folder):
    words = table(spark, folder, "documents").select(F.split("text", " ").alias("words"))
    return key_hash_dictionary(words, {"word": "/words[*]"}, key=KEY, together=True)


# Lookups.


@query
def lookup_struct(spark, folder):
    names = {"status": "o_orderstatus", "priority": "o_orderpriority"}
    found = hash_lookup(table(spark, folder, "orders"), names, key=KEY, into="found")
    return found.select("o_orderkey", "found.*")


@query
def lookup_map(spark, folder):
    found = hash_lookup_map(coordinates(), KEY)
    orders = table(spark, folder, "orders").select("o_orderkey", found.alias("found"))
    return orders.select("o_orderkey", "found.status", "found.priority")


# Sources, sinks and routing.


@query
def record_count(spark, folder):
    events = read_records(spark, f"{folder}/events.parquet", "parquet", unit=True)
    return count_by_unit(events).agg(F.sum("record_count").alias("record_count"))


@query
def conform_(spark, folder):
    target = T.StructType.fromDDL("c_custkey string, c_name string, note string, score double")
    return conform(table(spark, folder, "customer"), target)


def round_trip(df: DataFrame, fmt: str, options: dict[str, str] | None = None) -> str:
    """Write the table to a folder of its own and return that."""
    path = new_folder(df.sparkSession, fmt)
    write_records(df, path, fmt, options=options)
    return path


@query
def csv_round_trip(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = round_trip(customer, "csv", {"header": "false"})
    return hash_fields(
        read_delimited(spark, path, customer.schema), {"/c_name": "/c_name"}, key=KEY
    )


@query
def json_round_trip(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    records = read_records(spark, round_trip(orders, "json"), "json", schema=orders.schema)
    return hash_fields(records, {"/o_orderpriority": "/o_orderpriority"}, key=KEY)


@query
def orc_round_trip(spark, folder):
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    records = read_records(spark, round_trip(supplier, "orc"), "orc", schema=supplier.schema)
    return hash_fields(records, {"/s_name": "/s_name"}, key=KEY)


@query
def xml_round_trip(spark, folder):
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    tag = {"rowTag": "supplier"}
    path = round_trip(supplier, "xml", tag)
    records = read_records(spark, path, "xml", schema=supplier.schema, options=tag)
    return hash_fields(records, {"/s_name": "/s_name"}, key=KEY)


@query
def text_lines(spark, folder):
    names = table(spark, folder, "part").select("p_name")
    lines = read_records(spark, round_trip(names, "text"), "text")
    return hash_fields(lines, {"/value": "/value"}, key=KEY)


def order_lines(spark: SparkSession, folder: str, cut: Column) -> str:
    """Orders as JSON lines, in one folder for each priority, some with their end cut off."""
    whole = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    line = F.when(cut, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    orders = table(spark, folder, "orders").withColumn("line", whole)
    path = new_folder(spark, "orders")
    write_records(
        orders.select("o_orderpriority", line.alias("line")),
        path,
        "text",
        partition_by=["o_orderpriority"],
    )
    return path


def both_routes(success: DataFrame, failure: DataFrame) -> DataFrame:
    number = F.regexp_extract(LINE, r'"o_orderkey":(\d+)', 1).cast("bigint")
    return success.select(
        F.lit("success").alias("route"), "o_orderkey", F.col("o_orderstatus").alias("content")
    ).unionAll(
        failure.select(F.lit("failure"), number.alias("o_orderkey"), F.col(LINE).alias("content"))
    )


@query
def failure_split(spark, folder):
    cut = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    lines = read_lines(spark, f"{order_lines(spark, folder, cut)}/*", folders=True)
    routed = split_by_unit(lines, "json", ORDER)
    hashed = hash_fields(routed.success, {"/o_orderstatus": "/o_orderstatus"}, key=KEY)
    return both_routes(hashed, routed.failure)


# Streams.


@query
def stream_hash(spark, folder):
    schema = table(spark, folder, "events").select("event_id", "event_type").schema
    # A stream reads folders or patterns; this pattern fits the table in either form.
    events = stream_records(spark, f"{folder}/events.parque[t]", "parquet", schema)
    hashed = hash_fields(events, {"/event_type": "/event_type"}, key=KEY)
    out = new_folder(spark, "stream")
    started = start_writing(
        hashed, f"{out}/data", "parquet", checkpoint=f"{out}/checkpoint", available_now=True
    )
    started.awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/data")


@query
def stream_routing(spark, folder):
    lines = order_lines(spark, folder, F.col("o_orderpriority") == "1-URGENT")
    out = new_folder(spark, "routes")
    started = start_routing(
        stream_lines(spark, f"{lines}/*"),
        "json",
        ORDER,
        success_path=f"{out}/success",
        failure_path=f"{out}/failure",
        checkpoint=f"{out}/checkpoint",
        transform=lambda df: hash_fields(df, {"/o_orderstatus": "/o_orderstatus"}, key=KEY),
        available_now=True,
    )
    started.awaitTermination()
    return both_routes(
        spark.read.parquet(f"{out}/success"), spark.read.parquet(f"{out}/failure")
    )


@query
def stream_dictionary(spark, folder):
    """Each pair once, over batches of one file that share most of their values."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus", "o_custkey")
    path, out = new_folder(spark, "orders"), new_folder(spark, "pairs")
    files = orders.withColumn("part", F.col("o_custkey") % 3)
    write_records(files, path, "json", partition_by=["part"])
    schema = "o_orderpriority string, o_orderstatus string, o_custkey bigint"
    stream = stream_records(spark, f"{path}/*", "json", schema, files_per_trigger=2)
    paths = {name: f"/{name}" for name in orders.columns}
    started = start_writing(
        distinct_pairs(key_hash_dictionary(stream, paths, key=KEY)),
        f"{out}/data",
        "parquet",
        checkpoint=f"{out}/checkpoint",
        available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    started.awaitTermination()
    return spark.read.schema("hash string, plaintext string").parquet(f"{out}/data")


# Made-up members, drawn from the ids of a table.


@query
def members(spark, folder):
    return table(spark, folder, "customer").select(*member_columns("c_custkey", seed=SEED))


@query
def hashed_members(spark, folder):
    path = round_trip(members(spark, folder), "csv", {"header": "false"})
    records = conform(read_delimited(spark, path, MEMBER_INPUT), MEMBER)
    mapping = {"/hashed_first_name": "/first_name", "/hashed_last_name": "/last_name"}
    return hash_fields(records, mapping, key=KEY)


# Spark SQL.


@query
def sql_functions(spark, folder):
    register_sql_functions(spark, KEY)
    part = table(spark, folder, "part")
    return spark.sql(
        "SELECT p_partkey, keyed_sha256(p_name) AS sha256, keyed_crc32(p_name) AS crc32, "
        "keyed_adler32(p_name) AS adler32, keyed_crc32c(p_name) AS crc32c, "
        "keyed_farmhashfingerprint64(p_name) AS farm, keyed_sha384(p_name) AS sha384, "
        "keyed_sha512(p_name) AS sha512 FROM {part}",
        part=part,
    )


# The largest table, by every digest.

LINEITEM_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def of_lineitem(algorithm: str) -> Query:
    """All of the largest table, three of its columns hashed in place.

    Of these, suppliers come back most often: each task puts their lines side by side, without
    a shuffle, so that files hold one token for many lines, however many suppliers there are.
    """

    def run(spark, folder):
        mapping = {f"/{name}": f"/{name}" for name in LINEITEM_KEYS}
        columns = ("l_linenumber", *LINEITEM_KEYS)
        lines = table(spark, folder, "lineitem").select(*columns)
        together = lines.sortWithinPartitions("l_suppkey", "l_partkey", "l_orderkey")
        return hash_fields(together, mapping, key=KEY, algorithm=algorithm)

    return run


for _algorithm in ALGORITHMS:
    _short = _algorithm.id.removeprefix("hash-").lower()
    QUERIES[f"lineitem_{_short}"] = of_lineitem(_algorithm.id)


@query
def lineitem_dictionary(spark, folder):
    paths = {name: f"/{name}" for name in LINEITEM_KEYS}
    return key_hash_dictionary(table(spark, folder, "lineitem"), paths, key=KEY)


# Types, defaults and short keys.


@query
def value_types(spark, folder):
    orders = table(spark, folder, "orders")
    typed = orders.select(
        "o_orderkey",
        (F.col("o_orderkey") / 4).alias("d"),
        (F.col("o_orderkey") % 2 == 0).alias("b"),
        (F.col("o_orderkey") * F.lit("0.125").cast("decimal(4,3)"))
        .cast("decimal(20,3)")
        .alias("n"),
        F.date_add(F.to_date(F.lit("2001-02-03")), (F.col("o_orderkey") % 9999).cast("int")).alias(
            "day"
        ),
        F.timestamp_micros(F.col("o_orderkey") * 3600000001).alias("t"),
    )
    return hash_fields(typed, {f"/{name}": "." for name in ("d", "b", "n", "day", "t")}, key=KEY)


@query
def default_algorithm(spark, folder):
    customer = table(spark, folder, "customer")
    return customer.select(
        "c_custkey",
        keyed_hash("c_name", KEY, None).alias("of_none"),
        keyed_hash("c_name", KEY, "").alias("of_empty"),
    )


@query
def farm_fingerprint64_short(spark, folder):
    nation = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    hashed = keyed_hash("c_mktsegment", "k", "hash-farmHashFingerprint64")
    return nation.select("c_custkey", hashed.alias("c_mktsegment"))


# Whole jobs.


def hashed_orders(spark: SparkSession, folder: str, fmt: str) -> DataFrame:
    """Orders written in folders by status with a line end of their own, through a job."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = new_folder(spark, "orders")
    options = {"lineSep": ";"}
    write_records(orders, path, fmt, options=options, partition_by=["o_orderstatus"])
    schema = orders.drop("o_orderstatus").schema
    out = new_folder(spark, "hashed")
    done = hash_files(
        spark,
        Source(path, fmt, schema, options),
        Sink(out, "parquet"),
        {"/o_orderpriority": "/o_orderpriority"},
        key=KEY,
    )
    return spark.read.parquet(out).withColumn("record_count", F.lit(done.record_count))


@query
def hash_files_csv(spark, folder):
    return hashed_orders(spark, folder, "csv")


@query
def hash_files_json(spark, folder):
    return hashed_orders(spark, folder, "json")


@query
def count_by_unit_(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    path = new_folder(spark, "orders")
    write_records(orders, path, "json", partition_by=["o_orderpriority"])
    lines = read_lines(spark, path, folders=True)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    counted = split_by_unit(lines, "json", schema).counts
    priority = F.url_decode(F.regexp_extract("unit", "o_orderpriority=([^/]*)$", 1))
    return counted.select(F.url_decode(priority).alias("unit"), "record_count")


def split_suppliers(spark: SparkSession, folder: str, fmt: str, options: dict) -> DataFrame:
    """Suppliers in files by nation; in those of two nations a key that is no number."""
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    bad = F.col("s_nationkey").isin(3, 7)
    number = F.col("s_suppkey").cast("string")
    key = F.when(bad, F.concat(F.lit("x"), number)).otherwise(number)
    path = new_folder(spark, "suppliers")
    files = supplier.withColumn("s_suppkey", key)
    write_records(files, path, fmt, options=options, partition_by=["s_nationkey"])
    schema = T.StructType.fromDDL("s_suppkey bigint, s_name string, s_nationkey int")
    routed = split_files(spark, path, fmt, schema, options=options, folders=True)
    good = hash_fields(routed.records, {"/s_name": "/s_name"}, key=KEY)
    nation = F.regexp_extract("unit", "s_nationkey=([0-9]+)$", 1).cast("int")
    failed = routed.failure.select(nation.alias("s_nationkey")).distinct()
    nothing = [F.lit(None).cast("bigint"), F.lit(None).cast("string")]
    columns = ("s_nationkey", "s_suppkey", "s_name")
    return good.select(F.lit("success").alias("route"), *columns).unionAll(
        failed.select(F.lit("failure"), "s_nationkey", *nothing)
    )


@query
def split_files_csv(spark, folder):
    return split_suppliers(spark, folder, "csv", {"header": "true"})


@query
def split_files_xml(spark, folder):
    return split_suppliers(spark, folder, "xml", {"rowTag": "supplier"})


@query
def hash_files_parquet(spark, folder):
    """Orders in columnar files by priority; those of one priority are no such files."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = new_folder(spark, "orders")
    bad = F.col("o_orderpriority") == "3-MEDIUM"
    write_records(orders.where(~bad), path, "parquet", partition_by=["o_orderpriority"])
    lines = orders.where(bad).select(F.to_json(F.struct("*")).alias("line"), "o_orderpriority")
    write_records(lines, path, "text", mode="append", partition_by=["o_orderpriority"])
    out = new_folder(spark, "hashed")
    hash_files(
        spark,
        Source(path, "parquet", orders.drop("o_orderpriority").schema),
        Sink(f"{out}/good", "parquet", f"{out}/bad", manifest_path=f"{out}/jobs"),
        {"/o_orderstatus": "/o_orderstatus"},
        key=KEY,
    )
    done = read_published(spark, f"{out}/jobs")
    priority = F.url_decode(F.regexp_extract("unit", "o_orderpriority=([^/]*)/", 1))
    failed = done.failure.select(F.url_decode(priority).alias("o_orderpriority")).distinct()
    nothing = [F.lit(None).cast("bigint"), F.lit(None).cast("string")]
    columns = ("o_orderpriority", "o_orderkey", "o_orderstatus")
    return done.records.select(F.lit("success").alias("route"), *columns).unionAll(
        failed.select(F.lit("failure"), "o_orderpriority", *nothing)
    )


@query
def quoted_csv_files(spark, folder):
    """Texts with line ends in quotes, in files with a header, that any number of tasks read."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    path, out = new_folder(spark, "texts"), new_folder(spark, "hashed")
    options = {"header": "true", "escape": '"'}
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    write_records(documents, path, "csv", options={**options, **spaces})
    source = Source(path, "csv", documents.schema, options)
    hash_files(spark, source, Sink(out, "parquet"), {"/text": "/text"}, key=KEY)
    return spark.read.schema(documents.schema).parquet(out)


@query
def schema_of_each_file(spark, folder):
    """Customers in files of differing fields, each hashed by its own schema, in one job."""
    customer = table(spark, folder, "customer")
    path, out = new_folder(spark, "customers"), new_folder(spark, "hashed")
    low = F.col("c_nationkey") < 12
    for rows, names in (
        (customer.where(low), ("c_custkey", "c_name")),
        (customer.where(~low), ("c_mktsegment", "c_custkey", "c_acctbal")),
    ):
        files = rows.select("c_nationkey", *names)
        write_records(files, path, "json", mode="append", partition_by=["c_nationkey"])
    hash_files(
        spark,
        Source(path, "json", discover=True),
        Sink(f"{out}/good", "parquet", manifest_path=f"{out}/jobs"),
        {"/c_name": "/c_name", "/c_mktsegment": "."},
        key=KEY,
    )
    columns = ("c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal")
    nothing = spark.createDataFrame([], customer.schema)
    for records in read_published(spark, f"{out}/jobs").tables:
        nothing = nothing.unionByName(records, allowMissingColumns=True)
    return nothing.select(*columns)


@query
def log_records(spark, folder):
    """Events as log files in which some records go on over several lines."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("Info")
    head = F.concat_ws(
        " ", "event_id", level, F.concat(F.lit("app."), "event_type", F.lit(": user")), "user_id"
    )
    trace = F.concat(F.lit("\n\tat line "), "user_id", F.lit("\n\nCaused by: "), "props")
    line = F.when(F.col("event_id") % 5 == 0, F.concat(head, trace)).otherwise(head)
    path = new_folder(spark, "logs")
    write_records(table(spark, folder, "events").select(line.alias("line")), path, "text")
    pattern = "%{INT:event_id} %{LEVEL:level} %{CLASS:source}: %{REST:message}"
    records = read_logs(spark, path, pattern)
    hashed = hash_fields(records, {"/message": "."}, key=KEY)
    return hashed.withColumn("event_id", F.col("event_id").cast("bigint"))
