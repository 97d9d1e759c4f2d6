"""One query for each operator, over whole tables, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import mixing, oracles, secrets
from maskwright.llm.bpe import bpe_round_trip, read_ranks
from maskwright.llm.conversation_repair import digests, repair
from maskwright.llm.embedding_links import embedding_links
from maskwright.llm.filter_audit import filter_audit, word_filters
from maskwright.llm.language import predict_language, train_language
from maskwright.llm.mixing import mix_sources
from maskwright.llm.near_duplicates import near_duplicates
from maskwright.llm.nearest import nearest
from maskwright.llm.personal_data import BASE as PERSONAL
from maskwright.llm.personal_data import personal_data
from maskwright.llm.quality import labelled, quality_score, train_quality
from maskwright.llm.secrets import scan_secrets
from maskwright.llm.spans import count_of, listed
from maskwright.llm.tables import held_out, table
from maskwright.llm.token_counts import read_merges, token_count
from maskwright.llm.toxicity import letter_trigrams, toxicity_score, train_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
COUNTED_VOCABULARY = "word_bpe_49k.json"
#: Tokens that a model takes at once.
TOKEN_LIMIT = 2048
QUERIES["pipeline"] = corpus_pipeline.run


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function

#: A score from here on predicts the label 1.
PREDICTED = 0.3


@query
def op4_quality_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    fold = held_out(F.col("doc_id"), 5, 0)
    model = train_quality(
        labelled(documents, table(spark, folder, "labels"), fold, label_col="quality")
    )
    scored = documents.select(
        "doc_id", fold.alias("held_out"), quality_score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


@query
def op5_language_svm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    fold = held_out(F.col("doc_id"), 4, 2)
    model = train_language(documents.filter(~fold).select("text", "lang"))
    predicted = documents.select(
        "doc_id", fold.alias("held_out"), predict_language(F.col("text"), model).alias("found")
    )
    return predicted.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score")
    )


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    both = bpe_round_trip(F.col("text"), ranks, public_tokenizers.PATTERN)
    decoded = table(spark, folder, "documents").select("doc_id", both.alias("both"))
    decoded = decoded.select("doc_id", "both.*")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(documents)
    mix = F.col(mixed.columns[-1])
    planned = mixed.select(
        "doc_id",
        mix["size"].alias("size"),
        mix["source_size"].alias("source_size"),
        mix["target"].alias("target"),
        mix["taken"].alias("taken"),
        F.round(F.get(mix["takes"], F.lit(0))["position"], 6).alias("position"),
    )
    return planned.repartitionByRange("position", "doc_id").sortWithinPartitions("position")


ORACLES["op2_mixing"] = oracles.mixing(
    mixing.WEIGHTS, mixing.SCHEDULES, mixing.SHARE, mixing.MOST
)


@query
def op9_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    scanned = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col(scanned.columns[-1])
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE))
    return scanned.select(
        "doc_id",
        *(count_of(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


ORACLES["op1_secrets"] = oracles.secrets(
    {
        "assign": (
            secrets.ASSIGN,
            f"length(regexp_extract(value, {oracles.quoted(secrets.ASSIGN)}, 2)) >= 12",
        ),
        "access": (secrets.ACCESS, "true"),
        "hex": (secrets.HEX, "true"),
        "key_id": (secrets.KEY_ID, "true"),
        "opaque": (
            secrets.OPAQUE,
            " AND ".join(f"regexp_matches(value, '{c}')" for c in ("[0-9]", "[A-Z]", "[a-z]")),
        ),
        "endpoint": (secrets.ENDPOINT, "true"),
    },
    secrets.ROLES,
    secrets.BASE,
    secrets.SCOPE,
)


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    fold = held_out(F.col("doc_id"), 4, 2)
    counts = letter_trigrams(documents.select("text"))
    examples = labelled(documents, table(spark, folder, "labels"), fold, label_col="toxic")
    model = train_toxicity(examples, counts)
    scored = documents.select(
        "doc_id", fold.alias("held_out"), toxicity_score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


@query
def op3_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(table(spark, folder, "embeddings"))


@query
def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    found = nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*PERSONAL))
    return found.select(
        "doc_id",
        *(count_of(spans, kind).alias(f"n_{kind}") for kind in PERSONAL),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


@query
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    merges = read_merges(public_tokenizers.path(COUNTED_VOCABULARY))
    counted = table(spark, folder, "documents").select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_count(F.col("text"), merges).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return filter_audit(
        table(spark, folder, "documents").select("doc_id", "text", "lang"),
        word_filters(F.col("text")),
        part=F.col("lang"),
        marks={
            "good_lost": labels.filter("quality = 1").select("doc_id"),
            "toxic_lost": labels.filter("toxic = 1").select("doc_id"),
        },
        repeated="E",
    )


ORACLES["op12_filter_audit"] = oracles.filter_audit()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of conversations with faults by a hash of their conversation and turn: dropped,
    emptied, without their full stops, repeated, or of the role ``user``."""

    def or_space(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    place = F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))
    rows = conversations.select(
        "conv_id",
        "turn",
        or_space("role").alias("role"),
        or_space("text").alias("text"),
        (F.crc32(place) % 20).alias("damage"),
    )
    damage, text = F.col("damage"), F.col("text")
    emptied = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", ""))
    return rows.filter(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        emptied.otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(damage == 3, 2).otherwise(1))).alias("copy"),
    )


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    repaired = repair(damaged(conversations))
    found = repaired.audits.join(
        digests(repaired.rows).withColumnRenamed("conversation", "digested"),
        F.col("conversation").eqNullSafe(F.col("digested")),
        "left",
    )
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("conversation")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


ORACLES["op13_conversation_repair"] = oracles.conversation_repair()
