"""From raw documents to token ids: five stages, each written and read again by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents, whatever they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm.bpe import bpe_round_trip, read_ranks
from maskwright.llm.mixing import mix_sources, training_order
from maskwright.llm.near_duplicates import drop_near_duplicates
from maskwright.llm.quality import labelled, quality_score, train_quality
from maskwright.llm.secrets import redact_secrets
from maskwright.llm.tables import held_out, quoted, stored, table

#: Documents with a lower score are rejected.
LEAST_QUALITY = 0.3
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels outside fold 0."""
    fold = held_out(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels")
    model = train_quality(labelled(docs, labels, fold, label_col="quality"))
    return docs.filter(quality_score(F.col("text"), model) >= LEAST_QUALITY)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced by marks."""
    return redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each use, in the order of training."""
    ordered = training_order(mix_sources(docs))
    return ordered.select(*(F.col(quoted(name)) for name in docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, with their number and whether they decode to the text."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    text = F.coalesce("text", F.lit(""))
    both = bpe_round_trip(text, ranks, public_tokenizers.PATTERN)
    encoded = docs.select("doc_id", text.alias("text"), both.alias("both"))
    return encoded.select(
        "doc_id",
        F.size("both.ids").cast("long").alias("n_tokens"),
        "both.ids",
        (F.col("both.decoded") == F.encode("text", "UTF-8")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicate_removal),
    ("secret scans", secret_redaction),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The first stage is a trained model, which SQL does not express.
ORACLE_SQL = None
