"""A training corpus pipeline over ``documents``; each stage is written and read again.

Stages: toxic documents go; one document of each group of near copies stays; documents that
hold benchmark questions go; personal data get surrogates; what is left is packed. All
stages but the last return the columns of ``documents``. A row is judged by its own text: no
row goes because another one has the same doc_id, or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import decontamination, jaccard, packing, pii, toxicity
from tablewarden.llm.common import Scratch, load, small_batches

BROADCAST_KEYS = 100_000  # digests of 32 bytes, or row ids
SLICE = 1000  # texts of a batch
# Surrogates bear no loss. They are some 0.1 % of the tokens, two of a sequence, so with this limit
# on loss, sequences bear about the same and it is about as scarce as the tokens.
LIMITS = packing.Limits(packing.TOKENS, 16, packing.TOKENS - 2)


def without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not among ``keys``, a written table. Null keys stay."""
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return docs.join(keys, key, "left_anti")


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents predicted toxic; the scorer learns from all labels."""
    scorer = toxicity.train(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, scorer)
    return scored.filter(F.col("predicted") == 0).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that of the smallest id; null ids come last.

    Rows get ids of their own, so rows that share a doc_id, or have none, are told apart and
    repeated rows are copies. Documents with no words have no near copies and stay.
    """
    scratch = Scratch(spark)
    # written, so that a row keeps its id; the name clashes with no column
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = jaccard.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    found = scratch.save(found.filter("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id"), "found")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row)
    placed = found.join(rows.select("doc_id", row), row).select(row, "component_id", order.alias("place"))
    placed = scratch.save(placed, "placed")
    kept = scratch.save(placed.groupBy("component_id").agg(F.min("place").alias("kept"), F.count("*").alias("n")).filter("n > 1"), "kept")
    extra = placed.join(kept, "component_id").filter("place <> kept").select(row)
    return without(rows, scratch.save(extra, "extra"), row).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the texts that hold a benchmark question, re-parameterised or not."""
    key = "_digest"
    while key in docs.columns:
        key += "_"
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))  # null for a null text, which stays
    # equal texts have equal verdicts, so a text's digest is its id
    texts = docs.select(digest.alias("doc_id"), "text")
    found = decontamination.contaminations(texts, load(spark, sf_dir, "benchmark"))
    with small_batches(spark, SLICE):
        found = Scratch(spark).save(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return without(docs.withColumn(key, digest), found, key).select(docs.columns)


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts and counts their characters anew."""
    changed = pii.pseudonymise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into training sequences; a row per piece, with its tokens that bear loss and
    the limit that closed its sequence."""
    marked = pii.stretches(docs.select("doc_id", "text"), "stretches")
    return packing.pack(marked, packing.default_tokenizer(), LIMITS, stretches="stretches")


STAGES = [
    ("toxicity", clean_speech),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", decontaminated),
    ("pii", pseudonymised),
    ("packing", packed),
]

# Tokens, surrogates and learnt scores cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = load(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
