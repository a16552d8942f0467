"""The corpus pipeline: documents of a known language, one of each near-duplicate group, without secrets, mixed to
target weights and packed into training sequences. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import languages, mixing, near_copies, packing, secrets
from tradeloom.llm.common import table, written
from tradeloom.llm.queries import word_tokenizer


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language that their table teaches."""
    return languages.keep_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each near-duplicate group (five-word shingles, similarity of 0.8 or more)."""
    return near_copies.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; the documents stay."""
    scanned = secrets.scan(docs)
    found = F.size("spans") > 0
    marked = scanned.select("document", F.when(found, secrets.redact(F.col("document")["text"], F.col("spans"))).alias("clean"))
    # Only `document` and `clean` stand beside the struct, so columns of any name may be in it.
    changed = {"text": F.coalesce("clean", F.col("document")["text"])}
    changed["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast("long")).otherwise(F.col("document")["n_chars"])
    return marked.select(*[changed.get(c, F.col("document")[c]).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources come near their target weights."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in as few sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language ID", known_languages),
    ("near-duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned languages, MinHash and packing are not expressible in SQL; a test holds the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
