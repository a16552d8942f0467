"""The registered queries of these operators, each over its whole table, next to the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import centroids, extraction, languages, licenses, long_repeats, manifest, mixing, model_scores, near_copies, oracles, packing, quality, secrets, top_k
from tradeloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def word_tokenizer() -> str:
    """The tokenizer that the packing query is to use; its file stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


@query("op1_top_k", oracles.top_k())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    vectors = top_k.valid_vectors(table(spark, folder, "embeddings"))
    return top_k.search(vectors.where(F.col("vec_id") % 50 == 0), vectors)


@query("op2_quality_rules", oracles.quality())
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("clean_text")


@query("op3_extraction")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


@query("op4_mixing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), word_tokenizer())


@query("op6_long_repeats", oracles.long_repeats())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return long_repeats.without_repeats(table(spark, folder, "documents"))


@query("op7_near_copies", oracles.near_copies())
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies.classes(table(spark, folder, "documents"), near_copies.Settings(words=3, percent=85))


@query("op8_secret_scan", oracles.secrets())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = [r.key for r in secrets.BASE_RULES]

    def count(rule: secrets.Rule):
        return F.size(F.filter("spans", lambda s: s["rule"] == rule.key)).cast("long").alias(f"n_{rule.kind}")

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", secrets.kind_of(s), s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    return scanned.select(
        "document.doc_id",
        *(count(r) for r in secrets.BASE_RULES),
        F.sha2(listed(F.filter("spans", lambda s: s["rule"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op9_languages")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    profiles = languages.learn(documents.where(~languages.held_out()))
    found = languages.predict(documents, profiles)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


@query("op10_license_scan", oracles.licenses())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op11_centroids", oracles.centroids())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


@query("op12_model_scores")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return model_scores.score(table(spark, folder, "documents"))


@query("op13_manifest", oracles.manifest())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest(table(spark, folder, "documents"))
