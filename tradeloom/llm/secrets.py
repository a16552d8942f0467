r"""Secret scans with an incremental ledger of blobs.

Each version of a text is a blob, known by the SHA-256 of its bytes. The ledger holds, per blob, which versions of
which rules have been run and the spans they found; a scan reads only those (blob, rule version) pairs that it lacks,
so a text under many paths is scanned once and a new rule version alone is run again. Findings are joined back to all
paths. Everything is DataFrame functions.

A rule's matches are the leftmost non-overlapping ones. Spark gives the matches and the pieces between them; adding up
their lengths gives the spans, in code points with the end excluded.

Defined results: a null text is the empty blob, without spans; repeated rows each get their blob's findings; other
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import shared_folder

LEDGER = "blob string, ran array<string>, spans array<struct<start:int,rank:int,end:int,rule:string>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what it matches, and how long the given group must be. A changed rule gets a new version."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    version: int = 1
    #: Finds something in every text in which the rule has a span; the pattern itself if not given.
    quick: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_any_case('api')}_?{_any_case('key')}"

#: The base kinds, in their order.
BASE_RULES = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, quick=r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, quick=r"[0-9a-f]{24,}"),
)
#: Token formats that issuers publish.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def blob_of(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    pattern = F.lit(rule.pattern)
    lengths = lambda x: F.transform(x, F.length)
    steps = F.arrays_zip(
        lengths(F.slice(F.split(text, rule.pattern), 1, F.size(F.regexp_extract_all(text, pattern, F.lit(0))))).alias("gap"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("own"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("held"),
    )
    span = "struct<start:int,rank:int,end:int,rule:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + step["gap"]
        end = begin + step["own"]
        one = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.key).alias("rule")).cast(span)
        return F.struct(
            end.alias("at"),
            F.when(step["held"] >= rule.min_length, F.array_append(state["spans"], one)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(steps, start, add, lambda state: state["spans"])


class Ledger:
    """The written ledger: a folder of batches, each written whole by one scan. On a path that holds some, it takes up
    those that were completed."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_folder(spark)}/blob-ledger-{uuid.uuid4().hex}"
        self.batches: list[str] = self._completed() if path else []

    def _completed(self) -> list[str]:
        """Batches in the folder that Spark has marked as written whole."""
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        folder = Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        inside = [status.getPath() for status in files.listStatus(folder)]
        return sorted(p.toString() for p in inside if p.getName().startswith("batch-") and files.exists(Path(p, "_SUCCESS")))

    def rows(self) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*self.batches)

    def add(self, rows: DataFrame) -> None:
        batch = f"{self.path}/batch-{uuid.uuid4().hex}"
        rows.write.parquet(batch)
        self.batches.append(batch)


def unseen(documents: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Blobs with the rule versions that have not been run on them: blob, text, todo."""
    every = F.array(*(F.lit(r.key) for r in rules))
    blobs = (
        documents.select(F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("blob", blob_of(F.col("text")))
        .groupBy("blob")
        .agg(F.first("text").alias("text"))
    )
    if not ledger.batches:
        return blobs.withColumn("todo", every)
    done = ledger.rows().select("blob", F.explode("ran").alias("key")).groupBy("blob").agg(F.collect_set("key").alias("done"))
    todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan_unseen(documents: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> None:
    """Runs the missing (blob, rule version) pairs and writes them to the ledger."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    found = [
        F.when(F.array_contains("todo", r.key) & F.col("text").rlike(r.quick or r.pattern), _spans(F.col("text"), r, i)).otherwise(none)
        for i, r in enumerate(rules)
    ]
    ledger.add(unseen(documents, ledger, rules).select("blob", F.col("todo").alias("ran"), F.concat(*found).alias("spans")))


def findings(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob with a span of these rule versions: blob, spans (by start, then rule order)."""
    keys = [r.key for r in rules]
    return (
        ledger.rows()
        .select("blob", F.filter("spans", lambda s: s["rule"].isin(keys)).alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    )


def scan(documents: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: document (a struct of all its columns), blob, spans (empty if it has none)."""
    ledger = ledger or Ledger(documents.sparkSession)
    scan_unseen(documents, ledger, rules)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    named = documents.select(F.struct(*documents.columns).alias("document"), blob_of(F.col("text")).alias("blob"))
    joined = named.join(findings(ledger, rules), "blob", "left")
    return joined.select("document", "blob", F.coalesce("spans", none).alias("spans"))


def kind_of(span: Column) -> Column:
    return F.element_at(F.split(span["rule"], "@"), 1)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by one mark. Spans are in order of their start."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        gap = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        touching = (span["start"] == state["at"]) & (state["at"] > 0)
        piece = F.when(touching, F.lit("")).when(fresh, F.concat(gap, F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    done = F.aggregate(spans, start, add, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
