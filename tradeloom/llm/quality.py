"""Quality rules, line first: lines that fail a rule go, then documents that lost too much of their text.

A line fails as *punctuation* when it neither ends a sentence nor, if it is long, holds one, or carries more marks than
prose does, as *navigation*
when it is a row of short entries between separators, as *boilerplate* when it is a short line with a site's stock
phrase. Everything is DataFrame functions; a document never leaves its row and nothing is shuffled.

Defined results: a null or empty text has no words and fails the base rules; lines without a word are neither kept
nor counted; repeated rows are judged one by one; other columns of the input are ignored; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import words

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
#: What separates the entries of a menu.
SEPARATORS = "|>»›·•"
#: A line that ends so ends a sentence; closing quotes and brackets may follow.
SENTENCE_END = r"[.!?…:;。！？][\"'”’»)\]]*[ \t\x0b\f\r]*$"
#: A sentence that ends inside a line.
SENTENCE_INSIDE = r"[.!?…][\"'”’»)\]]* "
#: Stock phrases of sites, in lower case.
STOCK_PHRASES = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use cookies",
    "enable javascript", "sign up for", "log in to", "subscribe to our", "powered by", "click here", "read more",
    "share this", "follow us", "skip to content", "back to top", "lorem ipsum",
)


@dataclass(frozen=True)
class Rules:
    """The base rules and the limits of the line rules."""

    min_words: int = 50
    max_repeat_pct: int = 50
    #: Marks (symbols, and repeated ! or ?) a line may have per hundred words.
    max_marks_pct: int = 20
    #: Lines from so many words on may end in the middle of a sentence.
    long_words: int = 10
    #: From so many separators on, a line with at most so many words between two of them is navigation.
    min_separators: int = 3
    max_entry_words: int = 4
    #: A stock phrase counts in lines of at most so many words.
    max_stock_words: int = 30
    #: A document may lose so many of a hundred words.
    max_lost_pct: int = 40


#: A symbol, and repeated ! or ?.
MARKS = f"[{SYMBOLS}]|[!?]{{2}}"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]", ""))


def _may(text: Column, rules: Rules) -> list[Column]:
    """Whether any line of a text can fail by its marks, as navigation or as boilerplate: most texts hold nothing of the
    kind, and their lines need not be looked at for it."""
    lowered = F.lower(text)
    stock = reduce(or_, (lowered.contains(p) for p in STOCK_PHRASES))
    separators = reduce(or_, (text.contains(s) for s in SEPARATORS)) if rules.min_separators > 0 else F.lit(True)
    return [text.rlike(MARKS).alias("marked"), separators.alias("separated"), stock.alias("stocked")]


def _line_fails(line: Column, rules: Rules) -> Column:
    n = F.size(words(line))
    marks = _count(line, SYMBOLS) + _count(F.regexp_replace(line, r"[!?]{2,}", "##"), "#") - _count(line, "#")
    separators = _count(line, SEPARATORS)
    # A later condition is looked at only where those before it leave the question open.
    return (
        (~line.rlike(SENTENCE_END) & ~(line.rlike(SENTENCE_INSIDE) & (n >= rules.long_words)))
        | (F.col("marked") & line.rlike(MARKS) & (100 * marks > rules.max_marks_pct * n))
        | (F.col("separated") & (separators >= rules.min_separators) & (n <= rules.max_entry_words * (separators + 1)))
        | (F.col("stocked") & reduce(or_, (F.lower(line).contains(p) for p in STOCK_PHRASES)) & (n <= rules.max_stock_words))
    )


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the words in `w`: how many stand in a three-word window found twice or more.

    Most texts have no window twice, which hashes of the windows settle; equal hashes are looked at again by sorting
    the windows themselves, so the count is exact."""
    frame = frame.withColumn(
        "hashes", F.when(F.size("w") > 2, F.expr("transform(slice(w, 1, size(w) - 2), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))"))
    ).withColumn("twice", F.size("hashes") > F.size(F.array_distinct("hashes")))
    frame = frame.drop("hashes").withColumn(
        "sorted",
        F.when(
            F.col("twice"),
            F.expr(
                "sort_array(transform(slice(w, 1, size(w) - 2),"
                " (x, i) -> struct(concat(x, ' ', w[i + 1], ' ', w[i + 2]) AS g, i AS p)))"
            ),
        ),
    )
    frame = frame.drop("twice").withColumn(
        "found",
        F.expr(
            "sort_array(transform(filter(sorted, (e, j) -> coalesce(get(sorted, j - 1).g = e.g, false)"
            " OR coalesce(get(sorted, j + 1).g = e.g, false)), e -> e.p))"
        ),
    )
    covered = "transform(found, (p, j) -> least(3, coalesce(get(found, j + 1) - p, 3)))"
    return frame.drop("sorted").withColumn(
        "n_repeat_words", F.expr(f"coalesce(aggregate({covered}, 0L, (a, x) -> a + x), 0L)")
    ).drop("found")


def judge(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, the counts of lines, and clean_text (its lines
    that pass, joined by line feeds)."""
    frame = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    frame = frame.withColumn("w", words(F.col("t")))
    frame = frame.select(
        "doc_id", "w", "t",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        *_may(F.col("t"), rules),
    )
    frame = _repeated_words(frame).drop("w")
    frame = frame.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).drop("t")
    frame = frame.withColumn("good", F.filter("lines", lambda x: ~_line_fails(x, rules)))
    frame = frame.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_repeat_words", "good",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
    ).withColumn("clean_text", F.array_join("good", "\n"))
    cleaned = F.when(F.size("good") == F.col("n_lines"), F.col("n_words")).otherwise(F.size(words(F.col("clean_text"))))
    frame = frame.withColumn("n_clean_words", cleaned.cast("long"))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")
    )
    lost = 100 * (F.col("n_words") - F.col("n_clean_words")) > rules.max_lost_pct * F.col("n_words")
    return frame.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~lost).alias("kept"),
        "n_lines", F.size("good").cast("long").alias("n_clean_lines"), "n_clean_words", "clean_text",
    )
