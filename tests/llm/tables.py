"""Small tables for the operators' tests."""

from __future__ import annotations

import random

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, langs=None, sources=None, ids=None):
    rows = [
        (
            i if ids is None else ids[i],
            text,
            langs[i] if langs else "en",
            sources[i] if sources else "a",
            None if text is None else len(text),
        )
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def with_strange_columns(frame, *names):
    """The frame with further columns, named like those that operators make for themselves."""
    from pyspark.sql import functions as F

    return frame.select("*", *(F.lit("x").alias(n) for n in names))


def prose(seed: int, words: int, vocabulary: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def by_id(frame, *columns):
    """Rows by doc_id; the ids must be unique."""
    rows = frame.select("doc_id", *columns).collect()
    out = {r[0]: tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows}
    assert len(out) == len(rows)
    return out
