"""Long repeats across documents by recompression, and their removal.

Words get global numbers by hash. In each round runs of an equal symbol and then pairs of neighbours (a left symbol
followed by a right one, sides by a bit of the symbol's hash) are renamed by a hash of what they hold, so equal stretches
get equal symbols everywhere without a shared dictionary. Only the edges of a stretch can be parsed differently, as a
choice looks at the neighbours; every symbol therefore carries the span of words its name depends on. A window of words
is known by one symbol that depends on that window alone (the one whose span of words hashes least) or, where there is
none, by its own words.

1. Documents with equal words become one, the smallest doc_id; a later one is removed whole.
2. Symbols that stand for a window in two documents reveal possible repeats (partial sums first: a symbol may be in any
   number of documents).
3. Windows of revealed symbols are verified by 128-bit hashes of their words: the first document of each window keeps
   it, the others lose the words it covers.

Every window of every whole text is judged; no pairs of documents are made.

Defined results: null texts have no words; documents shorter than a window lose nothing; windows equal within one document
stay; rows that share a doc_id never remove from each other, each is judged by its own text; rows without doc_id
neither lose words nor make others lose them; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import ship, written
from tradeloom.llm.tokens import groups, mixed, numbered, words_of

#: Words of a window and rounds of recompression; after more rounds fewer windows hold a symbol of their own.
WINDOW, ROUNDS = 50, 4
#: Odd bases of the two window hashes, and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _shifted(values: np.ndarray, step: int) -> np.ndarray:
    """The neighbour before (step -1) or after (1); meaningless at the ends."""
    return np.roll(values, -step)


def recompressed(values: np.ndarray, owner: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after some rounds with the words [low, high) that each depends on; a symbol that depends on
    where its document begins or ends has low = -1 and is of no use elsewhere."""
    name, low = values, np.arange(len(values))
    high = low + 1
    for round_ in range(rounds):
        if not len(name):
            break
        # Runs: a symbol and its length, seen only together with both neighbours.
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(name))
        length = stop - start
        own = owner[start]
        has_left = np.append(False, own[1:] == own[:-1])
        has_right = np.append(own[1:] == own[:-1], False)
        before, after = np.maximum(start - 1, 0), np.minimum(stop, len(name) - 1)
        bad = ~has_left | ~has_right | (low[start] < 0) | (low[stop - 1] < 0) | (low[before] < 0) | (low[after] < 0)
        name = np.where(length > 1, mixed(name[start] + mixed(length.astype(np.uint64))), name[start])
        low, high, owner = np.where(bad, -1, low[before]), high[after], own
        # Pairs: a left symbol and the right one after it. A symbol left alone depends on the neighbour that did not fit.
        side = (mixed(name + np.uint64(round_ + 1)) & np.uint64(1)).astype(bool)
        opens = has_right & ~side & _shifted(side, 1)
        closes = np.append(False, opens[:-1])
        merged = mixed(mixed(name) + _shifted(name, 1))
        neighbour = np.where(side, has_left, has_right)
        bad = ~opens & (~neighbour | (np.where(side, _shifted(low, -1), _shifted(low, 1)) < 0))
        new_low = np.where(opens, low, np.where(side, _shifted(low, -1), low))
        new_high = np.where(opens, _shifted(high, 1), np.where(side, high, _shifted(high, 1)))
        bad |= (low < 0) | (opens & (_shifted(low, 1) < 0))
        keep = ~closes
        name = np.where(opens, merged, name)[keep]
        low, high, owner = np.where(bad, -1, new_low)[keep], new_high[keep], owner[keep]
    return name, low, high


def _windows(bounds: np.ndarray, window: int) -> np.ndarray:
    """First words of all windows that lie within one document."""
    starts = [np.arange(a, b - window + 1) for a, b in zip(bounds, bounds[1:]) if b - a >= window]
    return np.concatenate(starts) if starts else np.zeros(0, np.int64)


def span_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, both: bool = True) -> list[np.ndarray]:
    """One or two 64-bit hashes of the words in each span."""
    out = []
    for base in _BASES[: 1 + both]:
        own = mixed(values ^ np.uint64(base))
        powers, inverse, sums = (np.ones(len(values) + 1, np.uint64) for _ in range(3))
        powers[1:] = np.cumprod(np.full(len(values), base, np.uint64))
        inverse[1:] = np.cumprod(np.full(len(values), pow(base, -1, 2**64), np.uint64))
        sums[0] = 0
        np.cumsum(own * powers[:-1], out=sums[1:])
        out.append(mixed((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64)))
    return out


def window_names(values: np.ndarray, bounds: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and the name by which each is known."""
    starts = _windows(bounds, window)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, low, high = recompressed(values, owner, rounds)
    use = (low >= 0) & (high - low <= window)
    low, high = low[use], high[use]
    # A symbol left alone may be one frequent word; what it depends on tells it apart, and is as consistent.
    (name,) = span_hashes(values, low, high, both=False)
    first = np.searchsorted(low, starts, "left")
    last = np.searchsorted(high, starts + window, "right") - 1
    out = np.zeros(len(starts), np.uint64)
    has = last >= first
    if has.any():
        steps = [name]  # steps[i][j]: the least of 2**i names from j on
        while 2 ** len(steps) <= int((last - first + 1).max()):
            before, half = steps[-1], 2 ** (len(steps) - 1)
            steps.append(np.minimum(before[:-half], before[half:]))
        size = last[has] - first[has] + 1
        level = np.frexp(size.astype(float))[1] - 1
        least = np.zeros(int(has.sum()), np.uint64)
        for i, step in enumerate(steps):
            at = np.flatnonzero(level == i)
            if len(at):
                least[at] = np.minimum(step[first[has][at]], step[last[has][at] - 2**i + 1])
        out[has] = mixed(least)
    if not has.all():
        (alone,) = span_hashes(values, starts[~has], starts[~has] + window, both=False)
        out[~has] = mixed(alone + np.uint64(1))
    return starts, out


def _sha(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _text_id(sha: bytes) -> int:
    return int.from_bytes(sha[:4], "little", signed=True)


def _named(documents: DataFrame, window: int, rounds: int) -> DataFrame:
    """doc_id, n_words, sha (of the words joined by spaces) and the distinct names of the document's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                documents = [words_of(t) for t in texts]
                values, bounds = numbered(documents)
                starts, names = window_names(values, bounds, window, rounds)
                cuts = np.searchsorted(starts, bounds)
                own = [np.unique(names[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array([len(d) for d in documents], pa.int64()),
                        pa.array([_sha(d) for d in documents], pa.binary()),
                        pa.array(own, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_words", "sha", "names"],
                )

    return documents.mapInArrow(run, "doc_id long, n_words long, sha binary, names array<long>")


def _revealed_windows(texts: DataFrame, window: int, rounds: int) -> DataFrame:
    """h1, h2, doc_id, text_id, at: the windows known by one of the row's `names`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                documents = [words_of(t) for t in texts]
                values, bounds = numbered(documents)
                starts, names = window_names(values, bounds, window, rounds)
                cuts = np.searchsorted(starts, bounds)
                wanted = batch.column("names").slice(first, len(texts))
                hits = [
                    a + np.flatnonzero(np.isin(names[a:b], np.array(w.as_py(), np.int64).view(np.uint64)))
                    for w, a, b in zip(wanted, cuts, cuts[1:])
                ]
                rows = np.repeat(np.arange(len(texts)), [len(h) for h in hits])
                hits = np.concatenate(hits) if hits else np.zeros(0, np.int64)
                h1, h2 = span_hashes(values, starts[hits], starts[hits] + window)
                owners = np.array(batch.column("doc_id").slice(first, len(texts)).to_pylist(), np.int64)
                ids = batch.column("text_id").slice(first, len(texts)).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.array(owners[rows]),
                        pa.array(ids[rows]),
                        pa.array((starts[hits] - bounds[rows]).astype(np.int32)),
                    ],
                    names=["h1", "h2", "doc_id", "text_id", "at"],
                )

    return texts.select("doc_id", "text_id", "text", "names").mapInArrow(run, "h1 long, h2 long, doc_id long, text_id int, at int")


def _without(texts: DataFrame, window: int, with_text: bool) -> DataFrame:
    """doc_id, sha, n_removed, kept_sha of texts whose windows starting at `starts` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                removed, kept = [], []
                for text, starts in zip(texts, batch.column("starts").slice(first, len(texts))):
                    words = words_of(text)
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(starts.values.to_numpy())
                    edge[at] += 1
                    np.subtract.at(edge, at + window, 1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed.append(int(gone.sum()))
                    kept.append([w for w, g in zip(words, gone) if not g])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        batch.column("sha").slice(first, len(texts)),
                        pa.array(removed, pa.int64()),
                        pa.array([_sha(k) for k in kept], pa.binary()),
                        pa.array([b" ".join(k).decode() if with_text else None for k in kept], pa.string()),
                    ],
                    names=["doc_id", "sha", "n_removed", "kept_sha", "kept_text"],
                )

    chosen = texts.select("doc_id", "text", "sha", "starts")
    return chosen.mapInArrow(run, "doc_id long, sha binary, n_removed long, kept_sha binary, kept_text string")


def _fetched(texts: DataFrame, revealed: DataFrame) -> DataFrame:
    """doc_id, sha, text_id (tells apart texts that share a doc_id), text, names of the revealed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                part = batch.slice(first, len(texts))
                shas = part.column("sha").to_pylist()
                part = part.append_column("text_id", pa.array([_text_id(s) for s in shas], pa.int32()))
                keep = [_sha(words_of(t)) == s for t, s in zip(texts, shas)]
                yield part.filter(pa.array(keep, pa.bool_()))

    joined = texts.join(revealed, "doc_id").select("doc_id", "sha", "text", "names")
    return joined.mapInArrow(run, "doc_id long, sha binary, text string, names array<long>, text_id int")


def without_repeats(documents: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (the kept words joined by
    spaces; null where all words are kept)."""
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = written(_named(texts, window, rounds), "named")
    firsts = named.groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    placed = named.drop("names").join(firsts, "sha")
    used = named.join(firsts, "sha").where("doc_id = first_id").select("doc_id", "sha", F.explode("names").alias("name"))
    shared = used.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("name")
    revealed = used.join(shared, "name").groupBy("doc_id", "sha").agg(F.collect_set("name").alias("names"))
    fetched = written(_fetched(texts, revealed), "revealed")
    windows = written(_revealed_windows(fetched, window, rounds), "windows")
    holders = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").drop("b")
    # Written, so that both sides of the join come from shuffles of their own and Spark can split a hot window.
    holders = written(holders, "holders")
    later = windows.join(holders, ["h1", "h2"]).where("doc_id > a")
    gone = later.groupBy("doc_id", "text_id").agg(F.collect_set("at").alias("starts"))
    cut = _without(fetched.join(gone, ["doc_id", "text_id"]), window, with_text).dropDuplicates(["doc_id", "sha"])
    joined = placed.join(cut, ["doc_id", "sha"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= window)
    none = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    kept = F.when(copy, none).otherwise(F.coalesce("kept_sha", "sha"))
    columns = [
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.lower(F.hex(kept)).alias("kept_sha256"),
    ]
    return joined.select(*columns, F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")) if with_text else joined.select(*columns)
