"""Language identification by rank-order profiles of n-grams.

A profile is a language's most frequent letter n-grams in order. A document's own most frequent n-grams are compared with
each profile: every one adds the distance between its two ranks, or the whole length of the profile if it is missing
there. The language with the least sum is predicted; the score is the share of the largest possible sum that was
avoided.

N-grams run over lower-case letters; each stretch of anything else counts as one space. Ties in frequency go to the
n-gram first in code-point order, ties in distance to the language first in that order.

Profiles come from all documents that have a language (where `sample` is set, from so many a language, first in a hash order
of their id): n-grams are counted by task and added up by n-gram. They hold `profile` n-grams a language, which is all that
reaches the driver. Every document is scored on its whole text.

What is of no learned language scores below them, by how much depends on its length. So `keep_known` scores these documents
themselves, whole texts and their first and last stretches of 16, 32, 64 and so on letters, and rejects what scores below
`margin` times the lowest score that its language had at its length; the lowest scores are exact quantiles of all. Texts of fewer than 16 letters (a stretch of
others counting as one) are too short to tell; `min_score` alone rejects them.

Defined results: null texts and texts without letters are `und` with score 0, as is every text if nothing could be
learned; rows of the training table without text, letters or language teach nothing; repeated rows are scored one by
one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import frugal, ship, written
from tradeloom.llm.tokens import groups
from tradeloom.operators.quantiles import exact_quantiles

#: Characters worked on at a time; a longer text is counted in such parts.
PART = 500_000
#: Different n-grams of all languages that a task adds up before it hands them on, about.
HELD = 1_000_000


@dataclass(frozen=True)
class Settings:
    """sample: training documents a language, all if not set; profile: n-grams of a language; top: of a document; longest: their
    length; min_score: below it `keep_known` rejects, as below `margin` times the lowest score of the training documents, of which
    the share `stray` is taken for wrongly labelled."""

    sample: int | None = None
    profile: int = 400
    top: int = 300
    longest: int = 3
    min_score: float = 0.05
    margin: float = 0.55
    stray: float = 0.01


#: Lengths are told apart by powers of two, between these exponents.
SHORTEST, LONGEST = 4, 11


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points; 0 for each stretch of others, and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    points = np.concatenate([[np.uint64(0)], points, [np.uint64(0)]])
    return points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]


def ngrams(text: str | None, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams as numbers (21 bits a character, the last lowest, so their order is that of equally long
    strings) and how often each occurs. Those of spaces alone are left out."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = _codes(text)
    found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, len(codes), PART):
        part = codes[start : start + PART + longest - 1]
        grams, size = [], min(PART, len(codes) - start)
        for n in range(1, longest + 1):
            own = np.zeros(max(0, min(size, len(part) - n + 1)), np.uint64)
            for i in range(n):
                own = (own << np.uint64(21)) | part[i : i + len(own)]
            grams.append(own[own != 0])
        some, many = np.unique(np.concatenate(grams), return_counts=True)
        found, back = np.unique(np.concatenate([found, some]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, many]), len(found)).astype(np.int64) if len(found) else counts
    return found, counts


def ranked(found: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in order of rank."""
    if len(found) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))][:top]


class Profiles:
    """Languages with their ranked n-grams, laid out for lookup."""

    def __init__(self, profiles: dict[str, list[int]], length: int):
        self.languages = sorted(profiles)
        self.length = length
        self.known = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.languages), len(self.known)), -1, np.int64)
        for row, name in enumerate(self.languages):
            grams = np.array(profiles[name], np.uint64)
            self.ranks[row, np.searchsorted(self.known, grams)] = np.arange(len(grams))

    def predict(self, text: str | None, settings: Settings) -> tuple[str, float]:
        own = ranked(*ngrams(text, settings.longest), settings.top)
        if not len(own) or not self.languages:
            return "und", 0.0
        places = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        there = self.ranks[:, places]
        missing = (self.known[places] != own) | (there < 0)
        apart = np.where(missing, self.length, np.abs(there - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())
        return self.languages[best], 1.0 - float(apart[best]) / (self.length * len(own))


def _sample(training: DataFrame, settings: Settings) -> DataFrame:
    """The rows that teach: lang, doc_id, text."""
    usable = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if settings.sample is None:
        return usable.select("lang", "doc_id", "text")
    # The ids alone are ranked, and the few chosen texts fetched by them.
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = usable.select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
    chosen = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= settings.sample).select("lang", "doc_id").distinct()
    return usable.select("lang", "doc_id", "text").join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi")


def learn(training: DataFrame, settings: Settings = Settings()) -> Profiles:
    """Profiles from doc_id, text, lang of the training rows."""
    return _learned(_sample(training, settings), settings)


def _learned(sample: DataFrame, settings: Settings) -> Profiles:
    ship(sample.sparkSession)

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        many = np.bincount(back, np.concatenate([p[1] for p in parts]), len(found)) if len(found) else np.zeros(0)
        return found, many.astype(np.int64)

    def rows(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (found, many) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(many, pa.int64())],
                names=["lang", "gram", "n"],
            )

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for first, texts in groups(batch):
                by_lang: dict[str, list] = {}
                for lang, text in zip(batch.column("lang").slice(first, len(texts)).to_pylist(), texts):
                    by_lang.setdefault(lang, []).append(ngrams(text, settings.longest))
                for lang, parts in by_lang.items():
                    held[lang] = added([*parts, held[lang]] if lang in held else parts)
                if sum(len(found) for found, _ in held.values()) > HELD:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("r", F.row_number().over(best)).where(F.col("r") <= settings.profile)
    profiles: dict[str, list[int]] = {}
    for lang, gram in top.orderBy("lang", "r").select("lang", "gram").collect():  # `profile` rows a language
        profiles.setdefault(lang, []).append(gram)
    return Profiles(profiles, settings.profile)


def predict(documents: DataFrame, profiles: Profiles, settings: Settings = Settings()) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                found = [profiles.predict(t, settings) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    ship(documents.sparkSession)
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _letters_of(text: str) -> str:
    """Lower-case letters, and one space for each stretch of others between them."""
    return np.where((codes := _codes(text)) == 0, 32, codes).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").strip(" ")


def _length_class(letters: int) -> int:
    return min(letters.bit_length() - 1, LONGEST)


def lowest_scores(sample: DataFrame, profiles: Profiles, settings: Settings = Settings()) -> dict[str, dict[int, float]]:
    """Per language and class of length the lowest score of the training texts and of stretches of them, strays left
    out."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in groups(batch):
                found: list[tuple[str, int, float]] = []
                for text in texts:
                    letters = _letters_of(text or "")
                    sizes = [2**k for k in range(SHORTEST, LONGEST + 1) if 2**k < len(letters)]
                    parts = [letters, *(letters[:n] for n in sizes), *(letters[-n:] for n in sizes)]
                    for part in parts:
                        lang, score = profiles.predict(part, settings)
                        if lang != "und":
                            found.append((lang, _length_class(len(part)), score))
                columns = zip(*found) if found else ([], [], [])
                types = (pa.string(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "size", "score"])

    ship(sample.sparkSession)
    scores = sample.select("text").mapInArrow(run, "lang string, size int, score double")
    scores = written(scores.select(F.struct("lang", "size").alias("kind"), "score"), "language-scores")  # read a few times
    out: dict[str, dict[int, float]] = {}
    for kind, _, score in exact_quantiles(scores, "kind", "score", [settings.stray]).collect():  # a few rows a language
        out.setdefault(kind["lang"], {})[kind["size"]] = score
    return out


def bound(lowest: dict[str, dict[int, float]], lang: str, letters: int, settings: Settings = Settings()) -> float:
    """The least score with which a text of so many letters is kept: between its class and the next, the lower counts;
    for lengths that the sample lacks, the nearest."""
    own, size = {k: v for k, v in lowest.get(lang, {}).items() if k >= SHORTEST}, _length_class(letters)
    if not own or size < SHORTEST:
        return settings.min_score
    near = min(own, key=lambda k: (abs(k - size), k))
    return max(settings.min_score, settings.margin * min(own[near], own.get(near + 1, own[near])))


def keep_known(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, in one of the languages learned from them: not `und`, and with at least the score
    that texts of their language and length have (`bound`). Each row is judged where it stands, without a shuffle. Documents are read three times."""
    sample = _sample(documents, settings)
    sample = sample if settings.sample is None else written(sample, "language-sample")
    profiles = _learned(sample, settings)
    lowest = lowest_scores(sample, profiles, settings)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                keep = []
                for text in texts:
                    lang, score = profiles.predict(text, settings)
                    keep.append(lang != "und" and score >= bound(lowest, lang, len(_codes(text)) - 2, settings))
                yield batch.slice(first, len(texts)).filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
