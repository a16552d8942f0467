"""Near-duplicate documents by MinHash with sequential Bayesian verification, exact on full shingle sets at the end.

1. Documents with equal shingle sets become one class, known by its smallest doc_id; copies are never paired.
2. Bands of signature rows put classes into buckets. The number of bands follows from the threshold and the miss
   probability, so a pair at the threshold shares no bucket with at most that probability.
3. In each bucket every class meets the smallest one (a star: as many pairs as members). Signatures are compared batch
   after batch; a pair goes as soon as the posterior probability that its similarity reaches the threshold falls
   below the miss probability (uniform prior, so the tail of a Beta, a binomial sum). Survivors are confirmed on the
   full sets, and confirmed links are merged into components.
4. Buckets that still hold several components are searched whole, in packs of bounded size: classes outside the
   bucket's commonest component meet all members of other components, again by signature batches and then on the
   full sets; a task returns only links that join what was separate, at most one fewer than its members, so no pairs
   of a group are listed, yet none is left out.
5. Components of all links are found by large-star and small-star rounds over written tables.

Sets hold 64-bit hashes of shingles. Nothing grows with the data in the driver: it sees row counts only.

Defined results: a document with fewer words than a shingle has one shingle, its whole text; null, empty and white
texts have none and are linked with nothing; rows that share a doc_id count as one document; rows without doc_id are
linked with nothing and kept; other columns are ignored by `classes`, passed on by `keep_first`; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import frugal, ship, written
from tradeloom.llm.tokens import groups, mixed, numbered, words_of

#: Rows of a signature compared at a time.
BATCH = 16
#: Shingles a pack of bucket members may hold.
PACK_SHINGLES = 250_000


@dataclass(frozen=True)
class Settings:
    """words: of a shingle; percent: 100 * intersection >= percent * union links; rows: of a band; hashes: of a
    signature; miss: chance that a pair at the threshold is lost by the bands, and by each batch's pruning."""

    words: int = 5
    percent: int = 80
    rows: int = 4
    hashes: int = 128
    miss: float = 1e-6
    seed: int = 7

    @property
    def bands(self) -> int:
        alike = (self.percent / 100) ** self.rows
        if alike >= 1:
            return 1
        wanted = math.ceil(math.log(self.miss) / math.log1p(-alike))
        if wanted * self.rows > self.hashes:
            raise ValueError(f"{wanted} bands of {self.rows} rows need more than {self.hashes} hashes")
        return wanted

    def least_matches(self) -> list[int]:
        """For each batch, how many rows compared so far must agree. After m of n agree, the posterior of the similarity
        is Beta(m + 1, n - m + 1), whose tail from t on is the chance of at most m heads in n + 1 throws of chance t."""
        t, out = self.percent / 100, []
        for n in range(BATCH, self.hashes + 1, BATCH):
            tail, m = 0.0, 0
            while m <= n:
                tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if tail >= self.miss:
                    break
                m += 1
            out.append(min(m, n))
        return out


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    lowered = [[w.lower() for w in words_of(t)] for t in texts]
    values, bounds = numbered(lowered)
    out = []
    if len(values) >= words:
        own = np.zeros(len(values) - words + 1, np.uint64)
        for i in range(words):
            own = mixed(own + values[i : len(values) - words + 1 + i] + np.uint64(i + 1))
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            out.append(np.unique(own[a : b - words + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for i, v in enumerate(values[a:b]):
                whole = mixed(whole + v + np.uint64(1000 * (b - a) + i + 1))
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray, settings: Settings) -> np.ndarray:
    draw = np.random.default_rng(settings.seed).integers(0, 2**63, (2, settings.hashes), dtype=np.uint64)
    times, plus = draw[0] * np.uint64(2) + np.uint64(1), draw[1]
    least = np.full(settings.hashes, 2**32 - 1, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048, None] * times + plus
        np.minimum(least, (part >> np.uint64(32)).min(axis=0), out=least)
    return least.astype(np.uint32)


def band_keys(sig: np.ndarray, settings: Settings) -> np.ndarray:
    rows = sig[: settings.bands * settings.rows].reshape(settings.bands, settings.rows).astype(np.uint64)
    keys = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for i in range(settings.rows):
        keys = mixed(keys + rows[:, i])
    return keys.view(np.int64)


def signed(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n, key, sig (low 16 bits of each row) and bands; key, sig and bands are null for empty sets."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                sets = shingle_sets(texts, settings.words)
                sigs = [signature(s, settings) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([None if s is None else s.astype(np.uint16).tobytes() for s in sigs], pa.binary()),
                        pa.array([None if s is None else band_keys(s, settings) for s in sigs], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "key", "sig", "bands"],
                )

    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(run, "doc_id long, n long, key binary, sig binary, bands array<long>")


def survives(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of two signature matrices are not pruned by any batch."""
    alive = np.arange(len(left))
    same = np.zeros(len(left), np.int32)
    for i, wanted in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        same = same + (left[alive, part] == right[alive, part]).sum(axis=1)
        going = same >= wanted
        alive, same = alive[going], same[going]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _matrix(sigs: pa.Array | list) -> np.ndarray:
    sigs = sigs if isinstance(sigs, list) else sigs.to_pylist()
    return np.frombuffer(b"".join(sigs), np.uint16).reshape(len(sigs), -1)


def _alike(left: bytes, right: bytes, percent: int) -> bool:
    a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    places = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[places] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The pairs (a, b) with the column's value of either side, as column_a and column_b."""
    for side in ("a", "b"):
        pairs = pairs.join(values.select(F.col("rep").alias(side), F.col(column).alias(f"{column}_{side}")), side)
    return pairs


def _pruned(pairs: DataFrame, settings: Settings) -> DataFrame:
    least = settings.least_matches()

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = survives(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), least)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, settings: Settings) -> DataFrame:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("shingles_a"), batch.column("shingles_b"))
            keep = [_alike(a.as_buffer(), b.as_buffer(), settings.percent) for a, b in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def _sets_of(documents: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """rep, shingles (sorted 64-bit hashes as bytes) of the wanted (rep, key)."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                sets = shingle_sets(texts, settings.words)
                rows = [
                    (rep, s.tobytes())
                    for rep, key, s in zip(
                        batch.column("rep").slice(first, len(texts)).to_pylist(),
                        batch.column("key").slice(first, len(texts)).to_pylist(),
                        sets,
                    )
                    if key == set_key(s)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.binary())],
                    names=["rep", "shingles"],
                )

    texts = documents.select(F.col("doc_id").cast("long").alias("rep"), "text")
    return texts.join(wanted, "rep").select("rep", "key", "text").mapInArrow(run, "rep long, shingles binary")


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each linked node (a, b) reaches, by large-star and small-star rounds."""
    star = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    seen = None
    while True:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        star = written(small, "small")
        state = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if state == seen:
            return star.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state


def _search_packs(packs: DataFrame, settings: Settings) -> DataFrame:
    """Links that join separate components, from rows of two packs of one bucket: the members outside its commonest
    component, and any members."""
    least = settings.least_matches()

    def links(outer: list[dict], inner: list[dict]) -> Iterator[tuple[int, int]]:
        ids, at = np.unique(np.concatenate([np.frombuffer(m["shingles"], np.uint64) for m in inner]), return_inverse=True)
        sizes = np.array([len(m["shingles"]) // 8 for m in inner])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        comps, sigs = np.array([m["comp"] for m in inner]), _matrix([m["sig"] for m in inner])
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        for m in outer:
            others = np.flatnonzero(comps != m["comp"])
            if not len(others):
                continue
            own = np.broadcast_to(np.frombuffer(m["sig"], np.uint16), (len(others), sigs.shape[1]))
            others = others[survives(sigs[others], own, least)]
            if not len(others):
                continue
            mine = np.frombuffer(m["shingles"], np.uint64)
            marked = np.zeros(len(ids), np.int64)
            places = np.minimum(np.searchsorted(ids, mine), len(ids) - 1)
            marked[places[ids[places] == mine]] = 1
            both = np.add.reduceat(marked[at], starts)[others]
            for i in others[100 * both >= settings.percent * (len(mine) + sizes[others] - both)]:
                a, b = root(m["comp"]), root(int(comps[i]))
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    yield m["rep"], inner[i]["rep"]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                found = list(links(one["outer"], one["inner"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
                )

    return packs.select("outer", "inner").mapInArrow(run, "a long, b long")


def _in_mixed_buckets(members: DataFrame, comps: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (outer, inner) of packs of buckets in which more than one component is left."""
    placed = members.join(comps.select(F.col("node").alias("rep"), "label"), "rep", "left")
    placed = placed.join(classes.select("rep", "n"), "rep")
    placed = placed.select("bucket", "rep", "n", F.coalesce("label", "rep").alias("comp"))
    counts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("many"), F.sum("n").alias("n"))
    mixed_buckets = (
        counts.groupBy("bucket")
        .agg(F.count("*").alias("comps"), F.sum("many").alias("size"), F.sum("n").alias("n"),
             F.max_by("comp", F.struct("many", "comp")).alias("main"))
        .where("comps > 1 AND size > 2")
    )
    # Written, so that both sides of the join come from shuffles of their own and Spark can split a hot bucket.
    mixed_buckets = written(mixed_buckets, "mixed")
    held = placed.drop("n").join(mixed_buckets.select("bucket", "main", "n"), "bucket")
    held = held.join(classes.select("rep", "sig"), "rep").join(sets, "rep")
    n_packs = F.ceil(F.col("n") / PACK_SHINGLES)
    held = held.withColumn("pack", F.pmod(F.xxhash64("rep"), n_packs))
    member = F.struct("rep", "comp", "sig", "shingles")
    packed = held.groupBy("bucket", "pack").agg(
        F.collect_list(member).alias("inner"),
        F.collect_list(F.when(F.col("comp") != F.col("main"), member)).alias("outer"),
    )
    packed = written(packed, "packs")
    return packed.select("bucket", "outer").where(F.size("outer") > 0).join(packed.select("bucket", "inner"), "bucket")


def classes(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept."""
    ship(documents.sparkSession)
    rows = written(signed(documents, settings), "signed")
    full = rows.where("n > 0 AND doc_id IS NOT NULL")
    own = written(
        full.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "classes",
    )
    exploded = own.select("rep", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    members = written(exploded.join(shared.select("bucket", "least"), "bucket"), "members")
    pairs = members.where("least < rep").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    sets = written(_sets_of(documents, own.join(members.select("rep").distinct(), "rep").select("rep", "key"), settings), "sets")
    likely = _pruned(_with_both(pairs, own, "sig"), settings)
    # Rows that share a doc_id are one document, so their classes are linked.
    placed = full.select("doc_id", "key").join(own.select("key", "rep"), "key").select("doc_id", "rep")
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a < most")
    same = placed.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b")
    links = written(_confirmed(_with_both(likely, sets, "shingles"), settings).union(same).distinct(), "links")
    found = components(links)
    more = written(_search_packs(_in_mixed_buckets(members.select("bucket", "rep"), found, own, sets), settings).distinct(), "more")
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))
    named = own.select("key", "rep").join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("key", F.coalesce("label", "rep").alias("component"))
    joined = rows.select("doc_id", "n", "key").join(named, "key", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, without those whose group has a smaller doc_id."""
    gone = classes(documents, settings).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["gone_id"], "left_anti")

