"""Scores of texts by context-tree weighting, beside those of single words, learned from the table's own documents.

What a text needs from the corpus are facts: the count of each of its words, and the model's probability of each of its grams
(a byte behind five bytes of context). Texts are dealt once to blocks; a block asks for every different gram and word in
it and says how often its training texts hold it. The sums are the model's whole knowledge: `context_tree` turns them
into the probability of every asked gram, by decision and level: contexts of three and more bytes within groups that are
closed under their nearest three bytes, the shorter ones (bounded by the alphabet, not by the corpus) on sums of those.
Each block gets the answers to what it asked, and its texts, which have stayed where they were, are scored with them. Grams travel as messages of many
between blocks and groups, where they are added up; words are counted as rows.
So nothing is broadcast but four numbers, the knowledge may grow with the corpus, and a text crosses the network once.

The tree is exact for the training bytes: shares of the depths come from their whole sequence of counts, not from a
sample or a pruned tree. A text's bytes do not change the model. Every text starts without a context and ends by a
byte that no text holds, so the score is the logarithm of a probability over all texts.

Defined results: A-Z count as a-z, in words and bytes; a null text is empty: one token, its end, and the score is that of
ending at once; documents without an id are learned from; repeated rows are learned as often as they stand there, and all
scored; texts of any length are read in slices; further columns are ignored; an empty table gives no rows; with no document to
learn from every decision is even.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import context_tree as tree
from tradeloom.llm.common import blocks_for, frugal, ship, written
from tradeloom.llm.tokens import mixed

#: Context bytes of the model (at most five), and of the groups in which the longer contexts are worked out.
DEPTH, GROUPED = 5, 3
#: Bytes of text in a block, and the most blocks; beyond, blocks are larger. Bytes worked on at a time.
BLOCK_BYTES, MOST_BLOCKS, SLICE = 32 << 20, 100_000, 1 << 20
#: Grams in a group of contexts, bytes of text whose grams share a group, facts in a message.
GROUP_GRAMS, GROUP_BYTES, MESSAGE = 1_000_000, 64 << 20, 65_536

CHUNK = "chunk long, ids array<long>, learned array<boolean>, lengths array<int>, text binary"
ASKED = "block int, words binary, counts binary"
ANSWER = "block int, words binary, found binary"
NODES = "grp int, nodes binary, zeros binary, ones binary, weighted binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
WHITE = re.compile(rb"[\x20\x09-\x0d]")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def _chunks(documents: DataFrame) -> DataFrame:
    """Lower-cased texts of an Arrow batch as one row."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if batch.num_rows:
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([(task << 32) + number], pa.int64()),
                        "ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        "learned": pa.array([batch.column("learned").to_pylist()], pa.list_(pa.bool_())),
                        "lengths": pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                        "text": pa.array([b"".join(texts).lower()], pa.binary()),
                    }
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out()).alias("learned")).mapInArrow(run, CHUNK)


def _texts(lengths: Iterable[int], text: bytes) -> list[bytes]:
    ends = np.cumsum(lengths)
    return [text[e - n : e] for n, e in zip(lengths, ends, strict=True)]


def _split(texts: list[bytes]) -> pa.Array:
    """The words of each text, and perhaps empty ones at its ends."""
    return pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))


def _word_slices(text: bytes) -> Iterator[bytes]:
    """The text in slices that do not cut words."""
    start = 0
    while start < len(text):
        cut = WHITE.search(text, start + SLICE)
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop


def _gram_slices(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of the texts, a slice at a time, and the number of the text that each is from."""
    run, ends = tree.joined(texts, depth)
    for start in range(depth, len(run), SLICE):
        part = run[start - depth : start + SLICE]
        first, last = np.searchsorted(ends, [start, start + SLICE])
        inside = ends[first:last] - start + depth
        places, keys = tree.grams(part, inside, depth)
        stops = np.append(np.searchsorted(places, inside) + 1, len(places))
        yield keys, np.repeat(np.arange(first, last + 1), np.diff(stops, prepend=0))


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where the equal elements of an ordered array begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


class Grams:
    """Counts of grams, added up now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, learned: bool) -> None:
        keys = np.sort(keys)
        starts = _runs(keys)
        counts = np.diff(np.append(starts, len(keys))) if learned else np.zeros(len(starts), np.int64)
        self.parts.append((keys[starts], counts))
        self.held += len(starts)
        if self.held > 1_500_000:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0]) // 2

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = _runs(keys)
        return keys[starts], np.add.reduceat(counts, starts)


class Words:
    """Counts of words, added up for each so many bytes of them."""

    def __init__(self) -> None:
        self.waiting: dict[bool, list[pa.Array]] = {True: [], False: []}
        self.parts: list[pa.Table] = []
        self.held = 0

    def add(self, words: pa.Array, learned: bool) -> None:
        self.waiting[learned].append(words)
        self.held += words.nbytes
        if self.held > BLOCK_BYTES:
            self._count()

    def _count(self) -> None:
        for learned, words in self.waiting.items():
            if words:
                found = pc.value_counts(pa.chunked_array(words))
                counts = found.field("counts") if learned else pa.array(np.zeros(len(found), np.int64))
                self.parts.append(pa.table({"word": found.field("values"), "n": counts}))
        self.waiting, self.held = {True: [], False: []}, 0
        pa.default_memory_pool().release_unused()

    def total(self) -> pa.Table:
        """A word may have several rows."""
        self._count()
        return pa.concat_tables(self.parts) if self.parts else pa.table({"word": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})


def _sides(chunks: Iterable) -> Iterator[tuple[bool, list[bytes]]]:
    """The texts of each chunk that are learned from, and the others."""
    for _, (_, learned, lengths, text) in chunks:
        texts = _texts(lengths, text)
        for flag in (True, False):
            mine = [t for t, x in zip(texts, learned, strict=True) if x == flag]
            if mine:
                yield flag, mine


@frugal
def _asked_words(block: int, chunks: Iterable) -> Iterator[tuple]:
    """The words a block needs to know of, with their counts in its training texts; one may be asked for a few times."""
    words = Words()
    for flag, mine in _sides(chunks):
        for part in _word_slices(b"\n".join(mine)):
            flat = _split([part]).flatten()
            words.add(flat.filter(pc.not_equal(flat, "")), flag)
    listed = words.total()
    for i in range(0, len(listed), MESSAGE):
        part = listed.slice(i, MESSAGE)
        yield block, "\n".join(part.column("word").to_pylist()).encode(), part.column("n").to_numpy().tobytes()


@frugal
def _asked_grams(block: int, chunks: Iterable, depth: int, grouped: int, groups: int) -> Iterator[tuple]:
    """The grams a block needs to know of, each once, with their counts in its training texts, as messages to their groups."""
    grams = Grams()
    for flag, mine in _sides(chunks):
        for keys, _ in _gram_slices(mine, depth):
            grams.add(keys, flag)
    yield from _to_groups(block, *grams.total(), depth - grouped, groups)


def _to_groups(block: int, keys: np.ndarray, counts: np.ndarray, up: int, groups: int) -> Iterator[tuple]:
    """Ordered grams as a message to each group: group, (block, grams, counts). A group has all grams of its contexts."""
    if not len(keys):
        return
    group = (mixed((keys >> 8 * (up + 1)).astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    for rows in np.split(order, _runs(group[order])[1:]):
        yield int(group[rows[0]]), (block, _apart(keys[rows]), counts[rows].astype(np.int64).tobytes())


def _apart(ordered: np.ndarray) -> bytes:
    """Ordered numbers by their distances, which compress."""
    return np.diff(ordered, prepend=0).astype(np.int64).tobytes()


def _together(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.int64))


def _flat_words(asked: DataFrame) -> DataFrame:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(row["words"].split(b"\n"), pa.binary()),
                        "n": pa.array(counts),
                        "block": pa.array(np.full(len(counts), row["block"], np.int32)),
                    }
                )

    return asked.mapInArrow(run, "word binary, n long, block int")


def _merged(asked: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The grams that these messages ask for, in order, each once, with its count over all of them."""
    keys, counts = (np.concatenate([m[i] for m in asked]) for i in (1, 2))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(counts[order], starts)


def _read(messages: Iterable) -> list[tuple[int, np.ndarray, np.ndarray]]:
    return [(block, _together(grams), np.frombuffer(counts, np.int64)) for block, grams, counts in messages]


@frugal
def _lower(group: int, parts: Iterable, up: int) -> Iterator[tuple]:
    """The nodes of a group's contexts that are as short as contexts get in a group."""
    asked = _read(message for _, message in parts)
    if not asked:
        return
    keys, counts = _merged(asked)
    del asked
    for decision in range(8):
        top = tree.climbed(keys, counts, decision, up)[0][-1]
        for i in range(0, len(top.nodes), MESSAGE):
            yield group, *(x[i : i + MESSAGE].tobytes() for x in (top.nodes, top.zeros, top.ones, top.weighted))


@frugal
def _answered(parts: Iterable, up: int) -> Iterator[tuple]:
    """Answers of a group to all blocks that asked it: block, ("answer", grams, None, values). `begun` messages tell what the
    shorter contexts say of its nodes."""
    begun, asked = [], []
    for _, part in parts:
        if part[0] == "begun":
            begun.append((np.frombuffer(part[1], np.int64), np.frombuffer(part[2]), np.frombuffer(part[3])))
        else:
            asked += _read([part])
    if not asked:
        return
    keys, counts = _merged(asked)
    nodes, lead, rest = (np.concatenate(x) for x in zip(*begun, strict=True))
    order = np.argsort(nodes)
    nodes, lead, rest = nodes[order], lead[order], rest[order]
    value = np.zeros(len(keys))
    for decision in range(8):
        levels, places = tree.climbed(keys, counts, decision, up)
        at = np.searchsorted(nodes, levels[-1].nodes)[places[-1]]
        one = lead[at] + rest[at] * tree.mixed(levels, places)
        value += np.log10(np.where((keys >> (7 - decision)) & 1, one, 1 - one))
    for block, mine, _ in asked:
        yield block, ("answer", _apart(mine), None, value[np.searchsorted(keys, mine)].tobytes())


def _node_rows(nodes: DataFrame) -> DataFrame:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["nodes"], np.int64)
                facts = {c: pa.array(np.frombuffer(row[c])) for c in ("zeros", "ones", "weighted")}
                yield pa.RecordBatch.from_pydict({"node": pa.array(ids), **facts, "grp": pa.array(np.full(len(ids), row["grp"], np.int32))})

    return nodes.mapInArrow(run, "node long, zeros double, ones double, weighted double, grp int")


def _to_their_groups(begun: DataFrame) -> DataFrame:
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            for group, part in _by_number_in(table, "grp"):
                columns = {c: pa.array([part.column(c).to_numpy().tobytes()], pa.binary()) for c in ("node", "lead", "rest")}
                yield pa.RecordBatch.from_pydict({"grp": pa.array([group], pa.int32()), **columns})

    return begun.mapInArrow(run, "grp int, node binary, lead binary, rest binary")


def gram_answers(spark: SparkSession, asked: RDD, groups: int, depth: int, grouped: int) -> RDD:
    """Answers, (block, ("answer", grams, None, values)), to messages (group, (block, grams, counts)); values: log10 of the
    probability of each gram's byte in its context, by what all messages count."""
    up = depth - grouped
    asked = asked.partitionBy(groups, _own)  # one shuffle, whose files both passes read

    def upper(rows: pd.DataFrame) -> pd.DataFrame:
        decisions = np.floor(np.log2(rows.node.to_numpy(np.int64) & 0xFF)).astype(int)
        return pd.concat([_upper(part.sort_values("node"), grouped - 1) for _, part in rows.groupby(decisions)])

    lower = asked.mapPartitionsWithIndex(lambda group, parts: _lower(group, parts, up))
    nodes = written(_node_rows(spark.createDataFrame(lower, NODES, verifySchema=False)), "nodes")
    parent = F.shiftleft(F.shiftright("node", 16), 8).bitwiseOR(F.col("node").bitwiseAND(0xFF))
    sums = nodes.groupBy(parent.alias("node")).agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
    # At most 255 nodes for each pair of bytes, however large the corpus is.
    top = sums.groupBy().applyInPandas(upper, "parent long, lead double, rest double, stop double")
    seen = F.col("zeros") + F.col("ones") > 0
    begun = nodes.withColumn("parent", parent).join(top, "parent").select(
        "grp",
        "node",
        F.when(seen, F.col("lead")).otherwise(F.col("stop")).alias("lead"),
        F.when(seen, F.col("rest")).otherwise(F.lit(0.0)).alias("rest"),
    )
    told = _to_their_groups(begun).rdd.map(lambda r: (r.grp, ("begun", bytes(r.node), bytes(r.lead), bytes(r.rest))))
    return told.partitionBy(groups, _own).union(asked).mapPartitions(lambda parts: _answered(parts, up))


def gram_scores(facts: DataFrame, depth: int = DEPTH, grouped: int = GROUPED, per_group: int = GROUP_GRAMS) -> DataFrame:
    """gram, value: log10 of the probability of each gram's byte in its context. facts: gram, n (in training), no gram twice."""
    up, groups = depth - grouped, blocks_for(facts.count(), per_group)

    @frugal
    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = (batch.column(c).to_numpy() for c in ("gram", "n"))
            order = np.argsort(keys)
            for group, (_, grams, counted) in _to_groups(0, keys[order], counts[order], up, groups):
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([grams]), pa.array([counted])], ["grp", "grams", "counts"])

    @frugal
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_together(row["grams"])), pa.array(np.frombuffer(row["found"]))], ["gram", "value"])

    packed = facts.select("gram", "n").mapInArrow(messages, "grp int, grams binary, counts binary")
    asked = packed.rdd.map(lambda r: (r.grp, (0, bytes(r.grams), bytes(r.counts))))
    answers = gram_answers(facts.sparkSession, asked, groups, depth, grouped).map(lambda r: (r[1][1], r[1][3]))
    return facts.sparkSession.createDataFrame(answers, "grams binary, found binary", verifySchema=False).mapInArrow(flat, "gram long, value double")


def _upper(rows: pd.DataFrame, up: int) -> pd.DataFrame:
    """From the root down to these nodes of one decision: what the shorter contexts say (lead), the share that they leave to
    longer ones (rest), and the probability if training never met a longer one (stop)."""
    level = tree.Level(*(rows[c].to_numpy() for c in ("node", "zeros", "ones", "weighted")))
    levels, places = [level], [np.arange(len(rows))]
    for _ in range(up):
        higher, parent = levels[-1].above()
        levels.append(higher)
        places.append(parent[places[-1]])
    lead, rest = np.zeros(len(rows)), np.ones(len(rows))
    for depth in range(up, -1, -1):
        share, own = levels[depth].share[places[depth]], levels[depth].one[places[depth]]
        stop = lead + rest * own
        going = levels[depth - 1].seen[places[depth - 1]] if depth else True
        lead, rest = np.where(going, lead + rest * share * own, stop), np.where(going, rest * (1 - share), 0.0)
    return pd.DataFrame({"parent": rows.node, "lead": lead, "rest": rest, "stop": stop})


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of many small batches as some larger tables."""
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= 8 * MESSAGE:
            yield pa.Table.from_batches(waiting)
            waiting, held = [], 0
    if held:
        yield pa.Table.from_batches(waiting)


def _by_number_in(table: pa.Table, column: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each number in the column."""
    table = table.sort_by(column)
    numbers = table.column(column).to_numpy()
    starts = _runs(numbers)
    for a, b in zip(starts, np.append(starts[1:], len(numbers)), strict=True):
        yield int(numbers[a]), table.slice(a, b - a)


def _packed(answers: DataFrame) -> DataFrame:
    """Answers about words as messages to their blocks."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            rows: dict[str, list] = {"block": [], "words": [], "found": []}
            for block, part in _by_number_in(table, "block"):
                rows["block"].append(block)
                rows["words"].append(b"\n".join(part.column("word").to_pylist()))
                rows["found"].append(part.column("value").to_numpy().tobytes())
            types = {"block": pa.int32(), "words": pa.binary(), "found": pa.binary()}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in rows.items()})

    return answers.select("block", "word", "value").mapInArrow(run, ANSWER)


def _gram_sums(texts: list[bytes], depth: int, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's grams; known is ordered and holds all of them."""
    out = np.zeros(len(texts))
    for first in range(0, len(texts), 1 << 16):
        group = texts[first : first + (1 << 16)]
        for keys, text_of in _gram_slices(group, depth):
            both = (keys.astype(np.uint64) << np.uint64(16)) | text_of.astype(np.uint64)
            both.sort()  # equal grams together, each with its text
            keys = both >> np.uint64(16)
            starts = _runs(keys)
            value = values[np.searchsorted(known, keys[starts].astype(np.int64))]
            value = np.repeat(value, np.diff(np.append(starts, len(keys))))
            out[first : first + len(group)] += np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), value, len(group))
    return out


def _word_sums(texts: list[bytes], words: pa.Array, counted: np.ndarray, none: float) -> Iterator[tuple[int, int, float]]:
    """Words, known words and base score of each text."""
    small: list[bytes] = []

    def told(group: list[bytes]) -> Iterator[tuple[int, int, float]]:
        lists = _split(group)
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        listed, codes = coded.dictionary, coded.indices.to_numpy()
        at = pc.index_in(listed, value_set=words).fill_null(len(words)).to_numpy()
        count, real = np.append(counted, 0.0)[at], pc.not_equal(listed, "").to_numpy(zero_copy_only=False).astype(float)
        facts = (real, real * (count > 0), real * (np.log10(count + 0.5) - none))
        of = np.repeat(np.arange(len(group)), np.diff(lists.offsets.to_numpy()))
        sums = [np.bincount(of, fact[codes], len(group)) for fact in facts]
        yield from zip(sums[0].astype(int).tolist(), sums[1].astype(int).tolist(), sums[2].tolist(), strict=True)

    for text in texts:
        if len(text) <= SLICE:
            small.append(text)
            continue
        yield from told(small)
        small = []
        parts = [next(told([part])) for part in _word_slices(text)]
        yield tuple(sum(x) for x in zip(*parts, strict=True))
    yield from told(small)


@frugal
def _scored(parts: Iterable, depth: int, none: float) -> Iterator[tuple]:
    """Texts of a block by the answers, which come first. none: log10 of what is added to a word's count over all."""
    keys, values, words, counts, known = [], [], [], [], None
    for _, part in parts:
        if part[0] == "answer":
            _, grams, named, found = part
            found = np.frombuffer(found)
            if grams is not None:
                keys.append(_together(grams))
                values.append(found)
            else:
                words.append(_split([named]).flatten())
                counts.append(found)
            continue
        if known is None:
            known, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(known)
            known, value, keys, values = known[order], value[order], [], []
            words = pa.concat_arrays(words) if words else pa.array([], pa.large_string())
            counted = np.concatenate([*counts, np.zeros(0)])
        ids, learned, lengths, text = part
        texts = _texts(lengths, text)
        scores = _gram_sums(texts, depth, known, value).tolist()
        for doc_id, flag, n, score, base in zip(ids, learned, lengths, scores, _word_sums(texts, words, counted, none), strict=True):
            yield doc_id, not flag, base[0], base[1], base[2], score, n


def score(documents: DataFrame, depth: int = DEPTH, grouped: int = GROUPED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte of every document."""
    spark = documents.sparkSession
    ship(spark)
    size = documents.agg(
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.count_if(~held_out())
    ).first()
    per_block = max(BLOCK_BYTES, size[0] // MOST_BLOCKS)
    blocks = max(spark.sparkContext.defaultParallelism, blocks_for(size[0], per_block))
    # One shuffle; all later passes over the texts read its files.
    dealt = _chunks(documents).rdd.map(lambda r: (r.chunk, (r.ids, r.learned, r.lengths, bytes(r.text)))).map(_by_number)
    dealt = dealt.partitionBy(blocks, _own)
    blocks = dealt.getNumPartitions()

    asked = spark.createDataFrame(dealt.mapPartitionsWithIndex(_asked_words), ASKED, verifySchema=False)
    of_words = _flat_words(asked).groupBy("word").agg(F.sum("n").alias("n"), F.collect_set("block").alias("blocks"))
    # A word that training never met needs no answer.
    of_words = written(of_words.where("n > 0"), "words")
    held = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = size[1]
    train, distinct = held[0] + ends, held[1] + (ends > 0)
    none = float(np.log10(train + 0.5 * (distinct + 1)))

    groups = max(spark.sparkContext.defaultParallelism, blocks_for(size[0], max(GROUP_BYTES, size[0] // MOST_BLOCKS)))
    asked_grams = dealt.mapPartitionsWithIndex(lambda i, part: _asked_grams(i, part, depth, grouped, groups))
    grams_told = gram_answers(spark, asked_grams, groups, depth, grouped)
    words_told = _packed(of_words.select(F.explode("blocks").alias("block"), "word", F.col("n").cast("double").alias("value")))
    words_told = words_told.rdd.map(lambda r: (r.block, ("answer", None, bytes(r.words), bytes(r.found))))
    told = words_told.union(grams_told)
    told = told.partitionBy(blocks, _own)
    rows = told.union(dealt).mapPartitions(lambda parts: _scored(parts, depth, none))
    found = spark.createDataFrame(rows, SCORED, verifySchema=False)
    end_known = F.lit(int(ends > 0))
    return found.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + end_known).alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.lit(float(np.log10(ends + 0.5)) - none)).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def _by_number(chunk: tuple) -> tuple:
    """Chunks of different tasks to different blocks."""
    return (chunk[0] >> 32) * 7919 + (chunk[0] & 0xFFFFFFFF), chunk[1]


def _own(number: int) -> int:
    return number
