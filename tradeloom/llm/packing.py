"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenised whole; those longer than a sequence are cut into pieces of its length. What matters for packing is
only how many pieces there are of each length, a table as long as a sequence. Over it the plan is made: lengths from
the longest down look up their gap in an index of the sums of one, two and three available lengths and use up each
exact combination as often as all its lengths last; what finds no exact complement is filled best-fit, once all exact
combinations are used up or as it is met, whichever takes fewer sequences. A plan is a few
thousand lines whatever the data. Pieces are then numbered within their length (over salted buckets, so no length is one
task) and a piece's number says which line, and so which sequence and offset, it has.

Defined results: null and empty texts are the closing id alone; repeated rows are packed each; other columns are ignored;
an empty table gives an empty result. Ties need no rule: pieces of one length are interchangeable.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, compress, repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import blocks_for, frugal, ship, written
from tradeloom.llm.tokens import groups

#: Pieces of one length that are numbered in one task, about.
NUMBERED = 20_000
#: Words an encoder remembers, about; beyond, it forgets those it met least often.
REMEMBERED = 1_000_000
#: Characters of texts encoded at a time; the more, the fewer words are looked up twice.
ENCODED_CHARS = 4_000_000
#: Words encoded in one call.
CALL = 1000
#: Letters before it (Latin, Greek, Cyrillic) are the same in every Unicode version in use.
OLDER = "\u0530"
#: How byte-level tokenizers name bytes: printable ones of Latin-1 by themselves, the others from U+0100 on in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_NAMES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


#: What a tokenizer must encode word by word as it does whole, if its words are to be remembered.
PROBE = (
    " a \n b\tThe Émile, and. it's don't İI ΑΣ. ΑΣ naïve, NAÏVE. é́. x.,. ,., 12,3.4 ... a-b_c <y.> (z), \"q\" 漢字。 AB12cd, ß. ǅ ﬁ "
    "<|startoftext|> x <|ENDOFTEXT|> <|endoftext|>. straße, wörter. ¿qué? 🙂, supercalifragilistic."
)


class Encoder:
    """Token ids of texts. Where a tokenizer drops white space, words are encoded once and remembered: the ids of a text
    are then those of its words one after another."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = one(" a \n b\t") == one("a") + one("b") and bool(self.ends[one("a")[-1]])
        self.by_word = self.by_word and self.ids([PROBE])[0].tolist() == one(PROBE)
        self._forget()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, cores: list[bytes]) -> dict[bytes, bytes]:
        """The ids of these cores. Lower-case composed letters pass normalising and splitting as they are, so the model
        alone is asked for those of the older alphabets. Other cores of letters alone end in one token that closes a
        word each, so many can be encoded in one call and told apart."""
        out: dict[bytes, bytes] = {}
        plain, other = [], []
        tokenize = self.tokenizer.model.tokenize
        for core in cores:
            if core.isalpha() and core.islower():  # ASCII
                out[core] = array("I", [t.id for t in tokenize(core.decode())]).tobytes()
                continue
            text = core.decode()
            if not text.isalpha():
                other.append(text)
            elif max(text) < OLDER and text.lower() == text and is_normalized("NFC", text):
                out[core] = array("I", [t.id for t in tokenize(core.decode("latin-1").translate(BYTE_NAMES))]).tobytes()
            else:
                plain.append(text)
        for i in range(0, len(plain), CALL):
            part = plain[i : i + CALL]
            ids = np.array(self._encode([" ".join(part)])[0], np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                raw, start = ids.tobytes(), 0
                for word, stop in zip(part, (4 * stops).tolist()):
                    out[word.encode()] = raw[start:stop]
                    start = stop
            else:
                other += part
        for word, ids in zip(other, self._encode(other)):
            out[word.encode()] = array("I", ids).tobytes()
        return out

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """A word without its closing stops and commas, and these, where they are tokens of their own. ASCII letters are
        lowered, as the tokenizer does; special tokens are left as they are."""
        if word.isalpha():  # bytes: letters of ASCII
            return word.lower(), b""
        if b"<|" in word:
            return word, b""
        word = word.lower()
        core = word.rstrip(b".,")
        if core.isalpha():
            return core, word[len(core) :]
        if len(core) == len(word) or not core or not core.decode()[-1].isalnum():
            return word, b""
        return core, word[len(core) :]

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}  # the number of each word known
        self.sizes, self.starts, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.met = np.zeros(0, np.int64)  # groups of texts that held each word

    def _make_room(self) -> None:
        """Forgets the half of the words, or more, that was met least often."""
        kept = self.met > np.median(self.met)
        at, many = self._places(np.flatnonzero(kept))
        self.words = dict(zip(compress(self.words, kept.tolist()), range(int(kept.sum()))))  # they lie by their numbers
        self.known, self.sizes, self.starts = self.known[at], many, np.cumsum(many) - many
        self.met = self.met[kept] // 2

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of these words lie, one after another, and how many each has."""
        many = self.sizes[words]
        return np.repeat(self.starts[words] - (np.cumsum(many) - many), many) + np.arange(many.sum()), many

    def _remember(self, words: list[bytes]) -> None:
        """Adds the ids of these words, none of which is known. A core may be known as a word of its own."""
        parts = [(w.lower(), b"") if w.isalpha() else self._parts(w) for w in words]
        learned, unknown = {b"": b""}, []
        for part in dict.fromkeys(chain.from_iterable(parts)):
            number = self.words.get(part)
            if number is None:
                unknown.append(part)
            else:
                learned[part] = self.known[self.starts[number] : self.starts[number] + self.sizes[number]].tobytes()
        learned |= self._learned([x for x in unknown if x])
        raw = [learned[core] + learned[end] if end else learned[core] for core, end in parts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.starts = np.append(self.starts, len(self.known) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.known = np.append(self.known, np.frombuffer(b"".join(raw), np.uint32))
        self.met = np.append(self.met, np.zeros(len(words), np.int64))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(i, np.uint32) for i in self._encode([t or "" for t in texts])]
        if not texts:
            return []
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        # Cut at the same six characters as `words_of`; what is empty, at a text's ends, has no ids.
        lists = pc.ascii_split_whitespace(pa.array(raw, pa.large_binary()).view(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        held = coded.dictionary.view(pa.large_binary()).to_pylist()  # each different word once
        numbers = self._numbers(held)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            if len(self.words) + len(unknown) > REMEMBERED and self.words:
                self._make_room()
                numbers = self._numbers(held)
                unknown = np.flatnonzero(numbers < 0)
            numbers[unknown] = np.arange(len(self.words), len(self.words) + len(unknown))
            self._remember([held[i] for i in unknown.tolist()])
        self.met[numbers] += 1
        at, many = self._places(numbers[coded.indices.to_numpy()])
        last = lists.offsets.to_numpy()  # the number of words up to each document's end
        return np.split(self.known[at], np.append(0, np.cumsum(many))[last[1:-1]])


_encoders: dict[str, Encoder] = {}


def pieces(documents: DataFrame, tokenizer: str, length: int = 2048, closing: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its ids (little-endian, 32 bits) if asked for."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        for batch in batches:
            for first, texts in groups(batch, chars=ENCODED_CHARS):
                owners = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                rows: list[tuple] = []
                for doc_id, ids in zip(owners, encoder.ids(texts)):
                    ids = np.append(ids, np.uint32(closing)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), length)):
                        raw = ids[start : start + length].tobytes()
                        rows.append((doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return made if with_ids else made.drop("ids")


def plan(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Lines (lengths that share a sequence, longest first; how many such sequences) that use all pieces: of the plan
    that fills best-fit what exact combinations leave and the one that does so as it goes, the one of fewer sequences."""
    return min((_plan(counts, length, late) for late in (True, False)), key=lambda lines: sum(n for _, n in lines))


def _plan(counts: dict[int, int], length: int, late: bool) -> list[tuple[tuple[int, ...], int]]:
    """late: lengths without an exact complement wait until all exact combinations are used up."""
    free = np.zeros(length + 1, np.int64)
    for size, many in counts.items():
        free[size] = many
    lines: list[tuple[tuple[int, ...], int]] = []

    def use(sizes: tuple[int, ...]) -> None:
        each = {s: sizes.count(s) for s in sizes}
        many = min(int(free[s]) // n for s, n in each.items())
        for s, n in each.items():
            free[s] -= many * n
        lines.append((sizes, many))

    def pair(gap: int, top: int) -> tuple[int, int] | None:
        """Two available lengths of at most `top` that fill the gap, as unlike as can be."""
        high = np.arange(min(top, gap - 1), (gap + 1) // 2 - 1, -1)
        good = (free[high] > 0) & (free[gap - high] > (gap == 2 * high))
        hit = int(good.argmax()) if len(good) else 0
        return (int(high[hit]), gap - int(high[hit])) if len(good) and good[hit] else None

    def exact(size: int, gap: int) -> tuple[int, ...] | None:
        if gap <= size and free[gap] > 0:
            return (gap,)
        if found := pair(gap, size):
            return found
        for third in np.flatnonzero(free[1 : gap // 3 + 1])[::-1] + 1:
            free[third] -= 1
            two = pair(gap - int(third), size)
            free[third] += 1
            if two and two[1] >= third:
                return (*two, int(third))
        return None

    def best_fit(size: int, gap: int) -> tuple[int, ...]:
        best: list[int] = []
        while gap > 0 and len(there := np.flatnonzero(free[1 : min(gap, size) + 1])):
            best.append(int(there[-1]) + 1)
            free[best[-1]] -= 1
            gap -= best[-1]
        for s in best:
            free[s] += 1
        return tuple(best)

    waiting = np.zeros(length + 1, np.int64)
    for size in range(length, 0, -1):
        while free[size] > 0:
            if size == length:
                use((size,))
                continue
            free[size] -= 1  # the one being placed is not free to fill its own gap
            found = exact(size, length - size)
            if found is None and not late:
                found = best_fit(size, length - size)
            free[size] += 1
            if found is None:
                free[size], waiting[size] = 0, free[size]
            else:
                use((size, *found))
    free[:] = waiting
    for size in range(length - 1, 0, -1):
        while free[size] > 0:
            free[size] -= 1
            found = best_fit(size, length - size)
            free[size] += 1
            use((size, *found))
    return lines


def _slots(lines: list[tuple[tuple[int, ...], int]], length: int) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, offset) of the lines' slots, by first number."""
    used = [0] * (length + 1)
    slots: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for sizes, many in lines:
        offset = 0
        for size in sizes:
            slots.setdefault(size, []).append((used[size], sequence, offset))
            used[size] += many
            offset += size
        sequence += many
    return {size: np.array(rows, np.int64) for size, rows in slots.items()}


def pack(documents: DataFrame, tokenizer: str, length: int = 2048, closing: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = pieces(documents, tokenizer, length, closing, with_ids)
    cut = written(cut.withColumn("salt", (F.rand(5) * (1 << 30)).cast("long")), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `length` rows
    slots = _slots(plan(counts, length), length)
    buckets = blocks_for(sum(counts.values()), NUMBERED)
    cut = cut.withColumn("bucket", F.pmod("salt", F.lit(buckets))).drop("salt")
    sums = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    first = sums.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("ids_crc32")
    numbered = cut.withColumn("own", F.row_number().over(order)).join(first, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("own") - 1).drop("bucket", "own", "before")

    @frugal
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own = slots[int(size)]
                line = own[np.searchsorted(own[:, 0], numbers[rows], "right") - 1]
                sequence[rows] = line[:, 1] + numbers[rows] - line[:, 0]
                offset[rows] = line[:, 2]
            kept = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")
