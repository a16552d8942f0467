"""Context-tree scores against a tree of dictionaries, written node by node."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.tables import DOCUMENT, documents, prose, with_strange_columns
from tradeloom.llm import context_tree, model_scores

DEPTH = 5


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


class Tree:
    def __init__(self, texts):
        self.nodes = collections.defaultdict(lambda: [0, 0])
        for text in texts:
            before = b"\xff" * DEPTH
            for byte in text + b"\xff":
                for depth in range(DEPTH + 1):
                    for bit in range(8):
                        self.nodes[before[DEPTH - depth :], bit, byte >> (8 - bit)][(byte >> (7 - bit)) & 1] += 1
                before = (before + bytes([byte]))[-DEPTH:]
        children = collections.defaultdict(list)
        for context, bit, prefix in self.nodes:
            if context:
                children[context[1:], bit, prefix].append((context, bit, prefix))
        self.weighted = {}
        for node in sorted(self.nodes, key=lambda n: -len(n[0])):
            own = self.estimate(node)
            below = sum(self.weighted[c] for c in children[node])
            self.weighted[node] = own if len(node[0]) == DEPTH else np.logaddexp(math.log(0.5) + own, math.log(0.5) + below)

    def estimate(self, node):
        a, b = self.nodes[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def one(self, before, bit, prefix):
        out = None
        for depth in range(DEPTH, -1, -1):
            node = before[DEPTH - depth :], bit, prefix
            if node in self.nodes:
                a, b = self.nodes[node]
                own = (b + 0.5) / (a + b + 1)
                share = math.exp(math.log(0.5) + self.estimate(node) - self.weighted[node])
                out = own if out is None else share * own + (1 - share) * out
        return 0.5 if out is None else out

    def score(self, text):
        before, total = b"\xff" * DEPTH, 0.0
        for byte in text + b"\xff":
            for bit in range(8):
                p = self.one(before, bit, byte >> (8 - bit))
                total += math.log10(p if (byte >> (7 - bit)) & 1 else 1 - p)
            before = (before + bytes([byte]))[-DEPTH:]
        return total


def brute(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of (doc_id, text) rows."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    texts = [lowered(t) for _, t in rows]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    count = collections.Counter(w for t in train for w in t.split())
    n, v = sum(count.values()) + len(train), len(count) + bool(train)
    tree, out = Tree(train), []
    for (doc_id, _), text, flag in zip(rows, texts, held, strict=True):
        counts = [count[w] for w in text.split()] + [len(train)]
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in counts)
        out.append((doc_id, flag, len(counts), sum(c > 0 for c in counts), n, base, tree.score(text)))
    return sorted(out, key=repr)


def check(frame, rows):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    want = brute(rows)
    key = lambda r: (r[:5], round(r[6], 4))
    for g, w in zip(sorted(got, key=lambda r: repr(key(r))), sorted(want, key=lambda r: repr(key(r))), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


TEXTS = [
    prose(1, 60, 40),
    prose(2, 80, 40),
    None,
    "",
    "  \t\n ",
    "The Same text, AGAIN and again",
    "The Same text, AGAIN and again",
    "ÄÖ ünï ÀB 中文 🙂 " * 3,
    prose(3, 30, 1000),
    "x" * 500,
    "\x00\x01 \x7f",
]


def test_agrees_with_a_tree_of_dictionaries(spark):
    ids = [*range(len(TEXTS) - 2), None, 3]  # a null id, and one twice
    rows = list(zip(ids, TEXTS, strict=True))
    check(model_scores.score(with_strange_columns(documents(spark, TEXTS, ids=ids), "gram", "block", "n", "learned", "score")), rows)


def test_every_slice_and_group_agrees(spark, monkeypatch):
    # Slices are cut in the executors' copy of the module, so the cutting is tested here, the groups in Spark.
    monkeypatch.setattr(model_scores, "SLICE", 7)
    texts = [lowered(t) for t in TEXTS]
    found = list(model_scores._gram_slices(texts, DEPTH))
    keys, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    monkeypatch.undo()
    whole, numbers = zip(*model_scores._gram_slices(texts, DEPTH), strict=True)
    assert keys.tolist() == whole[0].tolist() and owner.tolist() == numbers[0].tolist()
    assert np.bincount(owner).tolist() == [len(t) + 1 for t in texts]
    monkeypatch.setattr(model_scores, "SLICE", 5)
    for text in texts:
        assert [w for part in model_scores._word_slices(text) for w in part.split()] == text.split()

    unique, counts = np.unique(keys, return_counts=True)
    facts = spark.createDataFrame(list(zip(unique.tolist(), counts.tolist(), strict=True)), "gram long, n long")
    one, many = (
        {r.gram: r.value for r in model_scores.gram_scores(facts, per_group=size).collect()} for size in (10**6, 20)
    )
    assert one == pytest.approx(many, rel=1e-12) and len(one) == len(unique)


def test_a_block_asks_each_group_in_one_message():
    texts = [lowered(t) for t in TEXTS]
    chunks = [(0, ([*range(len(texts))], [i % 3 > 0 for i in range(len(texts))], [len(t) for t in texts], b"".join(texts)))]
    asked = list(model_scores._asked_grams(4, chunks, DEPTH, 3, 5))
    assert sorted(group for group, _ in asked) == [0, 1, 2, 3, 4] and {block for _, (block, _, _) in asked} == {4}
    found, contexts = collections.Counter(), collections.defaultdict(set)
    for group, (_, grams, counts) in asked:
        for key, n in zip(model_scores._together(grams).tolist(), np.frombuffer(counts, np.int64).tolist(), strict=True):
            assert key not in found
            found[key] = n
            contexts[key >> 24].add(group)
    assert {len(groups) for groups in contexts.values()} == {1}  # closed under the nearest three bytes
    keys, owner = (np.concatenate(x) for x in zip(*model_scores._gram_slices(texts, DEPTH), strict=True))
    want = collections.Counter(dict.fromkeys(keys.tolist(), 0))
    want.update(k for k, o in zip(keys.tolist(), owner.tolist(), strict=True) if o % 3)
    assert found == want


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = [lowered(t) for t in TEXTS]
    run, ends = context_tree.joined(texts, DEPTH)
    keys, counts = np.unique(context_tree.grams(run, ends, DEPTH)[1], return_counts=True)
    for context in {int(k) >> 8 for k in keys[:: len(keys) // 5]} | {0x0102030405}:
        asked = [(context << 8) | byte for byte in range(256)]
        known = dict(zip(keys.tolist(), counts.tolist(), strict=True))
        rows = [(k, known.get(k, 0)) for k in set(asked) | set(known)]
        got = {r.gram: r.value for r in model_scores.gram_scores(spark.createDataFrame(rows, "gram long, n long")).collect()}
        assert sum(10 ** got[k] for k in asked) == pytest.approx(1, rel=1e-9)


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 40, 0.5), 10.0 ** np.arange(2, 12)])
    assert context_tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)


def test_empty_table_and_nothing_to_learn_from(spark):
    assert model_scores.score(spark.createDataFrame([], DOCUMENT)).collect() == []
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(i, t) for i, t in zip(held, ["ab c", "", None], strict=True)]
    got = model_scores.score(documents(spark, [t for _, t in rows], ids=held)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(held[0], 3, 0, 0), (held[1], 1, 0, 0), (held[2], 1, 0, 0)]
    for r in got:
        assert r.score == pytest.approx((r.n_bytes + 1) * 8 * math.log10(0.5)) and r.bits_per_byte == pytest.approx(8)
        assert r.base_score == pytest.approx(0)


def test_held_out_prose_costs_less_than_its_alphabet_and_noise_more(spark):
    rng = random.Random(5)
    syllables = ["an", "the", "re", "ti", "ou", "sh", "wh", "er", "on", "ed"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 6))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(400)]
    texts[1] = "".join(chr(rng.randrange(33, 127)) for _ in range(400))
    got = {r.doc_id: r for r in model_scores.score(documents(spark, texts)).collect()}
    assert got[1].bits_per_byte > 2 * got[0].bits_per_byte
    held = [r for r in got.values() if r.held_out and r.doc_id != 1]
    assert held and all(r.bits_per_byte < 2 for r in held)  # ten letters and a space even out at over three
