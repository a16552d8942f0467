from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import documents, prose, with_strange_columns
from tradeloom.llm import packing
from tradeloom.llm.queries import word_tokenizer

PATH = word_tokenizer()
TEXTS = [
    None, "", " \n", "Hello, World. It's A test...", "don't we'll ÀÉÎ ß é漢字", "<|startoftext|> x <|ENDOFTEXT|> <|endoftext|>.",
    prose(1, 30), "a\x0bb\x0cc d e", "é́.", "x.,. ,., 12,3.4 ...", prose(2, 9000), "word " * 5000, "İI ΑΣ. ΑΣ",
]


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(PATH)


def whole(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_whole_text(encoder):
    assert encoder.by_word
    assert [list(i) for i in encoder.ids(TEXTS)] == [whole(encoder, t) for t in TEXTS]


LETTERS = st.characters(categories=["Ll", "Lu", "Lt", "Lm", "Mn"], max_codepoint=0x600)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(LETTERS | st.sampled_from(" .,'"), max_size=30), max_size=4))
def test_ids_of_any_text(texts):
    if PATH not in packing._encoders:
        packing._encoders[PATH] = packing.Encoder(PATH)
    e = packing._encoders[PATH]
    assert [list(i) for i in e.ids(texts)] == [whole(e, t) for t in texts]


def test_other_tokenizers_read_whole_texts(tmp_path):
    """Of a cased one with closed words, and of one that drops accents, words are not remembered."""
    import json

    with open(PATH) as file:
        stated = json.load(file)
    for number, normalizers in enumerate([[{"type": "NFC"}], [{"type": "NFD"}, {"type": "StripAccents"}, {"type": "Lowercase"}]]):
        other = tmp_path / f"{number}.json"
        other.write_text(json.dumps(stated | {"normalizer": {"type": "Sequence", "normalizers": normalizers}}))
        e = packing.Encoder(str(other))
        assert not e.by_word
        assert [list(i) for i in e.ids(TEXTS)] == [whole(e, t) for t in TEXTS]


def test_words_met_often_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    e, whole, asked = packing.Encoder(PATH), packing.Encoder(PATH), []
    real = e._learned
    monkeypatch.setattr(e, "_learned", lambda cores: asked.extend(cores) or real(cores))
    for group in range(20):
        letters = [chr(97 + group) + chr(97 + i) * 3 for i in range(24)]
        texts = ["often seen, " + " ".join(letters), "", " \n seen often\t", None]
        assert [list(i) for i in e.ids(texts)] == [list(i) for i in whole.ids(texts)]
    assert asked.count(b"often") == asked.count(b"seen") == 1 and len(e.words) < 90


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    e = packing.Encoder(PATH)
    for _ in range(2):
        assert [list(i) for i in e.ids(TEXTS)] == [whole(e, t) for t in TEXTS]


def test_round_trip(spark, encoder):
    texts = TEXTS + [prose(100 + i, random.Random(i).randint(1, 900)) for i in range(60)] + [TEXTS[6]]
    frame = with_strange_columns(documents(spark, texts), "length", "piece", "salt", "bucket", "number", "ids")
    rows = packing.pack(frame, PATH, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert 1 <= r["length"] <= 2048 and len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [2048 * k for k in range(len(own))]
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in own), "<u4")
        assert list(ids) == [*whole(encoder, text), 0]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= math.ceil(total / 2048) + 1


def test_numbering_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 3)
    rows = packing.pack(documents(spark, ["same text"] * 50 + [prose(i, 5) for i in range(20)]), PATH, length=16).collect()
    places = {(r["sequence_id"], r["offset"] + k) for r in rows for k in range(r["length"])}
    assert len(places) == sum(r["length"] for r in rows)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def plain_best_fit(sizes, length):
    """Sequences that best fit of single pieces, longest first, needs."""
    room, used = [0] * (length + 1), 0
    for size in sorted(sizes, reverse=True):
        left = next((r for r in range(size, length) if room[r]), None)
        used += left is None
        if left is not None:
            room[left] -= 1
        room[(length if left is None else left) - size] += 1
    return used


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_every_piece_once_and_wastes_little(seed):
    rng = random.Random(seed)
    length = rng.choice([16, 100, 2048])
    sizes = [rng.randint(1, length) if seed % 2 else min(length, max(1, int(rng.lognormvariate(math.log(length / 4), 1)))) for _ in range(4000)]
    counts = {s: sizes.count(s) for s in set(sizes)}
    lines = packing.plan(counts, length)
    used = {}
    for combination, many in lines:
        assert many > 0 and sum(combination) <= length
        for s in combination:
            used[s] = used.get(s, 0) + many
    assert used == counts
    assert sum(m for _, m in lines) <= 1.002 * plain_best_fit(sizes, length) + 1
    assert len(lines) <= 6 * length


def test_exact_combinations_of_one_two_and_three():
    assert packing.plan({7: 1, 3: 1}, 10) == [((7, 3), 1)]
    assert packing.plan({7: 1, 2: 1, 1: 1}, 10) == [((7, 2, 1), 1)]
    assert packing.plan({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [((4, 3, 2, 1), 1)]
    assert packing.plan({5: 5}, 10) == [((5, 5), 2), ((5,), 1)]
    assert packing.plan({}, 10) == []


def test_best_fit_waits_for_exact_combinations_where_that_takes_fewer():
    def used(sizes, length):
        lines = packing.plan({s: sizes.count(s) for s in set(sizes)}, length)
        assert sorted(s for own, n in lines for s in own * n) == sorted(sizes) and all(sum(own) <= length for own, _ in lines)
        return sum(n for _, n in lines)

    assert used([14, 8, 10, 7, 7, 14, 16, 12], 30) == 3
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 12))]
        counts = {s: sizes.count(s) for s in set(sizes)}
        assert used(sizes, 30) == min(sum(n for _, n in packing._plan(counts, 30, late)) for late in (True, False))


def test_remembered_words_can_be_forgotten(monkeypatch):
    texts = [" ".join(f"word{i} x{j}" for i in range(j, j + 40)) for j in range(20)]
    want = [list(i) for i in packing.Encoder(PATH).ids(texts)]
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    e = packing.Encoder(PATH)
    assert [list(i) for t in texts for i in e.ids([t])] == want
