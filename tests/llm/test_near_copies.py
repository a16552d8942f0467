from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.tables import by_id, documents, prose, with_strange_columns
from tradeloom.llm import near_copies as nc

THREE = nc.Settings(words=3, percent=85)


def brute(texts, ids, settings):
    sets = nc.shingle_sets(texts, settings.words)
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(texts)):
        for y in range(x):
            a, b = sets[x], sets[y]
            both = len(np.intersect1d(a, b))
            if len(a) and len(b) and 100 * both >= settings.percent * (len(a) + len(b) - both) or ids[x] == ids[y]:
                p, q = root(ids[x]), root(ids[y])
                label[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def groups_of_copies(seed=0):
    """Bases with copies edited from hardly to heavily, so that many pairs lie around the threshold."""
    rng, texts = random.Random(seed), []
    for base in range(12):
        text = prose(100 + base, rng.randint(60, 160))
        texts.append(text)
        texts += [edited(text, i % 9, 1000 * base + i) for i in range(rng.choice([0, 1, 2, 25]))]
    texts += [texts[0], texts[0].upper(), None, "", " \t", "a", "a", "A b", "a  b", "b a"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [texts[i] for i in order]


@pytest.mark.parametrize("settings", [THREE, nc.Settings()])
def test_agrees_with_brute_force(spark, settings):
    texts = groups_of_copies()
    got = by_id(nc.classes(with_strange_columns(documents(spark, texts), "rep", "key", "n", "bucket", "label"), settings), "n_shingles", "component_id", "kept")
    want = brute(texts, list(range(len(texts))), settings)
    sizes = [len(s) for s in nc.shingle_sets(texts, settings.words)]
    assert got == {i: (sizes[i], want[i], want[i] == i) for i in want}


def test_links_that_the_first_round_cannot_see(spark, monkeypatch):
    """With tiny packs every bucket is searched in many pieces, and nothing is lost."""
    monkeypatch.setattr(nc, "PACK_SHINGLES", 300)
    texts = groups_of_copies(5)
    got = by_id(nc.classes(documents(spark, texts), THREE), "component_id")
    assert got == brute(texts, list(range(len(texts))), THREE)


def test_rows_with_the_same_id_and_without_one(spark):
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    frame = documents(spark, [a, b, b, c, a, c], ids=[5, 5, 9, 4, None, 4])
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"], r["kept"]) for r in nc.classes(frame).collect())
    assert got == [(-1, None, True), (4, 4, True), (4, 4, True), (5, 5, True), (5, 5, True), (9, 5, False)]
    kept = nc.keep_first(frame).select("doc_id").collect()
    assert sorted(str(r[0]) for r in kept) == ["4", "4", "5", "5", "None"]


def test_empty_table(spark):
    assert nc.classes(documents(spark, [])).count() == 0


def test_bands_and_pruning_keep_pairs_at_the_threshold():
    for settings in (THREE, nc.Settings()):
        t = settings.percent / 100
        assert (1 - t**settings.rows) ** settings.bands <= settings.miss
        rng = np.random.default_rng(1)
        left = rng.integers(0, 2**16, (4000, settings.hashes)).astype(np.uint16)
        alike = rng.random(left.shape) < t
        right = np.where(alike, left, left + 1).astype(np.uint16)
        assert nc.survives(left, right, settings.least_matches()).mean() > 0.999
        far = np.where(rng.random(left.shape) < 0.3, left, left + 1).astype(np.uint16)
        assert not nc.survives(left, far, settings.least_matches()).any()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r["node"]: r["label"] for r in nc.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 95: 90, 100: 90}
