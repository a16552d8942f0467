"""The pipeline's stages by their effects, and its run against plain versions of what can be told exactly."""

from __future__ import annotations

import os

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_packing import whole
from tradeloom.llm import mixing, near_copies, packing, queries, secrets

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    """The table after each stage, read again from where it was written."""
    from tradeloom.llm.common import table, written

    docs, out = table(spark, FOLDER, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), f"test-{name}".replace(" ", "-"))
        out.append(docs)
    return out


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "near-duplicates", "secrets", "mixing", "packing"]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages)


def test_language_stage_drops_only_texts_without_letters(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert [r for r in before if r[1] and any(c.isalpha() for c in r[1])] == after


def test_near_duplicates_leave_one_of_each_group(stages):
    before, after = stages[1].collect(), rows(stages[2])
    sets = near_copies.shingle_sets([r["text"] for r in before], 5)
    label = {r["doc_id"]: r["doc_id"] for r in before}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if both and 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = root(before[x]["doc_id"]), root(before[y]["doc_id"])
                label[max(a, b)] = min(a, b)
    assert after == sorted((tuple(r) for r in before if root(r["doc_id"]) == r["doc_id"]), key=repr)


def test_secrets_are_marked_and_nothing_else_changes(spark, stages):
    before, after = {r["doc_id"]: r for r in stages[2].collect()}, {r["doc_id"]: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    found = {r[0]: r[1] for r in secrets.scan(stages[2]).select("document.doc_id", "spans").collect()}
    for i, r in after.items():
        text, at, out = before[i]["text"], 0, ""
        for s in found[i]:
            if s["start"] >= at:
                out += text[at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        want = out + text[at:] if found[i] else text
        assert r["text"] == want and (not found[i] or r["n_chars"] == len(want))
    assert secrets.findings(_scanned(spark, stages[3])).isEmpty()


def _scanned(spark, docs):
    ledger = secrets.Ledger(spark)
    secrets.scan_unseen(docs, ledger)
    return ledger


def test_mixing_repeats_by_the_mix(stages):
    copies = {r["doc_id"]: r["copies"] for r in mixing.taken(stages[3]).collect()}
    counts = {r["doc_id"]: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}


def test_run_packs_what_the_stages_kept(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    encoder = packing.Encoder(queries.word_tokenizer())
    lengths = sorted(r["length"] for r in out if r["piece"] == 0)
    want = [len(whole(encoder, r["text"])) + 1 for r in stages[4].collect()]
    assert lengths == sorted(min(2048, n) for n in want)
    assert sum(r["length"] for r in out) == sum(want)
    held = {}
    for r in out:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
