from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.tables import documents, prose, with_strange_columns
from tradeloom.llm import long_repeats as lr
from tradeloom.llm.tokens import numbered, words_of


def brute(rows, window=50):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for p in range(len(w) - window + 1):
            g = tuple(w[p : p + window])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    frame = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    frame = with_strange_columns(frame, "sha", "names", "starts", "n_words", "first_id")
    return sorted((tuple(r) for r in lr.without_repeats(frame).collect()), key=repr)


def test_agrees_with_brute_force(spark):
    passage, other = prose(1, 60), prose(2, 49)
    run_ = "the " * 120
    rows = [
        (0, prose(3, 200)), (1, prose(4, 80) + " " + passage + " " + prose(5, 70)), (2, passage + " end"), (3, "start " + passage),
        (4, other), (5, other), (6, prose(6, 30) + " " + other), (7, prose(3, 200)), (8, None), (9, ""), (10, run_ + "x"),
        (11, "y " + run_), (12, " ".join([passage] * 3)), (13, prose(3, 120)), (14, "a " * 49), (15, "a " * 50), (16, "a " * 51),
        (17, passage.replace(" ", "\n\t")), (18, "  ".join(prose(7, 3000).split()) + " " + passage), (None, passage), (None, None),
        (19, prose(4, 80).upper()), (7, prose(3, 200)), (20, prose(8, 20000)), (21, prose(9, 10) + " " + prose(8, 20000)),
    ]
    assert run(spark, rows) == brute(rows)


def test_random_texts_of_few_words(spark):
    rng = random.Random(11)
    pool = [" ".join(rng.choice("abc") for _ in range(rng.randint(40, 90))) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 4)))) for i in range(80)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_share_an_id_do_not_remove_from_each_other(spark):
    passage = prose(1, 60)
    rows = [(3, passage), (3, passage + " more"), (4, passage), (4, "x " + passage)]
    assert run(spark, rows) == brute(rows)


def test_kept_text(spark):
    passage = prose(1, 60)
    frame = documents(spark, [passage, "before " + passage + " after"])
    got = {r["doc_id"]: r["kept_text"] for r in lr.without_repeats(frame, with_text=True).collect()}
    assert got == {0: None, 1: "before after"}


def test_empty_table(spark):
    assert lr.without_repeats(documents(spark, [])).count() == 0


@pytest.mark.parametrize("trial", range(30))
def test_equal_windows_have_equal_names(trial):
    rng = random.Random(trial)
    vocabulary = [b"%d" % i for i in range(rng.choice([2, 3, 10, 1000]))]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base = draw(rng.randint(50, 120))
    if trial % 3 == 0:
        base[10:10] = [vocabulary[0]] * rng.randint(2, 120)
    texts = [draw(rng.randint(0, 30)) + base + draw(rng.randint(0, 30)) for _ in range(3)] + [base]
    values, bounds = numbered(texts)
    flat = [w for t in texts for w in t]
    names = {}
    for start, name in zip(*lr.window_names(values, bounds, 50, 4)):
        names.setdefault(tuple(flat[start : start + 50]), set()).add(int(name))
    assert all(len(n) == 1 for n in names.values())
