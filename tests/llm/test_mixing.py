from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import documents, prose, with_strange_columns
from tradeloom.llm import mixing


def plain_targets(sizes, weights):
    """Repeats the resharing word for word: all get their share, those above their limit keep it, the rest is dealt again."""
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in above}


def sample(spark, seed=1, n=400):
    rng = random.Random(seed)
    sources = [rng.choice(["a", "b", "B", "é", "z", None, "hot", "hot", "hot"]) for _ in range(n)]
    texts = [prose(i, rng.randint(1, 120)) for i in range(n - 3)] + [None, "", prose(7, 20000)]
    return documents(spark, texts, sources=sources), sources, texts


def test_targets_are_met_within_a_few_words(spark):
    frame, sources, texts = sample(spark)
    frame = with_strange_columns(frame, "size", "p", "copies", "_h", "target", "extra", "taken")
    rows = {r["doc_id"]: r for r in mixing.taken(frame).collect()}
    words = [len((t or "").split()) for t in texts]
    sizes = {s: sum(w for w, x in zip(words, sources) if x == s) for s in set(sources)}
    weights = mixing.cyclic_weights(list(sizes))
    assert weights == {"B": 1, "a": 2, "b": 3, "hot": 1, "z": 2, "é": 3, None: 1}
    want = plain_targets(sizes, weights)
    for i, r in rows.items():
        assert (r["size"], r["source_size"]) == (words[i], sizes[sources[i]])
        assert r["target"] == pytest.approx(want[sources[i]])
        assert r["taken"] in {k * words[i] for k in range(4)}
    for s, goal in want.items():
        got = sum(rows[i]["taken"] for i, x in enumerate(sources) if x == s)
        # Documents are taken whole, so one that is most of a source may be passed over.
        assert abs(got - goal) <= max(10, 0.01 * goal) or goal < max(words)
    assert {i: r["taken"] for i, r in rows.items()} == {r["doc_id"]: r["taken"] for r in mixing.taken(frame.repartition(7)).collect()}


def test_small_sources_stop_at_three_copies(spark):
    frame = documents(spark, [prose(1, 10), prose(2, 1000), prose(3, 5)], sources=["a", "b", "c"])
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.taken(frame).collect()}
    assert got[0] == (30.0, 30) and got[2] == (15.0, 15) and got[1][0] == pytest.approx(970)


def test_repeated_rows_hold_all_columns(spark):
    frame, _, _ = sample(spark, 3, 120)
    frame = with_strange_columns(frame, "_row", "_n", "p")
    taken = {r["doc_id"]: r["copies"] for r in mixing.taken(frame).collect()}
    out = mixing.repeated(frame)
    assert out.columns == frame.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}
    assert out.join(frame, frame.columns, "left_anti").where(F.col("text").isNotNull() & F.col("source").isNotNull()).isEmpty()


def test_overlapping_sources_share_documents(spark):
    texts = [prose(i, 50) for i in range(60)]
    frame = documents(spark, texts, sources=["x" if i < 20 else "x y" if i < 40 else "y" for i in range(60)])
    flat = lambda names: {n: 1 for n in names}
    rows = mixing.taken(frame, F.split("source", " "), flat).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(3000, abs=60)


def test_sources_of_their_own_need_no_flow(monkeypatch):
    """Three hundred thousand of them, beside two that overlap."""
    patterns = [((f"s{i}",), i % 7) for i in range(300_000)] + [(("x",), 5), (("x", "y"), 4)]
    quotas = {f"s{i}": i % 30 for i in range(300_000)} | {"x": 9, "y": 7}
    flows = []
    monkeypatch.setattr(mixing, "Flow", lambda nodes, make=mixing.Flow: flows.append(nodes) or make(nodes))
    sent = mixing.route(patterns, quotas)
    assert flows == [6]
    assert all(own == {f"s{i}": min(3 * (i % 7), i % 30)} for i, own in enumerate(sent[:-2]))
    assert sent[-2]["x"] + sent[-1]["x"] == 9 and sent[-1]["y"] == 7


def test_many_patterns_and_buckets_change_nothing(spark, monkeypatch):
    frame, _, _ = sample(spark, 5, 150)
    want = {r["doc_id"]: r["taken"] for r in mixing.taken(frame).collect()}
    assert mixing._shift(0) == mixing._shift(80_000_000) == 52 and mixing._shift(10**11) == 41
    monkeypatch.setattr(mixing, "BROADCAST", 1)
    monkeypatch.setattr(mixing, "_shift", lambda n: 44)
    assert {r["doc_id"]: r["taken"] for r in mixing.taken(frame).collect()} == want


def test_empty_table_and_documents_without_sources(spark):
    assert mixing.taken(documents(spark, [])).count() == 0
    assert mixing.repeated(documents(spark, [])).count() == 0
    rows = mixing.taken(documents(spark, ["a b"]), F.array().cast("array<string>")).collect()
    assert [(r["copies"], r["taken"]) for r in rows] == [(0, 0)]


def brute_cost(patterns, quotas, most, costs):
    """Best (flow, cost) over all whole-word routings of tiny problems."""
    best = (-1, 0)
    edges = [(i, m) for i, (members, _) in enumerate(patterns) for m in members]
    ranges = [range(0, min(most * patterns[i][1], quotas[m]) + 1) for i, m in edges]
    for amounts in product(*ranges):
        per, into = [0] * len(patterns), dict.fromkeys(quotas, 0)
        for (i, m), a in zip(edges, amounts):
            per[i] += a
            into[m] += a
        if any(p > most * s for p, (_, s) in zip(per, patterns)) or any(into[m] > quotas[m] for m in quotas):
            continue
        cost = sum(max(0, min(s, p - k * s)) * costs[k] for p, (_, s) in zip(per, patterns) for k in range(most))
        best = max(best, (sum(per), -cost))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_of_least_cost(seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"][: rng.randint(2, 3)]
    patterns = [(tuple(sorted(rng.sample(names, rng.randint(1, 2)))), rng.randint(0, 2)) for _ in range(3)]
    quotas = {n: rng.randint(0, 5) for n in names}
    settings = mixing.Settings()
    sent = mixing.route(patterns, quotas, settings)
    per = [sum(s.values()) for s in sent]
    cost = sum(max(0, min(s, p - k * s)) * settings.costs[k] for p, (_, s) in zip(per, patterns) for k in range(3))
    assert (sum(per), -cost) == brute_cost(patterns, quotas, 3, settings.costs)
    for m in names:
        assert sum(s.get(m, 0) for s in sent) <= quotas[m]
