"""Distinct counts from sets of bits."""

from __future__ import annotations

import random
from datetime import date

from tests.fixtures import item, market, order, rows
from tradeloom.operators.distincts import dense_ids, key_bits, union_sizes
from tradeloom.plans.store import Store
from tradeloom.sources.increments import KEY_IDS, SETS


def test_ids_are_dense_in_order_and_go_on(spark):
    keys = spark.createDataFrame([(f"k{i % 300:03d}",) for i in range(1000)], "key string").repartition(5)
    got = rows(dense_ids(keys, 7))
    assert got == [(f"k{i:03d}", i + 7) for i in range(300)]
    assert rows(dense_ids(keys.filter("false"))) == []


def test_unions_count_every_key_once(spark):
    rng = random.Random(1)
    held = [(rng.randrange(3), rng.randrange(4), rng.choice([0, 1, 62, 63, 64, 127, 128, 10**12, rng.randrange(500)])) for _ in range(900)]
    sets = key_bits(spark.createDataFrame(held, "g int, month int, id long"), ["g", "month"])
    assert rows(union_sizes(sets, ["g", "month"], "n")) == sorted((g, m, len({i for a, b, i in held if (a, b) == (g, m)})) for g, m in {r[:2] for r in held})
    assert rows(union_sizes(sets, ["g"], "n")) == sorted((g, len({i for a, _, i in held if a == g})) for g in {r[0] for r in held})
    dense = key_bits(spark.range(640), []).count()
    assert dense == 10  # 64 keys a row


def test_sets_follow_the_lines_month_by_month(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    items = [item(po, po % 7, 1.0, f"2024-0{1 + po % 4}-10") for po in range(40)]
    orders = [order(po, po % 5, po % 3) for po in range(40)]

    def check(held):
        vendor = {o[0]: o[2] for o in orders}
        for resolution, of in (("month", lambda d: date(d.year, d.month, 1)), ("year", lambda d: date(d.year, 1, 1))):
            want = {(vendor[i[0]], "product", of(i[4]), i[1]) for i in held} | {(vendor[i[0]], "buyer", of(i[4]), i[0] % 5) for i in held}
            counted = {}
            for v, kind, at, _ in want:
                counted[v, kind, at] = counted.get((v, kind, at), 0) + 1
            assert rows(store.distinct_counts(resolution)) == sorted((*k, n) for k, n in counted.items())

    store.stage(market(spark, items, orders))
    assert store.update_distincts() and not store.update_distincts()
    check(items)
    before = store.snapshots.current()
    changed = [*items[:-1], item(2, 99, 1.0, "2024-03-11")]  # April loses a line, March gains one with a new product
    store.stage(market(spark, changed, orders))
    assert store.update_distincts()
    check(changed)
    after = store.snapshots.current()
    assert {k[1] for k in after if k[0] == SETS and after[k] != before[k]} == {"2024-03-01", "2024-04-01"}
    assert [k for k in sorted(after) if k[0] == KEY_IDS] == [(KEY_IDS, "0"), (KEY_IDS, "1")]
    store.stage(market(spark, [i for i in changed if i[4].month != 2], orders))
    assert store.update_distincts()
    check([i for i in changed if i[4].month != 2])
