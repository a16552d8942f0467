"""Lines gathered by entity: a sync moves them once for all queries of the entity."""

from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import functions as F

from tests.fixtures import category, item, market, order, rows
from tests.test_store import NOW, PARAMS
from tradeloom.operators import gathering
from tradeloom.operators.gathering import gathered
from tradeloom.plans.entities import numbered, query_rows
from tradeloom.plans.registry import plan_of
from tradeloom.plans.store import Store


def trades(spark):
    """Vendor 1 and buyer 2 have most lines; some belong to no vendor or no buyer."""
    items = [item(po, po % 7, float(po * 37 % 101), f"2024-0{1 + po % 3}-{10 + po % 9}") for po in range(240)]
    orders = [
        order(po, None if po % 31 == 0 else 2 if po % 3 else po % 11, None if po % 29 == 0 else 1 if po % 2 else po % 13,
              f"2024-0{1 + po % 3}-02", "web", po % 5)
        for po in range(240)
    ]
    products = [(p, p % 3, f"product {p}", category(("c", 1 + p % 2))) for p in range(6)]
    return market(spark, items, orders, products, [(a, f"city {a}") for a in range(4)], [(v, f"org {v}") for v in range(13)])


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("entity_type", ["buyer", "seller"])
def test_gathered_lines_are_not_shuffled_again(spark, entity_type):
    source, plan, params = trades(spark), plan_of(entity_type), PARAMS[entity_type]
    read = plan.lines_read(source, params)
    with gathered(read.lines(), plan.line_column, a_task=40) as (near, spread):
        assert spread is None and near.rdd.getNumPartitions() > 2
        for query in plan.queries:
            got = query.build(read.with_lines(near, None, read.first_dates), params)
            assert rows(got, *sorted(got.columns)) == rows(query.build(source, params), *sorted(got.columns)), query.name
            if query is plan.overview or query.name in ("monthly_trends", "quarterly_trends", "sales_time_series", "order_analysis"):
                placed = got if query is plan.overview else numbered(got, entity_type, query.name)
                assert "Exchange" not in executed(placed).split("InMemoryRelation")[0], query.name
        assert near.storageLevel.useDisk
    assert not near.storageLevel.useDisk


@pytest.mark.parametrize("most", [10**6, 20, 0])
def test_large_entities_stay_spread_and_lose_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(gathering, "LINES_TO_SPREAD", most)
    lines = plan_of("seller").lines_read(trades(spark), PARAMS["seller"]).lines()
    with gathered(lines, "seller_org_id") as sides:
        ids = [{r[0] for r in side.select("seller_org_id").distinct().collect()} if side is not None else set() for side in sides]
        whole = reduce(lambda a, b: a.unionByName(b), [s for s in sides if s is not None])
        assert rows(whole, *sorted(whole.columns)) == rows(lines, *sorted(lines.columns))
    assert not ids[0] & ids[1] and (1 in ids[1]) == (most < 10**6)
    assert (None in ids[1]) == (most == 0)  # nine lines without a vendor


@pytest.mark.parametrize("most", [10**6, 20, 0])
def test_a_sync_is_the_same_however_large_its_entities_are(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(gathering, "LINES_TO_SPREAD", most)
    monkeypatch.setattr(gathering, "LINES_A_TASK", 50)
    monkeypatch.setattr("tradeloom.plans.entities.ROWS_PER_PART", 4)
    source, store = trades(spark), Store(spark, str(tmp_path))
    assert 0 not in store.sync(source, PARAMS, NOW).values()
    columns = ["entity_id", "query", "position", "row"]
    for kind, params in PARAMS.items():
        history = store.history(kind)
        assert rows(history.select(columns), *columns) == rows(query_rows(source, kind, params).select(columns), *columns)
        # An entity's chunks follow each other in the query's order.
        spans = history.groupBy("entity_id", "query", "chunk").agg(F.min("position").alias("low"), F.max("position").alias("high")).collect()
        spans.sort(key=lambda r: (r.query, r.entity_id is None, r.entity_id or 0, r.chunk))
        for a, b in zip(spans, spans[1:]):
            assert (a.query, a.entity_id) != (b.query, b.entity_id) or a.high <= b.low
