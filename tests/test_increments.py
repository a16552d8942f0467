"""Staged lines that follow their sources, first dates kept with them, and snapshots of what a sync writes."""

from __future__ import annotations

import os
import random
from datetime import datetime

import pytest

from tests.fixtures import SCHEMAS, item, market, order, rows
from tradeloom.params import Period, QueryParams
from tradeloom.plans import buyer, runs
from tradeloom.plans.snapshots import Snapshots
from tradeloom.plans.store import Store
from tradeloom.sources import increments
from tradeloom.sources.increments import FIRSTS, LINES, differing_orders, file_changes, with_month
from tradeloom.sources.tables import TABLES, Marketplace, read_parquet

NOW = datetime(2024, 6, 30, 8, 0)
PARAMS = {"seller": QueryParams(Period.of("2024-01-01", "2024-03-31"), 3, "month")}


def purchases(seed, n=60, months=(1, 2, 3, 4)):
    rng = random.Random(seed)
    items = [
        item(po, rng.randrange(6), float(rng.randrange(1, 9)), f"2024-0{rng.choice(months)}-{rng.randrange(1, 28):02d}")
        for po in range(n) for _ in range(rng.randrange(1, 3))
    ]
    return items, [order(po, rng.randrange(5), rng.randrange(3), source="web") for po in range(n)]


def same_lines(store, source):
    """Staged lines, zones and first dates are those of a store that begins with this source."""
    staged = store.lines(source)
    columns = sorted(source.lines().columns)
    assert rows(staged.lines(), *columns) == rows(source.lines(), *columns)
    fresh = Store(store.spark, f"{store.root}-fresh-{len(os.listdir(os.path.dirname(store.root)))}")
    fresh.stage(source)
    other = fresh.lines(source)
    assert sorted(map(repr, staged.zones)) == sorted(map(repr, other.zones))
    key = ("buyer_org_id", "kind", "key", "first_seen")
    assert rows(staged.first_dates, *key) == rows(other.first_dates, *key)
    assert rows(staged.first_dates, *key) == rows(buyer.first_dates(source.lines()), *key)


def test_steps_equal_a_fresh_start_and_leave_other_months_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    items, orders = purchases(1)
    source = market(spark, items, orders)
    assert store.stage(source) and not store.stage(source)
    before = store.snapshots.current()
    same_lines(store, source)

    # One line of March changes its amount, one is removed, one comes, twice; an order of March alone changes its buyer.
    march = [i for i in items if i[4].month == 3]
    whole = {i[0] for i in march} - {i[0] for i in items if i[4].month != 3}
    first, second = sorted(whole)[:2]
    changed = [(*i[:3], i[3] + 1, *i[4:]) if i[0] == first else i for i in items if i[0] != second]
    changed += [item(first, 77, 3.0, "2024-03-02")] * 2  # a product that nobody bought before
    moved = [(po, 4 - b, *rest) if po == first else (po, b, *rest) for po, b, *rest in orders]
    source = market(spark, changed, moved)
    assert store.stage(source)
    after = store.snapshots.current()
    assert {k for k in after if k[0] == LINES and after[k] != before[k]} == {(LINES, "2024-03-01")}
    buckets = [k for k in after if k[0] == FIRSTS]
    assert 0 < sum(after[k] != before.get(k) for k in buckets) < len(buckets)
    same_lines(store, source)

    # A late line, older than all, one without a date, an item without an order, and all of April gone.
    late = [i for i in changed if i[4].month != 4]
    late += [item(3, 0, 1.0, "2023-01-05"), (4, 1, 1.0, 2.0, None, None), item(999, 1, 1.0, "2024-02-02")]
    source = market(spark, late, moved)
    assert store.stage(source)
    months = {part for name, part in store.snapshots.current() if name == LINES}
    assert months == {"2023-01-01", "2024-01-01", "2024-02-01", "2024-03-01", "none"}
    same_lines(store, source)
    source = market(spark, [*late, item(5, 1, 1.0, "2024-02-02")], [*moved, order(999, 1, 1)])  # the order comes, late
    assert store.stage(source)
    same_lines(store, source)


def write_tables(spark, folder, items, orders, mode="overwrite"):
    given = dict(zip(TABLES, (items, orders, [], [], []), strict=True))
    for name in TABLES:
        kind = SCHEMAS[name].replace("double", "decimal(18,2)") if name == "po_items" else SCHEMAS[name]
        from decimal import Decimal

        held = [tuple(Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in given[name]]
        if held or mode == "overwrite":
            spark.createDataFrame(held, kind).coalesce(1).write.mode(mode).parquet(f"{folder}/{name}")


def test_files_tell_what_changed(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "tables")
    items, orders = purchases(2, 30)
    write_tables(spark, folder, items, orders)
    store = Store(spark, str(tmp_path / "store"))
    assert store.stage(read_parquet(spark, folder))
    source = read_parquet(spark, folder)
    seen = store.staged_lines._read(store.snapshots.current(), "files")
    assert file_changes(source, seen) == ({}, 0) and not store.stage(source)

    # New files alone: nothing is compared.
    write_tables(spark, folder, [item(2, 4, 7.0, "2024-02-09"), item(50, 1, 7.0, "2024-05-09")], [order(50, 1, 1)], "append")
    with monkeypatch.context() as m:
        m.setattr("tradeloom.sources.increments.differing_orders", lambda *_: 1 / 0)
        assert store.stage(read_parquet(spark, folder))
    same_lines(store, read_parquet(spark, folder))

    # A file written anew: orders are compared.
    write_tables(spark, folder, items[:-4], orders)
    came, went = file_changes(read_parquet(spark, folder), store.staged_lines._read(store.snapshots.current(), "files"))
    assert went == 4 and sorted(came) == ["po_details", "po_items"]
    assert store.stage(read_parquet(spark, folder))
    same_lines(store, read_parquet(spark, folder))


def test_the_buyer_overview_of_a_sync_reads_two_periods(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    source = market(spark, *purchases(3))
    store.stage(source)
    params = QueryParams(Period.of("2024-04-01", "2024-04-30"))
    staged = store.lines(source)
    got = buyer.overview(staged, params)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("FileScan")[1:] if "amount_units" in x.split("PartitionFilters")[0])
    months = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "2024-03-01" in months and "2024-04-01" in months and "2024-02-01" not in months and "2024-01-01" not in months
    assert rows(got) == rows(buyer.overview(source, params))


@pytest.mark.parametrize("step", ["write overview", "platform_benchmarks", "_put_benchmarks", "_put_history", "publish"])
def test_a_failure_after_each_write_leaves_the_former_state_whole(spark, tmp_path, monkeypatch, step):
    store = Store(spark, str(tmp_path / "store"))
    store.sync(market(spark, *purchases(4, 12)), PARAMS, NOW)

    def state():
        kept = (store.history("seller").drop("created_at", "updated_at"), store.overview("seller"), store.benchmarks("seller"))
        return [rows(f) for f in kept]

    before, version = state(), store.snapshots.current()
    other = market(spark, *purchases(5, 12))
    store.stage(other)  # lines are published by themselves

    def after(real):
        def run(*args):
            real(*args)
            raise OSError("lost")

        return run

    with monkeypatch.context() as m:
        if step == "write overview":
            m.setattr("tradeloom.plans.store.platform_benchmarks", lambda *_: 1 / 0)
        elif step == "platform_benchmarks":
            m.setattr(store, "_put_benchmarks", lambda *_: 1 / 0)
        elif step == "publish":
            m.setattr(store.snapshots, "publish", lambda *_: 1 / 0)
        else:
            m.setattr(store, step, after(getattr(store, step)))
        assert store.sync(other, PARAMS, NOW) == {"seller": 0}
    assert state() == before
    types = ("history", "overview", "benchmarks")
    now = store.snapshots.current()
    assert {k: f for k, f in now.items() if k[0] in types} == {k: f for k, f in version.items() if k[0] in types}
    if step == "publish":
        reader = store.history("seller")  # begins before the next publication
        assert store.sync(other, PARAMS, NOW)["seller"] > 0 and state() != before
        assert rows(reader.drop("created_at", "updated_at")) == before[0]


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    for number in range(4):
        folder = snapshots.folder("numbers")
        spark.range(number + 1).write.parquet(snapshots.path(folder))
        assert snapshots.publish({("numbers", ""): folder, ("numbers", str(number)): folder}) == number + 1
    spark.range(9).write.parquet(snapshots.path(snapshots.folder("numbers")))  # never published
    assert snapshots.publish({("numbers", str(n)): None for n in range(4)}) == 5
    assert snapshots.vacuum(keep=1) == 4
    assert set(snapshots.current()) == {("numbers", "")}
    assert spark.read.parquet(snapshots.path(snapshots.current()["numbers", ""])).count() == 4
    snapshots.publish({("numbers", ""): None})
    assert snapshots.current() == {} and snapshots.publish({}) == 7
    assert snapshots.vacuum(keep=1) == 1 and len(os.listdir(tmp_path / "versions")) == 1


def test_a_run_uses_the_kept_first_dates(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    source = market(spark, *purchases(6, 20))
    params = QueryParams(Period.of("2024-03-01", "2024-03-31"), 3)
    store.sync(source, {"buyer": params}, NOW)
    seen = []
    real = buyer.purchases_by_key
    monkeypatch.setattr(buyer, "purchases_by_key", lambda m, p, d=None: seen.append(d) or real(m, p, d))
    status = runs.run_entities(store, store.lines(source), "buyer", params, NOW, entity_ids=[1, 2])
    assert len(seen) == 1 and seen[0] is not None and status.count() == 2


def test_a_failed_run_is_taken_up_after_its_last_finished_step(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    source = market(spark, *purchases(7, 20))
    store.sync(source, PARAMS, NOW)
    staged, calls = store.lines(source), []

    def run():
        return runs.run_entities(store, staged, "seller", PARAMS["seller"], NOW)

    def watch(owner, name):
        real = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *args: (calls.append(name), real(*args))[1])

    for owner, name in ((runs, "query_rows"), (store, "write_dashboards"), (store, "write_insights")):
        watch(owner, name)
    with monkeypatch.context() as m:
        m.setattr(runs, "entity_insights", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert calls == ["query_rows", "write_dashboards"] and store.insights().isEmpty()
    calls.clear()
    done = rows(run())
    assert calls == ["write_insights"] and {r[1] for r in done} == {"success"}
    calls.clear()
    assert rows(run()) == done and calls == ["query_rows", "write_dashboards", "write_insights"]  # through: begins anew
    calls.clear()
    with monkeypatch.context() as m:
        m.setattr(runs, "entity_insights", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    store.sync(source, PARAMS, NOW)  # another state of the store: nothing is taken up
    calls.clear()
    run()
    assert calls == ["query_rows", "write_dashboards", "write_insights"]


def test_lines_may_be_none_and_come_later(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    items, orders = purchases(8, 6)
    assert store.sync(market(spark, [], []), PARAMS, NOW) == {"seller": 0}
    assert store.latest_sync().first().status == "error"
    with pytest.raises(LookupError):
        store.lines(market(spark, [], []))
    for source in (market(spark, items, orders), market(spark, [], []), market(spark, items[:3], orders)):
        store.stage(source)
        if not source.po_items.isEmpty():
            assert rows(store.lines(source).lines(), *sorted(source.lines().columns)) == rows(source.lines(), *sorted(source.lines().columns))
            assert rows(store.lines(source).first_dates) == rows(buyer.first_dates(source.lines()))


def test_a_sync_moves_no_row_more_often_than_it_must(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    source = market(spark, *purchases(9, 12))
    store.stage(source)
    parts = store.snapshots.current()
    held = store.staged_lines._read(parts, LINES).columns
    assert sorted(held) == sorted([*source.lines().columns, "created_month"])  # no digests, which would not compress
    assert {name for name, _ in parts} == {LINES, "zones", FIRSTS}  # first dates once, not by month too
    staged = store.lines(source)

    def joins(start):
        params = QueryParams(Period.of(start, "2024-04-30"))
        got = buyer.overview(staged, params)
        assert rows(got) == rows(buyer.overview(source, params))
        return "Join" in got._jdf.queryExecution().optimizedPlan().toString()

    # The lines of January to April tell all first dates of a period and the one before that hold them; others look them up.
    assert not joins("2024-03-01") and joins("2024-04-01")


def test_first_dates_are_found_anew_where_most_months_change(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    items, orders = purchases(7, 20)
    store.stage(market(spark, items, orders))
    monkeypatch.setattr(buyer, "earliest", lambda *_: 1 / 0)  # looks changed keys up among those of all lines
    source = market(spark, [(*i[:3], i[3] + 1, *i[4:]) for i in items[:-1]], orders)
    assert store.stage(source)
    lines = store.lines(source)
    assert rows(lines.lines(), *sorted(source.lines().columns)) == rows(source.lines(), *sorted(source.lines().columns))
    assert rows(lines.first_dates) == rows(buyer.first_dates(source.lines()))


def test_sources_that_give_their_lines_are_not_joined_again(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    items, orders = purchases(10, 20)
    store.stage(market(spark, items, orders))
    new = market(spark, items[3:], [(*o[:4], "post" if o[0] == 9 else o[4], o[5]) for o in orders])
    joined, staged = new.lines(), store.staged_lines.lines(store.snapshots.current())
    given = Marketplace(spark, {n: (lambda n=n: getattr(new, n)) for n in TABLES}, lines=lambda: joined, scale=new.scale)
    assert rows(differing_orders(given, staged)) == rows(differing_orders(new, staged)) != []
    monkeypatch.setattr(increments, "join_items_orders", lambda *_: 1 / 0)
    assert store.stage(given) and not store.stage(given)
    same_lines(store, given)


def test_two_equal_lines_are_not_taken_for_two_others(spark):
    before, after = ([item(1, 2, amount, "2024-01-05") for _ in range(2)] for amount in (3.0, 4.0))
    orders = [order(1, 5, 6)]
    lines = with_month(market(spark, before, orders).lines())
    assert rows(differing_orders(market(spark, after, orders), lines)) == [(1,)]
    assert rows(differing_orders(market(spark, before, orders), lines)) == []
