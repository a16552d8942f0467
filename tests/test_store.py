"""Written history, benchmarks, log and documents."""

from __future__ import annotations

import json
from datetime import datetime
from types import SimpleNamespace

import pytest

from tests.fixtures import category, item, market, order, rows
from tradeloom import session
from tradeloom.params import Period, QueryParams
from tradeloom.plans import entities, runs, seller
from tradeloom.plans import store as stores
from tradeloom.plans.benchmarks import platform_benchmarks
from tradeloom.plans.store import Store
from tradeloom.session import shared_folder

NOW = datetime(2024, 3, 31, 8, 0)
QUARTER = Period.of("2024-01-01", "2024-03-31")
PARAMS = {"buyer": QueryParams(QUARTER, 3), "seller": QueryParams(QUARTER, 3, "month")}


def sample(spark, scale=1.0, vendors=3):
    items = [item(po, po % 4, scale * (po + 1), f"2024-0{1 + po % 3}-10") for po in range(30)]
    orders = [
        order(po, po % 5, None if po % 10 == 9 else po // 3 % vendors, "2024-01-02", "web", po % 4)
        for po in range(30)
    ]
    products = [(p, p % 3, f"product {p}", category(("c", 1))) for p in range(4)]
    addresses = [(a, f"city {a}") for a in range(4)]
    return market(spark, items, orders, products, addresses, [(v, f"org {v}") for v in range(3)])


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def test_empty_store(store):
    assert not store.history_exists("buyer")
    assert rows(store.health()) == [(0, 0, None, None)]
    with pytest.raises(LookupError):
        store.benchmark_lookup("buyer")
    with pytest.raises(LookupError):
        store.history_lookup("buyer", 1)
    assert store.insights().isEmpty()


def test_a_sync_reads_lines_in_small_splits(spark, store, monkeypatch):
    monkeypatch.setattr(session, "SUMMED_BYTES", 512)
    setting, splits, frames_of = "spark.sql.files.maxPartitionBytes", [], stores.query_frames

    def seen(market, *rest):
        splits.append((market.lines().rdd.getNumPartitions(), len(market.lines().inputFiles())))
        return frames_of(market, *rest)

    monkeypatch.setattr(stores, "query_frames", seen)
    before = spark.conf.get(setting)
    store.sync(sample(spark), PARAMS, NOW)
    assert len(splits) == 2 and all(parts > files for parts, files in splits)
    assert spark.conf.get(setting) == before


def test_sync_fills_history_benchmarks_and_log(spark, store):
    assert store.sync(sample(spark), PARAMS, NOW) == {"buyer": 5, "seller": 3}
    assert store.history_exists("buyer") and store.history_exists("seller")
    assert rows(store.log(), "entity_type", "entities_count", "status", "error_message") == [
        ("buyer", 5, "success", None),
        ("seller", 3, "success", None),
    ]
    health = store.health().first()
    assert (health.buyers, health.sellers, health.last_status) == (5, 3, "success")

    one = store.history_lookup("seller", 1)
    monthly = one.filter("query = 'monthly_trends'").orderBy("position").collect()
    assert [json.loads(r.row)["month"] for r in monthly] == ["2024-01", "2024-02", "2024-03"]
    with pytest.raises(LookupError):
        store.history_lookup("seller", 99)

    direct = platform_benchmarks(seller.performance_overview(sample(spark), PARAMS["seller"]), "seller")
    kept = store.benchmark_lookup("seller").drop("calculated_at")
    assert rows(kept.select(direct.columns)) == rows(direct)
    assert kept.first().platform_total_orders == 0.0


def test_benchmarks_without_unattributed_rows_have_no_totals(spark):
    overview = spark.createDataFrame(
        [(1, 4.0, 1), (2, None, 3)], "vendor_id int, total_sales double, total_buyers bigint"
    )
    got = platform_benchmarks(overview, "seller").first()
    assert (got.total_count, got.avg_period_spend, got.std_period_spend) == (2, 2.0, 2.0)
    assert got.median_counterparties == 2.0
    assert (got.p25, got.p90) == (1.0, 3.6)
    assert (got.platform_total_spend, got.platform_total_orders) == (None, None)
    assert platform_benchmarks(overview.filter("false"), "seller").isEmpty()


def test_second_sync_replaces_only_its_type(spark, store):
    store.sync(sample(spark), PARAMS, NOW)
    buyers = rows(store.history("buyer"), "entity_id", "query", "row")
    again = store.sync(sample(spark, 2.0, 2), {"seller": PARAMS["seller"]}, NOW)
    assert again == {"seller": 2}
    assert rows(store.history("buyer"), "entity_id", "query", "row") == buyers
    assert rows(store.entities("seller")) == [(0,), (1,)]
    assert store.benchmarks().count() == 2
    assert store.log().count() == 3


def test_empty_overview_keeps_the_old_history_and_is_logged(spark, store):
    store.sync(sample(spark), PARAMS, NOW)
    later = QueryParams(Period.of("2030-01-01", "2030-03-31"), 3, "month")
    assert store.sync(sample(spark), {"seller": later}, NOW) == {"seller": 0}
    assert store.entities("seller").count() == 3
    failed = store.log().filter("status = 'error'").first()
    assert failed.entity_type == "seller" and "EmptyOverviewError" in failed.error_message


def test_documents_hold_all_rows_in_bounded_parts(spark, tmp_path):
    m = sample(spark, vendors=1)
    params = QueryParams(QUARTER, 3)
    runs.write_rows(m, "seller", params, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/rows")
    ids = entities.active_entities(m, "seller", QUARTER)
    docs = entities.documents(ids, stored, "seller", params, NOW, rows_per_part=5).cache()
    orders = docs.filter("query = 'order_analysis'").collect()
    assert len(orders) == 6 and {(d.result_count, d.parts) for d in orders} == {(27, 6)}
    in_sequence = [r.toPython() for d in sorted(orders, key=lambda d: d.part) for r in d.data]
    assert sorted(r["po_id"] for r in in_sequence) == [po for po in range(30) if po % 10 != 9]
    values = [float(r["order_value"]) for r in in_sequence]
    assert values == sorted(values, reverse=True)
    failed = docs.filter("query = 'sales_time_series'").collect()
    assert [(d.error, d.result_count, d.data) for d in failed] == [("missing parameter: time_resolution", 0, [])]


def test_entity_without_rows_has_an_empty_part_for_each_query(spark, tmp_path):
    m = sample(spark)
    runs.write_rows(m, "buyer", PARAMS["buyer"], str(tmp_path))
    ids = spark.createDataFrame([(99,)], "entity_id bigint")
    docs = entities.documents(ids, spark.read.parquet(f"{tmp_path}/rows"), "buyer", PARAMS["buyer"], NOW)
    assert rows(docs, "query", "result_count", "data") == [
        (q, 0, []) for q in ("overview_metrics", "top_categories", "top_products", "top_suppliers")
    ]


def test_picking_entities_early_changes_nothing(spark):
    m = sample(spark)
    whole = entities.query_rows(m, "buyer", PARAMS["buyer"]).filter("entity_id IN (1, 3)")
    picked = entities.query_rows(entities.of_entities(m, "buyer", [1, 3]), "buyer", PARAMS["buyer"])
    assert rows(picked) == rows(whole)


def test_run_writes_dashboards_and_insights(spark, store):
    m = sample(spark)
    with pytest.raises(LookupError):
        runs.run_entities(store, m, "seller", PARAMS["seller"], NOW)
    store.sync(m, PARAMS, NOW)
    current = QueryParams(Period.of("2024-02-01", "2024-03-31"), 3)
    status = runs.run_entities(store, m, "seller", current, NOW)
    assert rows(status) == [(v, "success", 6) for v in range(3)]
    assert store.insights().count() == 3
    doc = store.insights().first()
    assert doc.insights_count == 6 and doc.has_historical_data and doc.generated_at == NOW
    assert doc.dashboard_period.start_date == current.period.start
    assert sum(doc.comparison_types) == 6

    some = runs.run_entities(store, m, "buyer", current, NOW, entity_ids=[2, 99])
    assert rows(some) == [(2, "success", 6), (99, "error", 0)]
    again = runs.run_entities(store, m, "buyer", current, NOW, entity_ids=spark.createDataFrame([(2,)], "id long"))
    assert rows(again) == [(2, "success", 6)]
    first = runs.run_entities(store, m, "buyer", current, datetime(2024, 4, 1), limit=2)
    assert rows(first, "entity_id") == [(0,), (1,)]


def test_broken_lines_are_told_in_insights_and_fail_in_dashboards(spark, store, tmp_path):
    m = sample(spark)
    store.sync(m, PARAMS, NOW)
    runs.run_entities(store, m, "seller", QueryParams(QUARTER, 3), NOW).collect()
    for table in ("insights", "dashboards"):
        (run,) = (tmp_path / table / "entity_type=seller").glob("run=*")
        (run / "broken.json").write_text('{"entity_id": 5, "insi')
    assert rows(store.insights(), "entity_id") == [(0,), (1,), (2,)]
    assert rows(store.skipped_insights(), "entity_type", "broken") == [("seller", '{"entity_id": 5, "insi')]
    with pytest.raises(Exception, match="MALFORMED"):
        store.dashboards().collect()


def test_a_repeated_run_replaces_its_documents(spark, store):
    m = sample(spark)
    store.sync(m, PARAMS, NOW)
    for _ in range(2):
        status = runs.run_entities(store, store.lines(m), "seller", QueryParams(QUARTER, 3), NOW)
        assert rows(status) == [(v, "success", 6) for v in range(3)]
        assert store.insights().count() == 3
        assert store.dashboards().groupBy("entity_id", "query", "part").count().filter("count > 1").isEmpty()
    assert store.insights().first().dashboard_run == store.dashboards().first().run


def test_a_failing_sync_replaces_nothing(spark, store, monkeypatch):
    m = sample(spark)
    store.sync(m, PARAMS, NOW)
    before = rows(store.history("seller"), "query", "row"), rows(store.benchmarks("seller"))
    monkeypatch.setattr("tradeloom.plans.store.platform_benchmarks", lambda *_: 1 / 0)
    assert store.sync(sample(spark, 3.0), {"seller": PARAMS["seller"]}, NOW) == {"seller": 0}
    assert (rows(store.history("seller"), "query", "row"), rows(store.benchmarks("seller"))) == before


def test_history_reads_prune_to_their_query(spark, store):
    store.sync(sample(spark), PARAMS, NOW)
    one = store.history("seller", "order_analysis")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "query" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.select("query").distinct().count() == 1 and one.first().created_at == NOW


def test_history_is_written_with_its_own_columns_in_small_files(spark, store, tmp_path):
    store.sync(sample(spark), PARAMS, NOW)
    files = list((tmp_path / "data" / "history").rglob("*.parquet"))
    assert sum(f.stat().st_size for f in files) < 20_000 * len(files)  # a filter of a file's entities took a megabyte
    (folder,) = (tmp_path / "data" / "history").glob("*/query=order_analysis")
    written = spark.read.parquet(str(folder)).columns
    assert written[:3] == ["vendor_id", "po_id", "order_value"] and "row" not in written
    one = store.history("seller", "order_analysis").orderBy("entity_id", "chunk", "position").collect()
    assert len(one) == 30 and all(r.row.startswith('{"vendor_id":%s,"po_id":' % json.dumps(r.entity_id)) for r in one)
    for a, b in zip(one, one[1:]):
        assert a.entity_id != b.entity_id or a.position <= b.position  # chunks follow each other
        assert a.position == -json.loads(a.row)["order_value"]


def test_batches_may_be_of_any_size(spark):
    ids = spark.createDataFrame([(1,), (1,), (4,)], "entity_id bigint")
    got = entities.select_batch(spark, [1, 2], ids)
    assert rows(got) == [(1, "success"), (2, "error")]
    assert rows(entities.batch_summary(got)) == [(2, 1, 1)]
    assert entities.select_batch(spark, range(200), ids).count() == 200
    assert rows(entities.select_batch(spark, spark.createDataFrame([(4,), (9,)], "id long"), ids)) == [
        (4, "success"), (9, "error"),
    ]


def test_shared_folder_follows_the_session(spark):
    def session(master, **settings):
        context = SimpleNamespace(master=master, applicationId="app")
        return SimpleNamespace(conf=settings, sparkContext=context)

    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "s3://shared/work/"})) == "s3://shared/work"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))
    assert shared_folder(spark) == shared_folder(spark)
