"""Lines and rows that move once: whole overviews, prepared lines, documents."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from tests.test_gathering import executed, trades
from tests.test_store import NOW, PARAMS
from tradeloom.operators.gathering import gathered
from tradeloom.params import QueryParams
from tradeloom.plans.entities import documents, whole_overview
from tradeloom.plans.registry import plan_of
from tradeloom.plans.runs import write_rows
from tradeloom.plans.store import Store
from tradeloom.sources import retail


@pytest.mark.parametrize("entity_type", ["buyer", "seller"])
def test_a_whole_overview_moves_its_lines_once(spark, entity_type):
    source, params, plan = trades(spark), PARAMS[entity_type], plan_of(entity_type)
    staged = source.with_lines(source.lines().localCheckpoint())
    got = whole_overview(staged, entity_type, params)
    assert executed(got).count("Exchange ") == 1
    assert rows(got) == rows(plan.overview.build(source, params))


@pytest.mark.parametrize("filters", [{}, {"categories": ("c",)}, {"channels": ("web",)}])
def test_prepared_lines_count_orders_alike(spark, filters):
    source, plan = trades(spark), plan_of("seller")
    params = QueryParams(PARAMS["seller"].period, 5, "week", **filters)
    read = plan.lines_read(source, params)
    twice = read.lines().filter("product_id % 2 = 0")  # orders of two lines
    lines = read.lines().unionByName(twice.withColumn("product_id", F.lit(1).cast("bigint")))
    with gathered(lines, plan.line_column, a_task=40, prepared=plan.prepared) as (near, _):
        assert {r[0] for r in near.select("alone").distinct().collect()} == {True, False}
        for query in plan.queries:
            got, wanted = (query.build(source.with_lines(side), params) for side in (near, lines))
            assert rows(got, *sorted(got.columns)) == rows(wanted, *sorted(got.columns)), query.name


def test_documents_number_only_what_needs_parts(spark, tmp_path):
    made = spark.createDataFrame(
        [(e, "top_products", float(p), '{"p":%d}' % p, p // 4) for e, n in ((1, 3), (2, 11), (3, 5)) for p in range(n)],
        "entity_id bigint, query string, position double, row string, chunk int",
    )
    made.write.parquet(str(tmp_path / "rows"))
    kept, ids = spark.read.parquet(str(tmp_path / "rows")), spark.createDataFrame([(1,), (2,), (4,)], "entity_id bigint")

    def held(rows_per_part):
        docs = documents(ids, kept, "buyer", PARAMS["buyer"], NOW, rows_per_part).filter("query = 'top_products'")
        got = docs.select("entity_id", "part", "parts", "result_count", F.col("data").cast("array<struct<p:int>>").alias("data"))
        return {(r.entity_id, r.part): (r.parts, r.result_count, [x.p for x in r.data]) for r in got.collect()}, got

    parts, _ = held(5)
    assert parts == {
        (1, 0): (1, 3, [0, 1, 2]), (2, 0): (3, 11, [0, 1, 2, 3, 4]), (2, 1): (3, 11, [5, 6, 7, 8, 9]), (2, 2): (3, 11, [10]), (4, 0): (1, 0, []),
    }
    whole, frame = held(20)
    assert whole == {(1, 0): (1, 3, [0, 1, 2]), (2, 0): (1, 11, list(range(11))), (4, 0): (1, 0, [])}
    assert "Window" not in executed(frame).split("Initial Plan")[0]  # nothing needs parts, nothing is numbered


@pytest.mark.parametrize("most", [10**6, 20])
def test_rows_of_a_run_are_those_of_its_queries(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr("tradeloom.operators.gathering.LINES_TO_SPREAD", most)
    source, params = trades(spark), PARAMS["seller"]
    made, path = write_rows(source, "seller", params, str(tmp_path))
    overview = spark.read.parquet(made)
    assert rows(overview) == rows(plan_of("seller").overview.build(source, params))
    held = spark.read.parquet(path).groupBy("query").count().collect()
    assert {r.query: r["count"] for r in held} == {q.name: q.build(source, params).count() for q in plan_of("seller").queries}


def test_documents_are_written_compressed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_insights(spark.createDataFrame([("buyer", 1)], "entity_type string, entity_id bigint"), "buyer", "run")
    assert {p.suffix for p in (tmp_path / "insights/entity_type=buyer/run=run").glob("part-*")} == {".gz"}
    assert [r.entity_id for r in store.insights().collect()] == [1]


def test_orders_of_the_retail_tables_move_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = retail.load(spark, "/root/testdata/sf0.001").po_details
        assert len(re.findall(r"Exchange hash", executed(orders))) == 2  # the two sides of the join
        assert orders.count() == orders.distinct().count() == orders.select("id").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
