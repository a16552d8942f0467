"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import item, market, order, rows
from tradeloom.params import Period, QueryParams
from tradeloom.plans import buyer, seller
from tradeloom.session import sized_for
from tradeloom.sources import retail
from tradeloom.sources.staging import read_lines, staged, write_lines
from tradeloom.sources.tables import jdbc_options

FOLDER = "/root/testdata/sf0.001"
YEAR = QueryParams(Period.of("1998-01-01", "1998-12-31"), 3, "month")

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

ALL = [
    buyer.overview,
    buyer.top_products,
    buyer.top_suppliers,
    buyer.top_categories,
    seller.performance_overview,
    seller.monthly_trends,
    seller.quarterly_trends,
    seller.product_line_breakdown,
    seller.sales_time_series,
    seller.top_selling_products,
    seller.regional_distribution,
    seller.order_analysis,
]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("query", ALL, ids=lambda q: q.__name__)
def test_lines_are_read_once_and_nothing_is_crossed(spark, tmp_path, query):
    write_lines(retail.load(spark, FOLDER), f"{tmp_path}/lines")
    lines = read_lines(spark, f"{tmp_path}/lines")
    plan = plan_of(query(retail.load(spark, FOLDER).with_lines(lines), YEAR))
    assert len(re.findall(r"FileScan parquet \[[^\]]*(?:amount_units|po_id)", plan)) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Expand" not in plan


@needs_tables
@pytest.mark.parametrize("query", [buyer.top_products, buyer.top_suppliers, seller.top_selling_products])
def test_rankings_cut_before_the_shuffle(spark, query):
    plan = plan_of(query(retail.load(spark, FOLDER), YEAR))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert [line.split(", ")[-1] for line in limits] == ["Final", "Partial"]
    assert plan.index("Final\n") < plan.index("Exchange", plan.index("Final\n")) < plan.index(", Partial\n")


@needs_tables
def test_dates_and_columns_reach_the_scan(spark, tmp_path):
    plan = plan_of(seller.order_analysis(retail.load(spark, FOLDER), YEAR))
    lineitem = next(line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in lineitem
    assert "l_linenumber" not in lineitem

    lines = staged(retail.load(spark, FOLDER), f"{tmp_path}/lines")
    plan = plan_of(seller.monthly_trends(lines, YEAR))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "created_month" in re.search(r"PartitionFilters: \[(.*?)\]", scan).group(1)
    assert "shipping_address" not in scan


@needs_tables
def test_staged_lines_are_not_staged_again(spark, tmp_path):
    once = staged(retail.load(spark, FOLDER), f"{tmp_path}/lines")
    assert staged(once, f"{tmp_path}/again") is once
    assert not os.path.exists(f"{tmp_path}/again")
    assert once.lines().count() == retail.load(spark, FOLDER).lines().count()


def test_an_order_with_most_lines_is_split_in_the_join(spark, tmp_path):
    items = [item(1 if i % 3 else i, i, i * 7919 % 10007 / 100, "2024-01-05") for i in range(6000)]
    orders = [order(i, i % 7, i % 5) for i in range(6000)]
    base = market(spark, items, orders)
    base.po_items.repartition(8).write.parquet(f"{tmp_path}/items")
    base.po_details.repartition(8).write.parquet(f"{tmp_path}/orders")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        stored = {"po_items": f"{tmp_path}/items", "po_details": f"{tmp_path}/orders"}
        m = type(base)(spark, {name: (lambda p=path: spark.read.parquet(p)) for name, path in stored.items()})
        sums = m.lines().groupBy("seller_org_id").agg(F.sum("amount_units").alias("cents"))
        assert sum(r.cents for r in sums.collect()) == sum(i * 7919 % 10007 for i in range(6000))
        assert "SortMergeJoin(skew=true)" in plan_of(sums).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shuffle_partitions_grow_with_the_input():
    assert sized_for(10**6)["spark.sql.shuffle.partitions"] == "8"
    settings = sized_for(100 * 10**12)
    partitions, splits = int(settings["spark.sql.shuffle.partitions"]), 100 * 10**12 // int(settings["spark.sql.files.maxPartitionBytes"])
    assert 10_000 < partitions < 30_000
    assert 10 * 10**12 / (partitions * splits) > 2000  # bytes of a shuffle block
    assert int(sized_for(10**12, 1.0)["spark.sql.shuffle.partitions"]) == -(-(10**12) // (512 * 1024 * 1024))


def test_database_reads_are_split_by_key():
    options = jdbc_options("jdbc:postgresql://db/market", "po_items", 1, 1000, 16)
    assert options["partitionColumn"] == "po_id"
    assert options["numPartitions"] == "16"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")


@pytest.fixture(scope="module")
def by_month(spark, tmp_path_factory):
    return staged(retail.load(spark, FOLDER), f"{tmp_path_factory.mktemp('staged')}/lines")


@needs_tables
@pytest.mark.parametrize("query", ALL, ids=lambda q: q.__name__)
def test_every_query_reads_the_months_of_its_window_only(spark, by_month, query):
    window = QueryParams(Period.of("1998-03-10", "1998-06-07"), 5, "month")
    plan = plan_of(query(by_month, window))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "amount_units" in line)
    assert "created_month" in re.search(r"PartitionFilters: \[(.*?)\](, PushedFilters|$)", scan).group(1)
    months = {z.month for z in by_month.zones}
    # One looks for what was ever bought before; in these tables any month has lines of orders of any date.
    if query not in (buyer.overview, seller.performance_overview):
        kept = {m for m in months if f"{m}" in plan}
        assert len(kept) < 10 < len(months)
    assert rows(query(by_month, window)) == rows(query(retail.load(spark, FOLDER), window))


@needs_tables
def test_kept_first_dates_spare_the_overview_the_months_before(spark, by_month):
    window = QueryParams(Period.of("1998-03-10", "1998-06-07"), 5)
    dates = buyer.earliest(buyer.first_dates(by_month.lines()))
    got = buyer.overview(by_month, window, dates)
    months = {z.month for z in by_month.zones}
    plan = plan_of(got)
    assert 0 < sum(f"{m}" in plan for m in months) < 15 < len(months)
    assert rows(got) == rows(buyer.overview(retail.load(spark, FOLDER), window))
