"""Hand-made cases for NULL keys, cut-offs, ties, labels and rounding."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.fixtures import at, category, item, market, order, rows
from tradeloom.functions import dates
from tradeloom.functions.categories import deepest_category
from tradeloom.functions.numeric import pct_change, pct_change_of_quotients, safe_ratio
from tradeloom.operators.ranking import top_n_per
from tradeloom.operators.trends import on_calendar
from tradeloom.params import Period, QueryParams, dashboard_params, history_params
from tradeloom.plans import buyer, seller
from tradeloom.plans.registry import run_query
from tradeloom.sources import retail
from tradeloom.sources.tables import scale_of, with_amounts

QUARTER = Period.of("2024-01-01", "2024-03-31")
PARAMS = QueryParams(QUARTER, 10)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_previous_period_has_the_same_length():
    period = Period.of("2025-11-19", "2026-02-17")
    assert period.days == 91
    assert period.previous == Period.of("2025-08-20", "2025-11-18")


def test_default_parameters_and_precedence():
    today = date(2026, 2, 17)
    assert dashboard_params("buyer", today).period == Period.of("2025-11-19", "2026-02-17")
    assert dashboard_params("seller", today, days=30).top_n == 20
    chosen = dashboard_params("buyer", today, days=30, start="2026-01-01")
    assert chosen.period == Period.of("2026-01-01", "2026-02-17")
    assert history_params("seller", today).time_resolution == "month"
    assert history_params("buyer", today).period.days == 366
    with pytest.raises(ValueError):
        dashboard_params("carrier", today)


@pytest.mark.parametrize(
    "text, expected",
    [
        (category(("a", 10), ("b", 9)), "a"),
        (category(("a", 1), ("b", '"3"'), ("c", 2)), "b"),
        ('{"cat_0": []}', None),
        ("{}", None),
        (None, None),
        (category(("a", 5), ("b", None)), "b"),
    ],
)
def test_deepest_category(spark, text, expected):
    assert one(spark, deepest_category(F.lit(text).cast("string")))[0] == expected


@pytest.mark.parametrize(
    "current, previous, expected",
    [
        (1352660938, 1202818198, 12.46),
        (516000, 647600, -20.32),
        (700, 1300, -46.15),
        (0, 75900000, -100.0),
        (5, 0, None),
        (None, 5, None),
    ],
)
def test_pct_change(spark, current, previous, expected):
    value = pct_change(F.lit(current).cast("bigint"), F.lit(previous).cast("bigint"))
    assert one(spark, value)[0] == expected


def test_quotients_and_their_change(spark):
    def change(*values):
        return pct_change_of_quotients(*(F.lit(v).cast("bigint") for v in values))

    got = one(
        spark,
        change(1352660938, 1, 1202818198, 7),
        change(1352660938, 516000, 1202818198, 647600),
        change(1, 0, 1, 1),
        change(1, 1, 0, 1),
        safe_ratio(F.lit(1202818198), F.lit(700)),
        safe_ratio(F.lit(1), F.lit(0)),
        safe_ratio(F.lit(1005), F.lit(1000)),
        safe_ratio(F.lit(-1005), F.lit(1000)),
    )
    assert list(got) == [687.20, 41.14, None, None, 1718311.71, None, 1.01, -1.01]


def test_labels(spark):
    day = F.lit(date(2024, 12, 30))
    got = one(
        spark,
        dates.week_label(day),
        dates.quarter_label(F.lit(date(2026, 2, 1))),
        dates.period_label(day, "year"),
        dates.bucket(F.lit(date(2025, 1, 1)), "week"),
    )
    assert list(got) == ["2024-12-30 (Week 01)", "Q1 2026", None, date(2024, 12, 30)]
    with pytest.raises(ValueError):
        dates.bucket(day, "fortnight")


def test_month_gap_counts_as_zero_then_has_no_growth(spark):
    items = [item(1, 1, 100.0, "2024-01-10"), item(2, 1, 50.0, "2024-03-10")]
    m = market(spark, items, [order(1, 5, 7), order(2, 5, 7)])
    got = rows(seller.monthly_trends(m, PARAMS), "month", "total_sales", "prev_month_sales", "mom_growth_rate_pct")
    assert got == [
        ("2024-01", 100.0, 0.0, None),
        ("2024-02", 0.0, 100.0, -100.0),
        ("2024-03", 50.0, 0.0, None),
    ]


def test_calendar_reaches_both_ends_of_the_period(spark):
    facts = spark.createDataFrame([(1, date(2024, 4, 1), 5), (2, date(2024, 1, 1), 6)], "e int, q date, v int")
    got = rows(on_calendar(facts, "e", "q", Period.of("2023-12-31", "2024-07-01"), "quarter"))
    starts = [date(2023, 10, 1), date(2024, 1, 1), date(2024, 4, 1), date(2024, 7, 1)]
    assert sorted(got, key=lambda r: r[:2]) == [
        *((1, s, 5 if s == starts[2] else None) for s in starts),
        *((2, s, 6 if s == starts[1] else None) for s in starts),
    ]


def test_rows_after_midnight_of_the_last_day_are_outside(spark):
    m = market(
        spark,
        [item(1, 1, 10.0, "2024-03-31"), item(1, 2, 20.0, "2024-03-31T10:00:00")],
        [order(1, 5, 7)],
    )
    assert rows(buyer.top_products(m, PARAMS), "product_id") == [(1,)]
    assert rows(seller.order_analysis(m, PARAMS), "order_value") == [(10.0,)]


def test_gap_between_the_periods_still_shows_the_buyer(spark):
    m = market(spark, [item(1, 1, 10.0, "2023-12-31T10:00:00")], [order(1, 5, 7)])
    got = rows(
        buyer.overview(m, PARAMS),
        "buyer_org_id",
        "current_period_purchases",
        "previous_period_purchases",
        "items_purchased_current",
        "new_items_purchased_previous",
    )
    assert got == [(5, 0.0, 0.0, 0, 0)]


def test_first_seen_looks_at_all_history(spark):
    m = market(
        spark,
        [
            item(1, 1, 10.0, "2020-01-01"),
            item(1, 1, 10.0, "2024-01-05"),
            item(1, 2, 10.0, "2024-01-05"),
            item(1, 2, 10.0, "2024-02-05"),
        ],
        [order(1, 5, 7)],
    )
    got = rows(
        buyer.overview(m, PARAMS),
        "items_purchased_current",
        "new_items_purchased_current",
        "suppliers_current",
        "new_suppliers_current",
    )
    assert got == [(2, 1, 1, 0)]


def test_unattributed_lines_have_no_first_seen_counts(spark):
    m = market(spark, [item(1, 1, 10.0, "2024-01-05")], [order(1, None, 7)])
    got = rows(buyer.overview(m, PARAMS), "buyer_org_id", "items_purchased_current", "new_items_purchased_current")
    assert got == [(None, 1, 0)]


def test_amounts_all_missing_stay_missing(spark):
    m = market(spark, [item(1, 1, None, "2024-01-05")], [order(1, 5, 7)])
    assert rows(buyer.overview(m, PARAMS), "current_period_purchases", "previous_period_purchases") == [(None, 0.0)]
    assert rows(seller.performance_overview(m, PARAMS), "total_sales", "units_sold") == [(None, 1.0)]


def test_missing_sum_ranks_first_and_ties_follow_the_key(spark):
    sums = spark.createDataFrame(
        [(1, 10, 5), (1, 11, None), (1, 12, 5), (1, 13, 1)], "entity int, key int, amount bigint"
    )
    got = rows(top_n_per(sums, "entity", "amount", "key", 3, "rank"), "rank", "key")
    assert got == [(1, 11), (2, 10), (3, 12)]


def test_city_named_like_the_placeholder_stays_apart(spark):
    m = market(
        spark,
        [item(1, 1, 10.0, "2024-01-05"), item(2, 1, 30.0, "2024-01-05")],
        [order(1, 5, 7, address=1), order(2, 5, 7, address=2)],
        addresses=[(1, None), (2, "Unknown")],
    )
    got = rows(seller.regional_distribution(m, PARAMS), "region", "total_revenue", "revenue_contribution_pct")
    assert got == [("Unknown", 10.0, 25.0), ("Unknown", 30.0, 75.0)]


def test_lines_without_a_vendor(spark):
    m = market(
        spark,
        [item(1, 1, 10.0, "2024-01-05")],
        [order(1, 5, None)],
        products=[(1, 7, "pen", category(("tools", 1)))],
    )
    overview = rows(seller.performance_overview(m, PARAMS), "vendor_id", "total_sales", "total_buyers")
    assert overview == [(None, 10.0, 0)]
    assert rows(seller.monthly_trends(m, PARAMS), "month", "total_sales", "order_count") == [
        ("2024-01", 0.0, 0),
        ("2024-02", 0.0, 0),
        ("2024-03", 0.0, 0),
    ]
    assert rows(seller.product_line_breakdown(m, PARAMS)) == []
    assert rows(seller.regional_distribution(m, PARAMS)) == []
    assert rows(seller.order_analysis(m, PARAMS), "vendor_id", "sales_channel") == [(None, "Unknown")]


def test_product_missing_from_the_catalog(spark):
    m = market(
        spark,
        [item(1, 1, 30.0, "2024-01-05"), item(1, 2, 20.0, "2024-01-05")],
        [order(1, 5, 7)],
        products=[(2, 7, "pen", None)],
    )
    assert rows(seller.top_selling_products(m, PARAMS), "rank_within_vendor", "product_name", "category") == [
        (2, "pen", "Unknown")
    ]
    assert rows(buyer.top_products(m, PARAMS), "rank_within_buyer", "product_name") == [(1, None), (2, "pen")]


def test_categories_count_only_what_the_owner_sells(spark):
    m = market(
        spark,
        [item(1, 1, 30.0, "2024-01-05"), item(2, 1, 20.0, "2024-01-05"), item(2, 2, 1.0, "2024-01-05")],
        [order(1, 5, 7), order(2, 5, 8)],
        products=[(1, 7, "pen", category(("tools", 1))), (2, 8, "cup", None)],
    )
    got = rows(buyer.top_categories(m, PARAMS), "category", "total_purchase_amount", "rank_within_buyer")
    assert got == [("tools", 30.0, 1), (None, 1.0, 2)]


def test_category_filter_leaves_out_products_without_category(spark):
    m = market(
        spark,
        [item(1, 1, 30.0, "2024-01-05"), item(1, 2, 20.0, "2024-01-05"), item(2, 2, 5.0, "2024-01-05")],
        [order(1, 5, 7, source="web"), order(2, 5, 8, source="web")],
        products=[(1, 7, "pen", category(("tools", 1))), (2, 7, "cup", None)],
    )
    chosen = QueryParams(QUARTER, categories=("tools",), channels=("web",))
    assert rows(seller.performance_overview(m, chosen), "vendor_id", "total_sales") == [(7, 30.0)]
    # Vendor 8 sold nothing of the category but is active.
    trends = rows(seller.monthly_trends(m, chosen), "vendor_id", "month", "total_sales")
    assert [r for r in trends if r[1] == "2024-01"] == [(7, "2024-01", 30.0), (8, "2024-01", 0.0)]


def test_repeat_buyers_follow_the_order_date(spark):
    m = market(
        spark,
        [item(1, 1, 10.0, "2024-01-05"), item(2, 1, 20.0, "2024-02-05"), item(3, 1, 30.0, "2024-02-05")],
        [order(1, 5, 7, "2024-01-01"), order(2, 5, 7, "2024-01-02"), order(3, 6, 7, "2023-01-01")],
    )
    got = rows(
        seller.performance_overview(m, PARAMS),
        "total_sales",
        "average_order_value",
        "total_buyers",
        "repeat_buyers",
        "repeat_purchase_rate_pct",
    )
    assert got == [(60.0, 20.0, 1, 1, 100.0)]


def test_time_series_needs_a_resolution(spark):
    m = market(spark, [item(1, 1, 10.0, "2024-01-05")], [order(1, 5, 7)])
    with pytest.raises(ValueError, match="time_resolution"):
        seller.sales_time_series(m, PARAMS)


def test_presentation_order(spark):
    m = market(
        spark,
        [item(po, 1, amount, "2024-01-05") for po, amount in ((1, 10.0), (2, 30.0), (3, None), (4, 1.0))],
        [order(1, 5, 7), order(2, 5, 7), order(3, 5, 7), order(4, 5, None)],
    )
    got = run_query(m, "seller", "order_analysis", PARAMS, ordered=True).collect()
    assert [r.po_id for r in got] == [3, 2, 1, 4]


def test_totals_agree_between_queries(spark):
    items = [item(po, po % 5, 10.0 + po / 100, f"2024-0{1 + po % 3}-1{po % 9}") for po in range(40)]
    m = market(
        spark,
        items,
        [order(po, po % 3, po % 4, address=po % 6) for po in range(40)],
        products=[(p, 1, f"p{p}", category((f"c{p % 2}", 1))) for p in range(5)],
        addresses=[(a, f"city{a % 3}") for a in range(6)],
    )
    totals = dict(rows(seller.performance_overview(m, PARAMS), "vendor_id", "total_sales"))
    for query, column in (
        (seller.monthly_trends, "total_sales"),
        (seller.order_analysis, "order_value"),
        (seller.product_line_breakdown, "total_revenue"),
        (seller.regional_distribution, "total_revenue"),
    ):
        sums = query(m, PARAMS).groupBy("vendor_id").agg(F.round(F.sum(column), 2))
        assert dict(rows(sums)) == pytest.approx(totals)
    shares = seller.regional_distribution(m, PARAMS).groupBy("vendor_id").agg(F.sum("revenue_contribution_pct"))
    assert all(abs(total - 100) < 0.05 for _, total in rows(shares))


def test_fine_amounts_are_summed_before_they_are_rounded(spark):
    items = [item(i, 1, 0.004, "2024-02-01", qty=0.004) for i in range(1000)]
    orders = [order(i, 7, 9) for i in range(1000)]
    m = market(spark, items, orders, scale=3)
    got = seller.performance_overview(m, QueryParams(Period.of("2024-01-01", "2024-03-31"), 5)).first()
    assert (got["total_sales"], got["units_sold"]) == (4.0, 4.0)


def test_decimal_amounts_keep_their_scale(spark):
    rows = spark.createDataFrame([(1,)], "id int").selectExpr(
        "cast(0.00049 as decimal(20,5)) qty", "cast(12.5 as decimal(9,1)) total_amount"
    )
    assert scale_of(rows) == 5
    assert with_amounts(rows, 5).first().asDict() == {"qty_units": 49, "amount_units": 1_250_000}
    with pytest.raises(ValueError):
        scale_of(rows.selectExpr("cast(qty as double) qty", "total_amount"))


def test_order_ids_of_any_size(spark, tmp_path):
    big = 6 * 10**11
    frames = {
        "lineitem": spark.createDataFrame(
            [(big, 1, 3, 1, 2.0, 10.0, at("1999-01-05"))], retail.SCHEMAS["lineitem"]
        ),
        "orders": spark.createDataFrame(
            [(big, 5, "F", at("1999-01-01"), "1-URGENT")], retail.SCHEMAS["orders"]
        ),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    got = seller.order_analysis(retail.load(spark, str(tmp_path)), QueryParams(Period.of("1999-01-01", "1999-12-31"), 5))
    assert [(r["po_id"], r["order_value"]) for r in got.collect()] == [(f"{big}-3", 10.0)]
