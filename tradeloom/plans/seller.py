"""Seller analytics, each for all vendors at once. Sales are counted on the item's created_date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.categories import deepest_category
from tradeloom.functions.dates import bucket, day_label, month_label, period_label, quarter_label
from tradeloom.functions.numeric import safe_ratio
from tradeloom.operators.filters import keep_categories, keep_channels, with_category_flag
from tradeloom.operators.ranking import top_n_per
from tradeloom.operators.shares import with_share
from tradeloom.operators.trends import growth_pct, on_calendar, with_previous
from tradeloom.params import QueryParams
from tradeloom.sources.staging import MONTH, lines_created_in
from tradeloom.sources.tables import Marketplace

CLOCK = "created_date"
VENDOR = "vendor_id"
UNKNOWN = "Unknown"
#: What the queries read of a line.
LINE_COLUMNS = (
    "seller_org_id", "buyer_org_id", "po_id", "product_id", CLOCK, "po_created_date", "source", "shipping_address",
    "amount_units", "qty_units",
)


def lines_read(market: Marketplace, params: QueryParams) -> Marketplace:
    """The marketplace with the lines that the queries read, whatever their category and channel."""
    return market.with_lines(_sold_or_ordered_in(market, params.period).select(*LINE_COLUMNS))


#: In gathered lines: whether a line is the only one of its order with its vendor.
ALONE = "alone"


def by_order(lines: DataFrame) -> DataFrame:
    """Gathered lines in the order in which they are summed by order, told which are the only ones of theirs."""
    ordered = lines.sortWithinPartitions("seller_org_id", "po_id", "po_created_date", "source")
    return ordered.withColumn(ALONE, F.count(F.lit(1)).over(Window.partitionBy("seller_org_id", "po_id")) == 1)


def count_orders(lines: DataFrame, wanted: Column | None = None) -> Column:
    """Distinct orders of a vendor's lines, or of the wanted ones. An order with one line is in no other group and no other
    line: where that is known it is counted as it is, and only the others are told apart."""
    order = F.col("po_id") if wanted is None else F.when(wanted, F.col("po_id"))
    if ALONE not in lines.columns:
        return F.count_distinct(order)
    return F.count_if(F.col(ALONE) & order.isNotNull()) + F.count_distinct(F.when(~F.col(ALONE), order))


def _vendor_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumnRenamed("seller_org_id", VENDOR)


def sales_lines(market: Marketplace, params: QueryParams) -> DataFrame:
    """Lines created in the period that pass the category and channel filters."""
    lines = _vendor_lines(lines_created_in(market.lines(), params.period))
    return keep_channels(keep_categories(market, lines, params.categories), params.channels)


def _revenue_and_units(total: str, quantity: str) -> list[Column]:
    return [F.sum("amount_units").alias(total), F.sum("qty_units").alias(quantity)]


def _either_clock_in(market: Marketplace, period: Period) -> DataFrame:
    """Lines of the months in which a line may be created, or its order placed, in the period."""
    if market.zones is None:
        return market.lines()
    first = period.start.replace(day=1)
    months = {z.month for z in market.zones if z.meets("po_created_date", period.start, period.end)}
    months |= {z.month for z in market.zones if z.month is not None and first <= z.month <= period.end}
    known = F.col(MONTH).isin(sorted(m for m in months if m is not None))
    return market.lines().filter(known | F.col(MONTH).isNull() if None in months else known)


def _sold_or_ordered_in(market: Marketplace, period: Period) -> DataFrame:
    sold, ordered = period.holds(F.col(CLOCK)), period.holds(F.col("po_created_date"))
    return _either_clock_in(market, period).filter(sold | ordered)


def orders_by_buyer(market: Marketplace, params: QueryParams) -> DataFrame:
    """One row per vendor, buyer and order, with what the period's two clocks say about it.

    Sales follow the item's creation, repeat purchases the order's, so a line is read when either
    lies in the period.
    """
    sold, ordered = params.period.holds(F.col(CLOCK)), params.period.holds(F.col("po_created_date"))
    lines = _vendor_lines(_sold_or_ordered_in(market, params.period))
    lines = keep_channels(keep_categories(market, lines, params.categories), params.channels)
    return lines.groupBy(VENDOR, "buyer_org_id", "po_id").agg(
        F.sum(F.when(sold, F.col("amount_units"))).alias("order_total"),
        F.sum(F.when(sold, F.col("qty_units"))).alias("order_qty"),
        F.max(sold).alias("sold"),
        F.max(ordered).alias("ordered"),
    )


def buyers_by_vendor(orders: DataFrame) -> DataFrame:
    return orders.groupBy(VENDOR, "buyer_org_id").agg(
        F.sum("order_total").alias("sales"),
        F.sum("order_qty").alias("units"),
        F.count_if("sold").alias("sold_orders"),
        F.count_if("ordered").alias("order_count"),
    )


def performance_overview(market: Marketplace, params: QueryParams) -> DataFrame:
    """Sales, average order value and repeat buyers per vendor, from one scan and no join."""
    known = F.col("buyer_org_id").isNotNull() & F.col(VENDOR).isNotNull()
    totals = (
        buyers_by_vendor(orders_by_buyer(market, params))
        .groupBy(VENDOR)
        .agg(
            F.sum("sales").alias("sales"),
            F.sum("units").alias("units"),
            F.sum("sold_orders").alias("sold_orders"),
            # Repeat figures are attached by vendor, so orders without a vendor have none.
            F.count_if(known & (F.col("order_count") > 0)).alias("total_buyers"),
            F.count_if(known & (F.col("order_count") > 1)).alias("repeat_buyers"),
        )
        .filter(F.col("sold_orders") > 0)
    )
    rate = safe_ratio(F.col("repeat_buyers") * 100, F.col("total_buyers"))
    return totals.select(
        VENDOR,
        market.units(F.col("sales")).alias("total_sales"),
        market.units(F.col("units")).alias("units_sold"),
        market.units_per(F.col("sales"), F.col("sold_orders")).alias("average_order_value"),
        "total_buyers",
        "repeat_buyers",
        F.coalesce(rate, F.lit(0.0)).alias("repeat_purchase_rate_pct"),
    )


def sales_by_bucket(market: Marketplace, params: QueryParams, resolution: str, name: str) -> DataFrame:
    """Sparse sales per vendor and bucket.

    The row of a vendor whose lines are all filtered out stays, with NULL sums: such a vendor is
    still active.
    """
    lines = _vendor_lines(lines_created_in(market.lines(), params.period))
    lines = with_category_flag(market, lines, params.categories)
    wanted = F.col("wanted")
    if params.channels is not None:
        wanted = wanted & F.coalesce(F.col("source").isin(list(params.channels)), F.lit(False))
    return lines.groupBy(VENDOR, bucket(F.col(CLOCK), resolution).alias(name)).agg(
        F.sum(F.when(wanted, F.col("amount_units"))).alias("total_sales"),
        F.sum(F.when(wanted, F.col("qty_units"))).alias("total_units"),
        count_orders(lines, wanted).alias("order_count"),
    )


def dense_sales(market: Marketplace, params: QueryParams, resolution: str, name: str) -> DataFrame:
    """Every active vendor with every bucket of the period, and the sales of the bucket before.

    Lines without a vendor have a full calendar too, but no sales, as a missing key matches nothing.
    """
    sales = sales_by_bucket(market, params, resolution, name)
    known = F.col(VENDOR).isNotNull()
    matched = sales.select(
        VENDOR, name, *(F.when(known, F.col(c)).alias(c) for c in ("total_sales", "total_units", "order_count"))
    )
    dense = on_calendar(matched, VENDOR, name, params.period, resolution)
    return with_previous(dense, VENDOR, name, "total_sales", "previous_sales")


def _zero_if_missing(market: Marketplace, column: Column) -> Column:
    return F.coalesce(market.units(column), F.lit(0.0))


def _trend_columns(market: Marketplace, previous: str, growth: str) -> list[Column]:
    return [
        _zero_if_missing(market, F.col("total_sales")).alias("total_sales"),
        _zero_if_missing(market, F.col("total_units")).alias("total_units"),
        F.coalesce(F.col("order_count"), F.lit(0)).alias("order_count"),
        _zero_if_missing(market, F.col("previous_sales")).alias(previous),
        growth_pct("total_sales", "previous_sales").alias(growth),
    ]


def monthly_trends(market: Marketplace, params: QueryParams) -> DataFrame:
    dense = dense_sales(market, params, "month", "month_start")
    return dense.select(
        VENDOR,
        month_label(F.col("month_start")).alias("month"),
        *_trend_columns(market, "prev_month_sales", "mom_growth_rate_pct"),
    )


def quarterly_trends(market: Marketplace, params: QueryParams) -> DataFrame:
    dense = dense_sales(market, params, "quarter", "quarter_start")
    return dense.select(
        VENDOR,
        quarter_label(F.col("quarter_start")).alias("quarter"),
        "quarter_start",
        *_trend_columns(market, "prev_quarter_sales", "qoq_growth_rate_pct"),
    )


def product_line_breakdown(market: Marketplace, params: QueryParams) -> DataFrame:
    """Revenue per category and its share of the vendor's total.

    Lines are summed per vendor and product before the catalog is joined.
    """
    by_product = (
        sales_lines(market, params)
        .groupBy(VENDOR, "product_id")
        .agg(*_revenue_and_units("revenue", "units"), F.count(F.lit(1)).alias("lines"))
    )
    by_category = (
        by_product.join(market.product_categories(), "product_id", "left")
        .groupBy(VENDOR, F.coalesce("category_name", F.lit(UNKNOWN)).alias("product_line"))
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("units").alias("units"),
            F.sum("lines").alias("transaction_count"),
        )
    )
    return with_share(by_category, VENDOR, "revenue", "revenue_contribution_pct").select(
        VENDOR,
        "product_line",
        market.units(F.col("revenue")).alias("total_revenue"),
        market.units(F.col("units")).alias("total_units"),
        "transaction_count",
        "revenue_contribution_pct",
    )


def sales_time_series(market: Marketplace, params: QueryParams) -> DataFrame:
    """Sales per bucket of the wanted resolution; buckets without sales have no row."""
    resolution = params.time_resolution
    if resolution is None:
        raise ValueError("sales_time_series needs time_resolution")
    lines = sales_lines(market, params)
    sales = lines.groupBy(VENDOR, bucket(F.col(CLOCK), resolution).alias("date_period")).agg(
        *_revenue_and_units("sales", "units"),
        count_orders(lines).alias("order_count"),
    )
    return sales.select(
        VENDOR,
        period_label(F.col("date_period"), resolution).alias("period_label"),
        "date_period",
        market.units(F.col("sales")).alias("total_sales"),
        market.units(F.col("units")).alias("total_units"),
        "order_count",
        market.units_per(F.col("sales"), F.col("order_count")).alias("avg_order_value"),
    )


def top_selling_products(market: Marketplace, params: QueryParams) -> DataFrame:
    """Top products per vendor; one missing from the catalog leaves a gap in the ranks."""
    lines = sales_lines(market, params)
    sales = lines.groupBy(VENDOR, "product_id").agg(
        *_revenue_and_units("revenue", "units"),
        count_orders(lines).alias("order_count"),
        F.count(F.lit(1)).alias("line_item_count"),
    )
    ranked = top_n_per(sales, VENDOR, "revenue", "product_id", params.top_n, "rank_within_vendor")
    catalog = market.vendor_products.select(
        F.col("id").alias("product_id"),
        "product_name",
        F.coalesce(deepest_category(F.col("category_ids")), F.lit(UNKNOWN)).alias("category"),
    )
    return ranked.join(catalog, "product_id").select(
        VENDOR,
        "product_name",
        "category",
        market.units(F.col("revenue")).alias("total_revenue"),
        market.units(F.col("units")).alias("total_units"),
        "order_count",
        "line_item_count",
        safe_ratio(F.col("revenue"), F.col("units")).alias("avg_price_per_unit"),
        "rank_within_vendor",
    )


def regional_distribution(market: Marketplace, params: QueryParams) -> DataFrame:
    """Sales per shipping city and their share of the vendor's total.

    Sales are summed per vendor and address before the cities are joined; an order has one address,
    so its count adds up. Cities are grouped as stored: a city named like the placeholder stays
    apart from a missing one.
    """
    lines = sales_lines(market, params)
    by_address = lines.groupBy(VENDOR, "shipping_address").agg(
        *_revenue_and_units("revenue", "units"), count_orders(lines).alias("orders")
    )
    cities = market.user_address.select(F.col("id").alias("shipping_address"), "city")
    by_city = (
        by_address.join(cities, "shipping_address", "left")
        .groupBy(VENDOR, "city")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("units").alias("units"),
            F.sum("orders").alias("order_count"),
        )
    )
    return with_share(by_city, VENDOR, "revenue", "revenue_contribution_pct").select(
        VENDOR,
        F.coalesce("city", F.lit(UNKNOWN)).alias("region"),
        market.units(F.col("revenue")).alias("total_revenue"),
        market.units(F.col("units")).alias("total_units"),
        "order_count",
        "revenue_contribution_pct",
    )


def order_analysis(market: Marketplace, params: QueryParams) -> DataFrame:
    """Value, quantity and unit price of every order."""
    orders = (
        sales_lines(market, params)
        .groupBy(VENDOR, "po_id", "po_created_date", "source")
        .agg(*_revenue_and_units("value", "units"))
    )
    return orders.select(
        VENDOR,
        "po_id",
        market.units(F.col("value")).alias("order_value"),
        market.units(F.col("units")).alias("quantity"),
        F.coalesce("source", F.lit(UNKNOWN)).alias("sales_channel"),
        day_label(F.col("po_created_date")).alias("order_date"),
        safe_ratio(F.col("value"), F.col("units")).alias("avg_price_per_unit"),
    )
