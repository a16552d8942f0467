"""Buyer analytics, each for all buyers at once. Buyers are counted on the item's updated_date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.categories import deepest_category
from tradeloom.functions.numeric import pct_change, pct_change_of_quotients, safe_ratio
from tradeloom.operators.filters import in_period
from tradeloom.operators.ranking import top_n_per
from tradeloom.params import Period, QueryParams
from tradeloom.sources.staging import lines_with
from tradeloom.sources.tables import Marketplace

CLOCK = "updated_date"
BUYER = "buyer_org_id"
RANK = "rank_within_buyer"
ITEM, SUPPLIER = "item", "supplier"


AMOUNTS = ("curr_amount", "curr_qty", "prev_amount", "prev_qty")
#: What the queries read of a line.
LINE_COLUMNS = (BUYER, CLOCK, "product_id", "seller_org_id", "amount_units", "qty_units")
FIRST_COLUMNS = LINE_COLUMNS[:4]


def lines_read(market: Marketplace, params: QueryParams) -> Marketplace:
    """The marketplace with the lines that the queries read, and with first dates only if the overview needs them."""
    first_dates = _needed(market, params.period, market.first_dates)
    lines = _overview_lines(market, params.period, first_dates)
    return market.with_lines(lines.select(*LINE_COLUMNS), None, first_dates)


def by_product(lines: DataFrame) -> DataFrame:
    """Gathered lines in the order in which they are summed by product and by product and seller."""
    return lines.sortWithinPartitions(BUYER, "product_id", "seller_org_id")


def purchases_by_key(market: Marketplace, period: Period, first_dates: DataFrame | None = None) -> DataFrame:
    """All lines up to the end of the period, as one row per buyer and product and one per buyer and
    seller; the sums are on the seller rows only. Where the first dates of all keys are known, only the lines of the
    period and the one before are read; where the zones tell that there are no others before them, the lines tell the
    first dates themselves, and nothing is joined.

    Later lines cannot change a sum, a count or whether something was first seen in the period. Both
    kinds of row come from one scan and share one shuffle, which is keyed by buyer and key: the lines
    of a buyer with most of the data spread over its keys.
    """
    clock = F.col(CLOCK)
    current, previous = period.holds(clock), period.previous.holds(clock)
    in_span = clock.between(F.lit(period.previous.start), F.lit(period.end))

    def spent(column: str, when: Column) -> Column:
        # Inside the span a line of the other period adds zero; outside it adds nothing.
        return F.sum(F.when(F.col("kind") == SUPPLIER, F.when(when, F.col(column)).when(in_span, F.lit(0))))

    first_dates = _needed(market, period, first_dates)
    found = (
        _overview_lines(market, period, first_dates)
        .select(BUYER, CLOCK, "amount_units", "qty_units", F.inline(_keys()))
        .groupBy(BUYER, "kind", "key")
        .agg(
            spent("amount_units", current).alias("curr_amount"),
            spent("qty_units", current).alias("curr_qty"),
            spent("amount_units", previous).alias("prev_amount"),
            spent("qty_units", previous).alias("prev_qty"),
            F.max(in_span).alias("in_span"),
            F.max(current).alias("in_current"),
            F.max(previous).alias("in_previous"),
            F.min(clock).alias("first_seen"),
        )
    )
    if first_dates is None:
        return found
    return found.drop("first_seen").join(first_dates, [BUYER, "kind", "key"], "left")


def _needed(market: Marketplace, period: Period, first_dates: DataFrame | None) -> DataFrame | None:
    """The first dates, unless they are those of the marketplace and the lines of both periods tell them."""
    told = first_dates is market.first_dates and _begins_at(market, period.previous.start)
    return None if told else first_dates


def _overview_lines(market: Marketplace, period: Period, first_dates: DataFrame | None) -> DataFrame:
    if first_dates is None:
        return lines_with(market, (CLOCK,), None, period.end).filter(F.col(CLOCK) <= F.lit(period.end))
    return updated_in(market, Period(period.previous.start, period.end))


def _begins_at(market: Marketplace, start: date) -> bool:
    """Whether the zones tell that no line was updated before this date."""
    return market.zones is not None and not any(z.meets(CLOCK, None, start - timedelta(days=1)) for z in market.zones)


def _keys() -> Column:
    return F.array(
        F.struct(F.lit(ITEM).alias("kind"), F.col("product_id").alias("key")),
        F.struct(F.lit(SUPPLIER).alias("kind"), F.col("seller_org_id").alias("key")),
    )


def purchased(lines: DataFrame) -> DataFrame:
    """What each buyer bought and from whom, with the date: two rows a line at most."""
    return lines.select(BUYER, CLOCK, F.inline(_keys())).filter(f"{BUYER} IS NOT NULL AND key IS NOT NULL")


def first_dates(lines: DataFrame) -> DataFrame:
    """When each buyer first bought each product, and from each seller, in these lines."""
    return purchased(lines).groupBy(BUYER, "kind", "key").agg(F.min(CLOCK).alias("first_seen"))


def earliest(dates: DataFrame) -> DataFrame:
    """First dates of several batches of lines as one."""
    return dates.groupBy(BUYER, "kind", "key").agg(F.min("first_seen").alias("first_seen"))


def buyer_measures(by_key: DataFrame, period: Period) -> DataFrame:
    """Sums and distinct counts of both periods, one row per buyer seen in the span.

    Distinct keys are plain counts of rows here, which are added up per task before the last shuffle.
    """
    known, first_seen = F.col("key").isNotNull(), F.col("first_seen")

    def counts(kind: str, name: str) -> list[Column]:
        of_kind = known & (F.col("kind") == kind)
        return [
            F.count_if(of_kind & F.col("in_current")).alias(f"curr_{name}"),
            F.count_if(of_kind & F.col("in_previous")).alias(f"prev_{name}"),
            F.count_if(of_kind & period.holds(first_seen)).alias(f"new_{name}_current"),
            F.count_if(of_kind & period.previous.holds(first_seen)).alias(f"new_{name}_previous"),
        ]

    return (
        by_key.groupBy(BUYER)
        .agg(
            *(F.sum(a).alias(a) for a in AMOUNTS),
            *counts(ITEM, "items"),
            *counts(SUPPLIER, "suppliers"),
            F.max("in_span").alias("in_span"),
        )
        .filter("in_span")
    )


def overview(market: Marketplace, params: QueryParams, first_dates: DataFrame | None = None) -> DataFrame:
    """Period-over-period purchases, quantities, prices, items and suppliers per buyer. First dates that the marketplace
    keeps are used, unless others are given."""
    first_dates = market.first_dates if first_dates is None else first_dates
    measures = buyer_measures(purchases_by_key(market, params.period, first_dates), params.period)
    c = {name: F.col(name) for name in measures.columns}
    spend = (c["curr_amount"], c["prev_amount"])
    qty = (c["curr_qty"], c["prev_qty"])
    suppliers = (c["curr_suppliers"], c["prev_suppliers"])
    items = (c["curr_items"], c["prev_items"])

    def known_buyer(count: str) -> Column:
        # First-seen counts are attached by buyer, so lines without a buyer have none.
        return F.when(c[BUYER].isNull(), F.lit(0)).otherwise(c[count]).cast("bigint")

    columns = {
        BUYER: c[BUYER],
        "current_period_purchases": market.units(spend[0]),
        "previous_period_purchases": market.units(spend[1]),
        "purchase_percentage_change": pct_change(*spend),
        "current_period_quantity": market.units(qty[0]),
        "previous_period_quantity": market.units(qty[1]),
        "quantity_percentage_change": pct_change(*qty),
        "avg_purchase_per_supplier_current": market.units_per(spend[0], suppliers[0]),
        "avg_purchase_per_supplier_previous": market.units_per(spend[1], suppliers[1]),
        "avg_purchase_per_supplier_percentage_change": pct_change_of_quotients(
            spend[0], suppliers[0], spend[1], suppliers[1]
        ),
        "avg_price_per_unit_current": safe_ratio(spend[0], qty[0]),
        "avg_price_per_unit_previous": safe_ratio(spend[1], qty[1]),
        "avg_price_per_unit_percentage_change": pct_change_of_quotients(
            spend[0], qty[0], spend[1], qty[1]
        ),
        "items_purchased_current": items[0],
        "items_purchased_previous": items[1],
        "items_purchased_percentage_change": pct_change(*items),
        "new_items_purchased_current": known_buyer("new_items_current"),
        "new_items_purchased_previous": known_buyer("new_items_previous"),
        "suppliers_current": suppliers[0],
        "suppliers_previous": suppliers[1],
        "suppliers_percentage_change": pct_change(*suppliers),
        "new_suppliers_current": known_buyer("new_suppliers_current"),
        "new_suppliers_previous": known_buyer("new_suppliers_previous"),
    }
    return measures.select([column.alias(name) for name, column in columns.items()])


def updated_in(market: Marketplace, period: Period) -> DataFrame:
    return in_period(lines_with(market, (CLOCK,), period.start, period.end), CLOCK, period)


def _purchases(market: Marketplace, params: QueryParams, *keys: str) -> DataFrame:
    lines = updated_in(market, params.period)
    return lines.groupBy(BUYER, *keys).agg(F.sum("amount_units").alias("total_purchase_amount"))


def _ranked(purchases: DataFrame, params: QueryParams, key: str) -> DataFrame:
    return top_n_per(purchases, BUYER, "total_purchase_amount", key, params.top_n, RANK)


def _ranking_columns(market: Marketplace, *names: str) -> list[Column]:
    total = market.units(F.col("total_purchase_amount")).alias("total_purchase_amount")
    return [F.col(BUYER), *(F.col(n) for n in names), total, F.col(RANK)]


def top_products(market: Marketplace, params: QueryParams) -> DataFrame:
    """A product missing from the catalog keeps its rank and has no name."""
    names = market.vendor_products.select(F.col("id").alias("product_id"), "product_name")
    ranked = _ranked(_purchases(market, params, "product_id"), params, "product_id")
    return ranked.join(names, "product_id", "left").select(_ranking_columns(market, "product_id", "product_name"))


def top_suppliers(market: Marketplace, params: QueryParams) -> DataFrame:
    names = market.organization.select(F.col("org_id").alias("seller_org_id"), "company_name")
    ranked = _ranked(_purchases(market, params, "seller_org_id"), params, "seller_org_id")
    return ranked.join(names, "seller_org_id", "left").select(
        _ranking_columns(market, "seller_org_id", "company_name")
    )


def top_categories(market: Marketplace, params: QueryParams) -> DataFrame:
    """Only products sold by their catalog owner count; a missing category is ranked too.

    The catalog is joined to sums per buyer, seller and product rather than to lines, so a product
    that is in most lines is no hot join key.
    """
    owned = market.vendor_products.select(
        F.col("id").alias("product_id"),
        F.col("org_id").alias("seller_org_id"),
        deepest_category(F.col("category_ids")).alias("category"),
    )
    by_product = _purchases(market, params, "product_id", "seller_org_id")
    by_category = (
        by_product.join(owned, ["product_id", "seller_org_id"])
        .groupBy(BUYER, "category")
        .agg(F.sum("total_purchase_amount").alias("total_purchase_amount"))
    )
    return _ranked(by_category, params, "category").select(_ranking_columns(market, "category"))
