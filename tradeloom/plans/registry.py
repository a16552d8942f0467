"""Which queries exist per entity type, and how their rows are keyed and ordered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.params import QueryParams, check_entity_type
from tradeloom.plans import buyer, seller
from tradeloom.sources.tables import Marketplace


@dataclass(frozen=True)
class NamedQuery:
    """`order` names the column that orders an entity's rows; a leading minus means descending."""

    name: str
    description: str
    kind: str
    build: Callable[[Marketplace, QueryParams], DataFrame]
    order: str | None = None
    needs_time_resolution: bool = False

    def error(self, params: QueryParams) -> str | None:
        if self.needs_time_resolution and params.time_resolution is None:
            return "missing parameter: time_resolution"
        return None

    def order_columns(self, id_column: str) -> list[Column]:
        """Missing values come last in rising order and first in falling order."""
        columns = [F.col(id_column).asc_nulls_last()]
        if self.order:
            name = self.order.lstrip("-")
            falling = self.order.startswith("-")
            columns.append(F.col(name).desc_nulls_first() if falling else F.col(name).asc_nulls_last())
        return columns

    def position(self) -> Column:
        """Number by which an entity's rows rise in their order."""
        if self.order is None:
            return F.lit(0.0)
        name = self.order.lstrip("-")
        if name == "month":
            return F.unix_date(F.to_date(name, "yyyy-MM")).cast("double")
        if name in ("quarter_start", "date_period"):
            return F.unix_date(name).cast("double")
        value = F.col(name).cast("double")
        return -value if self.order.startswith("-") else value


@dataclass(frozen=True)
class EntityPlan:
    """`line_column` holds the entity's id in the lines, of which `lines_read` gives what the queries read. Lines that are
    gathered by entity are `prepared` in their partitions, so that the queries sum them without hashing where they can."""

    id_column: str
    line_column: str
    lines_read: Callable[[Marketplace, QueryParams], Marketplace]
    prepared: Callable[[DataFrame], DataFrame]
    spend_column: str
    counterparty_column: str
    overview: NamedQuery
    others: tuple[NamedQuery, ...]

    @property
    def queries(self) -> tuple[NamedQuery, ...]:
        return (self.overview, *self.others)

    def query(self, name: str) -> NamedQuery:
        return next(q for q in self.queries if q.name == name)


PLANS = {
    "buyer": EntityPlan(
        id_column="buyer_org_id",
        line_column="buyer_org_id",
        lines_read=buyer.lines_read,
        prepared=buyer.by_product,
        spend_column="current_period_purchases",
        counterparty_column="suppliers_current",
        overview=NamedQuery(
            "overview_metrics", "What a buyer bought in the period and in the one before, with changes in percent", "overview", buyer.overview
        ),
        others=(
            NamedQuery(
                "top_products",
                "The products on which a buyer spent most",
                "ranking",
                buyer.top_products,
                "rank_within_buyer",
            ),
            NamedQuery(
                "top_suppliers",
                "The suppliers from which a buyer bought most",
                "ranking",
                buyer.top_suppliers,
                "rank_within_buyer",
            ),
            NamedQuery(
                "top_categories",
                "The product categories on which a buyer spent most",
                "ranking",
                buyer.top_categories,
                "rank_within_buyer",
            ),
        ),
    ),
    "seller": EntityPlan(
        id_column="vendor_id",
        line_column="seller_org_id",
        lines_read=seller.lines_read,
        prepared=seller.by_order,
        spend_column="total_sales",
        counterparty_column="total_buyers",
        overview=NamedQuery(
            "performance_overview",
            "What a vendor sold, to how many buyers, and how many of them came back",
            "overview",
            seller.performance_overview,
        ),
        others=(
            NamedQuery(
                "monthly_trends",
                "Each month's sales and their growth over the month before",
                "time_series",
                seller.monthly_trends,
                "month",
            ),
            NamedQuery(
                "quarterly_trends",
                "Each quarter's sales and their growth over the quarter before",
                "time_series",
                seller.quarterly_trends,
                "quarter_start",
            ),
            NamedQuery(
                "product_line_breakdown",
                "A vendor's sales per product category, with their share of all its sales",
                "breakdown",
                seller.product_line_breakdown,
                "-total_revenue",
            ),
            NamedQuery(
                "sales_time_series",
                "A vendor's sales per day, week, month or quarter",
                "time_series",
                seller.sales_time_series,
                "date_period",
                needs_time_resolution=True,
            ),
            NamedQuery(
                "top_selling_products",
                "The products that earned a vendor most",
                "ranking",
                seller.top_selling_products,
                "rank_within_vendor",
            ),
            NamedQuery(
                "regional_distribution",
                "Where a vendor's sales were shipped, city by city",
                "distribution",
                seller.regional_distribution,
                "-total_revenue",
            ),
            NamedQuery(
                "order_analysis",
                "Value, quantity and unit price of every order of a vendor",
                "analysis",
                seller.order_analysis,
                "-order_value",
            ),
        ),
    ),
}


def plan_of(entity_type: str) -> EntityPlan:
    return PLANS[check_entity_type(entity_type)]


def run_query(
    market: Marketplace, entity_type: str, name: str, params: QueryParams, ordered: bool = False
) -> DataFrame:
    """One named query; ordering the whole result is only for looking at it."""
    plan = plan_of(entity_type)
    query = plan.query(name)
    result = query.build(market, params)
    return result.orderBy(*query.order_columns(plan.id_column)) if ordered else result
