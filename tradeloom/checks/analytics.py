"""The twelve named analyses."""

from __future__ import annotations

from tradeloom.checks.base import (
    CATEGORIES,
    CHANNELS,
    LATER_HALF,
    WHOLE,
    in_list,
    money,
    pct,
    pct_of_quotients,
    ratio,
    register,
    whole,
    with_tables,
    within,
)
from tradeloom.params import Period, QueryParams
from tradeloom.plans import buyer, seller


def buyer_overview_ctes(period: Period, p: str = "") -> dict[str, str]:
    """Both periods by plain conditional and distinct aggregates; `p` starts all names."""
    before = period.previous
    span = Period(before.start, period.end)

    def first_seen(key: str) -> str:
        return f"SELECT buyer_org_id AS b, {key} AS k, min(updated_date) AS f FROM lines GROUP BY ALL"

    def newly(source: str, alias: str) -> str:
        return (
            f"SELECT b, count(DISTINCT CASE WHEN {within('f', period)} THEN k END) AS {alias}c,"
            f" count(DISTINCT CASE WHEN {within('f', before)} THEN k END) AS {alias}p FROM {source} GROUP BY b"
        )

    return {
        f"{p}both_periods": f"""
            SELECT *, {within('updated_date', period)} AS cur, {within('updated_date', before)} AS prev
            FROM lines WHERE {within('updated_date', span)}""",
        f"{p}sums": f"""
            SELECT buyer_org_id AS b,
                   sum(CASE WHEN cur THEN total_amount ELSE 0 END) AS ca,
                   sum(CASE WHEN prev THEN total_amount ELSE 0 END) AS pa,
                   sum(CASE WHEN cur THEN qty ELSE 0 END) AS cq,
                   sum(CASE WHEN prev THEN qty ELSE 0 END) AS pq,
                   count(DISTINCT CASE WHEN cur THEN seller_org_id END) AS cs,
                   count(DISTINCT CASE WHEN prev THEN seller_org_id END) AS ps,
                   count(DISTINCT CASE WHEN cur THEN product_id END) AS ci,
                   count(DISTINCT CASE WHEN prev THEN product_id END) AS pi
            FROM {p}both_periods GROUP BY buyer_org_id""",
        f"{p}product_first": first_seen("product_id"),
        f"{p}seller_first": first_seen("seller_org_id"),
        f"{p}new_products": newly(f"{p}product_first", "ni"),
        f"{p}new_sellers": newly(f"{p}seller_first", "ns"),
        f"{p}buyer_overview": f"""
            SELECT sums.b AS buyer_org_id,
                   CAST(ca AS DOUBLE) AS current_period_purchases,
                   CAST(pa AS DOUBLE) AS previous_period_purchases,
                   {pct('ca', 'pa')} AS purchase_percentage_change,
                   CAST(cq AS DOUBLE) AS current_period_quantity,
                   CAST(pq AS DOUBLE) AS previous_period_quantity,
                   {pct('cq', 'pq')} AS quantity_percentage_change,
                   {ratio('ca', 'cs')} AS avg_purchase_per_supplier_current,
                   {ratio('pa', 'ps')} AS avg_purchase_per_supplier_previous,
                   {pct_of_quotients('ca', 'cs', 'pa', 'ps')} AS avg_purchase_per_supplier_percentage_change,
                   {ratio('ca', 'cq')} AS avg_price_per_unit_current,
                   {ratio('pa', 'pq')} AS avg_price_per_unit_previous,
                   {pct_of_quotients('ca', 'cq', 'pa', 'pq')} AS avg_price_per_unit_percentage_change,
                   ci AS items_purchased_current, pi AS items_purchased_previous,
                   {pct('ci', 'pi')} AS items_purchased_percentage_change,
                   coalesce(nic, 0) AS new_items_purchased_current,
                   coalesce(nip, 0) AS new_items_purchased_previous,
                   cs AS suppliers_current, ps AS suppliers_previous,
                   {pct('cs', 'ps')} AS suppliers_percentage_change,
                   coalesce(nsc, 0) AS new_suppliers_current, coalesce(nsp, 0) AS new_suppliers_previous
            FROM {p}sums sums LEFT JOIN {p}new_products np ON sums.b = np.b
                              LEFT JOIN {p}new_sellers ns ON sums.b = ns.b""",
    }


@register(
    "buyer_overview_metrics",
    with_tables("SELECT * FROM buyer_overview", **buyer_overview_ctes(LATER_HALF)),
)
def _(market):
    return buyer.overview(market, QueryParams(LATER_HALF))


# The last quarter alone, where buyers without purchases in a period give NULL ratios.
LAST_QUARTER = Period.of("2001-07-01", "2001-09-30")


@register(
    "buyer_overview_metrics_quarter",
    with_tables("SELECT * FROM buyer_overview", **buyer_overview_ctes(LAST_QUARTER)),
)
def _(market):
    return buyer.overview(market, QueryParams(LAST_QUARTER))


def buyer_ranking(source: str, key: str, columns: str, top_n: int, join: str = "") -> str:
    return with_tables(
        f"SELECT buyer_org_id, {columns}, CAST(total AS DOUBLE) AS total_purchase_amount,"
        f" rank AS rank_within_buyer FROM ranked {join} WHERE rank <= {top_n}",
        totals=f"""
            SELECT buyer_org_id, {key}, sum(total_amount) AS total FROM {source}
            WHERE {within('updated_date', WHOLE)} GROUP BY buyer_org_id, {key}""",
        ranked=f"""
            SELECT *, row_number() OVER (PARTITION BY buyer_org_id
                                         ORDER BY total DESC NULLS FIRST, {key} NULLS LAST) AS rank
            FROM totals""",
    )


@register(
    "buyer_top_products",
    buyer_ranking(
        "lines",
        "product_id",
        "product_id, product_name",
        10,
        "LEFT JOIN vendor_products v ON v.id = product_id",
    ),
)
def _(market):
    return buyer.top_products(market, whole())


@register(
    "buyer_top_suppliers",
    buyer_ranking(
        "lines",
        "seller_org_id",
        "seller_org_id, company_name",
        10,
        "LEFT JOIN organization o ON o.org_id = seller_org_id",
    ),
)
def _(market):
    return buyer.top_suppliers(market, whole())


@register(
    "buyer_top_categories",
    buyer_ranking(
        "lines JOIN categories c ON c.product_id = lines.product_id AND c.org_id = lines.seller_org_id",
        "category",
        "category",
        5,
    ),
)
def _(market):
    return buyer.top_categories(market, whole(5))


def seller_overview_ctes(period: Period, filters: str = "", p: str = "") -> dict[str, str]:
    return {
        f"{p}per_order": f"""
            SELECT seller_org_id AS v, po_id, sum(total_amount) AS amount, sum(qty) AS units
            FROM lines WHERE {within('created_date', period)} {filters} GROUP BY ALL""",
        f"{p}sales": f"""
            SELECT v, {money('sum(amount)')} AS total_sales, {money('sum(units)')} AS units_sold,
                   {ratio('sum(amount)', 'count(po_id)')} AS average_order_value
            FROM {p}per_order GROUP BY v""",
        f"{p}buyer_orders": f"""
            SELECT seller_org_id AS v, buyer_org_id, count(DISTINCT po_id) AS n FROM lines
            WHERE {within('po_created_date', period)} AND buyer_org_id IS NOT NULL {filters} GROUP BY ALL""",
        f"{p}repeats": f"""
            SELECT v, count(*) AS total_buyers, count(*) FILTER (n > 1) AS repeat_buyers
            FROM {p}buyer_orders GROUP BY v""",
        f"{p}seller_overview": f"""
            SELECT sales.v AS vendor_id, total_sales, units_sold, average_order_value,
                   coalesce(total_buyers, 0) AS total_buyers, coalesce(repeat_buyers, 0) AS repeat_buyers,
                   coalesce({ratio('(100 * repeat_buyers)', 'total_buyers')}, 0) AS repeat_purchase_rate_pct
            FROM {p}sales sales LEFT JOIN {p}repeats repeats ON repeats.v = sales.v""",
    }


@register(
    "seller_performance_overview",
    with_tables("SELECT * FROM seller_overview", **seller_overview_ctes(LATER_HALF)),
)
def _(market):
    return seller.performance_overview(market, QueryParams(LATER_HALF))


WANTED_PRODUCT = f"product_id IN (SELECT product_id FROM categories WHERE category IN {in_list(CATEGORIES)})"
WANTED_CHANNEL = f"source IN {in_list(CHANNELS)}"


@register(
    "seller_performance_overview_filtered",
    with_tables(
        "SELECT * FROM seller_overview",
        **seller_overview_ctes(WHOLE, f"AND {WANTED_PRODUCT} AND {WANTED_CHANNEL}"),
    ),
)
def _(market):
    return seller.performance_overview(market, whole(categories=CATEGORIES, channels=CHANNELS))


def trend_sql(unit: str, label: str, extra: str, previous: str, growth: str, filters: str = "") -> str:
    step = {"month": "1 month", "quarter": "3 month"}[unit]
    return with_tables(
        f"""
        SELECT vendor_id, {label}, coalesce({money('total')}, 0) AS total_sales,
               coalesce({money('units')}, 0) AS total_units, coalesce(orders, 0) AS order_count,
               coalesce({money('before')}, 0) AS {previous},
               {pct('coalesce(total, 0)', 'before')} AS {growth} {extra}
        FROM lagged""",
        active=f"SELECT DISTINCT seller_org_id AS vendor_id FROM lines WHERE {within('created_date', WHOLE)}",
        buckets=f"""
            SELECT CAST(unnest(generate_series(date_trunc('{unit}', DATE '{WHOLE.start}'),
                   date_trunc('{unit}', DATE '{WHOLE.end}'), INTERVAL '{step}')) AS DATE) AS bucket""",
        facts=f"""
            SELECT seller_org_id AS v, CAST(date_trunc('{unit}', created_date) AS DATE) AS bucket_start,
                   sum(total_amount) AS total, sum(qty) AS units, count(DISTINCT po_id) AS orders
            FROM lines WHERE {within('created_date', WHOLE)} {filters} GROUP BY ALL""",
        dense="""
            SELECT vendor_id, bucket, total, units, orders
            FROM active CROSS JOIN buckets LEFT JOIN facts ON v = vendor_id AND bucket_start = bucket""",
        lagged="""
            SELECT *, lag(total) OVER (PARTITION BY vendor_id ORDER BY bucket) AS before FROM dense""",
    )


MONTH_LABEL = "strftime(bucket, '%Y-%m') AS month"
QUARTER_LABEL = "'Q' || quarter(bucket) || ' ' || strftime(bucket, '%Y') AS quarter"


@register(
    "seller_monthly_trends",
    trend_sql("month", MONTH_LABEL, "", "prev_month_sales", "mom_growth_rate_pct"),
)
def _(market):
    return seller.monthly_trends(market, whole())


@register(
    "seller_monthly_trends_filtered",
    trend_sql(
        "month",
        MONTH_LABEL,
        "",
        "prev_month_sales",
        "mom_growth_rate_pct",
        f"AND {WANTED_PRODUCT} AND {WANTED_CHANNEL}",
    ),
)
def _(market):
    return seller.monthly_trends(market, whole(categories=CATEGORIES, channels=CHANNELS))


@register(
    "seller_quarterly_trends",
    trend_sql(
        "quarter", QUARTER_LABEL, ", bucket AS quarter_start", "prev_quarter_sales", "qoq_growth_rate_pct"
    ),
)
def _(market):
    return seller.quarterly_trends(market, whole())


@register(
    "seller_product_line_breakdown",
    with_tables(
        f"""
        SELECT vendor_id, product_line, CAST(revenue AS DOUBLE) AS total_revenue,
               {money('units')} AS total_units, n AS transaction_count,
               {ratio('(100 * revenue)', 'whole')} AS revenue_contribution_pct
        FROM by_line JOIN totals USING (vendor_id)""",
        by_line=f"""
            SELECT seller_org_id AS vendor_id, coalesce(category, 'Unknown') AS product_line,
                   round(sum(total_amount), 2) AS revenue, sum(qty) AS units, count(*) AS n
            FROM lines LEFT JOIN categories USING (product_id)
            WHERE {within('created_date', WHOLE)} GROUP BY ALL""",
        totals="SELECT vendor_id, sum(revenue) AS whole FROM by_line GROUP BY vendor_id",
    ),
)
def _(market):
    return seller.product_line_breakdown(market, whole())


TIME_LABELS = {
    "day": "strftime(date_period, '%Y-%m-%d')",
    "week": "strftime(date_period, '%Y-%m-%d') || ' (Week ' || strftime(date_period, '%V') || ')'",
    "month": "strftime(date_period, '%Y-%m')",
    "quarter": "CAST(NULL AS VARCHAR)",
}

for _unit, _label in TIME_LABELS.items():

    @register(
        f"seller_sales_time_series_{_unit}",
        with_tables(
            f"""
            SELECT vendor_id, {_label} AS period_label, date_period, {money('total')} AS total_sales,
                   {money('units')} AS total_units, n AS order_count, {ratio('total', 'n')} AS avg_order_value
            FROM per_bucket""",
            per_bucket=f"""
                SELECT seller_org_id AS vendor_id,
                       CAST(date_trunc('{_unit}', created_date) AS DATE) AS date_period,
                       sum(total_amount) AS total, sum(qty) AS units, count(DISTINCT po_id) AS n
                FROM lines WHERE {within('created_date', WHOLE)} GROUP BY ALL""",
        ),
    )
    def _(market, unit=_unit):
        return seller.sales_time_series(market, whole(time_resolution=unit))


@register(
    "seller_top_selling_products",
    with_tables(
        f"""
        SELECT vendor_id, product_name, coalesce(category, 'Unknown') AS category,
               {money('revenue')} AS total_revenue, {money('units')} AS total_units, orders AS order_count,
               n AS line_item_count, {ratio('revenue', 'units')} AS avg_price_per_unit,
               rank AS rank_within_vendor
        FROM ranked JOIN vendor_products v ON v.id = ranked.product_id
                    LEFT JOIN categories c ON c.product_id = ranked.product_id
        WHERE rank <= 20""",
        per_product=f"""
            SELECT seller_org_id AS vendor_id, product_id, sum(total_amount) AS revenue, sum(qty) AS units,
                   count(DISTINCT po_id) AS orders, count(*) AS n
            FROM lines WHERE {within('created_date', WHOLE)} GROUP BY ALL""",
        ranked="""
            SELECT *, row_number() OVER (PARTITION BY vendor_id
                                         ORDER BY revenue DESC NULLS FIRST, product_id) AS rank
            FROM per_product""",
    ),
)
def _(market):
    return seller.top_selling_products(market, whole(20))


REGIONS = f"""
    SELECT seller_org_id AS vendor_id, city, sum(total_amount) AS revenue, sum(qty) AS units,
           count(DISTINCT po_id) AS orders
    FROM lines LEFT JOIN user_address a ON a.id = shipping_address
    WHERE {within('created_date', WHOLE)} GROUP BY seller_org_id, city"""


@register(
    "seller_regional_distribution",
    with_tables(
        f"""
        SELECT vendor_id, coalesce(city, 'Unknown') AS region, {money('revenue')} AS total_revenue,
               {money('units')} AS total_units, orders AS order_count,
               {ratio('(100 * revenue)', 'whole')} AS revenue_contribution_pct
        FROM regions JOIN totals USING (vendor_id)""",
        regions=REGIONS,
        totals="SELECT vendor_id, sum(revenue) AS whole FROM regions GROUP BY vendor_id",
    ),
)
def _(market):
    return seller.regional_distribution(market, whole())


@register(
    "seller_order_analysis",
    with_tables(
        f"""
        SELECT vendor_id, po_id, {money('amount')} AS order_value, {money('units')} AS quantity,
               coalesce(source, 'Unknown') AS sales_channel, strftime(placed, '%Y-%m-%d') AS order_date,
               {ratio('amount', 'units')} AS avg_price_per_unit
        FROM per_order""",
        per_order=f"""
            SELECT seller_org_id AS vendor_id, po_id, po_created_date AS placed, source,
                   sum(total_amount) AS amount, sum(qty) AS units
            FROM lines WHERE {within('created_date', WHOLE)} GROUP BY ALL""",
    ),
)
def _(market):
    return seller.order_analysis(market, whole())
