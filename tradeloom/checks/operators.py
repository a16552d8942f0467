"""The joins, aggregates, windows, filters and scalar functions one by one, over all lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.checks.analytics import REGIONS, WANTED_CHANNEL, WANTED_PRODUCT
from tradeloom.checks.base import (
    CATEGORIES,
    CHANNELS,
    LATER_HALF,
    WHOLE,
    money,
    pct,
    ratio,
    register,
    whole,
    with_tables,
    within,
)
from tradeloom.functions import dates
from tradeloom.functions.categories import deepest_category
from tradeloom.functions.numeric import pct_change, safe_ratio, units
from tradeloom.operators import filters
from tradeloom.operators.ranking import top_n_per
from tradeloom.operators.shares import with_share
from tradeloom.operators.trends import entity_calendar, growth_pct, with_previous
from tradeloom.params import QueryParams
from tradeloom.plans import buyer, seller
from tradeloom.sources.tables import TABLES, join_items_orders, with_amounts

EARLIER_HALF = LATER_HALF.previous


def in_units(market, **names: str) -> list:
    return [market.units(F.col(column)).alias(name) for name, column in names.items()]


# Scans and joins


@register(
    "scan_po",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS keys FROM {t}"
            for t, key in zip(TABLES, ("po_id", "id", "id", "id", "org_id"))
        )
    ),
)
def _(market):
    counts = [
        getattr(market, table).agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("row_count"),
            F.count_distinct(key).alias("keys"),
        )
        for table, key in zip(TABLES, ("po_id", "id", "id", "id", "org_id"))
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


@register(
    "join_items_orders",
    with_tables(
        "SELECT po_id, product_id, CAST(qty AS DOUBLE) AS qty, CAST(total_amount AS DOUBLE) AS total_amount,"
        " buyer_org_id, seller_org_id, source, shipping_address, CAST(created_date AS DATE) AS created_date,"
        " CAST(po_created_date AS DATE) AS po_created_date FROM lines"
    ),
)
def _(market):
    return join_items_orders(market.po_items, market.po_details).select(
        "po_id",
        "product_id",
        *in_units(market, qty="qty_units", total_amount="amount_units"),
        "buyer_org_id",
        "seller_org_id",
        "source",
        "shipping_address",
        F.col("created_date").cast("date").alias("created_date"),
        F.col("po_created_date").cast("date").alias("po_created_date"),
    )


@register(
    "join_category_left",
    with_tables(
        "SELECT po_id, product_id, category AS category_name FROM po_items LEFT JOIN categories USING (product_id)"
    ),
)
def _(market):
    return market.po_items.join(market.product_categories(), "product_id", "left").select(
        "po_id", "product_id", "category_name"
    )


@register(
    "join_address_left",
    with_tables(
        "SELECT d.id AS po_id, coalesce(city, 'Unknown') AS city"
        " FROM po_details d LEFT JOIN user_address a ON a.id = d.shipping_address"
    ),
)
def _(market):
    cities = market.user_address.select(F.col("id").alias("shipping_address"), "city")
    return market.po_details.join(cities, "shipping_address", "left").select(
        F.col("id").alias("po_id"), F.coalesce("city", F.lit("Unknown")).alias("city")
    )


@register(
    "join_organization_left",
    with_tables(
        "SELECT d.id AS po_id, company_name FROM po_details d LEFT JOIN organization o ON o.org_id = d.seller_org_id"
    ),
)
def _(market):
    names = market.organization.withColumnRenamed("org_id", "seller_org_id")
    return market.po_details.join(names, "seller_org_id", "left").select(
        F.col("id").alias("po_id"), "company_name"
    )


@register(
    "join_catalog_owner",
    with_tables(
        "SELECT po_id, lines.product_id, seller_org_id, category FROM lines JOIN categories c"
        " ON c.product_id = lines.product_id AND c.org_id = lines.seller_org_id"
    ),
)
def _(market):
    owned = market.vendor_products.select(
        F.col("id").alias("product_id"),
        F.col("org_id").alias("seller_org_id"),
        deepest_category(F.col("category_ids")).alias("category"),
    )
    return (
        market.lines()
        .join(owned, ["product_id", "seller_org_id"])
        .select("po_id", "product_id", "seller_org_id", "category")
    )


@register(
    "entity_calendar_spine",
    with_tables(
        f"""SELECT vendor_id, bucket AS month_start FROM
            (SELECT DISTINCT seller_org_id AS vendor_id FROM lines),
            (SELECT CAST(unnest(generate_series(DATE '{WHOLE.start}', DATE '{WHOLE.end}',
                    INTERVAL '1 month')) AS DATE) AS bucket)"""
    ),
)
def _(market):
    vendors = market.lines().select(F.col("seller_org_id").alias("vendor_id")).distinct()
    return entity_calendar(vendors, WHOLE, "month", "month_start")


@register(
    "share_of_total",
    with_tables(
        f"""SELECT buyer_org_id, source, {ratio('(100 * spent)', 'whole')} AS share_pct
            FROM spend JOIN (SELECT buyer_org_id, sum(spent) AS whole FROM spend GROUP BY 1) USING (buyer_org_id)""",
        spend="SELECT buyer_org_id, source, sum(total_amount) AS spent FROM lines GROUP BY ALL",
    ),
)
def _(market):
    spend = market.lines().groupBy("buyer_org_id", "source").agg(F.sum("amount_units").alias("spent"))
    return with_share(spend, "buyer_org_id", "spent", "share_pct").drop("spent")


# Aggregates


@register(
    "agg_sum",
    with_tables(
        f"SELECT seller_org_id, {money('sum(total_amount)')} AS amount, {money('sum(qty)')} AS units"
        " FROM lines GROUP BY seller_org_id"
    ),
)
def _(market):
    return (
        market.lines()
        .groupBy("seller_org_id")
        .agg(market.units(F.sum("amount_units")).alias("amount"), market.units(F.sum("qty_units")).alias("units"))
    )


FINE = 6


@register(
    "agg_sum_fine",
    f"""SELECT l_suppkey AS seller_org_id, {money(f'sum(CAST(l_extendedprice / 7 AS DECIMAL(18,{FINE})))')} AS amount,
               {money(f'sum(CAST(l_quantity / 7000 AS DECIMAL(18,{FINE})))')} AS units
        FROM lineitem GROUP BY l_suppkey""",
)
def _(market):
    """Amounts finer than hundredths: rounding each line would lose most of these quantities."""
    lines = market.spark.read.parquet(f"{market.origin}/lineitem.parquet").select(
        F.col("l_suppkey").alias("seller_org_id"),
        (F.col("l_quantity") / 7000).alias("qty"),
        (F.col("l_extendedprice") / 7).alias("total_amount"),
    )
    sums = with_amounts(lines, FINE).groupBy("seller_org_id")
    amount, quantity = (units(F.sum(c), FINE) for c in ("amount_units", "qty_units"))
    return sums.agg(amount.alias("amount"), quantity.alias("units"))


@register(
    "agg_count",
    with_tables(
        "SELECT seller_org_id, count(*) AS all_lines, count(total_amount) AS priced_lines"
        " FROM lines GROUP BY seller_org_id"
    ),
)
def _(market):
    return (
        market.lines()
        .groupBy("seller_org_id")
        .agg(F.count("*").alias("all_lines"), F.count("amount_units").alias("priced_lines"))
    )


@register(
    "agg_count_distinct",
    with_tables(
        "SELECT seller_org_id, count(DISTINCT po_id) AS orders FROM lines GROUP BY seller_org_id"
    ),
)
def _(market):
    return market.lines().groupBy("seller_org_id").agg(F.count_distinct("po_id").alias("orders"))


@register(
    "agg_conditional_sum",
    with_tables(
        f"""SELECT buyer_org_id,
            CAST(sum(CASE WHEN {within('updated_date', LATER_HALF)} THEN total_amount ELSE 0 END) AS DOUBLE) AS later,
            CAST(sum(CASE WHEN {within('updated_date', EARLIER_HALF)} THEN total_amount ELSE 0 END) AS DOUBLE)
                AS earlier
            FROM lines GROUP BY buyer_org_id"""
    ),
)
def _(market):
    def spent(period):
        return F.sum(F.when(period.holds(F.col("updated_date")), F.col("amount_units")).otherwise(0))

    return (
        market.lines()
        .groupBy("buyer_org_id")
        .agg(
            market.units(spent(LATER_HALF)).alias("later"), market.units(spent(EARLIER_HALF)).alias("earlier")
        )
    )


DISTINCT_COUNTS = ["curr_items", "prev_items", "curr_suppliers", "prev_suppliers"]


@register(
    "agg_conditional_distinct",
    with_tables(
        "SELECT buyer_org_id, "
        + ", ".join(
            f"count(DISTINCT CASE WHEN {within('updated_date', period)} THEN {key} END) AS {name}"
            for name, key, period in zip(
                DISTINCT_COUNTS,
                ("product_id", "product_id", "seller_org_id", "seller_org_id"),
                (LATER_HALF, EARLIER_HALF) * 2,
            )
        )
        + " FROM lines GROUP BY buyer_org_id"
    ),
)
def _(market):
    by_key = buyer.purchases_by_key(market, LATER_HALF)
    return buyer.buyer_measures(by_key, LATER_HALF).select("buyer_org_id", *DISTINCT_COUNTS)


FIRST_SEEN = """
    SELECT buyer_org_id, '{key}' AS kind, {key} AS key, min(updated_date) AS first_seen
    FROM lines GROUP BY ALL"""


@register(
    "first_seen",
    with_tables(
        "SELECT buyer_org_id, kind, key, CAST(first_seen AS DATE) AS first_seen FROM ("
        + " UNION ALL ".join(FIRST_SEEN.format(key=k) for k in ("product_id", "seller_org_id"))
        + ")"
    ),
)
def _(market):
    by_key = buyer.purchases_by_key(market, WHOLE)
    kind = F.when(F.col("kind") == buyer.ITEM, "product_id").otherwise("seller_org_id").alias("kind")
    return by_key.select("buyer_org_id", kind, "key", F.col("first_seen").cast("date").alias("first_seen"))


@register(
    "new_in_window",
    with_tables(
        f"""SELECT buyer_org_id, count(DISTINCT k) FILTER ({within('f', LATER_HALF)}) AS new_products,
                   count(DISTINCT k) FILTER ({within('f', EARLIER_HALF)}) AS new_products_before
            FROM (SELECT buyer_org_id, product_id AS k, min(updated_date) AS f FROM lines GROUP BY ALL)
            GROUP BY buyer_org_id"""
    ),
)
def _(market):
    by_key = buyer.purchases_by_key(market, LATER_HALF)
    return buyer.buyer_measures(by_key, LATER_HALF).select(
        "buyer_org_id",
        F.col("new_items_current").alias("new_products"),
        F.col("new_items_previous").alias("new_products_before"),
    )


@register(
    "select_distinct",
    with_tables("SELECT DISTINCT seller_org_id, buyer_org_id, po_id FROM lines WHERE buyer_org_id IS NOT NULL"),
)
def _(market):
    lines = market.lines().filter(F.col("buyer_org_id").isNotNull())
    return lines.select("seller_org_id", "buyer_org_id", "po_id").distinct()


@register(
    "order_level_rollup",
    with_tables(
        f"""SELECT v AS vendor_id, count(*) AS orders, {money('sum(amount)')} AS amount,
                   {money('max(amount)')} AS largest
            FROM (SELECT seller_org_id AS v, po_id, sum(total_amount) AS amount FROM lines GROUP BY ALL) GROUP BY v"""
    ),
)
def _(market):
    orders = (
        market.lines()
        .groupBy(F.col("seller_org_id").alias("vendor_id"), "po_id")
        .agg(F.sum("amount_units").alias("amount"))
    )
    return orders.groupBy("vendor_id").agg(
        F.count("po_id").alias("orders"),
        market.units(F.sum("amount")).alias("amount"),
        market.units(F.max("amount")).alias("largest"),
    )


@register(
    "average_order_value",
    with_tables(
        f"SELECT buyer_org_id, {ratio('sum(total_amount)', 'count(DISTINCT po_id)')} AS average_order_value"
        " FROM lines GROUP BY buyer_org_id"
    ),
)
def _(market):
    orders = market.lines().groupBy("buyer_org_id", "po_id").agg(F.sum("amount_units").alias("amount"))
    return orders.groupBy("buyer_org_id").agg(
        market.units_per(F.sum("amount"), F.count("po_id")).alias("average_order_value")
    )


@register(
    "repeat_purchase_rate",
    with_tables(
        f"""SELECT v AS vendor_id, count(*) AS total_buyers, count(*) FILTER (n > 1) AS repeat_buyers,
                   {ratio('(100 * count(*) FILTER (n > 1))', 'count(*)')} AS repeat_pct
            FROM (SELECT seller_org_id AS v, buyer_org_id, count(DISTINCT po_id) AS n FROM lines
                  WHERE buyer_org_id IS NOT NULL AND seller_org_id IS NOT NULL GROUP BY ALL) GROUP BY v"""
    ),
)
def _(market):
    orders = seller.orders_by_buyer(market, whole())
    pairs = seller.buyers_by_vendor(orders).filter("vendor_id IS NOT NULL AND buyer_org_id IS NOT NULL")
    counts = pairs.groupBy("vendor_id").agg(
        F.count("*").alias("total_buyers"), F.count_if(F.col("order_count") > 1).alias("repeat_buyers")
    )
    return counts.withColumn("repeat_pct", safe_ratio(F.col("repeat_buyers") * 100, F.col("total_buyers")))


@register(
    "group_by_expression",
    with_tables(
        f"""SELECT CAST(date_trunc('month', created_date) AS DATE) AS month_start, count(*) AS n,
                   {money('sum(total_amount)')} AS amount FROM lines GROUP BY 1"""
    ),
)
def _(market):
    return (
        market.lines()
        .groupBy(dates.bucket(F.col("created_date"), "month").alias("month_start"))
        .agg(F.count("*").alias("n"), market.units(F.sum("amount_units")).alias("amount"))
    )


@register(
    "group_raw_show_label",
    with_tables(
        f"""SELECT coalesce(source, 'Unknown') AS sales_channel, count(*) AS n,
                   {money('sum(total_amount)')} AS amount FROM lines GROUP BY source"""
    ),
)
def _(market):
    grouped = (
        market.lines()
        .groupBy("source")
        .agg(F.count("*").alias("n"), market.units(F.sum("amount_units")).alias("amount"))
    )
    return grouped.select(F.coalesce("source", F.lit("Unknown")).alias("sales_channel"), "n", "amount")


# Windows


@register(
    "rank_top_n_per_entity",
    with_tables(
        """SELECT source, seller_org_id, CAST(amount AS DOUBLE) AS amount, rank FROM
           (SELECT *, row_number() OVER (PARTITION BY source
                      ORDER BY amount DESC NULLS FIRST, seller_org_id NULLS LAST) AS rank
            FROM (SELECT source, seller_org_id, sum(total_amount) AS amount FROM lines GROUP BY ALL))
           WHERE rank <= 5"""
    ),
)
def _(market):
    sums = market.lines().groupBy("source", "seller_org_id").agg(F.sum("amount_units").alias("amount"))
    return top_n_per(sums, "source", "amount", "seller_org_id", 5, "rank").withColumn(
        "amount", market.units(F.col("amount"))
    )


BUYER_MONTHS = """
    SELECT buyer_org_id, CAST(date_trunc('month', created_date) AS DATE) AS month_start,
           sum(total_amount) AS amount FROM lines GROUP BY ALL"""
BUYER_LAG = f"""
    SELECT *, lag(amount) OVER (PARTITION BY buyer_org_id ORDER BY month_start) AS before
    FROM ({BUYER_MONTHS})"""


def _buyer_months(market):
    months = (
        market.lines()
        .groupBy("buyer_org_id", dates.bucket(F.col("created_date"), "month").alias("month_start"))
        .agg(F.sum("amount_units").alias("amount"))
    )
    return with_previous(months, "buyer_org_id", "month_start", "amount", "before")


@register(
    "lag_previous_bucket",
    with_tables(
        "SELECT buyer_org_id, month_start, CAST(amount AS DOUBLE) AS amount, CAST(before AS DOUBLE) AS before"
        f" FROM ({BUYER_LAG})"
    ),
)
def _(market):
    return _buyer_months(market).select("buyer_org_id", "month_start", *in_units(market, amount="amount", before="before"))


@register(
    "growth_rate",
    with_tables(
        f"SELECT buyer_org_id, month_start, {pct('coalesce(amount, 0)', 'before')} AS growth_pct FROM ({BUYER_LAG})"
    ),
)
def _(market):
    return _buyer_months(market).select(
        "buyer_org_id", "month_start", growth_pct("amount", "before").alias("growth_pct")
    )


# Filters

CLOCKS = ("created_date", "updated_date", "po_created_date")


@register(
    "filter_window",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{clock}' AS clock, seller_org_id, count(*) AS n,
                       CAST(sum(total_amount) AS DOUBLE) AS amount
                FROM lines WHERE {within(clock, LATER_HALF)} GROUP BY seller_org_id"""
            for clock in CLOCKS
        )
    ),
)
def _(market):
    parts = [
        filters.in_period(market.lines(), clock, LATER_HALF)
        .groupBy(F.lit(clock).alias("clock"), "seller_org_id")
        .agg(F.count("*").alias("n"), market.units(F.sum("amount_units")).alias("amount"))
        for clock in CLOCKS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "previous_window",
    with_tables(
        """SELECT buyer_org_id, count(*) AS n, min(CAST(updated_date AS DATE)) AS first_day,
                  max(CAST(updated_date AS DATE)) AS last_day
           FROM lines, (SELECT DATE '1998-07-01' AS a, DATE '2001-12-31' AS b)
           WHERE updated_date BETWEEN a - CAST(b - a + 1 AS INT) AND a - 1 GROUP BY buyer_org_id"""
    ),
)
def _(market):
    day = F.col("updated_date").cast("date")
    return (
        filters.in_period(market.lines(), "updated_date", LATER_HALF.previous)
        .groupBy("buyer_org_id")
        .agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


@register(
    "tag_period",
    with_tables(
        f"""SELECT buyer_org_id, CASE WHEN {within('updated_date', LATER_HALF)} THEN 'current'
                   WHEN {within('updated_date', EARLIER_HALF)} THEN 'previous' END AS period, count(*) AS n
            FROM lines GROUP BY ALL"""
    ),
)
def _(market):
    tag = filters.period_tag(F.col("updated_date"), LATER_HALF).alias("period")
    return market.lines().groupBy("buyer_org_id", tag).agg(F.count("*").alias("n"))


@register(
    "filter_category", with_tables(f"SELECT po_id, product_id FROM lines WHERE {WANTED_PRODUCT}")
)
def _(market):
    return filters.keep_categories(market, market.lines(), CATEGORIES).select("po_id", "product_id")


@register("filter_channel", with_tables(f"SELECT po_id, source FROM lines WHERE {WANTED_CHANNEL}"))
def _(market):
    return filters.keep_channels(market.lines(), CHANNELS).select("po_id", "source")


@register(
    "not_null_id",
    with_tables("SELECT DISTINCT po_id, seller_org_id FROM lines WHERE seller_org_id IS NOT NULL"),
)
def _(market):
    return filters.split_summary(market.lines(), "seller_org_id")[0].select("po_id", "seller_org_id").distinct()


ENTITY = 42


@register(
    "entity_slice",
    with_tables(
        f"""SELECT vendor_id, coalesce(city, 'Unknown') AS region, CAST(revenue AS DOUBLE) AS revenue
            FROM ({REGIONS}) WHERE vendor_id = {ENTITY}"""
    ),
)
def _(market):
    regions = seller.regional_distribution(market, whole())
    return filters.entity_slice(regions, "vendor_id", [ENTITY]).select(
        "vendor_id", "region", F.col("total_revenue").alias("revenue")
    )


@register(
    "split_summary_rows",
    with_tables(
        f"""SELECT CASE WHEN seller_org_id IS NULL THEN 'summary' ELSE 'entity' END AS part,
                   seller_org_id AS vendor_id, {money('sum(total_amount)')} AS total_sales
            FROM lines WHERE {within('created_date', LATER_HALF)} GROUP BY seller_org_id"""
    ),
)
def _(market):
    overview = seller.performance_overview(market, QueryParams(LATER_HALF))
    entities, summary = filters.split_summary(overview, "vendor_id")
    tagged = [
        df.select(F.lit(part).alias("part"), "vendor_id", "total_sales")
        for part, df in (("entity", entities), ("summary", summary))
    ]
    return tagged[0].unionByName(tagged[1])


# Scalar functions


def _calendar(market, unit):
    clock = F.col("created_date")
    spans = (
        market.lines().groupBy("product_id").agg(F.min(clock).alias("first"), F.max(clock).alias("last"))
    )
    return spans.select(
        "product_id", F.explode(dates.calendar(F.col("first"), F.col("last"), unit)).alias("bucket")
    )


for _unit, _name, _step in (
    ("month", "calendar_months", "1 month"),
    ("quarter", "calendar_quarters", "3 month"),
):

    @register(
        _name,
        with_tables(
            f"""SELECT product_id, CAST(unnest(generate_series(date_trunc('{_unit}', first),
                       date_trunc('{_unit}', last), INTERVAL '{_step}')) AS DATE) AS bucket
                FROM (SELECT product_id, min(created_date) AS first, max(created_date) AS last
                      FROM lines GROUP BY product_id)"""
        ),
    )
    def _(market, unit=_unit):
        return _calendar(market, unit)


@register(
    "quarter_label",
    with_tables(
        "SELECT DISTINCT CAST(created_date AS DATE) AS day, 'Q' || quarter(created_date) || ' ' ||"
        " strftime(created_date, '%Y') AS label FROM lines"
    ),
)
def _(market):
    days = market.lines().select(F.col("created_date").cast("date").alias("day")).distinct()
    return days.withColumn("label", dates.quarter_label(F.col("day")))


@register(
    "week_label",
    with_tables(
        "SELECT DISTINCT CAST(created_date AS DATE) AS day, strftime(created_date, '%Y-%m-%d') || ' (Week ' ||"
        " strftime(created_date, '%V') || ')' AS label FROM lines"
    ),
)
def _(market):
    days = market.lines().select(F.col("created_date").cast("date").alias("day")).distinct()
    return days.withColumn("label", dates.week_label(F.col("day")))


@register("deepest_category", with_tables("SELECT product_id, category FROM categories"))
def _(market):
    return market.product_categories().withColumnRenamed("category_name", "category")


def _product_halves(market):
    def bought(column, period):
        return F.sum(F.when(period.holds(F.col("updated_date")), F.col(column)).otherwise(0))

    return (
        market.lines()
        .groupBy("product_id")
        .agg(
            bought("amount_units", LATER_HALF).alias("curr_amount"),
            bought("qty_units", LATER_HALF).alias("curr_qty"),
            bought("amount_units", EARLIER_HALF).alias("prev_amount"),
        )
    )


PRODUCT_HALVES = ", ".join(
    f"sum(CASE WHEN {within('updated_date', period)} THEN {column} ELSE 0 END) AS {name}"
    for name, column, period in (
        ("ca", "total_amount", LATER_HALF),
        ("cq", "qty", LATER_HALF),
        ("pa", "total_amount", EARLIER_HALF),
    )
)


@register(
    "pct_change",
    with_tables(
        f"SELECT product_id, {pct('ca', 'pa')} AS change_pct"
        f" FROM (SELECT product_id, {PRODUCT_HALVES} FROM lines GROUP BY product_id)"
    ),
)
def _(market):
    change = pct_change(F.col("curr_amount"), F.col("prev_amount")).alias("change_pct")
    return _product_halves(market).select("product_id", change)


@register(
    "safe_ratio",
    with_tables(
        f"SELECT product_id, {ratio('ca', 'cq')} AS price_per_unit"
        f" FROM (SELECT product_id, {PRODUCT_HALVES} FROM lines GROUP BY product_id)"
    ),
)
def _(market):
    price = safe_ratio(F.col("curr_amount"), F.col("curr_qty")).alias("price_per_unit")
    return _product_halves(market).select("product_id", price)
