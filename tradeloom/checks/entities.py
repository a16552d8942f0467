"""Active entities, documents, the written store and the platform statistics."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.checks.analytics import buyer_overview_ctes, seller_overview_ctes
from tradeloom.checks.base import LATER_HALF, ORACLES, WHOLE, money, ratio, register, with_tables, within
from tradeloom.params import Period, QueryParams, dashboard_params, history_params
from tradeloom.plans import buyer, runs
from tradeloom.plans.benchmarks import platform_benchmarks
from tradeloom.plans.entities import (
    active_entities,
    batch_summary,
    documents,
    entity_lines,
    first_entities,
    select_batch,
)
from tradeloom.plans.registry import plan_of, run_query
from tradeloom.plans.store import Store
from tradeloom.session import shared_folder
from tradeloom.sources.tables import Marketplace

NOW = datetime(2001, 12, 31, 12, 0)
CURRENT = {
    "buyer": QueryParams(LATER_HALF, 10),
    "seller": QueryParams(LATER_HALF, 20),
}
HISTORY = {
    "buyer": QueryParams(WHOLE, 20),
    "seller": QueryParams(WHOLE, 30, "month"),
}
ID = {"buyer": "buyer_org_id", "seller": "seller_org_id"}
CLOCK = {"buyer": "updated_date", "seller": "created_date"}


STATISTICS = {"buyer": ("h_buyer_overview", "buyer_org_id", "current_period_purchases", "suppliers_current"),
              "seller": ("h_seller_overview", "vendor_id", "total_sales", "total_buyers")}


def active_sql(entity_type: str) -> str:
    column, clock = ID[entity_type], CLOCK[entity_type]
    return (
        f"SELECT DISTINCT {column} AS entity_id FROM lines"
        f" WHERE {column} IS NOT NULL AND {within(clock, LATER_HALF)}"
    )


def history_ctes() -> dict[str, str]:
    return {
        **buyer_overview_ctes(WHOLE, "h_"),
        **seller_overview_ctes(WHOLE, p="h_"),
    }


def _store(market, name: str) -> Store:
    """A store of its own for each call that writes."""
    return Store(market.spark, f"{shared_folder(market.spark)}/tradeloom/{name}-{uuid.uuid4().hex}")


def _filled(market, name: str, **params: QueryParams) -> Store:
    store = _store(market, name)
    if 0 in store.sync(market, params, NOW).values():
        raise RuntimeError(f"sync failed: {store.latest_sync().first()}")
    return store


_synced: dict[tuple[str, str], Store] = {}


def synced_store(market) -> Store:
    """The store that one sync per session and table folder fills; queries that share it only read."""
    key = (market.spark.sparkContext.applicationId, market.origin)
    if key not in _synced:
        _synced[key] = _filled(market, "synced", **HISTORY)
    return _synced[key]


def positions(ordered, *keys: str):
    """Adds `position`, the place of each row among those of its keys as an ordered frame holds them."""
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    return numbered.withColumn("position", place.cast("bigint")).drop("_at")


# Active entities


for _type in ("buyer", "seller"):

    @register(f"active_{_type}s", with_tables(active_sql(_type)))
    def _(market, kind=_type):
        return active_entities(market, kind, LATER_HALF)


@register(
    "list_entities",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS entity_type, {key} AS entity_id FROM {overview} WHERE {key} IS NOT NULL"
            for kind, (overview, key, _, _) in STATISTICS.items()
        ),
        **history_ctes(),
    ),
)
def _(market):
    store = synced_store(market)
    listed = [store.entities(kind).select(F.lit(kind).alias("entity_type"), "entity_id") for kind in HISTORY]
    return listed[0].unionByName(listed[1])


@register("limit_entities", with_tables(f"SELECT * FROM ({active_sql('buyer')}) ORDER BY entity_id LIMIT 25"))
def _(market):
    return first_entities(active_entities(market, "buyer", LATER_HALF), 25)


# The entities asked for in a batch; some of them have no lines.
BATCH = tuple(range(60, 260))


@register(
    "select_batch",
    with_tables(
        f"""SELECT entity_id, CASE WHEN entity_id IN (SELECT entity_id FROM ({active_sql('seller')}))
                   THEN 'success' ELSE 'error' END AS status
            FROM (SELECT CAST(unnest(generate_series({BATCH[0]}, {BATCH[-1]})) AS BIGINT) AS entity_id)"""
    ),
)
def _(market):
    return select_batch(market.spark, BATCH, active_entities(market, "seller", LATER_HALF))


@register(
    "batch_summary",
    with_tables(
        f"""SELECT {len(BATCH)} AS total, count(*) AS successful, {len(BATCH)} - count(*) AS failed
            FROM ({active_sql('seller')}) WHERE entity_id BETWEEN {BATCH[0]} AND {BATCH[-1]}"""
    ),
)
def _(market):
    return batch_summary(select_batch(market.spark, BATCH, active_entities(market, "seller", LATER_HALF)))


# Documents


def _document_summary(docs):
    """What the documents hold, without the text of their rows."""
    return docs.groupBy("entity_type", "entity_id", "query").agg(
        F.max("result_count").alias("result_count"),
        F.sum(F.size("data")).alias("rows_held"),
        F.max(F.col("error").isNotNull()).alias("failed"),
    )


def row_counts(kind: str, params: QueryParams) -> dict[str, str]:
    """Rows of each query and entity, as the plain queries give them."""
    period, n = params.period, params.top_n
    months = (period.end.year - period.start.year) * 12 + period.end.month - period.start.month + 1
    quarters = (period.end.month - 1) // 3 - (period.start.month - 1) // 3 + 1
    quarters += 4 * (period.end.year - period.start.year)

    def bought(count: str, lines: str = "lines", span: Period = period) -> str:
        return f"""SELECT buyer_org_id AS entity_id, {count} AS n FROM {lines}
                   WHERE {within('updated_date', span)} GROUP BY buyer_org_id"""

    def sold(count: str, lines: str = "lines") -> str:
        return f"""SELECT seller_org_id AS entity_id, {count} AS n FROM {lines}
                   WHERE {within('created_date', period)} GROUP BY seller_org_id"""

    owned = "lines JOIN categories c ON c.product_id = lines.product_id AND c.org_id = seller_org_id"
    by_kind = {
        "buyer": {
            "overview_metrics": bought("1", span=Period(period.previous.start, period.end)),
            "top_products": bought(f"least({n}, count(DISTINCT product_id))"),
            "top_suppliers": bought(f"least({n}, count(DISTINCT coalesce(seller_org_id, -1)))"),
            "top_categories": bought(f"least({n}, count(DISTINCT coalesce(category, '')))", owned),
        },
        "seller": {
            "performance_overview": sold("1"),
            "monthly_trends": sold(f"{months}"),
            "quarterly_trends": sold(f"{quarters}"),
            "product_line_breakdown": sold(
                "count(DISTINCT coalesce(category, 'Unknown'))", "lines LEFT JOIN categories USING (product_id)"
            ),
            "sales_time_series": sold(
                "count(DISTINCT date_trunc('month', created_date))" if params.time_resolution else "0"
            ),
            "top_selling_products": f"""
                SELECT v AS entity_id, count(*) FILTER (rank <= {n} AND id IS NOT NULL) AS n
                FROM (SELECT seller_org_id AS v, product_id,
                             row_number() OVER (PARTITION BY seller_org_id
                                                ORDER BY sum(total_amount) DESC NULLS FIRST, product_id) AS rank
                      FROM lines WHERE {within('created_date', period)} GROUP BY seller_org_id, product_id)
                LEFT JOIN vendor_products ON id = product_id GROUP BY v""",
            "regional_distribution": sold(
                "count(DISTINCT coalesce(city, 'Unknown'))",
                "lines LEFT JOIN user_address a ON a.id = shipping_address",
            ),
            "order_analysis": sold("count(DISTINCT po_id)"),
        },
    }
    return by_kind[kind]


def document_ctes(kind: str, params: QueryParams, ids: str, p: str = "") -> dict[str, str]:
    counts = row_counts(kind, params)
    no_series = "false" if params.time_resolution else "query = 'sales_time_series'"
    return {
        f"{p}ids": ids,
        f"{p}counts": " UNION ALL ".join(
            f"SELECT '{name}' AS query, entity_id, n FROM ({sql})" for name, sql in counts.items()
        ),
        f"{p}documents": f"""
            SELECT '{kind}' AS entity_type, entity_id, query, coalesce(n, 0) AS result_count,
                   coalesce(n, 0) AS rows_held, {no_series} AS failed
            FROM (SELECT entity_id, unnest([{", ".join(f"'{q}'" for q in counts)}]) AS query FROM {p}ids)
                 LEFT JOIN {p}counts USING (entity_id, query)""",
    }


def document_sql(kind: str) -> str:
    return with_tables("SELECT * FROM d_documents", **document_ctes(kind, CURRENT[kind], active_sql(kind), "d_"))


for _type in ("buyer", "seller"):

    @register(f"dashboard_documents_{_type}", document_sql(_type))
    def _(market, kind=_type):
        return _document_summary(_dashboards(market, kind))


PER_PART = 100


def _dashboards(market, kind: str):
    """Documents of small parts, so that larger entities have several."""
    root = _store(market, f"dashboards_{kind}").root
    runs.write_rows(market, kind, CURRENT[kind], root)
    rows = market.spark.read.parquet(f"{root}/rows")
    ids = active_entities(market, kind, LATER_HALF)
    return documents(ids, rows, kind, CURRENT[kind], NOW, rows_per_part=PER_PART)


ORDERED_VALUES = f"""
    SELECT seller_org_id AS entity_id, CAST(row_number() OVER (
             PARTITION BY seller_org_id ORDER BY sum(total_amount) DESC NULLS FIRST) - 1 AS BIGINT) AS position,
           {money('sum(total_amount)')} AS value
    FROM lines WHERE {within('created_date', LATER_HALF)} GROUP BY seller_org_id, po_id"""


@register(
    "document_rows",
    with_tables(
        f"""
        SELECT 'order_analysis' AS query, entity_id, position, '' AS name, value FROM ({ORDERED_VALUES})
        WHERE entity_id IS NOT NULL
        UNION ALL
        SELECT 'top_suppliers', buyer_org_id, CAST(rank - 1 AS BIGINT), coalesce(company_name, ''),
               {money('total')} FROM (
          SELECT buyer_org_id, seller_org_id, sum(total_amount) AS total,
                 row_number() OVER (PARTITION BY buyer_org_id
                                    ORDER BY sum(total_amount) DESC NULLS FIRST, seller_org_id NULLS LAST) AS rank
          FROM lines WHERE {within('updated_date', LATER_HALF)} GROUP BY buyer_org_id, seller_org_id)
        LEFT JOIN organization ON org_id = seller_org_id
        WHERE rank <= {CURRENT['buyer'].top_n} AND buyer_org_id IS NOT NULL"""
    ),
)
def _(market):
    """What the documents' rows hold, and where: over all parts in sequence."""

    def held(kind, query, name, value):
        docs = _dashboards(market, kind).filter(F.col("query") == query)
        rows = docs.select("entity_id", "part", F.posexplode("data").alias("place", "row"))
        text = F.coalesce(F.variant_get("row", f"$.{name}", "string"), F.lit("")) if name else F.lit("")
        return rows.select(
            F.lit(query).alias("query"),
            "entity_id",
            (F.col("part").cast("bigint") * PER_PART + F.col("place")).alias("position"),
            text.alias("name"),
            F.variant_get("row", f"$.{value}", "double").alias("value"),
        )

    orders = held("seller", "order_analysis", None, "order_value")
    return orders.unionByName(held("buyer", "top_suppliers", "company_name", "total_purchase_amount"))


@register("presentation_order", with_tables(ORDERED_VALUES))
def _(market):
    ordered = run_query(market, "seller", "order_analysis", CURRENT["seller"], ordered=True)
    placed = positions(ordered, "vendor_id")
    return placed.select(F.col("vendor_id").alias("entity_id"), "position", F.col("order_value").alias("value"))


TODAY = date(2001, 12, 31)
# Days back and rank limits of the two kinds of window.
WINDOWS = (("dashboard", 90, {"buyer": 10, "seller": 20}), ("history", 365, {"buyer": 20, "seller": 30}))


@register(
    "default_windows",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{use}' AS used_for, '{kind}' AS entity_type, {n} AS top_n, count(*) AS lines_read
                FROM lines WHERE {ID[kind]} IS NOT NULL
                 AND CAST({CLOCK[kind]} AS DATE) BETWEEN DATE '{TODAY}' - {days} AND DATE '{TODAY}'"""
            for use, days, limits in WINDOWS
            for kind, n in limits.items()
        )
    ),
)
def _(market):
    parts = []
    for use, build in (("dashboard", dashboard_params), ("history", history_params)):
        for kind in ID:
            params = build(kind, TODAY)
            parts.append(
                entity_lines(market, kind, params.period).agg(
                    F.lit(use).alias("used_for"),
                    F.lit(kind).alias("entity_type"),
                    F.lit(params.top_n).alias("top_n"),
                    F.count("*").alias("lines_read"),
                )
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@register(
    "write_dashboard_docs",
    with_tables(
        f"""SELECT entity_type, query, count(*) AS documents, CAST(sum(rows_held) AS BIGINT) AS rows_held
            FROM d_documents GROUP BY ALL""",
        **document_ctes("buyer", CURRENT["buyer"], active_sql("buyer"), "d_"),
    ),
)
def _(market):
    """Through the store's own sink, twice: a repeated run replaces its documents."""
    store = _store(market, "dashboard_docs")
    runs.write_rows(market, "buyer", CURRENT["buyer"], store.root)
    rows = market.spark.read.parquet(f"{store.root}/rows")
    ids = active_entities(market, "buyer", LATER_HALF)
    for _ in range(2):
        store.write_dashboards(documents(ids, rows, "buyer", CURRENT["buyer"], NOW), "buyer", "run")
    return (
        store.dashboards("run")
        .groupBy("entity_type", "query")
        .agg(F.count("*").alias("documents"), F.sum(F.size("data")).alias("rows_held"))
    )


# Platform statistics

def benchmark_sql(entity_type: str) -> str:
    overview, key, spend, parties = STATISTICS[entity_type]

    def mean(value: str) -> str:
        total = f"sum(CAST({value} AS DECIMAL(24,4))) FILTER ({key} IS NOT NULL)"
        return ratio(total, f"count({key})", 4)

    return f"""
        SELECT '{entity_type}' AS entity_type, count({key}) AS total_count,
               {mean('s')} AS avg_period_spend, {mean('c')} AS avg_counterparties,
               round(stddev_pop(s) FILTER ({key} IS NOT NULL), 4) AS std_period_spend,
               round(stddev_pop(c) FILTER ({key} IS NOT NULL), 4) AS std_counterparties,
               sum(s) FILTER ({key} IS NULL) AS platform_total_spend,
               CASE WHEN count(*) > count({key}) THEN CAST(0 AS DOUBLE) END AS platform_total_orders,
               sum(c) FILTER ({key} IS NULL) AS platform_total_counterparties,
               round(quantile_cont(s, 0.5) FILTER ({key} IS NOT NULL), 4) AS median_period_spend,
               round(quantile_cont(c, 0.5) FILTER ({key} IS NOT NULL), 4) AS median_counterparties,
               round(quantile_cont(s, 0.25) FILTER ({key} IS NOT NULL), 4) AS p25,
               round(quantile_cont(s, 0.5) FILTER ({key} IS NOT NULL), 4) AS p50,
               round(quantile_cont(s, 0.75) FILTER ({key} IS NOT NULL), 4) AS p75,
               round(quantile_cont(s, 0.9) FILTER ({key} IS NOT NULL), 4) AS p90
        FROM (SELECT {key}, coalesce({spend}, 0) AS s, CAST(coalesce({parties}, 0) AS DOUBLE) AS c
              FROM {overview})"""


for _type in ("buyer", "seller"):

    @register(f"platform_benchmarks_{_type}", with_tables(benchmark_sql(_type), **history_ctes()))
    def _(market, kind=_type):
        return platform_benchmarks(synced_store(market).overview(kind), kind)


@register(
    "platform_summary_row",
    with_tables(
        " UNION ALL ".join(
            f"SELECT entity_type, platform_total_spend, platform_total_orders, platform_total_counterparties"
            f" FROM ({benchmark_sql(kind)})"
            for kind in ("buyer", "seller")
        ),
        **history_ctes(),
    ),
)
def _(market):
    columns = ["entity_type", *(f"platform_total_{c}" for c in ("spend", "orders", "counterparties"))]
    found = [
        platform_benchmarks(synced_store(market).overview(kind), kind).select(columns)
        for kind in ("buyer", "seller")
    ]
    return found[0].unionByName(found[1])


# Written store


@register(
    "write_history",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS entity_type, {key} AS entity_id, 1 AS overview_rows,"
            f" CAST({spend} AS DOUBLE) AS spend FROM {overview} WHERE {key} IS NOT NULL"
            for kind, (overview, key, spend, _) in STATISTICS.items()
        ),
        **history_ctes(),
    ),
)
def _(market):
    store = _filled(market, "history", **HISTORY)

    def held(kind):
        plan = plan_of(kind)
        rows = store.overview(kind).filter(F.col(plan.id_column).isNotNull())
        return rows.groupBy(F.lit(kind).alias("entity_type"), F.col(plan.id_column).alias("entity_id")).agg(
            F.count("*").alias("overview_rows"), F.max(plan.spend_column).alias("spend")
        )

    return held("buyer").unionByName(held("seller"))


@register("buyer_overview_first_dates", ORACLES["buyer_overview_metrics"])
def _(market):
    """First dates kept from two batches of lines, the first of them added twice as after a failure."""
    store, lines = _store(market, "first_dates"), market.lines()
    early = F.col("created_date") < F.lit(date(1999, 6, 1))
    for batch, part in (("1", lines.filter(early)), ("1", lines.filter(early)), ("2", lines.filter(~early))):
        store.add_first_dates(part, batch)
    return buyer.overview(market, QueryParams(LATER_HALF), store.first_dates())


def _before_changes(market) -> Marketplace:
    """The marketplace as it might have been: later items are missing, some amounts differ, some lines are there twice,
    some orders came through another channel."""

    def items():
        rows = market.po_items
        some = F.col("product_id") % 7 == 0
        early = rows.filter("created_date < DATE '1999-06-01'")
        early = early.withColumn("amount_units", F.when(some, F.col("amount_units") * 2).otherwise(F.col("amount_units")))
        return early.unionByName(rows.filter(F.col("product_id") % 11 == 0))

    def details():
        other = F.when(F.col("buyer_org_id") % 5 == 0, F.lit("other")).otherwise(F.col("source"))
        return market.po_details.withColumn("source", other)

    names = ("vendor_products", "user_address", "organization")
    tables = {"po_items": items, "po_details": details} | {n: (lambda n=n: getattr(market, n)) for n in names}
    return Marketplace(market.spark, tables, origin=market.origin, scale=market.scale)


def _store_in_steps(market, name: str, distincts: bool = False) -> Store:
    """Lines staged from an earlier state of the sources and then brought up to date twice, the second time for nothing."""
    store = _store(market, name)
    store.stage(_before_changes(market))
    if distincts:
        store.update_distincts()
    if not store.stage(market) or store.stage(market):
        raise RuntimeError("the second step changes lines, the third none")
    if distincts and (not store.update_distincts() or store.update_distincts()):
        raise RuntimeError("the sets follow the lines once")
    return store


def _synced_in_steps(market, name: str) -> Marketplace:
    return _store_in_steps(market, name).lines(market)


@register(
    "staged_in_steps",
    with_tables(
        "SELECT po_id, product_id, CAST(qty AS DOUBLE) AS qty, CAST(total_amount AS DOUBLE) AS total_amount,"
        " buyer_org_id, seller_org_id, source, shipping_address, CAST(created_date AS DATE) AS created_date,"
        " CAST(updated_date AS DATE) AS updated_date, CAST(po_created_date AS DATE) AS po_created_date FROM lines"
    ),
)
def _(market):
    dates = [F.col(c).cast("date").alias(c) for c in ("created_date", "updated_date", "po_created_date")]
    amounts = [market.units(F.col(c)).alias(n) for c, n in (("qty_units", "qty"), ("amount_units", "total_amount"))]
    of_order = ("buyer_org_id", "seller_org_id", "source", "shipping_address")
    return _synced_in_steps(market, "steps").lines().select("po_id", "product_id", *amounts, *of_order, *dates)


RESOLUTIONS = ("month", "quarter", "year")
COUNTED = (("product", "product_id"), ("buyer", "buyer_org_id"))


@register(
    "distinct_counts_in_steps",
    with_tables(
        " UNION ALL ".join(
            f"SELECT seller_org_id AS vendor_id, '{kind}' AS kind, '{resolution}' AS resolution,"
            f" CAST(date_trunc('{resolution}', created_date) AS DATE) AS bucket, count(DISTINCT {column}) AS n"
            f" FROM lines WHERE {column} IS NOT NULL GROUP BY ALL"
            for kind, column in COUNTED
            for resolution in RESOLUTIONS
        )
    ),
)
def _(market):
    """Months, quarters and years from the sets of the months, kept through a change of the sources."""
    store = _store_in_steps(market, "steps_sets", distincts=True)
    found = [store.distinct_counts(r).withColumn("resolution", F.lit(r)) for r in RESOLUTIONS]
    return reduce(DataFrame.unionByName, found)


@register("buyer_overview_in_steps", ORACLES["buyer_overview_metrics"])
def _(market):
    """The first dates are those that the steps kept, of corrected, late and vanished lines."""
    staged = _synced_in_steps(market, "steps_dates")
    if staged.first_dates is None:
        raise RuntimeError("no first dates are kept")
    return buyer.overview(staged, QueryParams(LATER_HALF))


@register(
    "entity_history",
    with_tables(
        "SELECT * FROM b_documents UNION ALL SELECT * FROM s_documents",
        **history_ctes(),
        **document_ctes(
            "buyer", HISTORY["buyer"], "SELECT buyer_org_id AS entity_id FROM h_buyer_overview"
            " WHERE buyer_org_id IS NOT NULL", "b_"
        ),
        **document_ctes(
            "seller", HISTORY["seller"], "SELECT vendor_id AS entity_id FROM h_seller_overview"
            " WHERE vendor_id IS NOT NULL", "s_"
        ),
    ),
)
def _(market):
    store = synced_store(market)
    docs = [_document_summary(store.history_documents(kind, HISTORY[kind], NOW)) for kind in HISTORY]
    return docs[0].unionByName(docs[1])


@register(
    "history_lookup",
    with_tables(
        f"""SELECT 'regional_distribution' AS query, seller_org_id AS entity_id, coalesce(city, 'Unknown') AS region,
                   {money('sum(total_amount)')} AS total_revenue
            FROM lines LEFT JOIN user_address a ON a.id = shipping_address
            WHERE seller_org_id = 7 GROUP BY seller_org_id, city"""
    ),
)
def _(market):
    rows = synced_store(market).history_lookup("seller", 7)
    regions = rows.filter(F.col("query") == "regional_distribution")
    return regions.select(
        "query", "entity_id", F.from_json("row", "region string, total_revenue double").alias("r")
    ).select("query", "entity_id", "r.*")


@register("upsert_benchmarks", with_tables(benchmark_sql("seller"), **history_ctes()))
def _(market):
    store = _store(market, "benchmarks")
    found = platform_benchmarks(synced_store(market).overview("seller"), "seller")
    store.write_benchmarks(found.withColumn("total_count", F.lit(0).cast("bigint")), NOW)
    store.write_benchmarks(found, NOW)
    return store.benchmarks("seller").drop("calculated_at")


@register(
    "benchmark_lookup",
    with_tables(
        f"SELECT entity_type, total_count, median_period_spend, p90 FROM ({benchmark_sql('buyer')})",
        **history_ctes(),
    ),
)
def _(market):
    found = synced_store(market).benchmark_lookup("buyer")
    return found.select("entity_type", "total_count", "median_period_spend", "p90")


HISTORY_COUNTS = {
    kind: f"(SELECT count({key}) FROM {overview})" for kind, (overview, key, _, _) in STATISTICS.items()
}


@register(
    "append_sync_log",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS entity_type, CAST({count} AS INT) AS entities_count, 'success' AS status,"
            " CAST(NULL AS VARCHAR) AS error_message"
            for kind, count in HISTORY_COUNTS.items()
        ),
        **history_ctes(),
    ),
)
def _(market):
    # A repeated sync logs the same again.
    log = synced_store(market).log()
    return log.select("entity_type", "entities_count", "status", "error_message").distinct()


@register(
    "store_health",
    with_tables(
        f"SELECT {HISTORY_COUNTS['buyer']} AS buyers, {HISTORY_COUNTS['seller']} AS sellers,"
        " 'success' AS last_status",
        **history_ctes(),
    ),
)
def _(market):
    return synced_store(market).health().drop("last_synced_at")


@register(
    "history_exists",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS entity_type, {count} AS entities, {count} > 0 AS present"
            for kind, count in HISTORY_COUNTS.items()
        ),
        **history_ctes(),
    ),
)
def _(market):
    store = synced_store(market)
    counts = [
        store.entities(kind).agg(
            F.lit(kind).alias("entity_type"),
            F.count("*").alias("entities"),
            F.lit(store.history_exists(kind)).alias("present"),
        )
        for kind in HISTORY
    ]
    return counts[0].unionByName(counts[1])


@register(
    "latest_sync",
    with_tables(
        f"SELECT 'seller' AS entity_type, 'success' AS status, {HISTORY_COUNTS['seller']} AS entities_count",
        **history_ctes(),
    ),
)
def _(market):
    newest = synced_store(market).latest_sync()
    return newest.select("entity_type", "status", F.col("entities_count").cast("bigint").alias("entities_count"))
