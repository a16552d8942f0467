"""Insight rules, documents and browsing, over the insights of all buyers and sellers."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from tradeloom.checks.analytics import buyer_overview_ctes, seller_overview_ctes
from tradeloom.checks.base import (
    LATER_HALF,
    ORACLES,
    QUERIES,
    WHOLE,
    fixed,
    pct,
    register,
    rounded_quotient,
    with_tables,
)
from tradeloom.checks.entities import (
    CURRENT,
    HISTORY,
    NOW,
    STATISTICS,
    _filled,
    _store,
    benchmark_sql,
    history_ctes,
    positions,
    synced_store,
)
from tradeloom.params import Period, QueryParams
from tradeloom.plans import browse, insights, runs
from tradeloom.plans.entities import whole_overview
from tradeloom.plans.registry import plan_of
from tradeloom.session import written

KINDS = ("buyer", "seller")
SCALE = insights.history_scale(LATER_HALF, WHOLE, per_day=True)


def union(parts):
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def overview(market, kind, period=LATER_HALF):
    """Of the lines that the sync has staged."""
    return whole_overview(synced_store(market).lines(market), kind, QueryParams(period))


def compared(market, kind, period=LATER_HALF):
    store = synced_store(market)
    return insights.current_vs_history(overview(market, kind, period), store.overview(kind), kind)


def deviation_rows(market, kind, period=LATER_HALF):
    rows = insights.metric_rows(compared(market, kind, period), kind, SCALE)
    return insights.deviations(rows, synced_store(market).benchmarks(kind))


def both(build):
    return lambda market: union([build(market, kind) for kind in KINDS])


# The same in SQL, from the plain overviews of both windows

CURRENT_OVERVIEW = {"buyer": "buyer_overview", "seller": "seller_overview"}


def metric_sql(kind: str) -> str:
    key = plan_of(kind).id_column
    history = STATISTICS[kind][0]
    parts = []
    for m in insights.METRICS[kind]:
        past = f"c.{m.previous}" if m.previous else f"h.{m.column}"
        if not m.previous and m.additive:
            past = f"round(CAST({past} * CAST({SCALE!r} AS DOUBLE) AS DECIMAL(38,8)), 4)"
        mark = f"'{m.benchmark}'" if m.benchmark else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"""SELECT '{kind}' AS entity_type, c.{key} AS entity_id, h.{key} IS NOT NULL AS has_historical_data,
                       '{m.column}' AS metric, '{m.label}' AS label, {mark} AS benchmark,
                       CAST(c.{m.column} AS DOUBLE) AS current_value, CAST({past} AS DOUBLE) AS own_past
                FROM {CURRENT_OVERVIEW[kind]} c LEFT JOIN {history} h ON h.{key} = c.{key}
                WHERE c.{key} IS NOT NULL"""
        )
    return " UNION ALL ".join(parts)


BAND_SQL = """
    CASE WHEN benchmark = 'period_spend' AND current_value IS NOT NULL THEN
         CASE WHEN current_value < p25 THEN 'below_p25' WHEN current_value < p50 THEN 'p25_p50'
              WHEN current_value < p75 THEN 'p50_p75' WHEN current_value < p90 THEN 'p75_p90'
              ELSE 'top_10_pct' END END"""


def insight_ctes(period: Period = LATER_HALF) -> dict[str, str]:
    def statistic(kind: str) -> str:
        return (
            f"CASE benchmark WHEN 'period_spend' THEN {kind}_period_spend"
            f" WHEN 'counterparties' THEN {kind}_counterparties END AS platform_{kind}"
        )

    distance = f"({fixed('current_value')} - {fixed('platform_avg')})"
    return {
        **history_ctes(),
        **buyer_overview_ctes(period),
        **seller_overview_ctes(period),
        "statistics": " UNION ALL ".join(benchmark_sql(kind) for kind in KINDS),
        "metrics": " UNION ALL ".join(metric_sql(kind) for kind in KINDS),
        "measured": f"""
            SELECT metrics.*, p25, p50, p75, p90, {statistic('median')}, {statistic('avg')}, {statistic('std')}
            FROM metrics LEFT JOIN statistics USING (entity_type)""",
        "deviating": f"""
            SELECT entity_type, entity_id, has_historical_data, metric, label, current_value, own_past,
                   platform_median, {pct('current_value', 'own_past')} AS self_deviation_pct,
                   {pct('current_value', 'platform_median')} AS benchmark_deviation_pct,
                   {pct('current_value', 'platform_avg')} AS mean_deviation_pct,
                   {rounded_quotient(distance, fixed('platform_std'), 4)} AS z_score,
                   {BAND_SQL} AS percentile_band
            FROM measured""",
        "judged": """
            SELECT *, CASE WHEN own > 30 OR platform > 50 THEN 'high'
                           WHEN own > 15 OR platform > 25 THEN 'medium' ELSE 'low' END AS priority,
                   CASE WHEN own > 15 AND platform > 25 THEN 'both' WHEN platform > 25 THEN 'benchmark'
                        ELSE 'self' END AS comparison_type,
                   greatest(own, platform) AS magnitude
            FROM (SELECT *, coalesce(abs(self_deviation_pct), 0) AS own,
                         coalesce(abs(benchmark_deviation_pct), 0) AS platform FROM deviating)""",
        "ranked": """
            SELECT *, row_number() OVER (
                       PARTITION BY entity_type, entity_id
                       ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'low' THEN 2 ELSE 1 END,
                                magnitude DESC, metric) AS insight_rank
            FROM judged""",
        "insight": """
            SELECT entity_type, entity_id, has_historical_data, insight_rank, metric, priority, comparison_type,
                   concat(label, ' against ', CASE comparison_type WHEN 'both' THEN 'own past and platform'
                          WHEN 'benchmark' THEN 'the platform median' ELSE 'own past' END) AS title,
                   concat(label, ' is ', shown(current_value), ', own past ', shown(own_past), ' (',
                          shown(self_deviation_pct), '%), platform median ', shown(platform_median), ' (',
                          shown(benchmark_deviation_pct), '%).') AS observation,
                   CASE priority WHEN 'high' THEN 'Look into this change now and agree on a corrective step.'
                        WHEN 'medium' THEN 'Watch this figure and review it at the end of the period.'
                        ELSE 'No action is needed; keep following this figure.' END AS recommendation
            FROM ranked WHERE insight_rank <= 6""",
    }


def insight_sql(body: str, period: Period = LATER_HALF) -> str:
    return with_shown(with_tables(body, **insight_ctes(period)))


def with_shown(sql: str) -> str:
    """Write out the text form of a figure, two decimals or a word."""
    return re.sub(
        r"shown\((\w+)\)", r"coalesce(CAST(CAST(\1 AS DECIMAL(38,2)) AS VARCHAR), 'unknown')", sql
    )


# Comparisons


@register(
    "current_vs_history",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{kind}' AS entity_type, c.{key} AS entity_id, c.{spend} AS current_value,
                       h.{spend} AS historic_value, h.{key} IS NOT NULL AS has_historical_data
                FROM {CURRENT_OVERVIEW[kind]} c LEFT JOIN {history} h ON h.{key} = c.{key}
                WHERE c.{key} IS NOT NULL"""
            for kind, (history, key, spend, _) in STATISTICS.items()
        ),
        **history_ctes(),
        **buyer_overview_ctes(LATER_HALF),
        **seller_overview_ctes(LATER_HALF),
    ),
)
@both
def _(market, kind):
    spend = plan_of(kind).spend_column
    return compared(market, kind).select(
        F.lit(kind).alias("entity_type"),
        "entity_id",
        F.col(spend).alias("current_value"),
        F.col(f"historic_{spend}").alias("historic_value"),
        "has_historical_data",
    )


def register_columns(name: str, *columns: str, source: str = "deviating"):
    keys = ["entity_type", "entity_id", "metric"]
    sql = insight_sql(f"SELECT {', '.join([*keys, *columns])} FROM {source}")

    def wrap(build):
        return register(name, sql)(lambda market: build(market).select(*keys, *columns))

    return wrap


@register_columns("self_deviation", "current_value", "own_past", "self_deviation_pct")
@both
def _(market, kind):
    return deviation_rows(market, kind)


@register_columns(
    "benchmark_deviation", "current_value", "benchmark_deviation_pct", "mean_deviation_pct"
)
@both
def _(market, kind):
    return deviation_rows(market, kind)


@register(
    "zscore_outlier",
    insight_sql(
        "SELECT entity_type, entity_id, metric, z_score, abs(z_score) > 2 AS is_outlier"
        " FROM deviating WHERE z_score IS NOT NULL"
    ),
)
@both
def _(market, kind):
    rows = deviation_rows(market, kind).filter(F.col("z_score").isNotNull())
    return rows.select("entity_type", "entity_id", "metric", "z_score", "is_outlier")


@register(
    "percentile_band",
    insight_sql(
        "SELECT entity_type, entity_id, percentile_band FROM deviating WHERE percentile_band IS NOT NULL"
    ),
)
@both
def _(market, kind):
    rows = deviation_rows(market, kind).filter(F.col("percentile_band").isNotNull())
    return rows.select("entity_type", "entity_id", "percentile_band")


@register_columns("classify_priority", "priority", "magnitude", source="judged")
@both
def _(market, kind):
    return insights.classified(deviation_rows(market, kind))


@register_columns("classify_comparison", "comparison_type", source="judged")
@both
def _(market, kind):
    return insights.classified(deviation_rows(market, kind))


@register(
    "top_insights_per_entity",
    insight_sql(
        "SELECT entity_type, entity_id, metric, priority, insight_rank FROM ranked WHERE insight_rank <= 5"
    ),
)
@both
def _(market, kind):
    top = insights.top_insights(insights.classified(deviation_rows(market, kind)), 5)
    return top.select("entity_type", "entity_id", "metric", "priority", "insight_rank")


# Documents


def records(market, kind, period=LATER_HALF):
    top = insights.top_insights(insights.classified(deviation_rows(market, kind, period)))
    return insights.insight_records(top)


def insight_docs(market, period=LATER_HALF, generated_at=NOW):
    return union(
        [
            insights.insight_documents(records(market, kind, period), CURRENT[kind], generated_at)
            for kind in KINDS
        ]
    )


INSIGHT_COLUMNS = ["title", "observation", "recommendation", "priority", "comparison_type"]


@register(
    "insight_documents",
    insight_sql(
        f"SELECT entity_type, entity_id, insight_rank - 1 AS position, {', '.join(INSIGHT_COLUMNS)} FROM insight"
    ),
)
def _(market):
    return browse.insight_rows(insight_docs(market)).select(
        "entity_type", "entity_id", F.col("position").cast("bigint").alias("position"), *INSIGHT_COLUMNS
    )


COUNTS_SQL = """
    SELECT entity_type, entity_id, count(*) AS insights_count,
           count(*) FILTER (priority = 'high') AS high_count, count(*) FILTER (priority = 'medium') AS medium_count,
           count(*) FILTER (priority = 'low') AS low_count, count(*) FILTER (comparison_type = 'self') AS self_count,
           count(*) FILTER (comparison_type = 'benchmark') AS benchmark_count,
           count(*) FILTER (comparison_type = 'both') AS both_count
    FROM insight GROUP BY ALL"""


@register("insight_counts", insight_sql(COUNTS_SQL))
def _(market):
    counts = browse.insight_counts(insight_docs(market)).drop("generated_at")
    return counts.select(
        "entity_type",
        "entity_id",
        *(F.col(c).cast("bigint").alias(c) for c in counts.columns if c.endswith("_count")),
    )


@register(
    "browse_overview",
    insight_sql(
        f"""SELECT count(*) AS documents, CAST(sum(insights_count) AS BIGINT) AS total_insights,
                   CAST(sum(high_count) AS BIGINT) AS high_priority,
                   round(sum(insights_count) / count(*), 1) AS avg_per_document FROM ({COUNTS_SQL})"""
    ),
)
def _(market):
    return browse.browse_overview(insight_docs(market))


@register(
    "filter_insights",
    insight_sql(
        "SELECT entity_type, entity_id, title, priority, comparison_type FROM insight"
        " WHERE priority = 'high' AND comparison_type = 'benchmark'"
    ),
)
def _(market):
    rows = browse.filter_insights(browse.insight_rows(insight_docs(market)), "High", "Platform")
    return rows.select("entity_type", "entity_id", "title", "priority", "comparison_type")


@register(
    "filter_documents",
    insight_sql("SELECT entity_id, count(*) AS insights_count FROM insight WHERE entity_type = 'seller' GROUP BY 1"),
)
def _(market):
    docs = browse.filter_documents(insight_docs(market), "Sellers")
    return docs.select("entity_id", F.col("insights_count").cast("bigint").alias("insights_count"))


@register(
    "order_insights",
    insight_sql(
        """SELECT entity_type, entity_id, priority, title, CAST(row_number() OVER (
                    PARTITION BY entity_type, entity_id
                    ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, insight_rank) - 1
                  AS BIGINT) AS position FROM insight"""
    ),
)
def _(market):
    rows = browse.order_insights(browse.insight_rows(insight_docs(market))).drop("position")
    placed = positions(rows, "entity_type", "entity_id")
    return placed.select("entity_type", "entity_id", "priority", "title", "position")


# The last quarter gives older documents, of fewer entities than the later half.
QUARTER = Period.of("2001-07-01", "2001-09-30")
EARLIER = datetime(2001, 9, 30, 12, 0)


def _newest_sql() -> str:
    return with_tables(
        """SELECT entity_type, entity_id, max(made) AS generated_on FROM
           (SELECT 'buyer' AS entity_type, buyer_org_id AS entity_id, DATE '2001-09-30' AS made
            FROM q_buyer_overview
            UNION ALL SELECT 'seller', vendor_id, DATE '2001-09-30' FROM q_seller_overview
            UNION ALL SELECT 'buyer', buyer_org_id, DATE '2001-12-31' FROM buyer_overview
            UNION ALL SELECT 'seller', vendor_id, DATE '2001-12-31' FROM seller_overview)
           WHERE entity_id IS NOT NULL GROUP BY ALL""",
        **buyer_overview_ctes(QUARTER, "q_"),
        **seller_overview_ctes(QUARTER, p="q_"),
        **buyer_overview_ctes(LATER_HALF),
        **seller_overview_ctes(LATER_HALF),
    )


@register("latest_insight_per_entity", _newest_sql())
def _(market):
    docs = insight_docs(market, QUARTER, EARLIER).unionByName(insight_docs(market))
    newest = browse.latest_per_entity(docs)
    return newest.select(
        "entity_type", "entity_id", F.col("generated_at").cast("date").alias("generated_on")
    )


def _written_insights(market):
    """A store whose own sink has written the documents, one type twice: a repeated run replaces them."""
    store, docs = _store(market, "insight_docs"), written(insight_docs(market), "insight-docs")  # read three times
    for kind in ("buyer", "seller", "buyer"):
        store.write_insights(docs.filter(F.col("entity_type") == kind), kind, "run")
    return store


@register("write_insight_docs", insight_sql(COUNTS_SQL))
def _(market):
    store = _written_insights(market)
    counts = browse.insight_counts(store.insights()).drop("generated_at")
    return counts.select(
        "entity_type",
        "entity_id",
        *(F.col(c).cast("bigint").alias(c) for c in counts.columns if c.endswith("_count")),
    )


@register(
    "read_insight_docs",
    insight_sql(
        f"SELECT entity_type, entity_id, insight_rank - 1 AS position, {', '.join(INSIGHT_COLUMNS)} FROM insight"
    ),
)
def _(market):
    store = _written_insights(market)
    return browse.insight_rows(store.insights()).select(
        "entity_type", "entity_id", F.col("position").cast("bigint").alias("position"), *INSIGHT_COLUMNS
    )


COUNTED_SELLERS = """SELECT entity_id, 'success' AS status, count(*) AS insights_count FROM insight
                     WHERE entity_type = 'seller' GROUP BY entity_id"""


@register("run_all_entities", insight_sql(COUNTED_SELLERS))
def _(market):
    store = _filled(market, "runs", seller=HISTORY["seller"])
    return runs.run_entities(store, market, "seller", CURRENT["seller"], NOW)


# Some of the sellers asked for have no lines.
ASKED = (3, 4, 7, 24, 49, 99_999)


@register(
    "run_batch",
    insight_sql(
        f"""SELECT entity_id, coalesce(status, 'error') AS status, coalesce(insights_count, 0) AS insights_count
            FROM (SELECT CAST(unnest([{", ".join(map(str, ASKED))}]) AS BIGINT) AS entity_id)
            LEFT JOIN ({COUNTED_SELLERS}) USING (entity_id)"""
    ),
)
def _(market):
    """Run twice for the same entities at the same time, as after a failure."""
    store = _filled(market, "batch", seller=HISTORY["seller"])
    for _ in range(2):
        status = runs.run_entities(store, market, "seller", CURRENT["seller"], NOW, entity_ids=ASKED)
    return status


# Insights that come as text: one per document, with fields of all kinds

ENUM = {
    "priority": ("high", "medium", "low", "urgent", None),
    "comparison_type": ("self", "benchmark", "both", "trend"),
}


def _choice(key: str, values) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {repr(v) if v is not None else 'CAST(NULL AS VARCHAR)'}" for i, v in enumerate(values)
    )
    return f"CASE {key} % {len(values)} {cases} END"


REASONS = """
    CASE WHEN coalesce(title, '') = '' THEN 'missing title'
         WHEN coalesce(observation, '') = '' THEN 'missing observation'
         WHEN coalesce(recommendation, '') = '' THEN 'missing recommendation'
         WHEN coalesce(priority, '') = '' THEN 'missing priority'
         WHEN coalesce(comparison_type, '') = '' THEN 'missing comparison_type'
         WHEN length(title) < 10 OR length(title) > 100 THEN 'title length'
         WHEN length(observation) < 20 THEN 'observation length'
         WHEN length(recommendation) < 20 THEN 'recommendation length'
         WHEN priority NOT IN ('high', 'medium', 'low') THEN 'unknown priority'
         WHEN comparison_type NOT IN ('self', 'benchmark', 'both') THEN 'unknown comparison_type'
         WHEN metric_count > 5 THEN 'too many metrics' END"""


def candidates(spark, folder):
    """Insight records made of the documents' texts and keys."""
    key = F.col("doc_id")

    def choice(values):
        return F.get(F.array(*(F.lit(v).cast("string") for v in values)), (key % len(values)).cast("int"))

    return spark.read.parquet(f"{folder}/documents.parquet").select(
        key.alias("entity_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("text").alias("observation"),
        F.when(key % 7 == 0, "").otherwise(F.col("text")).alias("recommendation"),
        choice(ENUM["priority"]).alias("priority"),
        choice(ENUM["comparison_type"]).alias("comparison_type"),
        F.transform(F.sequence(F.lit(0), (key % 8).cast("int")), lambda i: F.concat(F.lit("m"), i)).alias(
            "metrics"
        ),
    )


CANDIDATES = f"""
    SELECT doc_id AS entity_id, concat_ws(' ', source, lang) AS title, text AS observation,
           CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS recommendation,
           {_choice('doc_id', ENUM['priority'])} AS priority,
           {_choice('doc_id', ENUM['comparison_type'])} AS comparison_type,
           CAST(doc_id % 8 AS INT) + 1 AS metric_count
    FROM documents"""
ORACLES["validate_insights"] = (
    f"SELECT entity_id, title, priority, comparison_type, {REASONS} AS reject_reason FROM ({CANDIDATES})"
)


def _validate(spark, folder):
    return insights.validate_insights(candidates(spark, folder)).select(
        "entity_id", "title", "priority", "comparison_type", "reject_reason"
    )


QUERIES["validate_insights"] = _validate


def responses(spark, folder):
    """The records as response texts: plain, fenced, fenced with a tag, or cut off."""
    fields = ["title", "observation", "recommendation", "priority", "comparison_type", "metrics"]
    text = F.to_json(F.struct(F.array(F.struct(*fields)).alias("insights")))
    kind = F.col("entity_id") % 4
    return candidates(spark, folder).select(
        "entity_id",
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit(" ```json\n"), text, F.lit("\n``` ")))
        .otherwise(F.concat(F.lit("Here it is: "), text))
        .alias("response"),
    )


ORACLES["parse_insights"] = f"""
    SELECT entity_id, title, observation, priority, comparison_type, metric_count
    FROM ({CANDIDATES}) WHERE entity_id % 4 <> 3"""


def _parse(spark, folder):
    return insights.parse_insights(responses(spark, folder), "response").select(
        "entity_id", "title", "observation", "priority", "comparison_type", F.size("metrics").alias("metric_count")
    )


QUERIES["parse_insights"] = _parse
