"""Insights: how far an entity is from its own past and from the platform, by fixed rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom import params as rules
from tradeloom.functions.numeric import WIDE, pct_change, safe_ratio
from tradeloom.params import Period, QueryParams
from tradeloom.plans.registry import plan_of


@dataclass(frozen=True)
class Metric:
    """A column of the overview, the column of its period before, and its platform statistic."""

    column: str
    label: str
    previous: str | None = None
    additive: bool = False
    benchmark: str | None = None


METRICS = {
    "buyer": (
        Metric(
            "current_period_purchases", "Total spend", "previous_period_purchases", True, "period_spend"
        ),
        Metric("current_period_quantity", "Purchased quantity", "previous_period_quantity", True),
        Metric(
            "avg_purchase_per_supplier_current", "Spend per supplier", "avg_purchase_per_supplier_previous"
        ),
        Metric("avg_price_per_unit_current", "Price per unit", "avg_price_per_unit_previous"),
        Metric("items_purchased_current", "Distinct items", "items_purchased_previous"),
        Metric("suppliers_current", "Supplier count", "suppliers_previous", False, "counterparties"),
    ),
    "seller": (
        Metric("total_sales", "Total sales", None, True, "period_spend"),
        Metric("units_sold", "Units sold", None, True),
        Metric("average_order_value", "Average order value"),
        Metric("total_buyers", "Buyer count", None, False, "counterparties"),
        Metric("repeat_buyers", "Repeat buyers"),
        Metric("repeat_purchase_rate_pct", "Repeat purchase rate"),
    ),
}
BANDS = ("p25", "p50", "p75", "p90")


def current_vs_history(current: DataFrame, history: DataFrame, entity_type: str) -> DataFrame:
    """Current overview with the historic value of each metric beside it.

    An entity without history stays, marked by has_historical_data.
    """
    plan = plan_of(entity_type)
    metrics = METRICS[entity_type]
    past = history.filter(F.col(plan.id_column).isNotNull()).select(
        F.col(plan.id_column).alias("entity_id"),
        *(F.col(m.column).cast("double").alias(f"historic_{m.column}") for m in metrics),
        F.lit(True).alias("has_history"),
    )
    now = current.filter(F.col(plan.id_column).isNotNull()).withColumnRenamed(plan.id_column, "entity_id")
    return (
        now.join(past, "entity_id", "left")
        .withColumn("has_historical_data", F.col("has_history").isNotNull())
        .drop("has_history")
    )


def metric_rows(compared: DataFrame, entity_type: str, scale_history: float | None = None) -> DataFrame:
    """One row per entity and metric: current value and own past.

    The own past is the period before where the overview has it, else the history. History covers a
    longer window; `scale_history` (current days / history days) brings its additive metrics to the
    length of the current one.
    """

    def past(metric: Metric) -> Column:
        if metric.previous:
            return F.col(metric.previous).cast("double")
        historic = F.col(f"historic_{metric.column}")
        if scale_history is not None and metric.additive:
            historic = F.round(historic * scale_history, 4)
        return historic

    rows = F.array(
        *(
            F.struct(
                F.lit(m.column).alias("metric"),
                F.lit(m.label).alias("label"),
                F.lit(m.benchmark).cast("string").alias("benchmark"),
                F.col(m.column).cast("double").alias("current_value"),
                past(m).alias("own_past"),
            )
            for m in METRICS[entity_type]
        )
    )
    return compared.select(
        F.lit(entity_type).alias("entity_type"), "entity_id", "has_historical_data", F.inline(rows)
    )


def percentile_band(value: Column) -> Column:
    """Where the value lies between the platform's spend percentiles."""
    band = F.when(value < F.col("p25"), "below_p25")
    for lower, upper in zip(BANDS, BANDS[1:]):
        band = band.when(value < F.col(upper), f"{lower}_{upper}")
    return F.when(F.col("p25").isNotNull() & value.isNotNull(), band.otherwise("top_10_pct"))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    return safe_ratio(value - mean, deviation, 4, WIDE)


def deviations(rows: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Percentage from the own past, and from the platform's median and mean, with outlier marks."""

    def statistic(kind: str) -> Column:
        return F.when(F.col("benchmark") == "period_spend", F.col(f"{kind}_period_spend")).when(
            F.col("benchmark") == "counterparties", F.col(f"{kind}_counterparties")
        )

    current = F.col("current_value")
    is_spend = F.col("benchmark") == "period_spend"
    # One row per entity type.
    joined = rows.join(F.broadcast(benchmarks), "entity_type", "left").withColumns(
        {f"platform_{kind}": statistic(kind) for kind in ("median", "avg", "std")}
    )
    return joined.select(
        "entity_type",
        "entity_id",
        "has_historical_data",
        "metric",
        "label",
        "current_value",
        "own_past",
        "platform_median",
        pct_change(current, F.col("own_past"), WIDE).alias("self_deviation_pct"),
        pct_change(current, F.col("platform_median"), WIDE).alias("benchmark_deviation_pct"),
        pct_change(current, F.col("platform_avg"), WIDE).alias("mean_deviation_pct"),
        z_score(current, F.col("platform_avg"), F.col("platform_std")).alias("z_score"),
        F.when(is_spend, percentile_band(current)).alias("percentile_band"),
    ).withColumn("is_outlier", F.abs("z_score") > rules.OUTLIER_Z)


def _beyond(column: str, limit: int) -> Column:
    return F.coalesce(F.abs(column) > limit, F.lit(False))


def priority(own: str = "self_deviation_pct", platform: str = "benchmark_deviation_pct") -> Column:
    """A deviation must exceed a threshold, not merely reach it."""
    high = _beyond(own, rules.HIGH_SELF) | _beyond(platform, rules.HIGH_BENCHMARK)
    medium = _beyond(own, rules.MEDIUM_SELF) | _beyond(platform, rules.MEDIUM_BENCHMARK)
    return F.when(high, "high").when(medium, "medium").otherwise("low")


def comparison_type(own: str = "self_deviation_pct", platform: str = "benchmark_deviation_pct") -> Column:
    """Which of the two deviations exceeds its medium threshold; the own past if neither does."""
    own_moved = _beyond(own, rules.MEDIUM_SELF)
    platform_moved = _beyond(platform, rules.MEDIUM_BENCHMARK)
    return (
        F.when(own_moved & platform_moved, "both").when(platform_moved, "benchmark").otherwise("self")
    )


def classified(deviation_rows: DataFrame) -> DataFrame:
    magnitude = F.greatest(
        F.coalesce(F.abs("self_deviation_pct"), F.lit(0.0)),
        F.coalesce(F.abs("benchmark_deviation_pct"), F.lit(0.0)),
    )
    return deviation_rows.withColumns(
        {"priority": priority(), "comparison_type": comparison_type(), "magnitude": magnitude}
    )


def priority_order(column: str = "priority") -> Column:
    """High, medium, low; anything else counts as medium."""
    return F.when(F.col(column) == "high", 0).when(F.col(column) == "low", 2).otherwise(1)


def top_insights(classified_rows: DataFrame, target: int = rules.TARGET_INSIGHTS) -> DataFrame:
    """The most important metrics of each entity; an entity has one row per metric."""
    order = [priority_order(), F.col("magnitude").desc(), F.col("metric")]
    ranked = classified_rows.withColumn(
        "insight_rank",
        F.row_number().over(Window.partitionBy("entity_type", "entity_id").orderBy(*order)),
    )
    return ranked.filter(F.col("insight_rank") <= target).withColumn(
        "insight_rank", F.col("insight_rank").cast("bigint")
    )


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("decimal(38,2)").cast("string"), F.lit("unknown"))


def insight_records(top: DataFrame) -> DataFrame:
    """Fixed sentences around the figures of each insight."""
    kind = F.col("comparison_type")
    against = (
        F.when(kind == "both", "own past and platform")
        .when(kind == "benchmark", "the platform median")
        .otherwise("own past")
    )
    advice = (
        F.when(F.col("priority") == "high", "Look into this change now and agree on a corrective step.")
        .when(F.col("priority") == "medium", "Watch this figure and review it at the end of the period.")
        .otherwise("No action is needed; keep following this figure.")
    )
    observation = F.concat(
        F.col("label"), F.lit(" is "), _number("current_value"),
        F.lit(", own past "), _number("own_past"),
        F.lit(" ("), _number("self_deviation_pct"),
        F.lit("%), platform median "), _number("platform_median"),
        F.lit(" ("), _number("benchmark_deviation_pct"), F.lit("%)."),
    )
    return top.select(
        "entity_type",
        "entity_id",
        "has_historical_data",
        "insight_rank",
        F.concat(F.col("label"), F.lit(" against "), against).alias("title"),
        observation.alias("observation"),
        advice.alias("recommendation"),
        "priority",
        "comparison_type",
        F.array("metric").alias("metrics"),
    )


def insight_documents(records: DataFrame, params: QueryParams, generated_at: datetime) -> DataFrame:
    """One document per entity with its few insights and their counts."""
    fields = ["title", "observation", "recommendation", "priority", "comparison_type", "metrics"]
    ranked = F.struct("insight_rank", F.struct(*fields).alias("insight"))
    docs = records.groupBy("entity_type", "entity_id").agg(
        F.sort_array(F.collect_list(ranked)).alias("ranked"),
        F.max("has_historical_data").alias("has_historical_data"),
    )
    insights = F.transform("ranked", lambda r: r["insight"])

    def count(field: str, value: str) -> Column:
        return F.size(F.filter(insights, lambda i: i[field] == value))

    return docs.select(
        "entity_type",
        "entity_id",
        F.lit(generated_at).alias("generated_at"),
        F.struct(
            F.lit(params.period.start).alias("start_date"),
            F.lit(params.period.end).alias("end_date"),
            F.lit(params.top_n).alias("top_n"),
        ).alias("dashboard_period"),
        insights.alias("insights"),
        F.size(insights).alias("insights_count"),
        count("priority", "high").alias("high_priority_count"),
        F.struct(*(count("comparison_type", c).alias(c) for c in rules.COMPARISONS)).alias(
            "comparison_types"
        ),
        "has_historical_data",
    )


def history_scale(current: Period, history: Period, per_day: bool) -> float | None:
    return current.days / history.days if per_day else None


# Insights that come as text

INSIGHTS_SCHEMA = """insights array<struct<title:string,observation:string,recommendation:string,
    priority:string,comparison_type:string,metrics:array<string>>>"""


def parse_insights(responses: DataFrame, text: str) -> DataFrame:
    """Insights out of response texts, one row each with its place in the response.

    A fenced text holds its JSON between the first two fences, after an optional language tag. A text
    that is no JSON gives no rows.
    """
    body = F.trim(F.col(text), F.lit(" \t\r\n"))
    inside = F.get(F.split(body, "```"), F.lit(1))
    fenced = F.when(body.startswith("```"), F.regexp_replace(inside, "^json", "")).otherwise(body)
    insights = F.from_json(fenced, INSIGHTS_SCHEMA)["insights"]
    others = [c for c in responses.columns if c != text]
    return responses.select(*others, F.posexplode(insights).alias("position", "i")).select(
        *others, "position", "i.*"
    )


def reject_reason() -> Column:
    """The first rule an insight breaks, or NULL if it is valid."""
    title_length, observation_length = F.length("title"), F.length("observation")

    def missing(column: str) -> Column:
        return F.coalesce(F.length(column), F.lit(0)) == 0

    reason = F.when(missing("title"), "missing title")
    for column in ("observation", "recommendation", "priority", "comparison_type"):
        reason = reason.when(missing(column), f"missing {column}")
    shortest, longest = rules.TITLE_LENGTH
    return (
        reason.when((title_length < shortest) | (title_length > longest), "title length")
        .when(observation_length < rules.MIN_OBSERVATION_LENGTH, "observation length")
        .when(F.length("recommendation") < rules.MIN_RECOMMENDATION_LENGTH, "recommendation length")
        .when(~F.col("priority").isin(*rules.PRIORITIES), "unknown priority")
        .when(~F.col("comparison_type").isin(*rules.COMPARISONS), "unknown comparison_type")
        .when(F.coalesce(F.size("metrics"), F.lit(0)) > rules.MAX_METRICS, "too many metrics")
    )


def validate_insights(insights: DataFrame) -> DataFrame:
    """All insights with the reason for rejection, NULL for valid ones."""
    return insights.withColumn("reject_reason", reject_reason())


def valid_insights(insights: DataFrame) -> DataFrame:
    return validate_insights(insights).filter(F.col("reject_reason").isNull()).drop("reject_reason")
