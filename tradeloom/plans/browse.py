"""Looking through insight documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.params import COMPARISONS, PRIORITIES
from tradeloom.plans.insights import priority_order

# The names shown for entity types and comparison types.
SHOWN_TYPES = {"Buyers": "buyer", "Sellers": "seller"}
SHOWN_COMPARISONS = {"Historical": "self", "Platform": "benchmark", "Combined": "both"}
ALL = "All"
DOCUMENT = ["entity_type", "entity_id", "generated_at"]


def latest_per_entity(docs: DataFrame) -> DataFrame:
    """The newest document of each entity."""
    newest = docs.groupBy("entity_type", "entity_id").agg(
        F.max_by(F.struct(*docs.columns), "generated_at").alias("doc")
    )
    return newest.select("doc.*")


def filter_documents(docs: DataFrame, shown_type: str = ALL) -> DataFrame:
    if shown_type not in SHOWN_TYPES:
        return docs
    return docs.filter(F.col("entity_type") == SHOWN_TYPES[shown_type])


def insight_rows(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENT, F.posexplode("insights").alias("position", "i")).select(
        *DOCUMENT, "position", "i.*"
    )


def filter_insights(insights: DataFrame, shown_priority: str = ALL, shown_comparison: str = ALL) -> DataFrame:
    if shown_priority != ALL:
        insights = insights.filter(F.initcap("priority") == shown_priority)
    if shown_comparison != ALL:
        wanted = SHOWN_COMPARISONS.get(shown_comparison)
        insights = insights.filter(F.col("comparison_type") == F.lit(wanted))
    return insights


def order_insights(insights: DataFrame) -> DataFrame:
    """Per document: high, medium, low; within a priority as they stand."""
    return insights.orderBy(*DOCUMENT, priority_order(), "position")


def insight_counts(docs: DataFrame) -> DataFrame:
    def count(field: str, value: str):
        return F.size(F.filter("insights", lambda i: i[field] == value))

    return docs.select(
        *DOCUMENT,
        F.size("insights").alias("insights_count"),
        *(count("priority", p).alias(f"{p}_count") for p in PRIORITIES),
        *(count("comparison_type", c).alias(f"{c}_count") for c in COMPARISONS),
    )


def browse_overview(docs: DataFrame) -> DataFrame:
    """Documents, insights, high-priority insights and insights per document."""
    totals = docs.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum("insights_count"), F.lit(0)).alias("total_insights"),
        F.coalesce(F.sum("high_priority_count"), F.lit(0)).alias("high_priority"),
    )
    average = F.coalesce(F.try_divide("total_insights", "documents"), F.lit(0.0))
    return totals.withColumn("avg_per_document", F.round(average, 1))
