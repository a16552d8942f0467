"""Platform statistics over all entities of a type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.numeric import WIDE, safe_ratio
from tradeloom.operators.quantiles import exact_quantiles
from tradeloom.plans.registry import plan_of
from tradeloom.session import written

# The published percentiles of spend, and the digits kept of each statistic.
PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
DIGITS = 4
METRICS = ("period_spend", "counterparties")


def entity_values(overview: DataFrame, entity_type: str) -> DataFrame:
    """Spend and counterparties of each entity; missing values count as zero."""
    plan = plan_of(entity_type)

    def value(column: str):
        return F.coalesce(F.col(column).cast("double"), F.lit(0.0))

    return overview.select(
        F.col(plan.id_column).alias("entity_id"),
        value(plan.spend_column).alias("period_spend"),
        value(plan.counterparty_column).alias("counterparties"),
    )


def _spread(values: DataFrame) -> DataFrame:
    """Mean and population deviation of the entities, and totals of what belongs to no entity.

    The totals are NULL when every row has its entity. Orders are in no overview, so their total is
    zero where the totals exist.
    """
    known, unknown = F.col("entity_id").isNotNull(), F.col("entity_id").isNull()

    def mean(metric: str):
        # Of decimals, so that it does not depend on the order of adding.
        total = F.sum(F.when(known, F.col(metric).cast(WIDE)))
        return safe_ratio(total, F.count_if(known), DIGITS, WIDE)

    def total(metric: str):
        return F.sum(F.when(unknown, F.col(metric)))

    return values.agg(
        F.count_if(known).alias("total_count"),
        *(mean(m).alias(f"avg_{m}") for m in METRICS),
        total("period_spend").alias("platform_total_spend"),
        F.sum(F.when(unknown, F.lit(0.0))).alias("platform_total_orders"),
        total("counterparties").alias("platform_total_counterparties"),
    )


def _deviation(values: DataFrame, spread: DataFrame) -> DataFrame:
    """Population deviations from the known means, whose squares are summed as decimals and so in any order alike."""
    one = F.lit(1).alias("one")
    known = values.filter(F.col("entity_id").isNotNull()).select(one, *METRICS)
    means = spread.select(one, *(F.col(f"avg_{m}").cast(WIDE).alias(f"mean_{m}") for m in METRICS))

    def deviation(metric: str):
        apart = F.col(metric).cast(WIDE) - F.col(f"mean_{metric}")
        squares = F.sum((apart * apart).cast("decimal(38,8)")).cast("double")
        return F.round(F.sqrt(squares / F.count(F.lit(1))), DIGITS)

    apart = known.join(F.broadcast(means), "one")  # the means are one row
    return apart.agg(*(deviation(m).alias(f"std_{m}") for m in METRICS))


def _quantile_columns(values: DataFrame) -> DataFrame:
    long = values.filter(F.col("entity_id").isNotNull()).select(F.expr(f"""
        inline(array({", ".join(f"struct('{m}' AS metric, {m} AS value)" for m in METRICS)}))
    """))
    quantiles = exact_quantiles(long, "metric", "value", list(PERCENTILES.values()))

    def pick(metric: str, probability: float):
        wanted = (F.col("metric") == metric) & (F.col("probability") == probability)
        return F.round(F.max(F.when(wanted, F.col("quantile"))), DIGITS)

    return quantiles.agg(
        *(pick(m, 0.5).alias(f"median_{m}") for m in METRICS),
        *(pick("period_spend", p).alias(name) for name, p in PERCENTILES.items()),
    )


def merge_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows that fill different columns, as one row per key."""
    return rows.groupBy(*keys).agg(*(F.max(c).alias(c) for c in rows.columns if c not in keys))


def platform_benchmarks(overview: DataFrame, entity_type: str) -> DataFrame:
    """One row of statistics, or none without entities. `overview` is read more than once."""
    values = entity_values(overview, entity_type)
    kind = F.lit(entity_type).alias("entity_type")
    spread = written(_spread(values), "spread")
    deviation = _deviation(values, spread).select(kind, "*")
    spread = spread.select(kind, "*")
    quantiles = _quantile_columns(values).select(kind, "*")
    merged = spread.unionByName(deviation, allowMissingColumns=True).unionByName(quantiles, allowMissingColumns=True)
    return merge_rows(merged, "entity_type").filter(F.col("total_count") > 0)
