"""Dense calendars per entity and growth from bucket to bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.dates import CALENDAR_MONTHS, bucket, period_calendar
from tradeloom.functions.numeric import pct_change
from tradeloom.params import Period


def entity_calendar(entities: DataFrame, period: Period, resolution: str, name: str) -> DataFrame:
    """Every entity with every bucket of the period, without a join."""
    return entities.withColumn(name, F.explode(period_calendar(period, resolution)))


def on_calendar(facts: DataFrame, entity: str, name: str, period: Period, resolution: str) -> DataFrame:
    """Give every entity a row for each bucket of the period; added rows have NULL measures.

    Each fact is followed by the empty buckets up to the entity's next fact, and the first one also
    preceded by those from the start. So the facts are read once, and joined with nothing. An entity
    has at most one fact per bucket.
    """
    in_order = Window.partitionBy(entity).orderBy(name)
    step = CALENDAR_MONTHS[resolution]
    first, last = (bucket(F.lit(day), resolution) for day in (period.start, period.end))
    since = F.when(F.lag(name).over(in_order).isNull(), first).otherwise(F.col(name))
    until = F.coalesce(F.add_months(F.lead(name).over(in_order), -step), last)
    buckets = F.sequence("since", "until", F.make_ym_interval(F.lit(0), F.lit(step)))
    measures = [c for c in facts.columns if c not in (entity, name)]
    return (
        facts.withColumns({"since": since, "until": until})
        .withColumn("filled", F.explode(buckets))
        .select(
            entity,
            F.col("filled").alias(name),
            *(F.when(F.col("filled") == F.col(name), F.col(m)).alias(m) for m in measures),
        )
    )


def with_previous(df: DataFrame, entity: str, order: str, value: str, name: str) -> DataFrame:
    """Value of the entity's preceding row; an entity has at most one row per calendar bucket."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(entity).orderBy(order)))


def growth_pct(current: str, previous: str) -> Column:
    """A missing current value counts as zero; missing or zero before gives NULL."""
    return pct_change(F.coalesce(F.col(current), F.lit(0)), F.col(previous))
