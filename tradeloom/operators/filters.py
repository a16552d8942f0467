"""Row filters and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.params import Period
from tradeloom.sources.tables import Marketplace


def in_period(df: DataFrame, clock: str, period: Period) -> DataFrame:
    return df.filter(period.holds(F.col(clock)))


def period_tag(clock: Column, period: Period) -> Column:
    """'current', 'previous' or NULL."""
    return F.when(period.holds(clock), "current").when(period.previous.holds(clock), "previous")


def with_category_flag(market: Marketplace, lines: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    """Add `wanted`: does the line's product lie in one of the categories?

    With the filter off no catalog is read. A product without a category is never wanted.
    """
    if categories is None:
        return lines.withColumn("wanted", F.lit(True))
    wanted = (
        market.product_categories()
        .filter(F.col("category_name").isin(list(categories)))
        .select("product_id", F.lit(True).alias("found"))
    )
    return (
        lines.join(wanted, "product_id", "left")
        .withColumn("wanted", F.col("found").isNotNull())
        .drop("found")
    )


def keep_categories(market: Marketplace, lines: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    if categories is None:
        return lines
    wanted = market.product_categories().filter(F.col("category_name").isin(list(categories)))
    return lines.join(wanted, "product_id", "left_semi")


def keep_channels(lines: DataFrame, channels: Sequence[str] | None) -> DataFrame:
    return lines if channels is None else lines.filter(F.col("source").isin(list(channels)))


def entity_slice(df: DataFrame, id_column: str, ids: Sequence[int]) -> DataFrame:
    return df.filter(F.col(id_column).isin(list(ids)))


def split_summary(df: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows of real entities, and the row of what belongs to no entity."""
    return df.filter(F.col(id_column).isNotNull()), df.filter(F.col(id_column).isNull())
