"""Share of the own group's total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.numeric import share_pct


def with_share(df: DataFrame, entity: str, amount: str, name: str) -> DataFrame:
    """Percent of the entity's total; rows without an entity are dropped.

    Meant for rows already aggregated to few per entity (one per category or region).
    """
    total = F.sum(amount).over(Window.partitionBy(entity))
    return df.filter(F.col(entity).isNotNull()).withColumn(name, share_pct(F.col(amount), total))
