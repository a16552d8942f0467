"""Top-N per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per(df: DataFrame, entity: str, amount: str, tie_break: str, n: int, rank: str) -> DataFrame:
    """Number the rows of each entity by falling amount and keep the first n.

    A NULL amount ranks first; equal amounts are ordered by the tie-break column. The filter on the
    row number lets each task drop all but n rows per entity before the shuffle, so an entity that
    holds most of the rows does not end up whole in one task.
    """
    order = [F.col(amount).desc_nulls_first(), F.col(tie_break).asc_nulls_last()]
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(entity).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))
