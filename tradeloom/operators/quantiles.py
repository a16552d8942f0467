"""Exact quantiles by selection: histograms that close in on the wanted ranks, without a sort of the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.session import written

#: Steps of a histogram, and values in an interval that are looked at one by one.
STEPS, FEW = 4096, 65_536


def exact_quantiles(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float], steps: int = STEPS, few: int = FEW
) -> DataFrame:
    """Linearly interpolated quantiles per group, as rows (group, probability, quantile); NULLs are no values.

    Every wanted rank lies in an interval of values, at first the whole range of its group. A pass counts the values of all
    open intervals in equal steps, added up before the shuffle, and each rank moves to the step that holds it, from the
    least to the greatest value there. Both ends of an interval fall into different steps, so it shrinks each time, by a
    factor of the steps where values are spread evenly. It closes when one value is left, however often that
    stands there, or few enough to count each. `df` is read once a pass; nothing of it is sorted, ranged or written.
    """
    held = df.select(group, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    totals = held.groupBy(group).agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))

    def neighbours(probability: float) -> list[Column]:
        at = F.lit(probability) * (F.col("_in") - 1)
        upper = at - F.floor(at)
        return [
            F.struct(F.lit(probability).alias("probability"), rank.cast("long").alias("rank"), part.alias("part"))
            for rank, part in ((F.floor(at), 1 - upper), (F.ceil(at), upper))
        ]

    wanted = F.explode(F.array(*(n for p in probabilities for n in neighbours(p)))).alias("n")
    ranks = totals.select(group, "_in", "_low", "_high", F.lit(0).cast("long").alias("_before"), wanted)
    ranks = written(ranks.select("*", "n.*").drop("n"), "ranks")
    unsettled = (F.col("_low") < F.col("_high")) & (F.col("_in") > few)
    while not ranks.filter(unsettled).isEmpty():
        counted = _inside(held, ranks.filter(unsettled), group, _step(steps))
        moved = _at_rank(ranks.filter(unsettled), counted, group)
        ranks = written(ranks.filter(~unsettled).unionByName(moved.select(ranks.columns)), "ranks")
    # What is left is one value, or few.
    one = F.col("_low") == F.col("_high")
    counted = _inside(held, ranks.filter(~one), group, F.col("_v"))
    found = _at_rank(ranks.filter(~one), counted, group).select(ranks.columns).unionByName(ranks.filter(one))
    return found.groupBy(group, "probability").agg(F.sum(F.col("_low") * F.col("part")).alias("quantile"))


def _step(steps: int) -> Column:
    """The step of a value in its interval; a range beyond the largest double is halved first."""
    width = F.col("_high") - F.col("_low")
    ratio = (F.col("_v") - F.col("_low")) / width
    halved = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
    return F.floor(F.when(width == F.lit(float("inf")), halved).otherwise(ratio) * steps)


def _inside(held: DataFrame, ranks: DataFrame, group: str, step: Column) -> DataFrame:
    """Counts by interval and step, with the values before each step of its interval."""
    spans = ranks.select(group, "_low", "_high").distinct()
    inside = held.join(spans, group).filter("_v BETWEEN _low AND _high")
    counted = inside.groupBy(group, "_low", "_high", step.alias("_step")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    in_order = Window.partitionBy(group, "_low", "_high").orderBy("_step")  # steps of a histogram, or few values
    return counted.withColumn("_sum", F.sum("_n").over(in_order) - F.col("_n"))


def _at_rank(ranks: DataFrame, counted: DataFrame, group: str) -> DataFrame:
    """Each rank in the step that holds it."""
    at = F.col("rank") - F.col("_before") - F.col("_sum")
    held = ranks.join(counted, [group, "_low", "_high"]).filter((at >= 0) & (at < F.col("_n")))
    return held.withColumns(
        {"_before": F.col("_before") + F.col("_sum"), "_in": F.col("_n"), "_low": F.col("_least"), "_high": F.col("_most")}
    )
