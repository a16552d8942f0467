"""Distinct counts that merge: sets of keys as bits, 64 keys a word.

Keys get dense numbers. A set is a row for each word (number div 64) that holds one of its keys, with the bits of those
that are there; a union is BIT_OR by word, its size the sum of BIT_COUNT. So the sets of months answer for any run of
months, exactly, without the lines. A lone key costs one row, 64 neighbours cost no more: sparse sets stay small, which
bitmaps of fixed size (32,768 keys each) would not. All of it is plain aggregation, merged before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.session import written

WORD = 64


def dense_ids(keys: DataFrame, start: int = 0) -> DataFrame:
    """The distinct keys (all columns) with `id`, numbered in their order from start; no task holds all of them."""
    by = keys.columns
    placed = keys.distinct().repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(placed.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ids")
    ranges = placed.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")  # a row for each range, not for each key
    ranges = ranges.select("_range", "_first", before.alias("_before"))
    number = F.col("_at") - F.col("_first") + F.col("_before") + F.lit(start)
    return placed.join(ranges, "_range").select(*by, number.alias("id"))


def key_bits(rows: DataFrame, groups: Sequence[str], number: str = "id") -> DataFrame:
    """The sets of the groups: groups, word, bits."""
    bit = F.expr(f"shiftleft(1L, CAST(pmod({number}, {WORD}) AS INT))")
    return rows.groupBy(*groups, F.expr(f"{number} div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits"))


def union_sizes(sets: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Size of the union of all sets in each group."""
    united = sets.groupBy(*groups, "word").agg(F.bit_or("bits").alias("bits"))
    return united.groupBy(*groups).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))
