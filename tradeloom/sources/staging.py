"""The joined order lines as a written table.

All named queries start from the same join of items with their orders. Written once, by month of the item's
creation, the join is paid once, later reads skip the months outside their period, and a lost executor re-reads files
instead of repeating the join. Beside the lines lies a small table of zones: for each month the range of the other
two clocks in it, so that a period by any clock becomes a choice of months.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.params import Period
from tradeloom.sources.tables import Marketplace, Zone

MONTH = "created_month"
#: The clocks that do not tell a line's month.
OTHER_CLOCKS = ("updated_date", "po_created_date")


def write_lines(market: Marketplace, path: str) -> None:
    """Write the joined lines, one folder per month of item creation.

    Rebalancing gives a task lines of one month only; a month that holds most rows is split over
    many tasks, and small months share one.
    """
    (
        market.lines()
        .withColumn(MONTH, F.date_trunc("month", F.col("created_date")).cast("date"))
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .partitionBy(MONTH)
        .parquet(path)
    )
    ranges = [f(F.col(c).cast("date")).alias(f"{n}_{c}") for c in OTHER_CLOCKS for f, n in ((F.min, "low"), (F.max, "high"))]
    zones = read_lines(market.spark, path).groupBy(MONTH).agg(*ranges)
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}_zones")


def read_zones(spark: SparkSession, path: str) -> list[Zone]:
    """One zone a month of the staged lines."""
    rows = spark.read.parquet(f"{path}_zones").collect()
    return [Zone(r[MONTH], {c: (r[f"low_{c}"], r[f"high_{c}"]) for c in OTHER_CLOCKS}) for r in rows]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(market: Marketplace, path: str) -> Marketplace:
    """The marketplace with its lines written to the path and read from there, unless they are so
    already."""
    if MONTH in market.lines().columns:
        return market
    write_lines(market, path)
    return written_market(market, path)


def written_market(market: Marketplace, path: str) -> Marketplace:
    """The marketplace with lines that `write_lines` has written."""
    return market.with_lines(read_lines(market.spark, path), read_zones(market.spark, path))


def lines_with(market: Marketplace, clocks: tuple[str, ...], start: date | None, end: date) -> DataFrame:
    """Lines of the months in which one of the other clocks may lie within the bounds; all lines if they are not
    staged. The caller still filters by the clock itself."""
    lines = market.lines()
    if market.zones is None:
        return lines
    months = {z.month for z in market.zones if any(z.meets(c, start, end) for c in clocks)}
    known = F.col(MONTH).isin(sorted(m for m in months if m is not None))
    return lines.filter(known | F.col(MONTH).isNull() if None in months else known)


def lines_created_in(lines: DataFrame, period: Period) -> DataFrame:
    """Lines whose item was created in the period; staged lines also skip the other months."""
    if MONTH in lines.columns:
        lines = lines.filter(F.col(MONTH).between(F.lit(period.start.replace(day=1)), F.lit(period.end)))
    return lines.filter(period.holds(F.col("created_date")))
