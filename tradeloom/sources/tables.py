"""The five marketplace tables and how they are read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.categories import deepest_category
from tradeloom.functions.numeric import decimals_of, units, units_per, whole

TABLES = ("po_items", "po_details", "vendor_products", "user_address", "organization")


@dataclass(frozen=True)
class Zone:
    """A month of staged lines and the range of each other clock in it; no range where the clock is never set."""

    month: date | None
    ranges: dict[str, tuple[date | None, date | None]]

    def meets(self, clock: str, start: date | None, end: date) -> bool:
        low, high = self.ranges[clock]
        return low is not None and low <= end and (start is None or high >= start)


@dataclass(frozen=True)
class FileSource:
    """Where items and orders are files: `listed` gives name (of the table), file, size and modified of each; `part` reads
    the given files of a table."""

    listed: Callable[[], DataFrame]
    part: Callable[[str, list[str]], DataFrame]


class Marketplace:
    """The source tables, each built when it is first asked for.

    `lines` may give the items already joined with their orders; else they are joined here. `origin`
    tells where the tables come from. Quantities and amounts are whole numbers of 10**-scale. `first_dates`, where
    they are kept, spare the buyer overview all lines before its two periods.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, Callable[[], DataFrame]],
        lines: Callable[[], DataFrame] | None = None,
        origin: str | None = None,
        scale: int = 2,
        zones: list[Zone] | None = None,
        first_dates: DataFrame | None = None,
        files: FileSource | None = None,
    ):
        self.spark = spark
        self.first_dates = first_dates
        self.files = files
        self.origin = origin
        self.scale = scale
        self.zones = zones
        self._tables = tables
        self._lines = lines

    @cached_property
    def po_items(self) -> DataFrame:
        return self._tables["po_items"]()

    @cached_property
    def po_details(self) -> DataFrame:
        return self._tables["po_details"]()

    @cached_property
    def vendor_products(self) -> DataFrame:
        return self._tables["vendor_products"]()

    @cached_property
    def user_address(self) -> DataFrame:
        return self._tables["user_address"]()

    @cached_property
    def organization(self) -> DataFrame:
        return self._tables["organization"]()

    def lines(self) -> DataFrame:
        """One row per line item with the columns of its order."""
        return self._lines() if self._lines else join_items_orders(self.po_items, self.po_details)

    @property
    def gives_lines(self) -> bool:
        """Whether the lines come joined, not from the items and orders here."""
        return self._lines is not None

    def product_categories(self) -> DataFrame:
        return self.vendor_products.select(
            F.col("id").alias("product_id"), deepest_category(F.col("category_ids")).alias("category_name")
        )

    def with_lines(
        self, lines: DataFrame, zones: list[Zone] | None = None, first_dates: DataFrame | None = None
    ) -> Marketplace:
        return Marketplace(self.spark, self._tables, lambda: lines, self.origin, self.scale, zones, first_dates)

    def units(self, total: Column) -> Column:
        """A sum of amounts or quantities as a double with two decimals."""
        return units(total, self.scale)

    def units_per(self, total: Column, count: Column) -> Column:
        return units_per(total, count, self.scale)


def order_columns(po_details: DataFrame) -> DataFrame:
    """Orders as their lines show them."""
    return po_details.select(
        F.col("id").alias("po_id"),
        "buyer_org_id",
        "seller_org_id",
        F.col("created_date").alias("po_created_date"),
        "source",
        "shipping_address",
    )


def join_items_orders(po_items: DataFrame, po_details: DataFrame) -> DataFrame:
    return po_items.join(order_columns(po_details), "po_id")


def scale_of(po_items: DataFrame) -> int:
    """The scale at which quantities and amounts of these types are exact."""
    kinds = dict(po_items.dtypes)
    held = [decimals_of(kinds[c]) for c in ("qty", "total_amount")]
    if None in held:
        raise ValueError("quantities or amounts are floating point: state the scale to sum them at")
    return max(held)


def with_amounts(po_items: DataFrame, scale: int) -> DataFrame:
    """Quantity and amount of each item as whole numbers of 10**-scale."""
    kinds = dict(po_items.dtypes)
    return po_items.withColumns(
        {
            "qty_units": whole(F.col("qty"), kinds["qty"], scale),
            "amount_units": whole(F.col("total_amount"), kinds["total_amount"], scale),
        }
    ).drop("qty", "total_amount")


def read_parquet(spark: SparkSession, folder: str, scale: int | None = None) -> Marketplace:
    """Tables stored as `<folder>/<table>`. Decimal amounts keep their own scale; for floating-point ones the
    scale must be stated."""
    scale = scale_of(spark.read.parquet(f"{folder}/po_items")) if scale is None else scale

    def read(table: str) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{table}")
        return with_amounts(rows, scale) if table == "po_items" else rows

    def listed() -> DataFrame:
        """Files that hold rows, from their own entries; no row is read."""
        facts = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}
        names = ("po_items", "po_details")
        found = [
            spark.read.parquet(f"{folder}/{name}")
            .select(F.lit(name).alias("name"), *(F.col(f"_metadata.{c}").alias(n) for n, c in facts.items()))
            .distinct()
            for name in names
        ]
        return found[0].union(found[1])

    def part(name: str, files: list[str]) -> DataFrame:
        rows = spark.read.option("basePath", f"{folder}/{name}").parquet(*files)
        return with_amounts(rows, scale) if name == "po_items" else rows

    files = FileSource(listed, part)
    return Marketplace(spark, {t: partial(read, t) for t in TABLES}, origin=folder, scale=scale, files=files)


# The column by which each table is read in parallel.
JDBC_SPLIT_COLUMN = {
    "po_items": "po_id",
    "po_details": "id",
    "vendor_products": "id",
    "user_address": "id",
    "organization": "org_id",
}


def jdbc_options(url: str, table: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options for a parallel read: one range of the split column per partition."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": JDBC_SPLIT_COLUMN[table],
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    partitions: int = 64,
    scale: int = 6,
    table_names: dict[str, str] | None = None,
    **login: str,
) -> Marketplace:
    """Tables of a live relational database; filters and column choice are pushed to it.

    `table_names` maps our table names to those of the database where they differ. `scale` is that of the
    sums of quantities and amounts, as a database's numeric columns need not state one.
    """

    def read(table: str) -> DataFrame:
        name = (table_names or {}).get(table, table)
        column = JDBC_SPLIT_COLUMN[table]
        bounds = (
            spark.read.format("jdbc")
            .options(url=url, **login)
            .option("query", f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {name}")
            .load()
            .first()
        )
        low, high = (int(v) if v is not None else 0 for v in (bounds[0], bounds[1]))
        options = {**jdbc_options(url, table, low, high + 1, partitions), "dbtable": name}
        rows = spark.read.format("jdbc").options(**options, **login).load()
        return with_amounts(rows, scale) if table == "po_items" else rows

    return Marketplace(spark, {table: partial(read, table) for table in TABLES}, scale=scale)
