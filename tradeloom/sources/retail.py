"""Marketplace tables derived from the retail star schema of the test data.

An order is split into one purchase order per supplier, since a purchase order has one seller.
The three clocks differ, and NULLs and catalog gaps are seeded by key, so that queries which mix
them up give other results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.numeric import whole
from tradeloom.sources.tables import Marketplace

# Prices and quantities of the retail tables have two decimals.
SCALE = 2

# The columns read of each retail table. Stated, they spare a look into the files.
SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,
        o_orderpriority string""",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_name string",
}


def _po_id() -> Column:
    """Text, so that no key is too large for it."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _order_columns() -> dict[str, Column]:
    return {
        "buyer_org_id": _null_if(F.col("o_custkey") % 97 == 0, F.col("o_custkey")),
        "seller_org_id": _null_if(F.col("l_suppkey") % 25 == 24, F.col("l_suppkey")),
        "po_created_date": F.col("o_orderdate"),
        "source": _null_if(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority")),
        "shipping_address": _null_if(F.col("o_orderstatus") == "P", F.col("o_custkey")),
    }


def _item_columns() -> dict[str, Column]:
    # Ship dates have no time of day, so the update is a date.
    return {
        "po_id": _po_id(),
        "product_id": F.col("l_partkey"),
        "qty_units": whole(F.col("l_quantity"), "double", SCALE),
        "amount_units": _null_if(F.col("l_partkey") % 101 == 0, whole(F.col("l_extendedprice"), "double", SCALE)),
        "created_date": F.col("l_shipdate"),
        "updated_date": F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber")),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def load(spark: SparkSession, folder: str) -> Marketplace:
    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    def sales() -> DataFrame:
        return table("lineitem").join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def po_details() -> DataFrame:
        # Told apart by the keys that make the id, so where the join has put the lines: they do not move again.
        keys = ("l_orderkey", "l_suppkey")
        orders = sales().select(*keys, *_named(_order_columns())).distinct()
        return orders.select(_po_id().alias("id"), *_order_columns()).withColumnRenamed("po_created_date", "created_date")

    def vendor_products() -> DataFrame:
        owners = (
            table("lineitem").groupBy(F.col("l_partkey").alias("owned")).agg(F.min("l_suppkey").alias("org_id"))
        )
        levels = F.array(
            *(
                F.struct(F.col(name).alias("name"), F.lit(level).alias("level"))
                for name, level in (("p_type", "1"), ("p_brand", "2"))
            )
        )
        return (
            table("part")
            .filter(F.col("p_partkey") % 23 != 0)
            .join(owners, F.col("p_partkey") == F.col("owned"), "left")
            .select(
                F.col("p_partkey").alias("id"),
                "org_id",
                F.col("p_name").alias("product_name"),
                _null_if(F.col("p_size") % 10 == 0, F.to_json(F.struct(levels.alias("cat_0")))).alias(
                    "category_ids"
                ),
            )
        )

    def user_address() -> DataFrame:
        return (
            table("customer")
            .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id"),
                _null_if(F.col("c_mktsegment") == "MACHINERY", F.col("n_name")).alias("city"),
            )
        )

    return Marketplace(
        spark,
        {
            "po_items": lambda: table("lineitem").select(_named(_item_columns())),
            "po_details": po_details,
            "vendor_products": vendor_products,
            "user_address": user_address,
            "organization": lambda: table("supplier").select(
                F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("company_name")
            ),
        },
        # Every line belongs to exactly one of the orders above, so one join gives the lines.
        lines=lambda: sales().select(_named(_item_columns() | _order_columns())),
        origin=folder,
        scale=SCALE,
    )
