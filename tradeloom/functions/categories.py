"""Product category from the catalog's JSON column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORY_SCHEMA = "cat_0 array<struct<name:string,level:string>>"


def _deeper_first(left: Column, right: Column) -> Column:
    a, b = left["level"].cast("int"), right["level"].cast("int")
    return (
        F.when(a.isNull() & b.isNull(), 0)
        .when(a.isNull(), -1)
        .when(b.isNull(), 1)
        .when(a > b, -1)
        .when(a < b, 1)
        .otherwise(0)
    )


def deepest_category(category_json: Column) -> Column:
    """Name at the highest numeric level; an entry without a level counts as deepest."""
    entries = F.from_json(category_json, CATEGORY_SCHEMA)["cat_0"]
    return F.get(F.array_sort(entries, _deeper_first), F.lit(0))["name"]
