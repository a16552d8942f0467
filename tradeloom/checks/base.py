"""Registration of queries next to their DuckDB SQL, and the SQL pieces that many share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.params import Period, QueryParams
from tradeloom.sources import retail
from tradeloom.sources.tables import Marketplace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# All dates of the test tables, and their later half, whose previous period is the earlier half.
WHOLE = Period.of("1995-01-01", "2001-12-31")
LATER_HALF = Period.of("1998-07-01", "2001-12-31")

CHANNELS = ("1-URGENT", "5-LOW")
CATEGORIES = ("Brand#1", "Brand#7", "Brand#21", "ECONOMY")


def register(name: str, sql: str | None = None) -> Callable[[Callable[[Marketplace], DataFrame]], Callable]:
    """Register a query on the marketplace tables, with the SQL it must agree with."""

    def wrap(build: Callable[[Marketplace], DataFrame]) -> Callable[[Marketplace], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(retail.load(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


def whole(top_n: int = 10, **options) -> QueryParams:
    return QueryParams(WHOLE, top_n, **options)


# The marketplace tables as SQL over the retail test tables.
ADAPTER = {
    "po_details": """
        SELECT DISTINCT l_orderkey || '-' || l_suppkey AS id,
               CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey END AS buyer_org_id,
               CASE WHEN l_suppkey % 25 = 24 THEN NULL ELSE l_suppkey END AS seller_org_id,
               o_orderdate AS created_date,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS source,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS shipping_address
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "po_items": """
        SELECT l_orderkey || '-' || l_suppkey AS po_id, l_partkey AS product_id,
               CAST(l_quantity AS DECIMAL(18,2)) AS qty,
               CASE WHEN l_partkey % 101 = 0 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS total_amount,
               l_shipdate AS created_date,
               l_shipdate + l_linenumber * INTERVAL '1' DAY AS updated_date
        FROM lineitem""",
    "part_owner": "SELECT l_partkey AS pk, MIN(l_suppkey) AS org FROM lineitem GROUP BY l_partkey",
    "vendor_products": """
        SELECT p_partkey AS id, org AS org_id, p_name AS product_name,
               CASE WHEN p_size % 10 = 0 THEN NULL
                    ELSE concat('{"cat_0":[{"name":"', p_type, '","level":"1"},{"name":"', p_brand,
                                '","level":"2"}]}') END AS category_ids
        FROM part LEFT JOIN part_owner ON p_partkey = pk WHERE p_partkey % 23 <> 0""",
    "user_address": """
        SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE n_name END AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "organization": "SELECT s_suppkey AS org_id, s_name AS company_name FROM supplier",
    "lines": """
        SELECT i.*, d.buyer_org_id, d.seller_org_id, d.created_date AS po_created_date, d.source,
               d.shipping_address
        FROM po_items i JOIN po_details d ON d.id = i.po_id""",
    "categories": """
        SELECT id AS product_id, org_id,
               (SELECT e.value->>'name' FROM json_each(CAST(category_ids AS JSON)->'cat_0') e
                ORDER BY CAST(e.value->>'level' AS INT) DESC NULLS FIRST LIMIT 1) AS category
        FROM vendor_products""",
}


def with_tables(body: str, **ctes: str) -> str:
    """The body behind the marketplace tables and any further named subqueries."""
    named = ",\n".join(f"{name} AS ({text})" for name, text in {**ADAPTER, **ctes}.items())
    return f"WITH {named}\n{body}"


def day(value) -> str:
    return f"DATE '{value.isoformat()}'"


def within(column: str, period: Period) -> str:
    return f"({column} BETWEEN {day(period.start)} AND {day(period.end)})"


def in_list(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def fixed(value: str) -> str:
    """A number with at most four decimals as an integer count of ten-thousandths."""
    return f"CAST(CAST({value} AS DECIMAL(38,4)) * 10000 AS HUGEINT)"


def rounded_quotient(numerator: str, denominator: str, digits: int = 2) -> str:
    """Exact quotient of two integers, rounded half away from zero; NULL for a zero denominator."""
    unit = 10**digits
    return (
        f"(CAST(sign({numerator}) * sign({denominator}) * ((2 * {unit} * abs({numerator}) + abs({denominator}))"
        f" // nullif(2 * abs({denominator}), 0)) AS DOUBLE) / {unit})"
    )


def ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    return rounded_quotient(fixed(numerator), fixed(denominator), digits)


def pct(current: str, previous: str) -> str:
    return rounded_quotient(f"(100 * ({fixed(current)} - {fixed(previous)}))", fixed(previous))


def pct_of_quotients(top: str, bottom: str, top_before: str, bottom_before: str) -> str:
    """Change from top_before / bottom_before to top / bottom in percent."""
    now = f"({fixed(top)} * {fixed(bottom_before)})"
    before = f"({fixed(top_before)} * nullif({fixed(bottom)}, 0))"
    return rounded_quotient(f"(100 * ({now} - {before}))", f"({before} * sign({fixed(bottom_before)}))")


def money(expression: str) -> str:
    return f"CAST(round({expression}, 2) AS DOUBLE)"
