"""Small hand-made marketplaces."""

from __future__ import annotations

from datetime import datetime

from tradeloom.sources.tables import TABLES, Marketplace, with_amounts

SCHEMAS = {
    "po_items": """po_id bigint, product_id bigint, qty double, total_amount double,
                   created_date timestamp_ntz, updated_date timestamp_ntz""",
    "po_details": """id bigint, buyer_org_id bigint, seller_org_id bigint, created_date timestamp_ntz,
                     source string, shipping_address bigint""",
    "vendor_products": "id bigint, org_id bigint, product_name string, category_ids string",
    "user_address": "id bigint, city string",
    "organization": "org_id bigint, company_name string",
}


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def item(po, product, amount, day, qty=1.0, updated=None):
    return (po, product, qty, amount, at(day), at(updated or day))


def order(po, buyer, seller, day="2024-01-15", source=None, address=None):
    return (po, buyer, seller, at(day), source, address)


def category(*levels) -> str:
    entries = ", ".join(
        f'{{"name": "{name}"}}' if level is None else f'{{"name": "{name}", "level": {level}}}'
        for name, level in levels
    )
    return f'{{"cat_0": [{entries}]}}'


def market(spark, items, orders, products=(), addresses=(), organizations=(), scale=2) -> Marketplace:
    rows = dict(zip(TABLES, (items, orders, products, addresses, organizations)))
    frames = {name: spark.createDataFrame(list(rows[name]), SCHEMAS[name]) for name in TABLES}
    frames["po_items"] = with_amounts(frames["po_items"], scale)
    return Marketplace(spark, {name: (lambda f=frame: f) for name, frame in frames.items()}, scale=scale)


def rows(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
