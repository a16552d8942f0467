"""Staged lines that follow their sources: only the orders that changed are joined, only their months written.

An order has changed if the count of its lines, or the sum of the digests of their items or of their order, differs from
what the sources give. Digests are worked out where they are compared, from the columns of the staged lines, and not kept: they
would not compress. Sums per order are formed before any shuffle, and neither side moves more than a key and two numbers a
line. Where the sources are files, they tell more: if none came or went, nothing is
read; if some only came, the orders they name are those that changed.

The months of the changed orders, before and after, are written anew in folders of their own; all others stay the files
they were. Beside the lines lie the zones of their clocks, and the first dates of what each buyer bought in buckets, of which only
those are written that hold a changed date.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.distincts import dense_ids, key_bits, union_sizes
from tradeloom.operators.gathering import LINES_TO_SPREAD, gathered
from tradeloom.plans import buyer
from tradeloom.plans.snapshots import Parts, Snapshots
from tradeloom.session import written
from tradeloom.sources.staging import MONTH, OTHER_CLOCKS
from tradeloom.sources.tables import Marketplace, Zone, join_items_orders, order_columns

#: Digests that earlier versions kept with each line.
FORMER = ("_item_digest", "_order_digest")
#: Columns of a line that come from its order.
OF_ORDER = ("buyer_org_id", "seller_org_id", "po_created_date", "source", "shipping_address")
BUCKETS = 32
MOST_FILES_A_MONTH = 1000
FIRST_KEY = [buyer.BUYER, "kind", "key"]
LINES, ZONES, FIRSTS, FILES = "lines", "zones", "first_dates", "files"
#: Sets of what a vendor sold and to whom, by month; the numbers of their keys; and the lines that the sets are from.
SETS, KEY_IDS, SETS_FROM = "month_sets", "key_ids", "month_sets_from"


def _item_digest(columns: list[str]) -> Column:
    return F.xxhash64(*sorted(set(columns) - {"po_id", MONTH, *OF_ORDER}))


def _order_digest() -> Column:
    return F.xxhash64(*OF_ORDER)


def with_month(lines: DataFrame) -> DataFrame:
    return lines.withColumn(MONTH, F.date_trunc("month", F.col("created_date")).cast("date"))


def _totals(digest: Column, name: str) -> list[Column]:
    """The sum of digests, of their upper and lower halves apart: no sum is too large, and none needs a decimal."""
    halves = {"high": F.shiftrightunsigned(digest, 32), "low": digest.bitwiseAND(F.lit(0xFFFFFFFF))}
    return [F.sum(half).alias(f"{name}_{which}") for which, half in halves.items()]


#: What orders are compared by.
FACTS = ("lines", "items_high", "items_low", "orders_high", "orders_low")


def source_digests(market: Marketplace) -> DataFrame:
    """Each order's lines as the sources have them: po_id, lines, items, orders (sums of digests). Nothing is joined
    but one row an order, unless the sources give the lines themselves."""
    if market.gives_lines:
        return staged_digests(market.lines())
    items, orders = market.po_items, order_columns(market.po_details)
    by_item = items.groupBy("po_id").agg(F.count(F.lit(1)).alias("n"), *_totals(_item_digest(items.columns), "items"))
    by_order = orders.groupBy("po_id").agg(F.count(F.lit(1)).alias("m"), *_totals(_order_digest(), "orders"))
    joined = by_item.join(by_order, "po_id")
    times = {"lines": ("n", "m")} | {c: (c, "m" if c.startswith("items") else "n") for c in FACTS[1:]}
    return joined.select("po_id", *((F.col(a) * F.col(b)).alias(c) for c, (a, b) in times.items()))


def staged_digests(lines: DataFrame) -> DataFrame:
    digests = {"items": _item_digest(lines.columns), "orders": _order_digest()}
    return lines.groupBy("po_id").agg(F.count(F.lit(1)).alias("lines"), *(c for n, d in digests.items() for c in _totals(d, n)))


def differing_orders(market: Marketplace, lines: DataFrame) -> DataFrame:
    """po_id of orders that are new, changed or gone."""
    now, then = source_digests(market), staged_digests(lines)
    both = now.join(then, "po_id", "full")
    same = reduce(Column.__and__, (now[c].eqNullSafe(then[c]) for c in FACTS))
    return both.filter(~same).select("po_id")


def file_changes(market: Marketplace, seen: DataFrame | None) -> tuple[dict[str, list[str]], int] | None:
    """The files that came, by table, and how many went (a file written anew did both); None if that is not known."""
    if market.files is None or seen is None:
        return None
    now = market.files.listed().withColumn("_now", F.lit(True))
    both = now.join(seen.withColumn("_seen", F.lit(True)), ["name", "file", "size", "modified"], "full")
    moved = both.filter("_now IS NULL OR _seen IS NULL").select("name", "file", "_now").collect()  # paths, never rows
    came: dict[str, list[str]] = {}
    for row in moved:
        if row["_now"]:
            came.setdefault(row["name"], []).append(row["file"])
    return came, sum(not row["_now"] for row in moved)


def orders_named_in(market: Marketplace, files: dict[str, list[str]]) -> DataFrame:
    """po_id of all orders that these files of items or orders name."""
    keys = [
        market.files.part(name, files[name]).select(F.col(column).alias("po_id"))
        for name, column in (("po_items", "po_id"), ("po_details", "id"))
        if name in files
    ]
    named = keys[0] if len(keys) == 1 else keys[0].union(keys[1])
    return named.filter(F.col("po_id").isNotNull()).distinct()


def _part(month: date | None) -> str:
    return "none" if month is None else month.isoformat()


def _month_in(months: list[date | None]) -> Column:
    known = F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(False))
    return known | F.col(MONTH).isNull() if None in months else known


class StagedLines:
    """The lines, zones and first dates below a store's snapshots."""

    def __init__(self, snapshots: Snapshots):
        self.snapshots = snapshots
        self.spark = snapshots.spark

    # Reading

    def _read(self, parts: Parts, name: str) -> DataFrame | None:
        paths = [self.snapshots.path(folder) for (table, _), folder in sorted(parts.items()) if table == name]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.snapshots.base(name)).parquet(*paths).drop("v")

    def lines(self, parts: Parts) -> DataFrame | None:
        lines = self._read(parts, LINES)
        return None if lines is None else lines.drop(*FORMER)

    def market(self, market: Marketplace, parts: Parts) -> Marketplace | None:
        """The marketplace with the staged lines, their zones and the first dates; None before the first sync."""
        lines = self.lines(parts)
        if lines is None:
            return None
        zones = [
            Zone(r[MONTH], {c: (r[f"low_{c}"], r[f"high_{c}"]) for c in OTHER_CLOCKS})
            for r in self._read(parts, ZONES).collect()  # one a month
        ]
        firsts = self._read(parts, FIRSTS)
        firsts = firsts.drop("bucket") if firsts is not None else self.spark.createDataFrame([], self._first_schema(lines))
        return market.with_lines(lines, zones, firsts)

    @staticmethod
    def _first_schema(lines: DataFrame) -> str:
        kinds = dict(lines.dtypes)
        return f"{buyer.BUYER} {kinds[buyer.BUYER]}, kind string, key {kinds['product_id']}, first_seen {kinds[buyer.CLOCK]}"

    # Writing

    def changes(self, market: Marketplace, parts: Parts) -> dict[tuple[str, str], str | None]:
        """Writes what the sources have changed since these parts; the new folders are to be published."""
        out: dict[tuple[str, str], str | None] = {}
        staged = self.lines(parts)
        files = file_changes(market, self._read(parts, FILES)) if staged is not None else None
        if files == ({}, 0):
            return out
        if market.files is not None:  # listed before the rows are read: what comes meanwhile counts as new next time
            folder = self.snapshots.folder(FILES)
            market.files.listed().write.parquet(self.snapshots.path(folder))
            out[FILES, ""] = folder
        if staged is None:
            fresh, before = with_month(market.lines()), []
        else:
            keys = orders_named_in(market, files[0]) if files and not files[1] else differing_orders(market, staged)
            keys = written(keys, "changed-orders")
            if keys.isEmpty():
                return out
            if market.gives_lines:
                changed = market.lines().join(keys, "po_id", "left_semi")
            else:
                items, details = market.po_items.join(keys, "po_id", "left_semi"), market.po_details
                details = details.join(keys.withColumnRenamed("po_id", "id"), "id", "left_semi")
                changed = join_items_orders(items, details)
            fresh = written(with_month(changed), "changed-lines")
            of_changed = staged.join(keys, "po_id", "left_semi").select(MONTH)
            before = [r[0] for r in of_changed.union(fresh.select(MONTH)).distinct().collect()]  # months
            kept = staged.filter(_month_in(before)).join(keys, "po_id", "left_anti")
            fresh = kept.unionByName(fresh)
        return out | self._write_months(fresh, before, parts if staged is not None else {})

    def _write_months(self, lines: DataFrame, before: list, parts: Parts) -> dict[tuple[str, str], str | None]:
        snapshots = self.snapshots
        folder = snapshots.folder(LINES)
        # The lines lie as they were joined: a task writes a file of each month. With many tasks these would be too many.
        moved = int(self.spark.conf.get("spark.sql.shuffle.partitions")) > MOST_FILES_A_MONTH
        placed = lines.hint("rebalance", MONTH) if moved else lines
        placed.write.partitionBy(MONTH).option("compression", "zstd").parquet(snapshots.path(folder))
        lines = self.spark.read.schema(lines.schema).parquet(snapshots.path(folder))
        ranges = [f(F.col(c).cast("date")).alias(f"{n}_{c}") for c in OTHER_CLOCKS for f, n in ((F.min, "low"), (F.max, "high"))]
        zones = lines.groupBy(MONTH).agg(*ranges)
        old_zones = self._read(parts, ZONES)
        if old_zones is not None:
            zones = zones.unionByName(old_zones.filter(~_month_in(before)))
        out: dict[tuple[str, str], str | None] = {(LINES, _part(m)): None for m in before}
        out[ZONES, ""] = snapshots.folder(ZONES)
        zones.coalesce(1).write.parquet(snapshots.path(out[ZONES, ""]))
        for (month,) in lines.select(MONTH).distinct().collect():
            value = "__HIVE_DEFAULT_PARTITION__" if month is None else month.isoformat()
            out[LINES, _part(month)] = f"{folder}/{MONTH}={value}"
        return out | self._merge_firsts(parts, out)

    def _merge_firsts(self, parts: Parts, changed: dict[tuple[str, str], str | None]) -> dict[tuple[str, str], str | None]:
        """The buckets of first dates in which the changed months change one."""
        lines = self.lines({k: f for k, f in (dict(parts) | changed).items() if f})
        if lines is None:  # no line is left
            return {key: None for key in parts if key[0] == FIRSTS}
        old = self._read(parts, FIRSTS)
        touched = {part for name, part in changed if name == LINES}
        months = {part for name, part in parts if name == LINES} | touched
        if old is None or 2 * len(touched) > len(months):
            # Most may have changed. To find out which would move each line, before and after, several times.
            bought = lines.select(*buyer.FIRST_COLUMNS).filter(f"{buyer.BUYER} IS NOT NULL")
            with gathered(bought, buyer.BUYER, kept=False, a_task=LINES_TO_SPREAD) as sides:
                made = self._write_firsts(reduce(DataFrame.union, [buyer.first_dates(s) for s in sides if s is not None]))
            return {key: None for key in parts if key[0] == FIRSTS} | made
        only = lambda p: {k: f for k, f in p.items() if k[0] == LINES and k[1] in touched and f}
        sides = [buyer.purchased(side) for p in (parts, changed) if (side := self.lines(only(p))) is not None]
        affected = reduce(DataFrame.union, [side.select(*FIRST_KEY) for side in sides]).distinct()
        now = buyer.earliest(buyer.purchased(lines).join(affected, FIRST_KEY, "left_semi").withColumnRenamed(buyer.CLOCK, "first_seen"))
        then = old.withColumnRenamed("first_seen", "_was").join(affected, FIRST_KEY, "left_semi")
        moved = now.join(then.drop("bucket"), FIRST_KEY, "full").withColumn("bucket", self._bucket())
        moved = written(moved.filter("NOT (first_seen <=> _was)"), "moved-dates")
        buckets = [r[0] for r in moved.select("bucket").distinct().collect()]
        if not buckets:
            return {}
        kept = old.filter(F.col("bucket").isin(buckets)).join(moved, FIRST_KEY, "left_anti").select(*FIRST_KEY, "first_seen")
        dates = kept.unionByName(moved.filter("first_seen IS NOT NULL").select(*FIRST_KEY, "first_seen"))
        return {(FIRSTS, str(b)): None for b in buckets} | self._write_firsts(dates)

    def _write_firsts(self, dates: DataFrame) -> dict[tuple[str, str], str | None]:
        folder = self.snapshots.folder(FIRSTS)
        dates = dates.withColumn("bucket", self._bucket())
        # Not moved once more to have fewer files: a task of the sums writes a part of each bucket.
        dates.write.partitionBy("bucket").option("compression", "zstd").parquet(self.snapshots.path(folder))
        made = self.spark.read.schema(dates.schema).parquet(self.snapshots.path(folder)).select("bucket").distinct().collect()
        return {(FIRSTS, str(b)): f"{folder}/bucket={b}" for (b,) in made}

    # Distinct counts

    @staticmethod
    def _sold(lines: DataFrame) -> DataFrame:
        """Month, vendor, kind and key of all that was sold; a vendor's key once a month."""
        kinds = F.array(
            *(
                F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("key"))
                for kind, column in (("product", "product_id"), ("buyer", buyer.BUYER))
            )
        )
        keyed = lines.select(MONTH, F.col("seller_org_id").alias("vendor_id"), F.inline(kinds))
        return keyed.filter("key IS NOT NULL").distinct()

    def set_changes(self, parts: Parts) -> dict[tuple[str, str], str | None]:
        """Sets of the months whose lines are not those that their sets were made from. Keys keep their numbers, new ones
        are numbered behind them."""
        sources = {part: folder for (name, part), folder in parts.items() if name == LINES}
        made = {part: folder for (name, part), folder in parts.items() if name == SETS_FROM}
        gone = made.keys() - sources.keys()
        out: dict[tuple[str, str], str | None] = {(name, m): None for m in gone for name in (SETS, SETS_FROM)}
        stale = {part for part, folder in sources.items() if made.get(part) != folder}
        if not stale:
            return out
        lines = self._read({k: f for k, f in parts.items() if k[0] == LINES and k[1] in stale}, LINES)
        sold = written(self._sold(lines), "sold")
        known = self._read(parts, KEY_IDS)
        keys = sold.select("kind", "key")
        if known is not None:
            keys = keys.join(known, ["kind", "key"], "left_anti")
        start = 0 if known is None else known.agg(F.max("id")).first()[0] + 1
        new = dense_ids(keys, start)
        number = sum(name == KEY_IDS for name, _ in parts)
        out[KEY_IDS, str(number)] = self.snapshots.folder(KEY_IDS)
        new.write.parquet(self.snapshots.path(out[KEY_IDS, str(number)]))
        if new.isEmpty():
            del out[KEY_IDS, str(number)]
        ids = self._read({k: f for k, f in (dict(parts) | out).items() if f}, KEY_IDS)
        folder = self.snapshots.folder(SETS)
        sets = key_bits(sold.join(ids, ["kind", "key"]), [MONTH, "vendor_id", "kind"])
        sets.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(self.snapshots.path(folder))
        held = self.spark.read.schema(sets.schema).parquet(self.snapshots.path(folder)).select(MONTH).distinct().collect()
        out |= {(SETS, m): None for m in stale}
        for (month,) in held:
            value = "__HIVE_DEFAULT_PARTITION__" if month is None else month.isoformat()
            out[SETS, _part(month)] = f"{folder}/{MONTH}={value}"
        return out | {(SETS_FROM, m): sources[m] for m in stale}

    def distinct_counts(self, parts: Parts, resolution: str) -> DataFrame:
        """vendor_id, kind (product or buyer), bucket (month, quarter or year of creation), n: distinct keys, from the sets of
        the months alone."""
        sets = self._read(parts, SETS)
        if sets is None:
            raise LookupError("no sets of months; update them first")
        at = F.date_trunc(resolution, F.col(MONTH)).cast("date")
        return union_sizes(sets.withColumn("bucket", at), ["vendor_id", "kind", "bucket"], "n")

    @staticmethod
    def _bucket() -> Column:
        return F.pmod(F.xxhash64(*FIRST_KEY), F.lit(BUCKETS)).cast("int")
