"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to) and, within a pattern, by buckets of a
seeded hash. A flow then routes each pattern's token capacity to the sources' quotas: the first copy of a pattern's
tokens is free, each further one dearer (convex repetition costs), so repetition is spread before it is deepened. What a
pattern sends is taken as whole copies of all its documents plus one more copy of those that come first in the seeded
order. Where a document is larger than what is left it is passed over, and the documents after it are taken in the same
order as long as they fit, until the gap is smaller than any left; then one more is taken if that brings the sum nearer.

The flow works on the aggregate of patterns that overlap and of those that share a source with them; a source all of whose
patterns hold it alone is met by its own words, without a flow. The driver holds one row a pattern, whatever their number.
Every other step is a DataFrame job: buckets, as many as the largest pattern needs, keep a pattern with a third of all rows
out of any single task.

Defined results: null texts have size 0 and are taken 0 words; a null source is a source of its own, after all others; a
document without sources is not taken; rows with equal id and text are taken alike; other columns are ignored by
`taken`, passed on by `repeated`; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import Counter, deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import words, written


#: Patterns that are broadcast at most, and documents of a pattern sorted in one task, about.
BROADCAST, SORTED = 100_000, 20_000


@dataclass(frozen=True)
class Settings:
    """most: copies of a document at most; costs: of each copy's tokens."""

    most: int = 3
    costs: tuple[int, ...] = (0, 1, 3)
    seed: int = 11


def cyclic_weights(names: list[str | None]) -> dict[str | None, int]:
    """Sources by code point, null last, weigh 1, 2, 3, repeating."""
    ordered = sorted((n for n in names if n is not None), key=lambda n: [ord(c) for c in n])
    ordered += [None] if None in names else []
    return {name: i % 3 + 1 for i, name in enumerate(ordered)}


def targets(sizes: dict, weights: dict, total: float, most: int) -> dict:
    """Shares of the total by weight; each stops at `most` times its source's size, the excess is reshared."""
    out: dict = {}
    open_, left = [s for s in sizes if sizes[s] > 0], float(total)
    out |= {s: 0.0 for s in sizes if sizes[s] <= 0}
    while open_:
        weight = sum(weights[s] for s in open_)
        full = [s for s in open_ if left * weights[s] / weight > most * sizes[s]]
        if not full:
            return out | {s: left * weights[s] / weight for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in set(full)]
    return out


class Flow:
    """Min-cost flow by successive blocking flows on the cheapest paths."""

    def __init__(self, nodes: int):
        self.edges: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, source: int) -> list[float]:
        far = [float("inf")] * len(self.edges)
        far[source], waiting, queued = 0, deque([source]), {source}
        while waiting:
            a = waiting.popleft()
            queued.discard(a)
            for e in self.edges[a]:
                if self.room[e] > 0 and far[a] + self.cost[e] < far[self.to[e]]:
                    far[self.to[e]] = far[a] + self.cost[e]
                    if self.to[e] not in queued:
                        queued.add(self.to[e])
                        waiting.append(self.to[e])
        return far

    def run(self, source: int, sink: int) -> None:
        while (far := self._distances(source))[sink] < float("inf"):
            tried = [0] * len(self.edges)
            path: list[int] = []
            inside = {source}
            a = source
            while True:
                if a == sink:
                    sent = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= sent
                        self.room[e ^ 1] += sent
                    a, path, inside = source, [], {source}
                    continue
                while tried[a] < len(self.edges[a]):
                    e = self.edges[a][tried[a]]
                    b = self.to[e]
                    if self.room[e] > 0 and far[a] + self.cost[e] == far[b] and b not in inside:
                        break
                    tried[a] += 1
                if tried[a] < len(self.edges[a]):
                    path.append(e)
                    inside.add(b)
                    a = b
                elif path:
                    inside.discard(a)
                    a = self.to[path.pop() ^ 1]
                    tried[a] += 1
                else:
                    break


def route(patterns: list[tuple[tuple, int]], quotas: dict, settings: Settings = Settings()) -> list[dict]:
    """Words that each pattern (its sources, its size) sends to each of its sources: as near the quotas as capacity
    allows, at the least cost of repetition."""
    often = Counter(m for members, _ in patterns for m in members)
    alone = [len(members) == 1 and often[members[0]] == 1 for members, _ in patterns]
    shared = {m for (members, _), a in zip(patterns, alone) if not a for m in members}
    routed = iter(_routed([p for p, a in zip(patterns, alone) if not a], {n: q for n, q in quotas.items() if n in shared}, settings))
    return [{p[0][0]: min(settings.most * p[1], quotas[p[0][0]])} if a else next(routed) for p, a in zip(patterns, alone)]


def _routed(patterns: list[tuple[tuple, int]], quotas: dict, settings: Settings) -> list[dict]:
    names = list(quotas)
    place = {name: 2 + len(patterns) + i for i, name in enumerate(names)}
    flow = Flow(2 + len(patterns) + len(names))
    sent: list[dict] = []
    for i, (members, size) in enumerate(patterns):
        for copy in range(settings.most):
            flow.add(0, 2 + i, size, settings.costs[min(copy, len(settings.costs) - 1)])
        sent.append({m: flow.add(2 + i, place[m], settings.most * size, 0) for m in members})
    for name in names:
        flow.add(place[name], 1, quotas[name], 0)
    flow.run(0, 1)
    return [{m: flow.room[e ^ 1] for m, e in own.items()} for own in sent]


def _keyed(documents: DataFrame, sources: Column, settings: Settings) -> DataFrame:
    """_row (a struct of all columns), _pattern, and the seeded order _h, _t of the documents."""
    pattern = F.to_json(F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))), {"ignoreNullFields": "false"})
    return documents.select(
        F.struct(*documents.columns).alias("_row"),
        pattern.alias("_pattern"),
        F.xxhash64(F.lit(settings.seed), F.col("doc_id")).alias("_h"),
        F.xxhash64(F.col("text")).alias("_t"),
    )


@dataclass
class Plan:
    """Per pattern: copies of all and the place in the seeded order up to which one more is taken; documents after it
    (_pattern, _h, _t) that get one more; per source its size and target."""

    patterns: DataFrame
    extra: DataFrame
    sizes: dict
    targets: dict


PLAN = "p string, copies int, cut_h long, cut_t long, source_size long, target double"
EXTRA = "p string, _h long, _t long"


def _after(h: str, t: str, ch: str, ct: str) -> Column:
    return (F.col(h) > F.col(ch)) | ((F.col(h) == F.col(ch)) & (F.col(t) > F.col(ct)))


def _few(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of patterns to join with documents: broadcast unless it has many rows."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST else table


def _shift(documents: int) -> int:
    """How far to shift a hash right for buckets of at most SORTED of so many documents, about."""
    return 64 - max(12, (documents // SORTED).bit_length())


def _cuts(sized: DataFrame, rests: list[tuple[str, int]], shift: int) -> list:
    """For patterns with a rest: the first document (all rows of equal id and text) in the seeded order with which the
    sum passes the rest, null if none does, and the sum before it. One row a pattern."""
    open_ = _few(sized.sparkSession, rests, "p string, rest long")
    # The bucket of the hash in which a pattern's rest ends, then the document in it.
    bucketed = sized.withColumn("bucket", F.shiftright("_h", shift)).join(open_, F.col("_pattern") == F.col("p"))
    sums = bucketed.groupBy("p", "rest", "bucket").agg(F.sum("size").alias("s"))
    by = Window.partitionBy("p").orderBy("bucket")
    before = F.coalesce(F.sum("s").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = sums.groupBy("p").agg(F.sum("s").alias("all"))
    ends = sums.withColumn("before", before).where("before <= rest AND rest < before + s")
    inside = bucketed.join(ends.select(F.col("p").alias("q"), F.col("bucket").alias("b"), "before"), (F.col("p") == F.col("q")) & (F.col("bucket") == F.col("b")))
    steps = inside.groupBy("p", "rest", "before", "_h", "_t").agg(F.sum("size").alias("s"))
    so_far = F.col("before") + F.sum("s").over(Window.partitionBy("p").orderBy("_h", "_t").rowsBetween(Window.unboundedPreceding, 0))
    cuts = steps.withColumn("so_far", so_far).groupBy("p").agg(
        F.min(F.when(F.col("so_far") > F.col("rest"), F.struct("_h", "_t"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("so_far") <= F.col("rest"), F.col("so_far"))), F.min("before")).alias("reached"),
    )
    return whole.join(cuts, "p", "left").select("p", "cut", F.coalesce("reached", "all").alias("reached")).collect()


def _closing(sized: DataFrame, state: dict, shift: int) -> DataFrame:
    """Documents after each pattern's cut that close its gap, in the seeded order, each if it fits what is left."""
    spark = sized.sparkSession
    wanted = [(k, v["gap"], *v["cut"]) for k, v in state.items() if v.get("gap", 0) > 0 and v.get("cut")]
    if not wanted:
        return spark.createDataFrame([], EXTRA)
    at = _few(spark, wanted, "p string, gap long, ch long, ct long")
    late = F.col("size").between(1, 2 * F.col("gap") - 1) & (_after("_h", "_t", "ch", "ct") | ((F.col("_h") == F.col("ch")) & (F.col("_t") == F.col("ct"))))
    groups = sized.join(at, F.col("_pattern") == F.col("p")).where(late).groupBy("_pattern", "_h", "_t", "gap").agg(F.sum("size").alias("size"))
    left = written(groups.where(F.col("size") < 2 * F.col("gap")).drop("gap"), "mix-left")
    parts: list[DataFrame] = []
    # Each round takes all up to the first document that no longer fits; what is left then is less than its size, so
    # that it is never looked at again.
    going = {k: (gap, None) for k, gap, _, _ in wanted}
    final: dict[str, int] = {}
    while going:
        now = [(k, gap, *(cut or (None, None))) for k, (gap, cut) in going.items()]
        here = _few(spark, now, "g string, gap long, fh long, ft long")
        later = F.col("fh").isNull() | _after("_h", "_t", "fh", "ft")
        fit = left.join(here, F.col("_pattern") == F.col("g")).where(later & (F.col("size") <= F.col("gap")))
        found = {r["p"]: r for r in _cuts(fit.select("_pattern", "_h", "_t", "size"), [(k, gap) for k, gap, _, _ in now], shift)}
        reached = [(k, *(tuple(r["cut"]) if r["cut"] else (None, None))) for k, r in found.items() if r["reached"] > 0]
        if reached:
            upto = _few(spark, reached, "q string, th long, tt long")
            early = F.col("th").isNull() | _after("th", "tt", "_h", "_t")
            parts.append(fit.join(upto, F.col("_pattern") == F.col("q")).where(early).select(F.col("_pattern").alias("p"), "_h", "_t"))
        following = {}
        for k, gap, _, _ in now:
            r = found.get(k)
            rest = gap - (r["reached"] if r else 0)
            if r and r["cut"] and rest > 0:
                following[k] = (rest, tuple(r["cut"]))
            elif rest > 0:
                final[k] = rest
        going = following
    taken_ = parts[0] if parts else spark.createDataFrame([], EXTRA)
    for part in parts[1:]:
        taken_ = taken_.union(part)
    taken_ = written(taken_, "mix-extra")
    if not final:
        return taken_
    # No document left fits, but one of less than twice the gap still brings the sum nearer.
    ends = _few(spark, list(final.items()), "g string, gap long")
    free = left.join(ends, (F.col("_pattern") == F.col("g")) & (F.col("size") < 2 * F.col("gap"))).withColumnRenamed("_pattern", "p")
    free = free.join(taken_, ["p", "_h", "_t"], "left_anti")
    picks = free.groupBy("p").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "_h", "_t")).alias("m")).select("p", "m._h", "m._t")
    return written(taken_.union(picks), "mix-closed")


def plan(sized: DataFrame, weights: Callable[[list], dict], settings: Settings = Settings()) -> Plan:
    """The mix of sized documents (_pattern, _h, _t, size)."""
    spark = sized.sparkSession
    rows = [tuple(r) for r in sized.groupBy("_pattern").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()]
    shift = _shift(max((n for *_, n in rows), default=0))
    patterns = [(tuple(json.loads(key)), size) for key, size, _ in rows]
    sizes: dict = {}
    for members, size in patterns:
        for m in members:
            sizes[m] = sizes.get(m, 0) + size
    total = sum(size for members, size in patterns if members)
    goal = targets(sizes, weights(list(sizes)), total, settings.most)
    sent = route(patterns, {name: round(goal[name]) for name in goal}, settings)
    state = {}
    for (key, *_), (members, size), own in zip(rows, patterns, sent):
        taken = sum(own.values())
        copies = min(settings.most, taken // size) if size else 0
        state[key] = {"copies": copies, "rest": taken - copies * size if copies < settings.most else 0}
    open_ = [(k, int(v["rest"])) for k, v in state.items() if v["rest"] > 0]
    for r in _cuts(sized, open_, shift) if open_ else ():
        own = state[r["p"]]
        own["cut"] = tuple(r["cut"])
        own["gap"] = own["rest"] - r["reached"]
    table = []
    for (key, *_), (members, _) in zip(rows, patterns):
        v, first = state[key], members[0] if members else None
        table.append((key, v["copies"], *v.get("cut", (None, None)), sizes.get(first), goal.get(first)))
    return Plan(_few(spark, table, PLAN), _closing(sized, state, shift), sizes, goal)


def _planned(keyed: DataFrame, made: Plan) -> DataFrame:
    """The rows with their pattern's plan and _n, how often each is taken."""
    extra = made.extra.select(F.col("p").alias("xp"), F.col("_h").alias("xh"), F.col("_t").alias("xt"))
    joined = keyed.join(made.patterns, F.col("_pattern") == F.col("p"))
    # A null text has a null hash, and size 0: it is never among the extra.
    joined = joined.join(extra, (F.col("p") == F.col("xp")) & (F.col("_h") == F.col("xh")) & (F.col("_t") == F.col("xt")), "left")
    before = (F.col("_h") < F.col("cut_h")) | ((F.col("_h") == F.col("cut_h")) & (F.col("_t") < F.col("cut_t")))
    return joined.withColumn("_n", F.col("copies") + (F.coalesce(before, F.lit(False)) | F.col("xp").isNotNull()).cast("int"))


def _sized(documents: DataFrame, sources: Column, settings: Settings) -> DataFrame:
    size = F.size(words(F.coalesce("_row.text", F.lit("")))).cast("long")
    keyed = _keyed(documents, sources, settings)
    return written(keyed.select("_row.doc_id", size.alias("size"), "_pattern", "_h", "_t"), "sized")


def taken(documents: DataFrame, sources: Column | None = None, weights=cyclic_weights, settings: Settings = Settings()) -> DataFrame:
    """doc_id, size, source_size and target (of the document's first source), copies, taken (words, repeats counted).
    sources: the array of a document's sources; by default the one in its column `source`."""
    sized = _sized(documents, F.array("source") if sources is None else sources, settings)
    made = plan(sized, weights, settings)
    n = F.col("_n")
    return _planned(sized, made).select("doc_id", "size", "source_size", "target", n.cast("long").alias("copies"), (F.col("size") * n).alias("taken"))


def repeated(documents: DataFrame, sources: Column | None = None, weights=cyclic_weights, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, each as often as the mix takes it."""
    sources = F.array("source") if sources is None else sources
    made = plan(_sized(documents, sources, settings), weights, settings)
    often = _planned(_keyed(documents, sources, settings), made).where("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return often.select("_row.*")
