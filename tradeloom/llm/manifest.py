"""Merkle manifest of a table: a digest for each row, a tree over each language, one over the languages, and proofs.

A row's leaf is the hash of its columns, made in the JVM. The leaves of a language stand in the order of their ids;
runs of eight become their hash until one is left. The order of all leaves comes from one sort by ranges, written with
row numbers, so no window holds a language. A superblock is 4,096 leaves: four levels of the tree. Each is reduced by itself
to one node, and the nodes of all superblocks form the same problem again, 4,096 times smaller, up to the top. On the way
back the leaves and the outer nodes that they need (siblings above their superblock, up to the root) are cogrouped by
superblock: the task reduces its four levels once more, joins each leaf's proof, and folds the leaf, or a tampered
one in its place, with the original siblings up to the root.

Defined results: a null column is hashed as `-`; a null language is a language, the first; null ids come first in theirs and
are never tampered with; rows of equal language and id stand in the order of their leaves, so repeated rows have the same
leaf and a place each, with proofs of their own (equal columns cannot tell which row has which); a language that each row has
alone is a tree of one leaf; empty texts and texts of any length are hashed whole; only the five columns are hashed,
further ones are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import ship, written

#: Children of a node, and the levels in a superblock (four of eight: 4,096 leaves).
ARITY, LEVELS = 8, 4
#: The hashed columns, in order.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "key string, n long, pos long, digest string"
#: at: a node's place among its run, level by level upwards; siblings: the others of the run, left to right.
PATH = "at array<int>, siblings array<array<string>>"
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(_part(columns[c]) for c in HASHED)), 256)


def leaves(documents: DataFrame) -> DataFrame:
    """key (of the language, in their order), doc_id, leaf, and tampered: the leaf with its text's A-Z lower-cased
    where 3 divides the id's checksum, else null."""
    columns = {c: F.col(c) for c in HASHED}
    changed = columns | {"text": F.translate("text", UPPER, LOWER)}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return documents.select(
        F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "lang")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(columns).alias("leaf"),
        F.when(chosen, leaf_of(changed)).alias("tampered"),
    )


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with n, the rows of their key, and pos, their place in it by the order, from 0.

    Rows are sorted by ranges and written with their number in the range; sums of the ranges' counts give the places. The
    last sort column numbers the rows as written, so equal rows are split over ranges too.
    """
    fixed = written(rows.withColumn("_tie", F.monotonically_increasing_id()), "manifest-rows")
    by = ["key", *order, "_tie"]
    placed = fixed.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).drop("_tie")
    placed = written(placed, "manifest-order")
    counts = placed.groupBy("key", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    all_of_key = Window.partitionBy("key")  # a row for each range that holds the key
    counts = counts.withColumns(
        {
            "_before": F.sum("_rows").over(all_of_key.orderBy("_range")) - F.col("_rows"),
            "n": F.sum("_rows").over(all_of_key),
        }
    )
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(counts, ["key", "_range"]).withColumn("pos", pos).drop("_range", "_at", "_first", "_rows", "_before")


def levels_of(n: int, most: int) -> int:
    """Levels that a superblock of a key of n nodes climbs: to its one node, of a small key to the top."""
    levels = 0
    while levels < most and ARITY**levels < n:
        levels += 1
    return levels


def reduced(digests: Sequence[str], levels: int) -> list[list[str]]:
    """The digests and the levels above them."""
    out = [list(digests)]
    for _ in range(levels):
        last = out[-1]
        out.append([sha256("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return out


def path_in(tree: list[list[str]], i: int) -> tuple[list[int], list[list[str]]]:
    """Place and siblings of leaf i of the reduced levels, upwards."""
    at, siblings = [], []
    for level in tree[:-1]:
        start, place = i - i % ARITY, i % ARITY
        at.append(place)
        siblings.append(level[start : start + place] + level[start + place + 1 : start + ARITY])
        i //= ARITY
    return at, siblings


def fold(node: str, at: Sequence[int], siblings: Sequence[Sequence[str]]) -> str:
    for place, others in zip(at, siblings, strict=True):
        node = sha256("".join([*others[:place], node, *others[place:]]))
    return node


def _superblock(levels: int) -> Column:
    return F.expr(f"pos div {ARITY**levels}").alias("block")


def superblocks(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each superblock, as nodes of the same key."""
    held = ARITY**levels

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows.n.iloc[0])
        top = reduced(rows.digest, levels_of(n, levels))[-1]
        return pd.DataFrame({"key": [rows.key.iloc[0]], "n": [-(-n // held)], "pos": [int(rows.pos.iloc[0]) // held], "digest": top})

    return written(nodes.groupBy("key", _superblock(levels)).applyInPandas(run, NODE), "manifest-nodes")


def climb(nodes: DataFrame, levels: int) -> DataFrame:
    """Path and top for each node: key, pos, at, siblings, top."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    blocks = superblocks(nodes, levels)
    if largest > ARITY**levels:
        above = climb(blocks, levels)
    else:
        empty = {"at": F.array().cast("array<int>"), "siblings": F.array().cast("array<array<string>>")}
        above = blocks.select("key", "pos", *(c.alias(name) for name, c in empty.items()), F.col("digest").alias("top"))

    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, found = rows.sort_values("pos"), []
        tree = reduced(rows.digest, levels_of(int(rows.n.iloc[0]), levels))
        rest = _outer(outer)
        for i, pos in enumerate(rows.pos):
            at, siblings = path_in(tree, i)
            found.append((rows.key.iloc[0], pos, at + rest[0], siblings + rest[1], outer.top.iloc[0]))
        return pd.DataFrame(found, columns=["key", "pos", "at", "siblings", "top"])

    by_block = above.withColumnRenamed("pos", "block").groupBy("key", "block")
    both = nodes.groupBy("key", _superblock(levels)).cogroup(by_block)
    return written(both.applyInPandas(run, f"key string, pos long, {PATH}, top string"), "manifest-paths")


def _outer(outer: pd.DataFrame) -> tuple[list[int], list[list[str]]]:
    return [int(x) for x in outer["at"].iloc[0]], [list(level) for level in outer["siblings"].iloc[0]]


def manifest(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; superblocks of so many levels."""
    ship(documents.sparkSession)
    rows = numbered(leaves(documents), ["doc_id", "leaf"])
    blocks = superblocks(rows.select("key", "n", "pos", F.col("leaf").alias("digest")), levels)
    inner = climb(blocks, levels)  # paths from the superblocks to their language's subroot
    subroots = inner.where(F.col("pos") == 0).select(F.lit("").alias("key"), F.col("key").alias("_lang"), F.col("top").alias("digest"))
    ordered = written(numbered(subroots, ["_lang"]), "manifest-subroots")
    upper = climb(ordered.select("key", "n", "pos", "digest"), levels).join(ordered.select("pos", "_lang"), "pos")
    upper = upper.select(
        F.col("_lang").alias("key"), F.col("at").alias("_at"), F.col("siblings").alias("_siblings"), F.col("top").alias("root")
    )
    outer = inner.join(upper, "key").select(
        "key",
        F.col("pos").alias("block"),
        F.concat("at", "_at").alias("at"),
        F.concat("siblings", "_siblings").alias("siblings"),
        F.col("top").alias("subroot"),
        "root",
    )

    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree, rest = reduced(rows.leaf, levels_of(int(rows.n.iloc[0]), levels)), _outer(outer)
        root, proofs, folded = outer.root.iloc[0], [], []
        for i, (leaf, tampered) in enumerate(zip(rows.leaf, rows.tampered, strict=True)):
            at, siblings = path_in(tree, i)
            at, siblings = at + rest[0], siblings + rest[1]
            proofs.append(sha256("".join(digest for level in siblings for digest in level)))
            folded.append(fold(leaf if tampered is None else tampered, at, siblings))
        return pd.DataFrame(
            {
                "doc_id": rows.doc_id.astype("Int64"),
                "leaf": rows.leaf,
                "subroot": outer.subroot.iloc[0],
                "root": root,
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [f == root for f in folded],
            }
        )

    both = rows.groupBy("key", _superblock(levels)).cogroup(outer.groupBy("key", "block"))
    return both.applyInPandas(run, PROOF)
