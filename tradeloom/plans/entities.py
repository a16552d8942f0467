"""Which entities are active, and their documents: the rows of every query, per entity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.operators.filters import entity_slice
from tradeloom.operators.gathering import gathered
from tradeloom.params import Period, QueryParams
from tradeloom.plans import buyer
from tradeloom.plans.registry import NamedQuery, plan_of
from tradeloom.session import written
from tradeloom.sources.staging import lines_created_in
from tradeloom.sources.tables import Marketplace

ROWS_PER_PART = 10_000
KEY = ["entity_id", "query"]


def entity_lines(market: Marketplace, entity_type: str, period: Period) -> DataFrame:
    """Ids of the lines in the period: by item update for buyers, by creation for sellers."""
    plan_of(entity_type)
    if entity_type == "buyer":
        ids = buyer.updated_in(market, period).select(F.col("buyer_org_id").alias("entity_id"))
    else:
        ids = lines_created_in(market.lines(), period).select(F.col("seller_org_id").alias("entity_id"))
    return ids.filter(F.col("entity_id").isNotNull())


def active_entities(market: Marketplace, entity_type: str, period: Period) -> DataFrame:
    return entity_lines(market, entity_type, period).distinct()


def overview_lines(market: Marketplace, entity_type: str, period: Period) -> DataFrame:
    """Lines that make an entity appear in the overview, which for buyers shows two periods."""
    if entity_type == "buyer":
        period = Period(period.previous.start, period.end)
    return entity_lines(market, entity_type, period)


def first_entities(ids: DataFrame, limit: int) -> DataFrame:
    return ids.orderBy("entity_id").limit(limit)


Ids = Sequence[int] | DataFrame


def as_ids(spark: SparkSession, ids: Ids) -> DataFrame:
    """Distinct asked-for ids as one column, entity_id."""
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("bigint").alias("entity_id")).distinct()
    return spark.createDataFrame([(int(i),) for i in dict.fromkeys(ids)], "entity_id bigint")


def of_entities(market: Marketplace, entity_type: str, ids: Ids) -> Marketplace:
    """The marketplace as these entities see it.

    Every query treats its entities apart, so their lines can be picked before anything is summed. Ids that
    are listed become a filter of the scan; ids in a frame may be any number and are joined.
    """
    column = "buyer_org_id" if entity_type == "buyer" else "seller_org_id"
    if not isinstance(ids, DataFrame):
        return market.with_lines(entity_slice(market.lines(), column, ids), market.zones, market.first_dates)
    asked = as_ids(market.spark, ids).withColumnRenamed("entity_id", column)
    return market.with_lines(market.lines().join(asked, column, "left_semi"), market.zones, market.first_dates)


def whole_overview(market: Marketplace, entity_type: str, params: QueryParams) -> DataFrame:
    """The overview of all entities, from lines that are moved once, by entity, and summed where they lie. Entities of
    very many lines stay spread."""
    plan = plan_of(entity_type)
    read = plan.lines_read(market, params)
    with gathered(read.lines(), plan.line_column, kept=False) as sides:
        built = [plan.overview.build(read.with_lines(side, None, read.first_dates), params) for side in sides if side is not None]
    return reduce(DataFrame.unionByName, built)


def query_frames(
    market: Marketplace, entity_type: str, params: QueryParams, overview: DataFrame | None = None, gathered: Marketplace | None = None
) -> dict[str, DataFrame]:
    """The rows of each query with its own columns, by its name. A query that lacks a parameter has none. An overview that
    is already written need not be computed again. Where the market's lines are gathered by entity, they are read there."""
    plan = plan_of(entity_type)
    market = market if gathered is None else gathered
    return {
        query.name: overview if query is plan.overview and overview is not None else query.build(market, params)
        for query in plan.queries
        if query.error(params) is None
    }


def json_rows(frame: DataFrame, entity_type: str, name: str, *kept: str) -> DataFrame:
    """A query's rows as entity_id, query, position, row as JSON, and the columns to keep, which are no part of the row."""
    plan = plan_of(entity_type)
    own = [c for c in frame.columns if c not in kept]
    return frame.select(
        F.col(plan.id_column).alias("entity_id"),
        F.lit(name).alias("query"),
        plan.query(name).position().alias("position"),
        F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("row"),
        *kept,
    )


def query_rows(
    market: Marketplace,
    entity_type: str,
    params: QueryParams,
    overview: DataFrame | None = None,
    ordered: bool = False,
    sides: Sequence[Marketplace] = (),
) -> DataFrame:
    """The rows of all queries in one long table: entity_id, query, position, row as JSON; and `chunk` if each query's are to
    be `in_order`. Where the lines are gathered by entity, `sides` are the marketplaces with those put together, whose rows
    are `numbered` where they lie, and with those that stay spread, if any; the overview given holds the entities of both.

    A query that lacks a parameter gives no rows; `documents` reports its error.
    """
    if not ordered:
        frames = query_frames(market, entity_type, params, overview)
        return reduce(DataFrame.unionByName, (json_rows(f, entity_type, n) for n, f in frames.items()))
    placed = []
    for side, place in zip(sides, (numbered, in_order)) if sides else [(market, in_order)]:
        frames = query_frames(side, entity_type, params, overview)
        if placed:
            del frames[plan_of(entity_type).overview.name]
        placed += [json_rows(place(f, entity_type, n), entity_type, n, "chunk") for n, f in frames.items()]
    return reduce(DataFrame.unionByName, placed)


def in_order(frame: DataFrame, entity_type: str, name: str) -> DataFrame:
    """A query's rows range-partitioned by entity and position, with the number of their partition in `chunk`. Written
    so, they can be numbered without any task holding all rows of an entity.

    They move with their own columns, a few bytes each; their JSON text, several times as long, is made from them where
    it is read. Equal positions follow the column behind the entity, as their JSON texts do. Ranging looks at the rows
    once before it moves them. All that they are summed from has been shuffled by then and is not shuffled again, so they
    need not be written first."""
    plan = plan_of(entity_type)
    key = [F.col(plan.id_column), plan.query(name).position()]
    ordered = frame.repartitionByRange(*key, F.col(next(c for c in frame.columns if c != plan.id_column)).cast("string"))
    return ordered.sortWithinPartitions(*key).withColumn("chunk", F.spark_partition_id())


def numbered(frame: DataFrame, entity_type: str, name: str) -> DataFrame:
    """As `in_order`, of entities that have few enough rows for one task: `chunk` numbers each one's runs of `ROWS_PER_PART`
    rows, or of days in a series. Rows move only where those of an entity are not together yet, as after a join with the catalog by product."""
    plan = plan_of(entity_type)
    if plan.query(name).kind == "overview":
        return frame.withColumn("chunk", F.lit(0))
    if plan.query(name).kind == "time_series":  # one row of an entity a day at most, and positions count days
        chunk = F.floor(plan.query(name).position() / ROWS_PER_PART).cast("int")
        return frame.sortWithinPartitions(plan.id_column).withColumn("chunk", chunk)
    behind = F.col(next(c for c in frame.columns if c != plan.id_column)).cast("string")
    own = F.row_number().over(Window.partitionBy(plan.id_column).orderBy(plan.query(name).position(), behind))
    return frame.withColumn("chunk", F.floor((own - 1) / ROWS_PER_PART).cast("int"))


def documents(
    ids: DataFrame,
    rows: DataFrame,
    entity_type: str,
    params: QueryParams,
    executed_at: datetime,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """The documents of the given entities, one or more parts per entity and query.

    A query without rows for an entity has one empty part. A vendor's orders are unbounded, so an entity's rows
    are cut into parts of `rows_per_part` in the query's order: part 0 holds its first rows, and all parts in
    sequence are the query's result. `part` and `parts` number them. `rows` is a written table of rows `in_order`
    and read more than once.

    Rows that fit one part move once, to their entity, and need not be numbered. Those of entities and queries that need more
    are numbered by their chunks.
    """
    plan = plan_of(entity_type)
    queries = F.array(*(F.lit(q.name) for q in plan.queries))
    asked = ids.select("entity_id")
    counts = rows.groupBy(*KEY).agg(F.count("*").alias("result_count"))
    large = written(counts.filter(F.col("result_count") > rows_per_part), "large-documents")
    is_large = (F.col("entity_id") == F.col("_id")) & (F.col("query") == F.col("_query"))
    named = large.select(F.col("entity_id").alias("_id"), F.col("query").alias("_query"))
    whole = (
        rows.join(named, is_large, "left_anti")
        .join(asked, "entity_id", "left_semi")
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("position", "row"))).alias("ordered"))
        .select(
            *KEY,
            F.lit(0).alias("part"),
            F.lit(1).alias("parts"),
            F.size("ordered").cast("bigint").alias("result_count"),
            F.transform("ordered", lambda r: F.parse_json(r["row"])).alias("data"),
        )
    )
    wanted = rows.join(named, is_large, "left_semi").join(asked, "entity_id", "left_semi")
    chunks = wanted.groupBy(*KEY, "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*KEY).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select(*KEY, "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(*KEY, "chunk").orderBy("position", "row"))
    numbered = wanted.withColumn("own", own).join(before, [*KEY, "chunk"])
    part = F.floor((F.col("before") + F.col("own") - 1) / rows_per_part).cast("int")
    in_parts = (
        numbered.groupBy(*KEY, part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "row"))).alias("ordered"))
        .join(large, KEY)
        .select(
            *KEY,
            "part",
            F.ceil(F.col("result_count") / rows_per_part).cast("int").alias("parts"),
            "result_count",
            F.transform("ordered", lambda r: F.parse_json(r["row"])).alias("data"),
        )
    )
    empty = (
        asked.withColumn("query", F.explode(queries))
        .join(counts, KEY, "left_anti")
        .select(
            *KEY,
            F.lit(0).alias("part"),
            F.lit(1).alias("parts"),
            F.lit(0).cast("bigint").alias("result_count"),
            F.array().cast("array<variant>").alias("data"),
        )
    )

    def of_query(value: Callable[[NamedQuery], str | None]) -> Column:
        chosen = F.lit(None).cast("string")
        for q in plan.queries:
            chosen = F.when(F.col("query") == q.name, F.lit(value(q)).cast("string")).otherwise(chosen)
        return chosen

    return whole.unionByName(in_parts).unionByName(empty).select(
        F.lit(entity_type).alias("entity_type"),
        "entity_id",
        F.lit(executed_at).alias("execution_timestamp"),
        F.struct(
            F.lit(params.period.start).alias("start_date"),
            F.lit(params.period.end).alias("end_date"),
            F.lit(params.top_n).alias("top_n"),
        ).alias("parameters"),
        "query",
        of_query(lambda q: q.description).alias("description"),
        of_query(lambda q: q.error(params)).alias("error"),
        "result_count",
        "part",
        "parts",
        "data",
    )


def select_batch(spark: SparkSession, entity_ids: Ids, available: DataFrame) -> DataFrame:
    """Every requested entity with a status; `available` has the entities with a result."""
    requested = as_ids(spark, entity_ids)
    found = available.select("entity_id").distinct().withColumn("found", F.lit(True))
    return requested.join(found, "entity_id", "left").select(
        "entity_id", F.when(F.col("found"), "success").otherwise("error").alias("status")
    )


def batch_summary(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "error").alias("failed"),
    )
