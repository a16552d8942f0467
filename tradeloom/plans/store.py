"""Written tables: history, benchmarks, sync log, dashboard and insight documents."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.operators.gathering import gathered
from tradeloom.params import ENTITY_TYPES, QueryParams
from tradeloom.plans import buyer
from tradeloom.plans.benchmarks import merge_rows, platform_benchmarks
from tradeloom.plans.entities import documents, in_order, json_rows, numbered, overview_lines, query_frames
from tradeloom.plans.registry import plan_of
from tradeloom.plans.snapshots import Parts, Snapshots
from tradeloom.session import small_splits
from tradeloom.sources.increments import StagedLines
from tradeloom.sources.staging import MONTH
from tradeloom.sources.tables import Marketplace

HISTORY_SCHEMA = """
    entity_id bigint, query string, position double, row string, chunk int, created_at timestamp, updated_at timestamp
"""
#: What is written with a history row besides its own columns.
KEPT_WITH_HISTORY = ("chunk", "created_at", "updated_at")
BENCHMARK_SCHEMA = """
    total_count bigint, avg_period_spend double, avg_counterparties double, std_period_spend double,
    std_counterparties double, platform_total_spend double, platform_total_orders double,
    platform_total_counterparties double, median_period_spend double, median_counterparties double,
    p25 double, p50 double, p75 double, p90 double, calculated_at timestamp
"""
LOG_SCHEMA = """
    synced_at timestamp, entity_type string, entities_count int, duration_s double, status string,
    error_message string
"""
INSIGHT = """struct<title:string,observation:string,recommendation:string,priority:string,
    comparison_type:string,metrics:array<string>>"""
INSIGHT_DOCUMENT_SCHEMA = f"""
    entity_id bigint, generated_at timestamp,
    dashboard_period struct<start_date:date,end_date:date,top_n:int>, insights array<{INSIGHT}>,
    insights_count int, high_priority_count int,
    comparison_types struct<self:int,benchmark:int,both:int>, has_historical_data boolean,
    dashboard_run string, broken string
"""

DASHBOARD_SCHEMA = """
    entity_id bigint, execution_timestamp timestamp,
    parameters struct<start_date:date,end_date:date,top_n:int>, query string, description string,
    error string, result_count bigint, part int, parts int, data array<variant>, entity_type string,
    run string
"""


class EmptyOverviewError(ValueError):
    """The overview found no entity, so there is nothing to replace the history with."""


class Store:
    """Tables below one folder that all executors share.

    Lines, first dates, history, overviews and benchmarks are snapshots: what a sync writes of an entity type is seen
    all at once, when it is published, and a failure before that leaves the former state whole.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.snapshots = Snapshots(spark, root)
        self.staged_lines = StagedLines(self.snapshots)

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema: str, source: str = "parquet", **options: str) -> DataFrame:
        """The table, or no rows where nothing was written yet."""
        kind = StructType.fromDDL(schema)
        try:
            return self.spark.read.schema(kind).options(**options).format(source).load(self._path(table))
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], kind)

    def _snapshot(self, table: str, entity_types: Sequence[str], schema: str | None = None) -> DataFrame | None:
        """The newest rows of these entity types, with their type in a column; None if there are none yet."""
        parts = self.snapshots.current()
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        frames = [
            reader.parquet(self.snapshots.path(parts[table, kind])).withColumn("entity_type", F.lit(kind))
            for kind in entity_types
            if (table, kind) in parts
        ]
        return reduce(DataFrame.unionByName, frames) if frames else None

    # History

    def _put_history(
        self, frames: Mapping[str, DataFrame], entity_type: str, updated_at: datetime, together: Mapping[str, DataFrame] | None = None
    ) -> Parts:
        """Each query has a folder of its own, with its own columns. In it files hold ranges of entities, so a lookup skips
        most by their least and greatest one; an entity with most rows spreads over files. The rows of other entities may come
        `together`: they are written as they lie, and ranged by entity if their lines were. One query is written after
        another, so that what it was summed from need not be kept for the next."""
        folder = self.snapshots.folder("history")
        stamp = {"created_at": F.lit(updated_at), "updated_at": F.lit(updated_at)}
        placed = [(name, in_order(frame, entity_type, name)) for name, frame in frames.items()]
        placed += [(name, numbered(frame, entity_type, name)) for name, frame in (together or {}).items()]
        for name, frame in placed:
            (
                frame.withColumns(stamp)
                .write.mode("append")
                .option("compression", "zstd")
                .parquet(f"{self.snapshots.path(folder)}/query={name}")
            )
        return {("history", entity_type): folder}

    def write_history(self, frames: Mapping[str, DataFrame], entity_type: str, updated_at: datetime) -> None:
        """Replace the history of one entity type by these rows, by query; a query without rows has none afterwards."""
        self.snapshots.publish(self._put_history(frames, entity_type, updated_at))

    def history(self, entity_type: str, query: str | None = None) -> DataFrame:
        """The rows of one query or all, their own columns as JSON."""
        folder = self.snapshots.current().get(("history", entity_type))
        names = [q.name for q in plan_of(entity_type).queries] if query is None else [query]
        found = [] if folder is None else [self._history_of(folder, entity_type, name) for name in names]
        frames = [f for f in found if f is not None]
        rows = reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], HISTORY_SCHEMA)
        return rows.withColumn("entity_type", F.lit(entity_type))

    def _history_of(self, folder: str, entity_type: str, name: str) -> DataFrame | None:
        path = self.snapshots.path(folder)
        try:
            rows = self.spark.read.option("basePath", path).parquet(f"{path}/query={name}")
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return json_rows(rows.filter(F.col("query") == name).drop("query"), entity_type, name, *KEPT_WITH_HISTORY)

    def overview(self, entity_type: str) -> DataFrame:
        """The overview query's rows of the last sync, typed; also of what belongs to no entity."""
        rows = self._snapshot("overview", [entity_type])
        if rows is None:
            raise LookupError(f"no {entity_type} overview; sync first")
        return rows.drop("entity_type")

    def entities(self, entity_type: str) -> DataFrame:
        """Ids of entities with history; each has one overview row."""
        column = plan_of(entity_type).id_column
        rows = self._snapshot("overview", [entity_type])
        rows = self.spark.createDataFrame([], f"{column} bigint") if rows is None else rows
        return rows.select(F.col(column).alias("entity_id")).filter(F.col("entity_id").isNotNull())

    def history_exists(self, entity_type: str) -> bool:
        return not self.entities(entity_type).isEmpty()

    def history_documents(self, entity_type: str, params: QueryParams, executed_at: datetime) -> DataFrame:
        """Documents of the entities the overview knows, with an empty part for each query without rows."""
        ids = self.entities(entity_type)
        return documents(ids, self.history(entity_type), entity_type, params, executed_at)

    def history_lookup(self, entity_type: str, entity_id: int) -> DataFrame:
        """All history rows of one entity; raises if there are none."""
        rows = self.history(entity_type).filter(F.col("entity_id") == entity_id)
        if rows.isEmpty():
            raise LookupError(f"no history for {entity_type} {entity_id}")
        return rows

    # First dates

    def add_first_dates(self, lines: DataFrame, batch: str) -> None:
        """The first dates that a batch of new lines tells; a repeated batch replaces its own. For lines that no sync
        stages; a sync keeps its own."""
        buyer.first_dates(lines).write.mode("overwrite").parquet(f"{self._path('first_dates')}/batch={batch}")

    def first_dates(self) -> DataFrame:
        """When each buyer first bought each product, and from each seller, over all batches so far. With it
        `buyer.overview` reads the lines of its two periods only."""
        return buyer.earliest(self.spark.read.parquet(self._path("first_dates")))

    # Benchmarks

    def _put_benchmarks(self, benchmarks: DataFrame, calculated_at: datetime) -> Parts:
        folder = self.snapshots.folder("benchmarks")
        stamped = benchmarks.withColumn("calculated_at", F.lit(calculated_at))
        stamped.write.partitionBy("entity_type").parquet(self.snapshots.path(folder))
        kinds = self.spark.read.parquet(self.snapshots.path(folder)).select("entity_type").collect()  # a row each
        return {("benchmarks", kind): f"{folder}/entity_type={kind}" for (kind,) in kinds}

    def write_benchmarks(self, benchmarks: DataFrame, calculated_at: datetime) -> None:
        """Insert or replace the one row of each entity type that occurs."""
        self.snapshots.publish(self._put_benchmarks(benchmarks, calculated_at))

    def benchmarks(self, entity_type: str | None = None) -> DataFrame:
        table = self._snapshot("benchmarks", ENTITY_TYPES if entity_type is None else [entity_type], BENCHMARK_SCHEMA)
        return self.spark.createDataFrame([], f"{BENCHMARK_SCHEMA}, entity_type string") if table is None else table

    def benchmark_lookup(self, entity_type: str) -> DataFrame:
        found = self.benchmarks(entity_type)
        if found.isEmpty():
            raise LookupError(f"no benchmarks for {entity_type}")
        return found

    # Sync log

    def append_log(
        self, entity_type: str, count: int, seconds: float, status: str, error: str | None, at: datetime
    ) -> None:
        row = self.spark.createDataFrame([(at, entity_type, count, seconds, status, error)], LOG_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self._path("sync_log"))

    def log(self) -> DataFrame:
        return self._read("sync_log", LOG_SCHEMA)

    def latest_sync(self) -> DataFrame:
        log = self.log()
        newest = log.agg(F.max_by(F.struct(*log.columns), "synced_at").alias("last"))
        return newest.filter(F.col("last").isNotNull()).select("last.*")

    def health(self) -> DataFrame:
        """One row: entities per type and the newest log entry."""
        parts = [self.entities(kind).agg(F.count("*").alias(f"{kind}s")) for kind in ENTITY_TYPES]
        parts.append(
            self.latest_sync().select(
                F.col("synced_at").alias("last_synced_at"), F.col("status").alias("last_status")
            )
        )
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return merge_rows(rows)

    # Sync

    def sync(
        self,
        market: Marketplace,
        params: dict[str, QueryParams],
        now: datetime,
    ) -> dict[str, int]:
        """Rebuild history and benchmarks of the given entity types and log each outcome.

        The joined lines are staged below the store and follow their sources: only months with a changed line are
        written, and with them the first dates of what each buyer bought. The overview is computed and written once:
        history and benchmarks are taken from it. All of a type is written before any of it is published; a type that
        fails until then, or whose overview is empty, keeps what it had. Lines that come staged are read where they are.
        """
        started = time.monotonic()
        if MONTH not in market.lines().columns:
            self.stage(market)
            market = self.staged_lines.market(market, self.snapshots.current()) or market
        counts: dict[str, int] = {}
        for entity_type, chosen in params.items():
            try:
                counts[entity_type] = self._sync_type(market, entity_type, chosen, now)
                status, error = "success", None
            except Exception as failure:
                counts[entity_type] = 0
                status, error = "error", f"{type(failure).__name__}: {failure}"
            seconds = time.monotonic() - started
            done = now + timedelta(seconds=seconds)
            self.append_log(entity_type, counts[entity_type], seconds, status, error, done)
        return counts

    def _sync_type(self, market: Marketplace, entity_type: str, params: QueryParams, now: datetime) -> int:
        if overview_lines(market, entity_type, params.period).isEmpty():
            raise EmptyOverviewError(f"no {entity_type} in {params.period}")
        plan, folder = plan_of(entity_type), self.snapshots.folder("overview")
        read = plan.lines_read(market, params)
        with small_splits(self.spark), gathered(read.lines(), plan.line_column, prepared=plan.prepared) as (lines, spread):
            near = read.with_lines(lines, None, read.first_dates)
            far = None if spread is None else read.with_lines(spread, None, read.first_dates)
            overviews = [plan.overview.build(side, params) for side in (near, far) if side is not None]
            reduce(DataFrame.unionByName, overviews).write.parquet(self.snapshots.path(folder))
            overview = self.spark.read.parquet(self.snapshots.path(folder))
            made: Parts = {("overview", entity_type): folder}
            made |= self._put_benchmarks(platform_benchmarks(overview, entity_type), now)
            together = query_frames(market, entity_type, params, overview, near)
            ranged = {} if far is None else query_frames(far, entity_type, params, overview)
            ranged[plan.overview.name] = together.pop(plan.overview.name)
            made |= self._put_history(ranged, entity_type, now, together)
        self.snapshots.publish(made)
        return self.entities(entity_type).count()

    def stage(self, market: Marketplace) -> bool:
        """Let the staged lines follow the sources; False if nothing changed."""
        with small_splits(self.spark):
            changes = self.staged_lines.changes(market, self.snapshots.current())
        if changes:
            self.snapshots.publish(changes)
        return bool(changes)

    def lines(self, market: Marketplace) -> Marketplace:
        """The marketplace with the joined lines, zones and first dates that the last sync wrote."""
        found = self.staged_lines.market(market, self.snapshots.current())
        if found is None:
            raise LookupError("no staged lines; sync first")
        return found

    def update_distincts(self) -> bool:
        """Let the sets of what vendors sold follow the staged lines, month by month; False if nothing changed."""
        changes = self.staged_lines.set_changes(self.snapshots.current())
        if changes:
            self.snapshots.publish(changes)
        return bool(changes)

    def distinct_counts(self, resolution: str) -> DataFrame:
        """Products and buyers of each vendor by month, quarter or year, from the sets of the months."""
        return self.staged_lines.distinct_counts(self.snapshots.current(), resolution)

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions but the newest and the folders that only they name."""
        return self.snapshots.vacuum(keep)

    # Documents

    def _write_run(self, docs: DataFrame, table: str, entity_type: str, run: str) -> None:
        """The documents of one run, which a repeated run replaces."""
        path = f"{self._path(table)}/entity_type={entity_type}/run={run}"
        with small_splits(self.spark):
            docs.drop("entity_type").write.mode("overwrite").option("compression", "gzip").json(path)

    def write_dashboards(self, docs: DataFrame, entity_type: str, run: str) -> None:
        self._write_run(docs, "dashboards", entity_type, run)

    def write_insights(self, docs: DataFrame, entity_type: str, run: str) -> None:
        """Each document names the run whose dashboards it was made from."""
        self._write_run(docs.withColumn("dashboard_run", F.lit(run)), "insights", entity_type, run)

    def dashboards(self, run: str | None = None) -> DataFrame:
        """Dashboard documents; a line that cannot be parsed fails the read."""
        docs = self._read("dashboards", DASHBOARD_SCHEMA, "json", mode="FAILFAST")
        return docs if run is None else docs.filter(F.col("run") == run)

    def _insight_lines(self) -> DataFrame:
        lines = self._read("insights", "value string, entity_type string, run string", "text")
        # Parsed here, as Spark's reader cannot tell broken lines from others by themselves.
        document = F.from_json("value", INSIGHT_DOCUMENT_SCHEMA, {"columnNameOfCorruptRecord": "broken"})
        return lines.select(document.alias("d"), "entity_type", "run").select("d.*", "entity_type", "run")

    def insights(self, run: str | None = None) -> DataFrame:
        """Insight documents; lines that cannot be parsed are left to `skipped_insights`."""
        docs = self._insight_lines()
        docs = docs if run is None else docs.filter(F.col("run") == run)
        return docs.filter(F.col("broken").isNull()).drop("broken")

    def skipped_insights(self) -> DataFrame:
        """Lines of insight files that cannot be parsed: entity_type, run, broken."""
        return self._insight_lines().filter(F.col("broken").isNotNull()).select("entity_type", "run", "broken")
