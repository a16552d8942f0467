"""Whole runs: dashboards and insights of many entities in one job each."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from contextlib import ExitStack
from datetime import datetime
from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.gathering import gathered
from tradeloom.params import QueryParams
from tradeloom.plans import insights
from tradeloom.plans.entities import (
    Ids,
    active_entities,
    as_ids,
    documents,
    first_entities,
    of_entities,
    query_rows,
)
from tradeloom.plans.registry import plan_of
from tradeloom.plans.snapshots import Snapshots
from tradeloom.plans.store import Store
from tradeloom.session import small_splits, written
from tradeloom.sources.staging import MONTH, staged
from tradeloom.sources.tables import Marketplace


class Steps:
    """A run's finished steps. A step writes to a new folder, which is listed once it is whole, under a digest of all that the run
    starts from; a run that failed takes up the listed ones when it is repeated on the same."""

    def __init__(self, store: Store, path: str, inputs: object):
        self.listed = Snapshots(store.spark, path)
        self.digest = hashlib.sha256(repr(inputs).encode()).hexdigest()
        self.done = self.listed.current()

    def folder(self, name: str, write: Callable[[str], object]) -> str:
        """The folder of the step, which is written first unless it is there."""
        key = (name, self.digest)
        if key not in self.done:
            made = self.listed.folder(name)
            write(self.listed.path(made))
            self.listed.publish({key: made})
            self.done[key] = made
        return self.listed.path(self.done[key])

    def close(self) -> None:
        """The run is through: repeated, it begins anew."""
        self.listed.publish(dict.fromkeys(self.done))


def write_rows(market: Marketplace, entity_type: str, params: QueryParams, path: str, steps: Steps | None = None) -> tuple[str, str]:
    """The overview with its own columns, and the rows of all queries in order; later steps read both more than once.
    They are written below the path, or as steps. All are summed from lines that are gathered by entity once."""

    def step(name: str, write: Callable[[str], object]) -> str:
        if steps is not None:
            return steps.folder(name, write)
        write(f"{path}/{name}")
        return f"{path}/{name}"

    plan = plan_of(entity_type)
    with ExitStack() as opened:

        @cache
        def sides() -> list[Marketplace]:
            read = plan.lines_read(market, params)
            lines = read.lines() if MONTH in market.lines().columns else written(read.lines(), "lines")  # read twice
            opened.enter_context(small_splits(market.spark))
            found = opened.enter_context(gathered(lines, plan.line_column, prepared=plan.prepared))
            return [read.with_lines(side, None, read.first_dates) for side in found if side is not None]

        def put_overview(to: str) -> None:
            built = [plan.overview.build(side, params) for side in sides()]
            reduce(DataFrame.unionByName, built).write.mode("overwrite").parquet(to)

        made = step("overview", put_overview)
        overview = market.spark.read.parquet(made)

        def put_rows(to: str) -> None:
            rows = query_rows(market, entity_type, params, overview, True, sides())
            rows.write.mode("overwrite").option("compression", "zstd").parquet(to)

        return made, step("rows", put_rows)


def entity_insights(
    current: DataFrame,
    history: DataFrame,
    benchmarks: DataFrame,
    entity_type: str,
    scale_history: float | None = None,
) -> DataFrame:
    """Insight records of every entity of the current overview."""
    compared = insights.current_vs_history(current, history, entity_type)
    rows = insights.metric_rows(compared, entity_type, scale_history)
    found = insights.classified(insights.deviations(rows, benchmarks))
    return insights.insight_records(insights.top_insights(found))


def run_name(now: datetime, entity_ids: Ids | None, limit: int | None) -> str:
    """The same request at the same time has the same name, so a repeated run replaces its own documents."""
    asked = "all" if entity_ids is None else "frame" if isinstance(entity_ids, DataFrame) else sorted(set(entity_ids))
    digest = hashlib.sha256(repr((asked, limit)).encode()).hexdigest()[:8]
    return f"{now:%Y%m%d_%H%M%S}_{digest}"


def run_entities(
    store: Store,
    market: Marketplace,
    entity_type: str,
    params: QueryParams,
    now: datetime,
    entity_ids: Ids | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Write dashboards and insights of all active, or the given, entities; a status row for each, also for a given
    one that has no lines in the period.

    Needs the history of the type. Every query runs once for all entities, on lines that are joined and
    written once (pass `store.lines(market)` to use those of the last sync); for given entities only their
    own lines are read. Ids may be a list or a frame of any size. A run that fails is taken up after its last finished
    step when it is repeated with the same request and time on the same state of the store; not with ids in a frame, or
    lines that are not the store's, whose content nothing names.
    """
    now = now.replace(microsecond=0)  # documents keep no finer time
    if not store.history_exists(entity_type):
        raise LookupError(f"no {entity_type} history; sync first")
    run = run_name(now, entity_ids, limit)
    path = f"{store.root}/runs/{entity_type}/{run}"
    if entity_ids is not None:
        market = of_entities(market, entity_type, entity_ids)
    named = not isinstance(entity_ids, DataFrame) and market.first_dates is not None
    state = sorted(store.snapshots.current().items()) if named else uuid.uuid4().hex
    steps = Steps(store, path, (state, entity_type, params, run))
    market = staged(market, f"{path}/lines")
    overview, rows = write_rows(market, entity_type, params, path, steps)
    rows = store.spark.read.parquet(rows)

    ids = active_entities(market, entity_type, params.period)
    if limit is not None:
        ids = first_entities(ids, limit)
    # Documents have their place in the store; the step's own folder stays empty.
    steps.folder("dashboards", lambda _: store.write_dashboards(documents(ids, rows, entity_type, params, now), entity_type, run))

    def put_insights(_: str) -> None:
        plan = plan_of(entity_type)
        chosen = ids.withColumnRenamed("entity_id", plan.id_column)
        current = store.spark.read.parquet(overview).join(chosen, plan.id_column, "left_semi")
        benchmarks = store.benchmark_lookup(entity_type)
        records = entity_insights(current, store.overview(entity_type), benchmarks, entity_type)
        store.write_insights(insights.insight_documents(insights.valid_insights(records), params, now), entity_type, run)

    steps.folder("insights", put_insights)
    steps.close()

    made = store.insights(run).filter(F.col("entity_type") == entity_type).select("entity_id", "insights_count")
    asked = ids if entity_ids is None or limit is not None else as_ids(store.spark, entity_ids)
    status = F.when(F.col("insights_count").isNull(), "error").otherwise("success")
    return asked.join(made, "entity_id", "left").select(
        "entity_id", status.alias("status"), F.coalesce("insights_count", F.lit(0)).alias("insights_count")
    )
