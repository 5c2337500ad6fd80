"""Refreshing the stored tables: staging incrementally, then the marts and the checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.operators import checks
from dayledger.operators.dimension import dim_creative
from dayledger.operators.fact import ranks, with_measures, with_ranks
from dayledger.operators.latest import latest_deliveries
from dayledger.plans.defect_log import log_defects
from dayledger.plans.incremental import stored_lookback_start, within_lookback
from dayledger.plans.snapshot import write_snapshot
from dayledger.sources.ingest import LOADED, RunSummary, ingest
from dayledger.sources.tables import COMPACT, Store

_BY_DAY = ["event_date"]


@dataclass(frozen=True)
class StagingRun:
    # First recomputed event day; None for a full build.
    start: date | None
    rows_in: int
    rows_out: int


@dataclass(frozen=True)
class DailyRun:
    ingested: RunSummary
    staging: StagingRun


def refresh_staging(
    store: Store, settings: Settings = DEFAULTS, full_refresh: bool = False
) -> StagingRun:
    """Recompute the lookback window of staging, or all of it.

    Full on request and while the target has no event day. Every recomputed day is
    replaced as a whole partition; days before the window stay untouched, so a row
    that arrives later than the window reaches is left to the next full refresh.
    """
    start = None if full_refresh else stored_lookback_start(store.staging(), settings)
    return rebuild_staging(store, start)


def rebuild_staging(store: Store, start: date | None, undated: bool = False) -> StagingRun:
    """Recompute staging from ``start`` on, with ``undated`` also its rows without an event day.

    All of it where ``start`` is None.
    """
    raw = store.raw() if start is None else raw_since(store, start, undated)

    # Counted inside the one pass that does the work.
    read, written = Observation(), Observation()
    raw = raw.observe(read, F.count("*").alias("rows"))
    rows = latest_deliveries(raw).observe(written, F.count("*").alias("rows"))
    if start is None:
        store.replace("staging", rows, by=_BY_DAY)
    else:
        store.replace_partitions("staging", rows, by=_BY_DAY)
    return StagingRun(start, read.get.get("rows", 0), written.get.get("rows", 0))


def raw_since(store: Store, start: date, undated: bool = False) -> DataFrame:
    """Raw rows of event days from ``start`` on, reading only drops that can hold some.

    Rows without an event day, which can be in any drop, are read too on request.

    Raw is partitioned by delivery, not by event day. The load log knows the newest
    event day in every file, so the oldest drop worth reading is exact, with no
    assumption on how late rows can be.
    """
    relevant = store.load_log().filter(
        (F.col("status") == LOADED) & (F.col("last_event_date") >= F.lit(start))
    )
    oldest_drop = relevant.agg(F.min("drop_date")).first()[0]
    unknown = F.col("_drop_date").isNull()
    drops = unknown if oldest_drop is None else unknown | (F.col("_drop_date") >= F.lit(oldest_drop))
    if undated:
        blank = F.col("date").isNull()
        return store.raw().filter(blank | (drops & (F.col("date") >= F.lit(start))))
    return within_lookback(store.raw().filter(drops), start)


def refresh_marts(
    store: Store, settings: Settings = DEFAULTS, since: date | None = None, undated: bool = False
) -> None:
    """Rebuild the dimension and the fact.

    With ``since``, only fact days from there on are rebuilt (and, with ``undated``, rows
    without a day): no measure of the fact looks across days, and older staging days have
    not changed. Days that an earlier, interrupted run refreshed in staging only are
    caught up with.
    """
    staged = store.staging()
    store.replace("dim_creative", dim_creative(staged))
    caught_up = stored_lookback_start(store.fact(), settings)
    whole = since is None or caught_up is None
    if not whole:
        rebuilt = F.col("event_date") >= F.lit(min(since, caught_up))
        staged = staged.filter(rebuilt | F.col("event_date").isNull() if undated else rebuilt)
    # ``creative_daily`` in its steps. Ranks are written first: their size is known to the
    # join then, which sends a small table to all tasks and shuffles rows only for a large one.
    with store.scratch() as folder:
        ranked = ranks(staged, settings)
        ranked.write.options(**COMPACT).parquet(folder)
        rows = with_ranks(staged, store.spark.read.schema(ranked.schema).parquet(folder))
        replace = store.replace if whole else store.replace_partitions
        replace("fct_creative_daily", rows, by=_BY_DAY, then=lambda balanced: with_measures(balanced, settings))


def run_checks(
    store: Store,
    truth: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    registry: Iterable[checks.RowCheck | checks.TableCheck] = checks.REGISTRY,
) -> DataFrame:
    """Run all checks on the stored marts, keep violating rows and results, return the results.

    The rows are written once, under the run's name, and counted from there.
    """
    tables = {"fact": store.fact(), "dimension": store.dimension()}
    tables |= {} if truth is None else {"truth": truth}
    registry = tuple(registry)
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}"
    found = checks.violations(tables, registry, settings).withColumn("run", F.lit(run))
    store.replace_partitions("check_violations", found, by=["run"])
    kept = store.check_violations().filter(F.col("run") == run)
    results = checks.results_of(kept, checks.applicable(tables, registry))
    store.replace("check_results", results.coalesce(1))
    return store.check_results()


def run_daily(
    store: Store,
    drops_folder: str,
    truth: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    full_refresh: bool = False,
) -> DailyRun:
    """One run from new files to the published snapshot.

    Raises ``ChecksFailed`` before publishing if a check of severity "error" fails.
    """
    ingested = ingest(store, drops_folder, settings)
    staging = refresh_staging(store, settings, full_refresh)
    refresh_marts(store, settings, since=staging.start)
    checks.raise_on_errors(run_checks(store, truth, settings))
    log_defects(store)
    write_snapshot(store, settings)
    return DailyRun(ingested, staging)
