"""The registered queries: every operator over deliveries derived from whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.config import Settings
from dayledger.functions import text
from dayledger.functions.measures import creative_day_id
from dayledger.operators import checks, defects, freshness, reports
from dayledger.operators.dimension import attribute_conflicts, dim_creative, entity_counts
from dayledger.operators.fact import creative_daily, with_ratios
from dayledger.operators.latest import latest_deliveries, same_drop_repeats, typed
from dayledger.plans.defect_log import log_defects
from dayledger.plans.incremental import lookback_start, merged, within_lookback
from dayledger.plans.refresh import refresh_marts, refresh_staging
from dayledger.plans.snapshot import snapshot_head, snapshot_lines
from dayledger.sources import files, lineitem
from dayledger.sources.ingest import RunSummary, ingest
from dayledger.sources.schemas import DELIVERED, EARLY_LAYOUT, LATE_LAYOUT
from dayledger.sources.tables import Store, read_truth, scratch_folder, settled
from dayledger.streaming.arrivals import follow_drops

Query = Callable[[SparkSession, str], DataFrame]

# The day up to which the target of the incremental queries was loaded.
LOADED_UNTIL = date(2026, 3, 25)

# The day after which the dimension of the orphan query was not refreshed.
STALE_SINCE = date(2026, 1, 3)

# The drop from which files carry the late layout.
_LATE_FROM = date(2026, 2, 20)


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    return latest_deliveries(lineitem.deliveries(spark, folder))


def _stored_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Staging as a warehouse has it: deduplicated once, for consumers that read it repeatedly."""
    return settled(_staged(spark, folder))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return creative_daily(_stored_staging(spark, folder))


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """The fact without rankings: all that checks and most reports read of it."""
    return with_ratios(_staged(spark, folder))


def deliveries(spark, folder):
    return lineitem.deliveries(spark, folder)


def staging_dedup(spark, folder):
    return _staged(spark, folder)


def same_drop_duplicates(spark, folder):
    return same_drop_repeats(lineitem.deliveries(spark, folder))


def dimension(spark, folder):
    return dim_creative(_staged(spark, folder))


def dimension_conflicts(spark, folder):
    return attribute_conflicts(_staged(spark, folder))


def adset_conflicts(spark, folder):
    """The same check one level up: ad sets whose creatives differ."""
    by_adset = _staged(spark, folder).withColumn("creative_id", F.col("adset_id"))
    return attribute_conflicts(by_adset).withColumnRenamed("creative_id", "adset_id")


def entities(spark, folder):
    return entity_counts(dim_creative(_staged(spark, folder)))


def creative_daily_metrics(spark, folder):
    return with_ratios(_staged(spark, folder)).select(
        "event_date", "campaign_id", "adset_id", "creative_id",
        "ctr", "cpc", "cpa", "conversion_rate", "meets_volume_floor",
    )


def spend_share(spark, folder):
    return _fact(spark, folder).select(
        "event_date", "campaign_id", "adset_id", "creative_id", "spend", "spend_share"
    )


def ctr_percentile(spark, folder):
    return _fact(spark, folder).select(
        "event_date", "campaign_id", "adset_id", "creative_id", "ctr", "meets_volume_floor",
        "ctr_percentile_in_campaign_day",
    )


def ctr_percentile_hot_groups(spark, folder):
    """Share, rank and flag as campaign-days of any size get them: there is one way."""
    return _fact(spark, folder).select(
        "event_date", "campaign_id", "adset_id", "creative_id", "spend_share",
        "ctr_percentile_in_campaign_day", "is_top_decile_creative",
    )


def top_decile(spark, folder):
    return _fact(spark, folder).filter("is_top_decile_creative").select(
        "event_date", "campaign_id", "creative_id", "ctr", "ctr_percentile_in_campaign_day"
    )


def creative_daily_fact(spark, folder):
    return _fact(spark, folder)


def _finalized_top(spark: SparkSession, folder: str) -> DataFrame:
    # Ranking never crosses a day, so one day of deliveries is all the fact needs.
    raw = settled(lineitem.deliveries(spark, folder))
    day_rows = raw.filter(F.col("date") == freshness.latest_finalized_day(raw))
    return freshness.finalized_top_creatives(creative_daily(latest_deliveries(day_rows)), raw)


def finalized_top_decile(spark, folder):
    return freshness.in_report_order(_finalized_top(spark, folder))


def display_top_decile(spark, folder):
    return freshness.display_rows(_finalized_top(spark, folder))


def _files(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.col("_source_file").alias("file_name")).agg(
        F.lit("loaded").alias("status"), F.count("*").alias("row_count")
    )


def freshness_summary(spark, folder):
    raw = settled(lineitem.deliveries(spark, folder))
    return freshness.freshness(raw, creative_daily(latest_deliveries(raw)), _files(raw))


def file_status(spark, folder):
    return freshness.file_status_counts(_files(lineitem.deliveries(spark, folder)))


def drop_file_names(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    name = F.col("file_name")
    return _files(raw).select(
        "file_name",
        text.drop_date(name).alias("drop_date"),
        text.drop_date(F.concat(F.lit("re"), name)).alias("other_name_date"),
        "row_count",
    )


def _loaded(spark, folder):
    raw = settled(lineitem.deliveries(spark, folder))
    return raw, settled(latest_deliveries(raw.filter(F.col("_drop_date") <= F.lit(LOADED_UNTIL))))


def lookback_window(spark, folder):
    raw, target = _loaded(spark, folder)
    window = within_lookback(raw, lookback_start(target))
    return window.groupBy(F.col("date").alias("event_date")).agg(F.count("*").alias("rows"))


def incremental_staging(spark, folder):
    raw, target = _loaded(spark, folder)
    start = lookback_start(target)
    return merged(target, latest_deliveries(within_lookback(raw, start)), start)


def clicks_exceed_impressions(spark, folder):
    return checks.impossible_clicks(_rows(spark, folder)).select(
        "creative_daily_id", "event_date", "creative_id", "impressions", "clicks"
    )


def reconciliation(spark, folder):
    fact = with_ratios(_stored_staging(spark, folder))
    return checks.reconciliation(fact, lineitem.truth(spark, folder))


def reconciliation_mid_history(spark, folder):
    _, staged = _loaded(spark, folder)
    return checks.reconciliation(with_ratios(staged), lineitem.truth(spark, folder))


def unexpected_in_fact(spark, folder):
    known = lineitem.truth(spark, folder).filter(F.col("date") < F.lit(LOADED_UNTIL))
    return checks.unexpected_in_fact(_rows(spark, folder), known)


def unique_creative_days(spark, folder):
    return checks.repeated_values(_rows(spark, folder), "creative_daily_id")


def repeated_deliveries(spark, folder):
    delivered = typed(lineitem.deliveries(spark, folder))
    return checks.repeated_values(
        delivered.withColumn("creative_daily_id", creative_day_id()), "creative_daily_id"
    )


def orphan_creatives(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    stale = dim_creative(latest_deliveries(raw.filter(F.col("_drop_date") <= F.lit(STALE_SINCE))))
    return checks.orphans(with_ratios(latest_deliveries(raw)), stale, "creative_id")


def check_results(spark, folder):
    staged = _stored_staging(spark, folder)
    return checks.check_results(
        with_ratios(staged), dim_creative(staged), lineitem.truth(spark, folder)
    )


def gap_split(spark, folder):
    return reports.gap_split(_rows(spark, folder), lineitem.truth(spark, folder))


def floor_calibration(spark, folder):
    return reports.floor_calibration(with_ratios(_stored_staging(spark, folder)))


def flagged_share(spark, folder):
    return reports.flagged_share(_fact(spark, folder))


_PLACE = ["event_date", "drop_date", "campaign_id", "adset_id", "creative_id"]


def _detailed(found: DataFrame, **details: str) -> DataFrame:
    columns = [F.col("detail")[key].cast(kind).alias(key) for key, kind in details.items()]
    return found.select("defect_type", *_PLACE, *columns)


def defect_late_arrival(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    return _detailed(defects.delivery_defects(raw, [defects.LATE]), delayed_by_days="int")


def defect_restatement(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    found = defects.delivery_defects(raw, [defects.RESTATED])
    return _detailed(found, original_drop_date="date")


def defect_duplicate_exact(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    return _detailed(defects.exact_duplicates(raw), copies="bigint")


def defect_duplicate_near(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    return _detailed(defects.delivery_defects(raw, [defects.NEAR]), jittered_field="string")


def defect_null_value(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    return _detailed(defects.row_defects(raw, [defects.MISSING_VALUE]), field="string")


def defect_clicks_exceed_impressions(spark, folder):
    raw = lineitem.deliveries(spark, folder)
    found = defects.row_defects(raw, [defects.IMPOSSIBLE])
    return _detailed(found, impressions="bigint", clicks="bigint")


def defect_missing_day(spark, folder):
    return _detailed(defects.missing_days(lineitem.deliveries(spark, folder)))


def defect_schema_drift(spark, folder):
    layouts = defects.observed_layouts(lineitem.deliveries(spark, folder))
    return _detailed(defects.schema_drifts(layouts), from_layout="string", to_layout="string")


def defect_counts(spark, folder):
    raw = settled(lineitem.deliveries(spark, folder))
    counts = defects.defect_counts(defects.defect_log(raw))
    return counts.withColumn("label", text.label_text(F.col("defect_type")))


def snapshot_document(spark, folder):
    raw = settled(lineitem.deliveries(spark, folder))
    # Rows, ranks, dates and the top list all read staging; it is made once.
    fact = creative_daily(settled(latest_deliveries(raw)))
    counts = defects.defect_counts(defects.defect_log(raw))
    head = snapshot_head(freshness.freshness(raw, fact, _files(raw)), counts)
    top = freshness.finalized_top_creatives(fact, raw)
    # The time of generation is the one field that cannot be compared.
    return snapshot_lines(head.drop("generated_at"), top)


def _write_drops(raw: DataFrame, drops: str) -> None:
    """Deliveries as CSV files: both layouts, and rows of a layout nobody knows."""
    early, late = raw.filter(F.col("_drop_date") < F.lit(_LATE_FROM)), raw.filter(
        F.col("_drop_date") >= F.lit(_LATE_FROM)
    )
    early.select(*EARLY_LAYOUT).write.mode("append").csv(drops, header=True)
    late.withColumnRenamed("spend", "cost").select(*LATE_LAYOUT).write.mode("append").csv(
        drops, header=True
    )
    foreign = checks.impossible_clicks(raw).select("date", "creative_id", "clicks")
    foreign.write.mode("append").csv(drops, header=True)


def _delivered_files(spark: SparkSession, folder: str) -> tuple[Store, str]:
    root = scratch_folder(spark)
    drops = f"{root}/drops"
    _write_drops(settled(lineitem.deliveries(spark, folder)), drops)
    return Store(spark, f"{root}/warehouse"), drops


def _ingested(spark: SparkSession, folder: str) -> Store:
    store, drops = _delivered_files(spark, folder)
    ingest(store, drops)
    return store


def ingested_deliveries(spark, folder):
    return _ingested(spark, folder).raw().select(*DELIVERED.fieldNames())


def ingested_by_layout(spark, folder):
    return _ingested(spark, folder).load_log().groupBy("status", "layout").agg(
        F.sum("row_count").alias("rows"),
        F.min("first_event_date").alias("first_event_date"),
        F.max("last_event_date").alias("last_event_date"),
    )


def quarantined_lines(spark, folder):
    lines = _ingested(spark, folder).quarantine()
    return lines.filter("line <> 'date,creative_id,clicks'").select("line")


def streamed_creative_days(spark, folder):
    store, drops = _delivered_files(spark, folder)
    follow_drops(store, drops, store.path("checkpoint"))
    return store.staging().groupBy("event_date").agg(F.count("*").alias("creative_days"))


def check_violations(spark, folder):
    """On mid-history marts with a dimension that is not up to date, so that several checks fail."""
    raw, staged = _loaded(spark, folder)
    tables = {
        "fact": with_ratios(staged),
        "dimension": dim_creative(latest_deliveries(raw.filter(F.col("_drop_date") <= F.lit(STALE_SINCE)))),
        "truth": lineitem.truth(spark, folder),
    }
    found = checks.violations(tables)
    return found.select(*found.columns[:-1], F.get_json_object("record", "$.issue").alias("issue"))


class _DatedDrops:
    """Deliveries as one CSV file per drop, named by its date, that arrive step by step."""

    def __init__(self, spark: SparkSession, folder: str):
        root = scratch_folder(spark)
        self._spark, self._made, self.drops = spark, f"{root}/made", f"{root}/drops"
        self.store = Store(spark, f"{root}/warehouse")
        copies = settled(lineitem.copies(spark, folder))
        self.raw = lineitem.described(copies)
        late = F.col("_drop_date") >= F.lit(_LATE_FROM)
        self._write(copies.filter(~late), EARLY_LAYOUT)
        self._write(copies.filter(late), LATE_LAYOUT)

    def _write(self, copies: DataFrame, layout: list[str]) -> None:
        # Rows get their texts where they are written; what is dealt by drop and sorted is small.
        dealt = copies.repartition("_drop_date").sortWithinPartitions("_drop_date", lineitem.place_in_drop())
        ordered = lineitem.described(dealt).withColumn("cost", F.col("spend"))
        # The text source creates the folder that files are then moved to.
        ordered.select(*layout, "_drop_date").write.mode("append").partitionBy("_drop_date").csv(self._made, header=True)
        ordered.limit(0).select("campaign_id").write.mode("append").text(self.drops)

    def arrive(self, until: date | None = None) -> RunSummary:
        """Load the files up to a drop date that have not arrived before, or all."""
        self.deliver(until)
        return ingest(self.store, self.drops)

    def deliver(self, until: date | None = None) -> None:
        """Put the files there without loading them."""
        for name in files.names_in(self._spark, self._made):
            day = name.removeprefix("_drop_date=")
            if name == day or (until is not None and day > until.isoformat()):
                continue
            parts = [n for n in files.names_in(self._spark, f"{self._made}/{name}") if n.startswith("part-")]
            for part in parts:
                files.move(self._spark, f"{self._made}/{name}/{part}", f"{self.drops}/drop_{day}.csv")

    def deliver_foreign(self, rows: DataFrame) -> None:
        """Put one file of a layout there that nobody knows.

        Only its lines reach the task that writes it; ``rows`` are computed before, in many.
        """
        rows.repartition(1).write.mode("append").csv(self.drops, header=True)


def raw_lineage(spark, folder):
    delivered = _DatedDrops(spark, folder)
    delivered.arrive()
    return delivered.store.raw().drop("_loaded_at")


def second_run_log(spark, folder):
    delivered = _DatedDrops(spark, folder)
    delivered.arrive(LOADED_UNTIL)
    delivered.arrive()
    return delivered.store.load_log().drop("loaded_at")


def stored_incremental_staging(spark, folder):
    delivered = _DatedDrops(spark, folder)
    delivered.arrive(LOADED_UNTIL)
    refresh_staging(delivered.store)
    delivered.arrive()
    refresh_staging(delivered.store)
    return delivered.store.staging()


def defect_log_replay(spark, folder):
    delivered = _DatedDrops(spark, folder)
    for until in (_LATE_FROM, LOADED_UNTIL, None):
        delivered.arrive(until)
        log_defects(delivered.store)
    return delivered.store.defect_log().drop("detail")


def streamed_staging(spark, folder):
    """Two arrivals, the first of which the stream takes in several batches."""
    delivered = _DatedDrops(spark, folder)
    few = Settings(files_per_batch=50)
    for until in (LOADED_UNTIL, None):
        delivered.deliver(until)
        follow_drops(delivered.store, delivered.drops, delivered.store.path("checkpoint"), few)
    return delivered.store.staging()


def freshness_after_loads(spark, folder):
    """From the stored tables and the load log, with one file that could not be loaded."""
    delivered = _DatedDrops(spark, folder)
    delivered.deliver_foreign(checks.impossible_clicks(delivered.raw).select("creative_id", "clicks"))
    delivered.arrive()
    store = delivered.store
    refresh_staging(store)
    refresh_marts(store)
    log = store.load_log()
    drops = log.filter("row_count > 0").select(F.col("drop_date").alias("_drop_date"))
    return freshness.freshness(drops, store.fact(), log)


def header_schema_drift(spark, folder):
    """Layout changes as the headers of the files show them."""
    delivered = _DatedDrops(spark, folder)
    delivered.arrive()
    layouts = delivered.store.load_log().select("drop_date", "layout")
    return _detailed(defects.schema_drifts(layouts), from_layout="string", to_layout="string")


def reconciliation_from_file(spark, folder):
    """Against the correct numbers as a CSV file has them."""
    path = f"{scratch_folder(spark)}/truth"
    lineitem.truth(spark, folder).write.csv(path, header=True)
    _, staged = _loaded(spark, folder)
    return checks.reconciliation(with_ratios(staged), read_truth(spark, path))


def run_counts(spark, folder):
    """What two runs of ingestion and refresh say about themselves: counts, one row per run."""
    delivered = _DatedDrops(spark, folder)
    runs = []
    for until in (LOADED_UNTIL, None):
        loads, staging = delivered.arrive(until), refresh_staging(delivered.store)
        runs.append(
            (len(runs), loads.skipped, loads.loaded, loads.quarantined, loads.rows_loaded,
             staging.start, staging.rows_in, staging.rows_out)
        )
    return spark.createDataFrame(
        runs,
        "run int, skipped int, loaded int, quarantined int, rows_loaded long, "
        "start date, rows_in long, rows_out long",
    )


REGISTRY: dict[str, Query] = {
    "deliveries": deliveries,
    "staging_dedup": staging_dedup,
    "same_drop_duplicates": same_drop_duplicates,
    "dim_creative": dimension,
    "dimension_conflicts": dimension_conflicts,
    "adset_conflicts": adset_conflicts,
    "entity_counts": entities,
    "creative_daily_metrics": creative_daily_metrics,
    "spend_share": spend_share,
    "ctr_percentile": ctr_percentile,
    "ctr_percentile_hot_groups": ctr_percentile_hot_groups,
    "top_decile": top_decile,
    "creative_daily_fact": creative_daily_fact,
    "finalized_top_decile": finalized_top_decile,
    "display_top_decile": display_top_decile,
    "freshness": freshness_summary,
    "file_status": file_status,
    "drop_file_names": drop_file_names,
    "lookback_window": lookback_window,
    "incremental_staging": incremental_staging,
    "clicks_exceed_impressions": clicks_exceed_impressions,
    "reconciliation": reconciliation,
    "reconciliation_mid_history": reconciliation_mid_history,
    "unexpected_in_fact": unexpected_in_fact,
    "unique_creative_days": unique_creative_days,
    "repeated_deliveries": repeated_deliveries,
    "orphan_creatives": orphan_creatives,
    "check_results": check_results,
    "gap_split": gap_split,
    "floor_calibration": floor_calibration,
    "flagged_share": flagged_share,
    "defect_late_arrival": defect_late_arrival,
    "defect_restatement": defect_restatement,
    "defect_duplicate_exact": defect_duplicate_exact,
    "defect_duplicate_near": defect_duplicate_near,
    "defect_null_value": defect_null_value,
    "defect_clicks_exceed_impressions": defect_clicks_exceed_impressions,
    "defect_missing_day": defect_missing_day,
    "defect_schema_drift": defect_schema_drift,
    "defect_counts": defect_counts,
    "snapshot_document": snapshot_document,
    "ingested_deliveries": ingested_deliveries,
    "ingested_by_layout": ingested_by_layout,
    "quarantined_lines": quarantined_lines,
    "streamed_creative_days": streamed_creative_days,
    "check_violations": check_violations,
    "raw_lineage": raw_lineage,
    "second_run_log": second_run_log,
    "stored_incremental_staging": stored_incremental_staging,
    "defect_log_replay": defect_log_replay,
    "streamed_staging": streamed_staging,
    "freshness_after_loads": freshness_after_loads,
    "header_schema_drift": header_schema_drift,
    "reconciliation_from_file": reconciliation_from_file,
    "run_counts": run_counts,
}
