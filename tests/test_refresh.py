import json
import os
from datetime import date

import pytest
from helpers import EARLY, comparable, write_drop, write_drops
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from dayledger.config import Settings
from dayledger.operators import checks
from dayledger.operators.fact import creative_daily
from dayledger.operators.latest import latest_deliveries
from dayledger.plans.incremental import stored_lookback_start
from dayledger.plans.refresh import (
    log_defects,
    raw_since,
    rebuild_staging,
    refresh_marts,
    refresh_staging,
    run_checks,
    run_daily,
)
from dayledger.plans.snapshot import write_snapshot
from dayledger.sources import files, lineitem
from dayledger.sources.ingest import ingest
from dayledger.sources.schemas import CHECK_RESULTS
from dayledger.sources.tables import Store, read_truth
from dayledger.streaming import arrivals
from dayledger.streaming.arrivals import follow_drops

SMALL = "/root/testdata/sf0.001"
ONE_FILE = Settings(files_per_batch=1)


@pytest.fixture
def drops(folder):
    path = f"{folder}/drops"
    os.mkdir(path)
    return path


@pytest.fixture
def store(spark, folder):
    return Store(spark, f"{folder}/warehouse")


def row(event, creative="cr", impressions=100):
    return f"2026-{event},cmp,as,{creative},video,feed,{impressions},5,2.5,1"


def staged(store):
    return {(str(r.event_date)[5:], r.creative_id): r.impressions for r in store.staging().collect()}


def test_window_is_recomputed_and_older_days_are_not(store, drops):
    write_drop(drops, "drop_2026-01-20.csv", EARLY, [row("01-20"), row("01-13"), row("01-12")])
    ingest(store, drops)
    assert refresh_staging(store).start is None
    write_drop(drops, "drop_2026-01-21.csv", EARLY, [row("01-13", impressions=1), row("01-12", impressions=1)])
    ingest(store, drops)
    run = refresh_staging(store)
    assert run.start == date(2026, 1, 13)
    assert (run.rows_in, run.rows_out) == (3, 2)
    assert staged(store) == {("01-20", "cr"): 100, ("01-13", "cr"): 1, ("01-12", "cr"): 100}
    refresh_staging(store, full_refresh=True)
    assert staged(store)[("01-12", "cr")] == 1


def test_a_replacement_that_dies_leaves_the_table_as_it_was(store, drops, monkeypatch):
    write_drop(drops, "drop_2026-01-20.csv", EARLY, [row("01-20"), row("01-13"), row("01-02")])
    ingest(store, drops)
    refresh_staging(store)
    refresh_marts(store)
    before = staged(store), comparable(store.fact()), comparable(store.dimension())
    write_drop(drops, "drop_2026-01-21.csv", EARLY, [row("01-13", impressions=1), row("01-21", "new")])
    ingest(store, drops)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # after the rows are written, before they are published
        patch.setattr(files, "publish_text", killed)
        for replacing in (lambda: refresh_staging(store), lambda: refresh_staging(store, full_refresh=True), lambda: refresh_marts(store)):
            with pytest.raises(KeyboardInterrupt):
                replacing()
            assert (staged(store), comparable(store.fact()), comparable(store.dimension())) == before
    old = store.staging()
    refresh_staging(store)
    assert staged(store) == {("01-20", "cr"): 100, ("01-13", "cr"): 1, ("01-02", "cr"): 100, ("01-21", "new"): 100}
    assert old.count() == 3  # a reader keeps what it began with
    # What died is removed; days that were not replaced stay in their version.
    assert len([n for n in files.names_in(store.spark, store.path("staging")) if n.startswith("version=")]) == 2


def test_rows_that_fail_while_written_are_never_published(store):
    good = store.spark.createDataFrame([("c", "error", 0, "pass")], CHECK_RESULTS)
    store.replace("check_results", good)
    with pytest.raises(PySparkException):
        store.replace("check_results", good.withColumn("check_name", F.raise_error(F.lit("lost")).cast("string")))
    assert store.check_results().collect() == good.collect()


def test_empty_target_gets_a_full_build(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [])
    ingest(store, drops)
    assert refresh_staging(store).start is None
    assert stored_lookback_start(store.staging()) is None
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [row("01-01")])
    ingest(store, drops)
    assert refresh_staging(store).start is None
    assert staged(store) == {("01-01", "cr"): 100}


def test_rerun_changes_nothing(store, drops):
    write_drop(drops, "drop_2026-01-20.csv", EARLY, [row("01-20"), row("01-01")])
    ingest(store, drops)
    refresh_staging(store)
    refresh_marts(store)
    before = comparable(store.staging()), comparable(store.fact())
    run = refresh_staging(store)
    refresh_marts(store, since=run.start)
    assert (comparable(store.staging()), comparable(store.fact())) == before


def test_undated_and_early_drops_are_still_read(store, drops):
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [row("01-20", "ahead"), row("01-02")])
    write_drop(drops, "drop_2026-01-05.csv", EARLY, [row("01-05")])
    write_drop(drops, "x.csv", EARLY, [row("01-19", "undated")])
    ingest(store, drops)
    rows = raw_since(store, date(2026, 1, 13)).collect()
    assert sorted(r.creative_id for r in rows) == ["ahead", "undated"]


def test_pruned_scan_reads_recent_drops_only(store, drops):
    for d in range(1, 29):
        write_drop(drops, f"drop_2026-01-{d:02d}.csv", EARLY, [row(f"01-{d:02d}")])
    ingest(store, drops)
    frame = raw_since(store, date(2026, 1, 21))
    read = frame.inputFiles() and frame.select("_source_file").distinct().count()
    assert read == 8
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(_drop_date" in plan
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2026-01-21)]" in plan


def test_interrupted_marts_catch_up(store, drops):
    write_drop(drops, "drop_2026-01-10.csv", EARLY, [row("01-10"), row("01-05")])
    ingest(store, drops)
    refresh_staging(store)
    refresh_marts(store)
    write_drop(drops, "drop_2026-01-15.csv", EARLY, [row("01-15"), row("01-05", impressions=7)])
    ingest(store, drops)
    refresh_staging(store)  # the run dies before the marts
    run = refresh_staging(store)
    assert run.start == date(2026, 1, 8)
    refresh_marts(store, since=run.start)
    assert {str(r.event_date)[5:]: r.impressions for r in store.fact().collect()} == {
        "01-05": 7, "01-10": 100, "01-15": 100,
    }


@pytest.fixture(scope="module")
def delivered(spark):
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    names = write_drops(spark, lineitem.deliveries(spark, SMALL), folder)
    return folder, names


def copied(names, source, target):
    for name in names:
        with open(f"{source}/{name}") as a, open(f"{target}/{name}", "w") as b:
            b.write(a.read())


def test_files_give_the_derived_deliveries(spark, store, delivered):
    folder, names = delivered
    summary = ingest(store, folder)
    assert (summary.loaded, summary.quarantined, summary.rows_loaded) == (96, 0, 5354)
    derived = lineitem.deliveries(spark, SMALL)
    columns = [c for c in derived.columns if c != "_row_in_file"]
    assert comparable(store.raw(), columns) == comparable(derived, columns)

    refresh_staging(store)
    refresh_marts(store)
    expected = latest_deliveries(derived)
    assert comparable(store.staging()) == comparable(expected)
    fact = creative_daily(expected)
    assert comparable(store.fact()) == comparable(fact)

    results = {r.check_name: r for r in run_checks(store, lineitem.truth(spark, SMALL)).collect()}
    assert {r.status for r in results.values()} == {"pass", "warn"}
    assert results["clicks_lte_impressions"].status == "warn"

    log = log_defects(store)
    drift = log.filter("defect_type = 'schema_drift'").collect()
    assert [str(r.drop_date) for r in drift] == ["2026-02-20"]
    lost = log.filter("defect_type = 'missing_day'").collect()
    assert [str(r.drop_date) for r in lost] == ["2026-03-12"]

    write_snapshot(store)
    document = snapshot(store)
    assert document["today"] == "2026-04-07"
    assert document["latest_finalized_day"] == "2026-03-31"
    assert document["loaded_files"] == 96
    assert document["defect_counts"]["restatement"] == 237
    top = document["top_decile_by_campaign"]
    assert len(top) == 21
    assert list(top[0]) == [
        "campaign_id", "creative_id", "creative_format", "placement", "impressions", "clicks", "ctr",
    ]
    assert [t["campaign_id"] for t in top] == sorted(t["campaign_id"] for t in top)


def snapshot(store):
    folder = store.path("snapshot")
    parts = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return json.loads("".join(open(f"{folder}/{n}", encoding="utf-8").read() for n in parts))


def test_replaying_drop_by_drop_equals_one_full_build(spark, store, folder, drops, delivered):
    source, names = delivered
    steps = [names[:64], names[64:71], names[71:]]
    for step in steps:
        copied(step, source, drops)
        ingest(store, drops)
        run = refresh_staging(store)
        refresh_marts(store, since=run.start)
    whole = Store(spark, f"{folder}/whole")
    ingest(whole, source)
    refresh_staging(whole)
    refresh_marts(whole)
    assert comparable(store.staging()) == comparable(whole.staging())
    assert comparable(store.fact()) == comparable(whole.fact())


def test_stream_equals_batch(spark, store, drops, folder, delivered):
    source, names = delivered
    copied(names[:50], source, drops)
    follow_drops(store, drops, f"{folder}/checkpoint")
    assert store.load_log().count() == 50
    copied(names[50:], source, drops)
    follow_drops(store, drops, f"{folder}/checkpoint")
    assert store.load_log().count() == len(names)
    expected = creative_daily(latest_deliveries(lineitem.deliveries(spark, SMALL)))
    assert comparable(store.fact()) == comparable(expected)


def arrives(drops, name, lines, minute):
    write_drop(drops, name, EARLY, lines)
    at = 1_700_000_000 + 60 * minute
    os.utime(f"{drops}/{name}", (at, at))


def first_arrival(store, drops, folder):
    """A window from the 13th on; then a file far beyond it before one with a late row."""
    arrives(drops, "drop_2026-01-20.csv", [row("01-20")], 0)
    follow_drops(store, drops, f"{folder}/checkpoint", ONE_FILE)
    arrives(drops, "drop_2026-02-10.csv", [row("02-10", "new")], 1)
    arrives(drops, "drop_2026-01-21.csv", [row("01-14", "late"), row("01-12", "too late")], 2)


WITH_LATE_ROW = {("01-20", "cr"): 100, ("02-10", "new"): 100, ("01-14", "late"): 100}


def test_batches_of_one_arrival_share_a_window(store, drops, folder):
    first_arrival(store, drops, folder)
    query = follow_drops(store, drops, f"{folder}/checkpoint", ONE_FILE)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    assert staged(store) == WITH_LATE_ROW
    assert store.fact().count() == 3
    assert not os.path.exists(f"{store.path('_arrivals')}/window.json")


def test_a_run_after_one_that_died_keeps_its_window(store, drops, folder, monkeypatch):
    first_arrival(store, drops, folder)
    rebuilt = []

    def dies_in_the_second_batch(*args, **kwargs):
        rebuilt.append(args[1])
        if len(rebuilt) == 2:
            raise RuntimeError("lost")
        return rebuild_staging(*args, **kwargs)

    monkeypatch.setattr(arrivals, "rebuild_staging", dies_in_the_second_batch)
    with pytest.raises(StreamingQueryException):
        follow_drops(store, drops, f"{folder}/checkpoint", ONE_FILE)
    # The second batch holds an older day than the window, which bounds it.
    assert rebuilt == [date(2026, 1, 13)] * 2
    assert ("01-14", "late") not in staged(store)
    follow_drops(store, drops, f"{folder}/checkpoint", ONE_FILE)
    assert staged(store) == WITH_LATE_ROW


def test_first_arrival_in_batches_keeps_rows_without_a_day(store, drops, folder):
    for minute, creative in enumerate("abc"):
        blank = f",cmp,as,{creative},video,feed,100,5,2.5,1"
        arrives(drops, f"drop_2026-01-0{minute + 1}.csv", [blank, row(f"01-0{minute + 1}")], minute)
    follow_drops(store, drops, f"{folder}/checkpoint", ONE_FILE)
    for table in (store.staging(), store.fact()):
        blank_days = table.filter("event_date is null").collect()
        assert sorted(r.creative_id for r in blank_days) == ["a", "b", "c"]
        assert table.count() == 6


def test_daily_run(spark, store, drops):
    lines = [f"2026-01-01,cmp,as,cr_{i:02d},video,feed,2000,{i},2.5,1" for i in range(12)]
    write_drop(drops, "drop_2026-01-01.csv", EARLY, lines)
    write_drop(drops, "drop_2026-01-08.csv", EARLY, [row("01-08")])
    write_drop(drops, "drop_2026-01-09.csv", "what,is,this", ["1,2,3"])
    run = run_daily(store, drops)
    assert (run.ingested.loaded, run.ingested.quarantined) == (2, 1)
    document = snapshot(store)
    assert [t["creative_id"] for t in document["top_decile_by_campaign"]] == ["cr_11", "cr_10"]
    assert document["quarantined_files"] == 1
    assert document["defect_counts"] == {"missing_day": 6}


def test_daily_run_without_files(store, drops):
    run = run_daily(store, drops)
    assert run.staging.rows_out == 0
    document = snapshot(store)
    assert (document["today"], document["top_decile_by_campaign"]) == (None, [])


def test_failed_check_stops_before_publishing(store, drops):
    lines = ["2026-01-01,a,as,cr,video,feed,2000,5,2.5,1", "2026-01-01,b,as,cr,video,feed,2000,5,2.5,1"]
    write_drop(drops, "drop_2026-01-01.csv", EARLY, lines)
    with pytest.raises(checks.ChecksFailed):
        run_daily(store, drops)
    assert not store.has("snapshot")
    assert store.check_results().filter(F.col("status") == "fail").count() == 1


def test_stored_truth_is_read_with_types(spark, folder):
    lineitem.truth(spark, SMALL).coalesce(1).write.csv(f"{folder}/truth", header=True)
    read = read_truth(spark, f"{folder}/truth")
    assert read.schema["date"].dataType.simpleString() == "date"
    assert comparable(read) == comparable(lineitem.truth(spark, SMALL))
