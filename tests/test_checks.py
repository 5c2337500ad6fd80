import json
import random
from collections import Counter

import pytest
from helpers import day, staged_row, staged_rows
from pyspark.sql import functions as F

from dayledger.operators import checks, reports
from dayledger.operators.dimension import dim_creative
from dayledger.operators.fact import creative_daily, with_ratios
from dayledger.plans.refresh import run_checks
from dayledger.sources.schemas import TRUTH
from dayledger.sources.tables import Store


def truth_row(creative="cr", impressions=2000, clicks=20, spend=2.5, conversions=1, event="01-01"):
    return (day(event), "cmp", "as", creative, "video", "feed", impressions, clicks, spend, conversions)


def marts(spark, rows):
    staged = staged_rows(spark, rows)
    return creative_daily(staged), dim_creative(staged)


def truth(spark, rows):
    return spark.createDataFrame(rows, TRUTH)


def issues(spark, staged, expected):
    fact, _ = marts(spark, staged)
    found = checks.reconciliation(fact, truth(spark, expected)).collect()
    return sorted((r.creative_id, r.issue) for r in found)


def test_reconciliation_finds_missing_and_different_rows(spark):
    found = issues(
        spark,
        [staged_row("ok"), staged_row("wrong", clicks=21), staged_row("extra")],
        [truth_row("ok"), truth_row("wrong"), truth_row("gone")],
    )
    assert found == [("gone", "missing_from_fct"), ("wrong", "value_mismatch")]


@pytest.mark.parametrize(
    "excused",
    [
        staged_row("x", impressions=None),
        staged_row("x", spend=None),
        staged_row("x", impressions=10, clicks=11),
        staged_row("x", clicks=21, duplicate=True),
    ],
)
def test_defects_nobody_corrects_are_not_compared(spark, excused):
    assert issues(spark, [excused], [truth_row("x")]) == []


def test_spend_is_compared_in_cents(spark):
    assert issues(spark, [staged_row("x", spend=2.501)], [truth_row("x", spend=2.5)]) == []
    assert issues(spark, [staged_row("x", spend=2.51)], [truth_row("x", spend=2.5)]) == [("x", "value_mismatch")]


def test_window_is_inclusive(spark):
    staged = [staged_row("new", event="01-20")]
    expected = [truth_row("new", event="01-20"), truth_row("edge", event="01-13"), truth_row("old", event="01-12")]
    assert issues(spark, staged, expected) == [("edge", "missing_from_fct")]


def test_reconciliation_counts_pairs_of_repeated_creative_days(spark):
    """Against a plain comparison of all truth rows with all fact rows."""
    draw = random.Random(7)
    staged = [
        staged_row(
            draw.choice(["a", "b", "c", None]), campaign=f"cmp{n}", clicks=draw.choice([20, 21, None]),
            duplicate=draw.random() < 0.2, event=draw.choice(["01-01", "01-02"]),
        )
        for n in range(60)
    ]
    expected = [
        truth_row(draw.choice(["a", "b", "d", None]), clicks=draw.choice([20, 21, 22]), event=draw.choice(["01-01", "01-02"]))
        for _ in range(40)
    ]
    fact = with_ratios(staged_rows(spark, staged))
    plain = Counter()
    rows = fact.collect()
    for want in truth(spark, expected).collect():
        same_day = [r for r in rows if r.event_date == want.date and r.creative_id == want.creative_id is not None]
        if not same_day:
            plain[want.creative_id, want.date, "missing_from_fct"] += 1
        for row in same_day:
            if row.clicks is not None and not row.had_same_drop_duplicate and row.clicks != want.clicks:
                plain[want.creative_id, want.date, "value_mismatch"] += 1
    found = checks.reconciliation(fact, truth(spark, expected)).collect()
    assert Counter((r.creative_id, r.event_date, r.issue) for r in found) == plain
    assert {issue for _, _, issue in plain} == {"missing_from_fct", "value_mismatch"}


def test_issues_repeat_beyond_one_array(spark, monkeypatch):
    monkeypatch.setattr(checks, "_REPEATS", 4)
    rows = spark.createDataFrame([("a", 1), ("b", 4), ("c", 5), ("d", 13)], "name string, times bigint")
    assert Counter(r.name for r in checks._repeated(rows, "times").collect()) == {"a": 1, "b": 4, "c": 5, "d": 13}


def test_reconciliation_reads_each_table_once_and_joins_nothing(spark, folder):
    staged_rows(spark, [staged_row("a")]).write.parquet(f"{folder}/staged")
    truth(spark, [truth_row("a")]).write.parquet(f"{folder}/truth")
    fact = with_ratios(spark.read.parquet(f"{folder}/staged"))
    found = checks.reconciliation(fact, spark.read.parquet(f"{folder}/truth"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    scans = [s for s in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in s]
    # Other scans look up the newest day, of one column, and are one at run time.
    assert sum("clicks" in s for s in scans) == 2
    assert all("ReadSchema: struct<event_date:date>" in s for s in scans if "clicks" not in s)


def test_unexpected_rows_are_a_check_of_their_own(spark):
    fact, _ = marts(spark, [staged_row("a"), staged_row("b")])
    assert [r.creative_id for r in checks.unexpected_in_fact(fact, truth(spark, [truth_row("a")])).collect()] == ["b"]


def results(spark, rows, expected=None):
    fact, dimension = marts(spark, rows)
    known = None if expected is None else truth(spark, expected)
    return checks.check_results(fact, dimension, known)


def test_ten_checks_pass_on_clean_rows(spark):
    table = results(spark, [staged_row("a")], [truth_row("a")])
    rows = table.collect()
    assert len(rows) == 10
    assert {r.status for r in rows} == {"pass"}
    checks.raise_on_errors(table)


def test_a_warning_does_not_stop_the_run(spark):
    table = results(spark, [staged_row("a", impressions=10, clicks=20)], [truth_row("a")])
    found = {r.check_name: (r.failures, r.status) for r in table.collect()}
    assert found["clicks_lte_impressions"] == (1, "warn")
    checks.raise_on_errors(table)


def test_an_error_stops_the_run(spark):
    two_campaigns = [staged_row("a"), staged_row("a", campaign="other"), staged_row(None)]
    table = results(spark, two_campaigns)
    found = {r.check_name: r.failures for r in table.collect() if r.status == "fail"}
    assert found == {
        "unique_fct_creative_daily_id": 1, "not_null_fct_creative_daily_id": 1,
        "not_null_fct_creative_id": 1, "not_null_dim_creative_id": 1,
    }
    with pytest.raises(checks.ChecksFailed, match="unique_fct_creative_daily_id: 1"):
        checks.raise_on_errors(table)


def test_orphans_are_counted_by_row(spark):
    fact, dimension = marts(spark, [staged_row("a"), staged_row("b"), staged_row("b", event="01-02")])
    rows = checks.orphans(fact, dimension.filter("creative_id = 'a'"), "creative_id").collect()
    assert [(r.creative_id, r.rows) for r in rows] == [("b", 2)]


def test_gap_split(spark):
    fact, _ = marts(spark, [staged_row("a", event="03-10")])
    expected = truth(spark, [
        truth_row("a", event="03-10"), truth_row("b", event="03-10"),
        truth_row("a", event="03-12"), truth_row("b", event="03-12"),
    ])
    found = {r.on_outage_day: r.lost_rows for r in reports.gap_split(fact, expected).collect()}
    assert found == {True: 2, False: 1}


def test_floor_calibration(spark):
    fact, _ = marts(spark, [staged_row(f"cr_{i}", impressions=i * 100) for i in range(1, 21)])
    row = reports.floor_calibration(fact).first()
    assert (row.impressions_p10, row.creative_days, row.eligible_days, row.eligible_share) == (
        pytest.approx(290.0), 20, 11, 0.55,
    )


def test_flagged_share(spark):
    rows = [staged_row(f"cr_{i}", clicks=i) for i in range(5)] + [staged_row("z", event="01-02")]
    fact, _ = marts(spark, rows)
    found = {r.group_size: (r.campaign_days, r.flagged, r.flagged_share) for r in reports.flagged_share(fact).collect()}
    assert found == {5: (1, 1, 0.2), 1: (1, 1, 1.0)}


def test_violating_rows_are_kept_whole(spark):
    fact, dimension = marts(spark, [staged_row("a", impressions=10, clicks=20), staged_row(None), staged_row("b")])
    tables = {"fact": fact, "dimension": dimension.filter("creative_id = 'a'")}
    found = {r.check_name: r for r in checks.violations(tables).collect()}
    assert set(found) == {
        "clicks_lte_impressions", "not_null_fct_creative_daily_id", "not_null_fct_creative_id",
        "relationships_fct_creative_id",
    }
    clicks = found["clicks_lte_impressions"]
    assert (clicks.creative_id, clicks.event_date, clicks.failures) == ("a", day("01-01"), 1)
    assert json.loads(clicks.record)["clicks"] == 20
    assert json.loads(found["relationships_fct_creative_id"].record) == {"creative_id": "b", "rows": 1}


def test_a_check_of_ones_own(spark):
    fact, _ = marts(spark, [staged_row("a", spend=-1.0), staged_row("b")])
    own = (
        checks.RowCheck("spend_not_negative", "fact", lambda: F.col("spend") < 0, checks.WARN),
        checks.TableCheck("needs_other", ("other",), lambda t, _: t["other"]),
    )
    entries = checks.applicable({"fact": fact}, own)
    rows = checks.results_of(checks.violations({"fact": fact}, own), entries).collect()
    assert [tuple(r) for r in rows] == [("spend_not_negative", "warn", 1, "warn")]
    with pytest.raises(ValueError, match="one name"):
        checks.applicable({"fact": fact}, own[:1] * 2)
    with pytest.raises(ValueError, match="no check"):
        checks.violations({"fact": fact}, own[1:])


def test_row_checks_of_a_table_share_a_scan(spark, folder):
    staged_rows(spark, [staged_row("a")]).write.parquet(f"{folder}/staged")
    fact = with_ratios(spark.read.parquet(f"{folder}/staged"))
    row_wise = [c for c in checks.REGISTRY if isinstance(c, checks.RowCheck) and c.table == "fact"]
    assert len(row_wise) == 5
    plan = checks.violations({"fact": fact}, row_wise)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_stored_violations_keep_every_run(spark, folder):
    store = Store(spark, f"{folder}/warehouse")
    dimension = None
    for clicks in (20, 5, 30):
        staged = staged_rows(spark, [staged_row("a", impressions=10, clicks=clicks), staged_row("b")])
        fact, dimension = creative_daily(staged), dim_creative(staged)
        store.replace("fct_creative_daily", fact, by=["event_date"])
        store.replace("dim_creative", dimension)
        results = {r.check_name: r.status for r in run_checks(store).collect()}
        assert results["clicks_lte_impressions"] == ("warn" if clicks > 10 else "pass")
        assert len(results) == 9
    kept = store.check_violations().orderBy("run").collect()
    assert [json.loads(r.record)["clicks"] for r in kept] == [20, 30]
    assert len({r.run for r in kept}) == 2
