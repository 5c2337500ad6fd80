"""The stored defect log, kept up drop by drop, against one made from all drops."""

import glob
import os
import random

import pytest
from helpers import EARLY, LATE, comparable, write_drop
from pyspark.sql import functions as F

from dayledger.operators import defects
from dayledger.plans.defect_log import log_defects
from dayledger.sources import files
from dayledger.sources.ingest import LOADED, ingest
from dayledger.sources.tables import Store

PLACE = ["defect_type", "event_date", "drop_date", "campaign_id", "adset_id", "creative_id"]


@pytest.fixture
def drops(folder):
    path = f"{folder}/drops"
    os.mkdir(path)
    return path


@pytest.fixture
def store(spark, folder):
    return Store(spark, f"{folder}/warehouse")


def as_text(log):
    return comparable(log.withColumn("detail", F.to_json("detail")), [*PLACE, "detail"])


def from_all_drops(store):
    layouts = store.load_log().filter(F.col("status") == LOADED).select("drop_date", "layout")
    return as_text(defects.defect_log(store.raw(), layouts))


def line(event, creative="cr", impressions=100, clicks=5, late=False):
    text = f"2026-{event},cmp,as,{creative},video,feed,{impressions},{clicks},2.5,1"
    return f"{text},0.5" if late else text


def deliver(store, drops, drop, lines, header=EARLY):
    write_drop(drops, drop if drop.endswith(".csv") else f"drop_2026-{drop}.csv", header, lines)
    ingest(store, drops)
    return as_text(log_defects(store))


def runs(store):
    return len(store.parts("defect_log", "logged_in") - {"calendar"})


def test_each_run_adds_what_new_drops_show(store, drops):
    deliver(store, drops, "01-01", [line("01-01"), line("01-01", "b")])
    deliver(store, drops, "01-02", [line("01-01", impressions=200), line("01-01", "late"), line("01-02"), line("01-02")])
    found = deliver(store, drops, "01-05", [line("01-01"), line("01-01", "b"), line("01-02", clicks="")])
    assert found == from_all_drops(store)
    assert sorted(row[0] for row in found) == [
        "duplicate_exact", "late_arrival", "missing_day", "missing_day", "null_value",
        "restatement", "restatement", "restatement",
    ]


def test_random_drops_one_by_one(store, drops):
    dice = random.Random(7)
    for day in sorted(dice.sample(range(1, 28), 4)):
        rows = [
            line(f"01-{dice.randint(1, day):02d}", f"cr_{dice.randint(0, 3)}", dice.choice([100, 200, ""]),
                 dice.choice([5, 500]), late=day > 14)
            for _ in range(25)
        ]
        found = deliver(store, drops, f"01-{day:02d}", rows, LATE if day > 14 else EARLY)
        assert found == from_all_drops(store)
    assert runs(store) == 4


def test_older_drops_are_not_read(store, drops):
    deliver(store, drops, "01-01", [line("01-01"), line("01-01", "b", clicks=500)])
    expected_store_rows = [line("01-01", impressions=7), line("01-02")]
    write_drop(drops, "drop_2026-01-02.csv", EARLY, expected_store_rows)
    ingest(store, drops)
    expected = from_all_drops(store)
    for path in glob.glob(f"{store.path('raw')}/_drop_date=2026-01-01/**/*.parquet", recursive=True):
        with open(path, "wb") as file:
            file.write(b"unreadable")
    assert as_text(log_defects(store)) == expected


def test_only_touched_days_of_the_state_are_replaced(store, drops):
    deliver(store, drops, "01-02", [line("01-01"), line("01-02")])
    before = dict(store._manifest("last_delivered"))
    deliver(store, drops, "01-03", [line("01-02", impressions=1), line("01-03")])
    after = store._manifest("last_delivered")
    assert after["part=day-2026-01-01"] == before["part=day-2026-01-01"]
    assert after["part=day-2026-01-02"] != before["part=day-2026-01-02"]
    newest = {(str(r.date), str(r["_drop_date"])) for r in store.last_delivered().filter("date is not null").collect()}
    assert newest == {("2026-01-01", "2026-01-02"), ("2026-01-02", "2026-01-03"), ("2026-01-03", "2026-01-03")}


def test_a_drop_that_comes_before_profiled_ones(store, drops):
    deliver(store, drops, "01-01", [line("01-01")])
    deliver(store, drops, "01-05", [line("01-01", impressions=3), line("01-02")])
    found = deliver(store, drops, "01-03", [line("01-01", impressions=3), line("01-02")])
    assert found == from_all_drops(store)
    assert runs(store) == 1
    assert deliver(store, drops, "undated.csv", [line("01-01"), ",cmp,as,cr,video,feed,1,2,1,1"]) == from_all_drops(store)


def test_two_files_of_a_day_and_blank_days(store, drops):
    deliver(store, drops, "01-01", [line("01-01"), ",cmp,as,cr,video,feed,1,0,1,1"])
    found = deliver(store, drops, "01-02", [",cmp,as,cr,video,feed,2,0,1,1", line("01-01", clicks=6)])
    assert found == from_all_drops(store)
    assert [row[0] for row in found].count("restatement") == 2


def test_a_run_without_news_changes_nothing(store, drops):
    first = deliver(store, drops, "01-02", [line("01-01")])
    assert as_text(log_defects(store)) == first == from_all_drops(store)
    assert as_text(log_defects(store, full_refresh=True)) == first


def test_no_files_at_all(store):
    assert log_defects(store).isEmpty()
    assert log_defects(store).isEmpty()


@pytest.mark.parametrize("published", [0, 1])
def test_a_run_that_dies_is_made_good(store, drops, monkeypatch, published):
    deliver(store, drops, "01-01", [line("01-01")])
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [line("01-01", impressions=9), line("01-02", clicks=500)])
    ingest(store, drops)
    publish, left = files.publish_text, [published]

    def dying(*arguments):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        publish(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(files, "publish_text", dying)
        with pytest.raises(KeyboardInterrupt):
            log_defects(store)
    write_drop(drops, "drop_2026-01-03.csv", EARLY, [line("01-01", impressions=10)])
    ingest(store, drops)
    assert as_text(log_defects(store)) == from_all_drops(store)
