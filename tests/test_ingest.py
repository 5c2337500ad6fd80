import os

import pytest
from helpers import EARLY, LATE, comparable, write_drop
from pyspark.sql import functions as F

from dayledger import queries
from dayledger.plans.refresh import refresh_staging
from dayledger.sources import files, lineitem
from dayledger.sources.ingest import ingest, read_rows, run_summary
from dayledger.sources.tables import Store, settled

EARLY_ROW = "2026-01-01,camp-7,set-3,ad-9,video,main,640,16,8.25,3"
LATE_ROW = "2026-03-01,camp-7,set-3,ad-9,video,main,910,21,13.5,4,0.35"


@pytest.fixture
def drops(folder):
    path = f"{folder}/drops"
    os.mkdir(path)
    return path


@pytest.fixture
def store(spark, folder):
    return Store(spark, f"{folder}/warehouse")


def outcome(summary, name):
    return next(o for o in summary.outcomes if o.file_name == name)


def test_loads_both_layouts(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    write_drop(drops, "drop_2026-03-01.csv", LATE, [LATE_ROW])
    summary = ingest(store, drops)
    assert (summary.loaded, summary.quarantined, summary.rows_loaded) == (2, 0, 2)
    rows = store.raw().orderBy("date").collect()
    assert [(r.spend, r.video_completion_rate) for r in rows] == [(8.25, None), (13.5, 0.35)]
    assert [str(r["_drop_date"]) for r in rows] == ["2026-01-01", "2026-03-01"]
    assert [o.layout for o in summary.outcomes] == ["early", "late"]


def test_quarantines_unknown_layout(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    write_drop(drops, "drop_2026-01-02.csv", "day,left,right", ["2026-01-02,x,77"])
    summary = ingest(store, drops)
    assert (summary.loaded, summary.quarantined) == (1, 1)
    assert outcome(summary, "drop_2026-01-02.csv").reason == "unrecognized columns: ['day', 'left', 'right']"
    kept = store.quarantine().orderBy("block", "position").collect()
    assert [r.line for r in kept] == ["day,left,right", "2026-01-02,x,77"]
    assert os.path.exists(f"{drops}/drop_2026-01-02.csv")
    assert store.raw().count() == 1
    assert tuple(run_summary(store.load_log()).first()) == (1, 1, 1)


def test_second_run_changes_nothing(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    write_drop(drops, "drop_2026-01-02.csv", "day,left,right", [])
    ingest(store, drops)
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW, EARLY_ROW])
    again = ingest(store, drops)
    assert (again.loaded, again.quarantined, again.skipped) == (0, 0, 2)
    assert store.raw().count() == 1
    assert store.load_log().count() == 2


def test_new_files_are_added(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    ingest(store, drops)
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [EARLY_ROW])
    second = ingest(store, drops)
    assert (second.loaded, second.skipped) == (1, 1)
    assert store.raw().count() == 2


def test_interrupted_run_does_not_load_twice(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    write_drop(drops, "plain.csv", EARLY, [EARLY_ROW])
    ingest(store, drops)
    files.remove(store.spark, store.path("load_log"))  # died before the log was written
    assert ingest(store, drops).loaded == 2
    assert store.raw().count() == 2


def test_column_order_and_case_matter(store, drops):
    names = EARLY.split(",")
    write_drop(drops, "a.csv", ",".join([names[1], names[0], *names[2:]]), [EARLY_ROW])
    write_drop(drops, "b.csv", EARLY.upper(), [EARLY_ROW])
    assert ingest(store, drops).quarantined == 2


def test_file_name_without_a_date_is_loaded(store, drops):
    for name in ("x.csv", "my_drop_2026-01-01.csv", "a+b %20 ü.csv"):
        write_drop(drops, name, EARLY, [EARLY_ROW])
    assert ingest(store, drops).loaded == 3
    rows = store.raw().collect()
    assert {r["_source_file"] for r in rows} == {"x.csv", "my_drop_2026-01-01.csv", "a+b %20 ü.csv"}
    assert {r["_drop_date"] for r in rows} == {None}


def test_impossible_drop_date_is_quarantined(store, drops):
    write_drop(drops, "drop_2026-02-30.csv", EARLY, [EARLY_ROW])
    assert ingest(store, drops).outcomes[0].reason == "no such drop date"


def test_header_only_file_is_loaded_with_no_rows(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [])
    summary = ingest(store, drops)
    assert (summary.loaded, summary.rows_loaded) == (1, 0)
    assert store.raw().count() == 0
    assert ingest(store, drops).skipped == 1


def test_empty_file_is_quarantined(store, drops):
    open(f"{drops}/drop_2026-01-01.csv", "w").close()
    assert ingest(store, drops).outcomes[0].reason == "unrecognized columns: []"


def test_no_files(store, drops):
    summary = ingest(store, drops)
    assert (summary.loaded, summary.skipped, summary.outcomes) == (0, 0, [])
    assert store.raw().count() == 0


@pytest.mark.parametrize("text", ["", "NA", "nan", "NULL", "None", " n/a "])
def test_blank_texts_are_null(store, drops, text):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW.replace("8.25", text)])
    assert ingest(store, drops).loaded == 1
    assert store.raw().first().spend is None


@pytest.mark.parametrize(
    "row",
    [
        EARLY_ROW.replace("640", "many"),
        EARLY_ROW.replace("640", "1d"),
        EARLY_ROW.replace("2026-01-01", "yesterday"),
        EARLY_ROW.replace("2026-01-01", "2026-02-30"),
        EARLY_ROW + ",7",
    ],
)
def test_file_with_an_unreadable_row_is_quarantined_whole(store, drops, row):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW, row])
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [EARLY_ROW])
    summary = ingest(store, drops)
    assert outcome(summary, "drop_2026-01-01.csv").reason == "unreadable values in 1 row(s)"
    assert [r["_source_file"] for r in store.raw().collect()] == ["drop_2026-01-02.csv"]
    assert store.quarantine().count() == 3


def test_short_rows_are_filled_with_blanks(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, ["2026-01-01,cmp,a1"])
    assert ingest(store, drops).loaded == 1
    row = store.raw().first()
    assert (row.adset_id, row.creative_id, row.spend) == ("a1", None, None)


def test_identifiers_keep_leading_zeros_and_quotes(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, ['2026-01-01,007,"a,1","say ""hi""",video,feed,1e2,5,2.5,1'])
    ingest(store, drops)
    row = store.raw().first()
    assert (row.campaign_id, row.adset_id, row.creative_id, row.impressions) == ("007", "a,1", 'say "hi"', 100.0)


def test_positions_are_dense_and_in_file_order_over_many_blocks(store, drops, small_blocks):
    for name, size in (("drop_2026-01-01.csv", 90), ("drop_2026-01-02.csv", 41), ("x.csv", 1)):
        write_drop(drops, name, EARLY, [EARLY_ROW.replace("640", str(i)) for i in range(size)])
    summary = ingest(store, drops)
    assert [o.row_count for o in summary.outcomes] == [90, 41, 1]
    rows = store.raw().collect()
    assert all(r.impressions == r["_row_in_file"] for r in rows)
    assert len({(r["_source_file"], r["_row_in_file"]) for r in rows}) == 132


def test_intermediate_tables_are_removed(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    with store.scratch() as scratch:
        folder = scratch.rsplit("/", 1)[0]
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ingest(store, drops)
    assert set(os.listdir(folder)) <= before


def test_load_log_keeps_event_day_range(store, drops):
    write_drop(drops, "drop_2026-01-03.csv", EARLY, [EARLY_ROW, EARLY_ROW.replace("2026-01-01", "2026-01-03")])
    ingest(store, drops)
    row = store.load_log().first()
    assert (str(row.first_event_date), str(row.last_event_date), str(row.drop_date)) == (
        "2026-01-01", "2026-01-03", "2026-01-03",
    )


def test_header_may_follow_blank_lines_and_a_byte_order_mark(spark, drops):
    with open(f"{drops}/x.csv", "w", encoding="utf-8") as file:
        file.write("\n\n﻿" + EARLY + "\n" + EARLY_ROW + "\n")
    found = files.read_headers(spark, files.list_drops(spark, drops))
    assert found["x.csv"].layout == "early"


@pytest.mark.parametrize("spend", ["1e400", "1e30", "-1e19"])
def test_a_number_out_of_range_quarantines_its_file_only(store, drops, spend):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    write_drop(drops, "drop_2026-01-02.csv", EARLY, [EARLY_ROW, EARLY_ROW.replace("640", spend)])
    assert outcome(ingest(store, drops), "drop_2026-01-02.csv").status == "quarantined"
    refresh_staging(store)
    assert store.staging().count() == 1


def test_a_quoted_line_break_quarantines_its_file_only(store, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW, EARLY_ROW.replace("ad-9", '"ad-9, ""b"""')])
    first, second = EARLY_ROW.split(",ad-9,")
    for n, rest in enumerate((f'",{second}', f'",,{second}', f',",{second}')):
        write_drop(drops, f"drop_2026-01-0{n + 2}.csv", EARLY, [EARLY_ROW, f'{first},"ad-9', rest])
    summary = ingest(store, drops)
    assert [o.status for o in summary.outcomes] == ["loaded"] + ["quarantined"] * 3
    assert {r.creative_id for r in store.raw().collect()} == {"ad-9", 'ad-9, "b"'}


def test_a_header_may_follow_any_number_of_blank_lines(store, drops, small_blocks):
    with open(f"{drops}/drop_2026-01-01.csv", "w") as file:
        file.write((" " * 1023 + "\n") * 30 + "\n" * 500 + EARLY + "\n" + "2026-01-01,cmp,as,cr,video,feed,1,1,1,1\n")
    store.spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    found = files.read_headers(store.spark, files.list_drops(store.spark, drops))
    assert found["drop_2026-01-01.csv"].layout == "early"


def test_a_file_behind_two_megabytes_of_blank_lines_is_loaded(store, drops):
    with open(f"{drops}/drop_2026-01-01.csv", "w") as file:
        file.write("\n" * (2 << 20) + EARLY + "\n" + "2026-01-01,cmp,as,cr,video,feed,1,1,1,1\n")
    summary = ingest(store, drops)
    assert (summary.loaded, summary.quarantined, summary.rows_loaded) == (1, 0, 1)


def test_an_endless_first_line_is_no_header(store, drops):
    with open(f"{drops}/drop_2026-01-01.csv", "w") as file:
        file.write("x" * (3 << 20) + "\n")
    summary = ingest(store, drops)
    assert summary.quarantined == 1 and len(store.load_log().first().reason) < 20_000


def test_a_foreign_file_is_one_file_whose_rows_come_from_many_tasks(spark):
    delivered = queries._DatedDrops(spark, "/root/testdata/sf0.001")
    before = set(files.names_in(spark, delivered.drops))
    rows = spark.range(0, 40, 1, 4).select(F.spark_partition_id().cast("string").alias("task"))
    delivered.deliver_foreign(rows)
    new = [n for n in files.names_in(spark, delivered.drops) if n not in before and n.endswith(".csv")]
    lines = [r.value for r in spark.read.text(f"{delivered.drops}/{new[0]}").collect()]
    assert len(new) == 1 and len(lines) == 41
    assert set(lines) == {"task", "0", "1", "2", "3"}


def test_each_field_is_parsed_once(spark, drops):
    write_drop(drops, "drop_2026-01-01.csv", EARLY, [EARLY_ROW])
    found = files.unseen(spark, files.list_drops(spark, drops), spark.createDataFrame([], "file_name string"))
    rows = read_rows(spark, found, files.read_headers(spark, found))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # The date, and four metrics whose value is named by its bound and by its result; the flag adds none.
    assert plan.lower().count("rlike") == 1 + 4 * 2


def test_drops_are_dealt_without_the_texts_of_their_rows(spark):
    small = "/root/testdata/sf0.001"
    copies = lineitem.copies(spark, small)
    assert not {"campaign_id", "adset_id", "creative_id", "_source_file"} & set(copies.columns)
    dealt = copies.repartition(3, "_drop_date")
    assert comparable(lineitem.described(dealt)) == comparable(lineitem.deliveries(spark, small))


def test_the_snapshot_makes_staging_once(spark, monkeypatch):
    kept = []

    def noted(rows):
        kept.append(rows.columns)
        return settled(rows)

    monkeypatch.setattr(queries, "settled", noted)
    queries.snapshot_document(spark, "/root/testdata/sf0.001")
    assert any("had_same_drop_duplicate" in columns for columns in kept)
