import json

from helpers import delivery, raw_rows

from dayledger.operators import defects


def details(frame):
    return [r.detail for r in frame.collect()]


def test_late_arrival_is_the_first_delivery_after_its_day(spark):
    raw = raw_rows(spark, [
        delivery("01-03", event="01-01", creative="late"),
        delivery("01-01", event="01-01", creative="ok"),
        delivery("01-04", event="01-01", creative="ok"),
        delivery(None, event="01-01", creative="undated"),
    ])
    rows = defects.delivery_defects(raw, [defects.LATE]).collect()
    assert [(r.creative_id, str(r.drop_date), r.detail) for r in rows] == [
        ("late", "2026-01-03", {"delayed_by_days": "2"})
    ]


def test_restatement_needs_a_changed_value_in_a_later_drop(spark):
    raw = raw_rows(spark, [
        delivery("01-01", creative="same"), delivery("01-02", creative="same"),
        delivery("01-01", creative="fixed"), delivery("01-03", creative="fixed", clicks=None),
        delivery("01-01", 0, creative="one_drop"), delivery("01-01", 1, creative="one_drop", clicks=9),
    ])
    rows = defects.delivery_defects(raw, [defects.RESTATED]).collect()
    assert [(r.creative_id, str(r.drop_date)) for r in rows] == [("fixed", "2026-01-03")]
    detail = rows[0].detail
    assert detail["original_drop_date"] == "2026-01-01"
    assert json.loads(detail["wrong_values"])["clicks"] == 5
    assert json.loads(detail["corrected_values"])["clicks"] is None


def test_restatement_compares_surviving_rows_of_each_drop(spark):
    raw = raw_rows(spark, [
        delivery("01-01", 0, clicks=1), delivery("01-01", 1, clicks=5), delivery("01-02", 0, clicks=5),
    ])
    assert defects.delivery_defects(raw, [defects.RESTATED]).isEmpty()


def test_exact_and_near_duplicates_are_within_one_file(spark):
    raw = raw_rows(spark, [
        *[delivery(row=i, creative="copy") for i in range(3)],
        delivery(row=0, creative="jitter"), delivery(row=1, creative="jitter", impressions=107, clicks=None),
        delivery("01-01", creative="apart"), delivery("01-02", creative="apart"),
        delivery(None, 0, creative="two_files", file="x.csv"), delivery(None, 0, creative="two_files", file="y.csv"),
    ])
    assert [(r.creative_id, r.detail) for r in defects.exact_duplicates(raw).collect()] == [
        ("copy", {"copies": "3"})
    ]
    assert [
        (r.creative_id, r.detail) for r in defects.delivery_defects(raw, [defects.NEAR]).collect()
    ] == [("jitter", {"jittered_field": "impressions,clicks"})]


def test_blanks_and_impossible_clicks(spark):
    raw = raw_rows(spark, [
        delivery(spend=None, conversions=None, creative="blank"),
        delivery(impressions=10, clicks=12, creative="odd"),
        delivery(impressions=None, clicks=12, creative="unknown"),
    ])
    blanks = defects.row_defects(raw, [defects.MISSING_VALUE]).collect()
    assert sorted((r.creative_id, r.detail["field"]) for r in blanks) == [
        ("blank", "conversions"), ("blank", "spend"), ("unknown", "impressions"),
    ]
    odd = defects.row_defects(raw, [defects.IMPOSSIBLE]).collect()
    assert [(r.creative_id, r.detail) for r in odd] == [("odd", {"impressions": "10", "clicks": "12"})]


def test_missing_day(spark):
    raw = raw_rows(spark, [delivery(d) for d in ("01-01", "01-02", "01-04")] + [delivery(None)])
    assert [str(r.drop_date) for r in defects.missing_days(raw).collect()] == ["2026-01-03"]


def test_schema_drift_at_change_points(spark):
    layouts = spark.createDataFrame(
        [("2026-01-01", "early"), ("2026-01-02", "early"), ("2026-01-03", "late"), ("2026-01-04", "late"),
         (None, "early")],
        "drop_date string, layout string",
    ).selectExpr("cast(drop_date as date) as drop_date", "layout")
    rows = defects.schema_drifts(layouts).collect()
    assert [(str(r.drop_date), r.detail) for r in rows] == [
        ("2026-01-03", {"from_layout": "early", "to_layout": "late"})
    ]


def test_counts_over_the_whole_log(spark):
    raw = raw_rows(spark, [delivery("01-02", event="01-01", clicks=None), delivery("01-04", event="01-04")])
    counts = {r.defect_type: r.defects for r in defects.defect_counts(defects.defect_log(raw)).collect()}
    assert counts == {"late_arrival": 1, "null_value": 1, "missing_day": 1}
