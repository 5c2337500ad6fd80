import random

from helpers import comparable, delivery, raw_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from dayledger.operators.latest import latest_deliveries, same_drop_repeats, typed
from dayledger.functions.text import reversed_order


def winner(spark, rows):
    found = latest_deliveries(raw_rows(spark, rows)).collect()
    assert len(found) == 1
    return found[0]


def values(row):
    return row.impressions, row.clicks, row.spend, row.conversions


def test_latest_drop_wins(spark):
    row = winner(spark, [
        delivery("01-01", 0, 100, 5, 2.5, 1), delivery("01-03", 0, 120, 6, 3.0, 1),
    ])
    assert values(row) == (120, 6, 3.0, 1)
    assert row.had_same_drop_duplicate is False
    assert row.loaded_from_file == "drop_2026-01-03.csv"


def test_position_breaks_ties_within_a_drop(spark):
    row = winner(spark, [delivery(row=3), delivery(row=7, impressions=107)])
    assert row.impressions == 107
    assert row.had_same_drop_duplicate is True


def test_multiplicity_is_that_of_the_winning_drop(spark):
    row = winner(spark, [delivery(row=0), delivery(row=1), delivery("01-02", 0, 9)])
    assert row.impressions == 9
    assert row.had_same_drop_duplicate is False


def test_undated_drop_loses(spark):
    row = winner(spark, [delivery(None, 9, 1), delivery("01-01", 0, 2)])
    assert row.impressions == 2


def test_undated_files_count_as_one_drop(spark):
    tied = [delivery(None, 0, 1, file="a.csv"), delivery(None, 0, 2, file="b.csv")]
    row = winner(spark, tied)
    assert (row.loaded_from_file, row.had_same_drop_duplicate) == ("b.csv", True)
    assert winner(spark, tied[:1]).had_same_drop_duplicate is False
    assert winner(spark, [delivery(None, 0, file="a.csv"), delivery(None, 0, file="a.csv.csv")]).had_same_drop_duplicate


def test_latest_wins_by_row_not_by_field(spark):
    row = winner(spark, [delivery("01-01"), delivery("01-02", clicks=None)])
    assert values(row) == (100, None, 2.5, 1)


def test_halves_round_to_even(spark):
    row = winner(spark, [delivery(impressions=2.6, clicks=2.5, conversions=3.5)])
    assert (row.impressions, row.clicks, row.conversions) == (3, 2, 4)


def test_null_keys_are_kept(spark):
    rows = raw_rows(spark, [delivery(campaign=None), delivery("01-02", campaign=None, impressions=7)])
    assert [r.impressions for r in latest_deliveries(rows).collect()] == [7]


def test_same_drop_repeats(spark):
    rows = raw_rows(spark, [delivery(row=0), delivery(row=1), delivery("01-02")])
    assert [r.same_drop_key_count for r in same_drop_repeats(rows).collect()] == [2]


def test_reversed_order_mirrors_any_two_names(spark):
    names = ["", "a", "ab", "abc", "b", "B", "é", "drop_1.csv", "drop_10.csv", "~", "zz"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    forward = [r.name for r in frame.orderBy("name").collect()]
    backward = [r.name for r in frame.orderBy(reversed_order(F.col("name"))).collect()]
    assert backward == forward[::-1]


def by_windows(raw):
    """The rule spelled out with window functions."""
    key = ["event_date", "campaign_id", "adset_id", "creative_id"]
    order = Window.partitionBy(*key).orderBy(
        F.desc("_drop_date"), F.desc("_row_in_file"), F.desc("_source_file")
    )
    return (
        typed(raw)
        .withColumn("rn", F.row_number().over(order))
        .withColumn("same", F.count("*").over(Window.partitionBy(*key, "_drop_date")))
        .filter("rn = 1")
        .select(
            *key, "creative_format", "placement", "impressions", "clicks", "spend", "conversions",
            "video_completion_rate", F.col("_drop_date").alias("loaded_from_drop_date"),
            F.col("_source_file").alias("loaded_from_file"),
            (F.col("same") > 1).alias("had_same_drop_duplicate"),
        )
    )


def random_deliveries(seed, size, hot_share=0.0):
    dice = random.Random(seed)
    rows = []
    for i in range(size):
        hot = dice.random() < hot_share
        drop = None if dice.random() < 0.1 else f"01-{dice.randint(1, 9):02d}"
        rows.append(delivery(
            drop, i, dice.choice([None, 0, dice.randint(0, 5000)]), dice.choice([None, dice.randint(0, 50)]),
            dice.choice([None, round(dice.random() * 9, 2)]), dice.randint(0, 3),
            event="01-01" if hot else f"01-{dice.randint(1, 5):02d}",
            creative="cr_hot" if hot else f"cr_{dice.randint(0, 30)}",
            campaign="cmp" if hot else dice.choice(["cmp", "other", None]),
            file=None if drop else dice.choice(["x.csv", "y.csv"]),
            creative_format=dice.choice(["video", "slides"]),
        ))
    return rows


def test_equals_the_window_form_and_ignores_input_order(spark):
    rows = random_deliveries(7, 600, hot_share=0.4)
    expected = comparable(by_windows(raw_rows(spark, rows)))
    assert comparable(latest_deliveries(raw_rows(spark, rows))) == expected
    random.Random(1).shuffle(rows)
    assert comparable(latest_deliveries(raw_rows(spark, rows).repartition(7))) == expected


def test_one_shuffle_and_map_side_combine(spark):
    plan = latest_deliveries(raw_rows(spark, [delivery()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan
    assert "Window" not in plan
