import random

import pytest
from helpers import comparable, staged_row, staged_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS
from dayledger.operators.dimension import attribute_conflicts, dim_creative, entity_counts
from dayledger.operators.fact import creative_daily, with_ratios
from dayledger.operators.ranks import exact_percentile, ranked_values


@pytest.fixture
def settings():
    return DEFAULTS


def fact(spark, rows, settings):
    return {r.creative_id: r for r in creative_daily(staged_rows(spark, rows), settings).collect()}


def flagged(rows):
    return sorted(name for name, r in rows.items() if r.is_top_decile_creative)


def test_zero_impressions(spark, settings):
    row = fact(spark, [staged_row(impressions=0, clicks=0, spend=0, conversions=0)], settings)["cr"]
    assert (row.ctr, row.cpc, row.cpa, row.conversion_rate, row.spend_share) == (None,) * 5
    assert row.meets_volume_floor is False
    assert row.ctr_percentile_in_campaign_day is None
    assert row.is_top_decile_creative is False


def test_unknown_impressions(spark, settings):
    row = fact(spark, [staged_row(impressions=None, clicks=5)], settings)["cr"]
    assert row.ctr is None
    assert row.meets_volume_floor is None
    assert row.ctr_percentile_in_campaign_day is None
    assert row.is_top_decile_creative is False


def test_ratios(spark, settings):
    row = fact(spark, [staged_row(impressions=2000, clicks=20, spend=50, conversions=4)], settings)["cr"]
    assert (row.ctr, row.cpc, row.cpa, row.conversion_rate) == (0.01, 2.5, 12.5, 0.2)


def test_single_eligible_row_is_flagged(spark, settings):
    row = fact(spark, [staged_row(), staged_row("small", impressions=10)], settings)["cr"]
    assert (row.ctr_percentile_in_campaign_day, row.is_top_decile_creative) == (0.0, True)


@pytest.mark.parametrize("size, expected", [(10, 1), (11, 2), (20, 2), (21, 3), (31, 4)])
def test_flagged_count_without_ties(spark, settings, size, expected):
    rows = [staged_row(f"cr_{i:02d}", clicks=i) for i in range(size)]
    names = flagged(fact(spark, rows, settings))
    assert names == [f"cr_{i:02d}" for i in range(size - expected, size)]


def test_ties_share_a_rank(spark, settings):
    rows = [staged_row(f"cr_{i:02d}", clicks=min(i, 8)) for i in range(11)]
    found = fact(spark, rows, settings)
    assert flagged(found) == ["cr_08", "cr_09", "cr_10"]
    assert {found[n].ctr_percentile_in_campaign_day for n in flagged(found)} == {0.0}


def test_unknown_ctr_ranks_last_but_counts(spark, settings):
    rows = [staged_row(f"cr_{i:02d}", clicks=i) for i in range(10)] + [staged_row("none", clicks=None)]
    found = fact(spark, rows, settings)
    assert found["none"].ctr_percentile_in_campaign_day == 1.0
    assert flagged(found) == ["cr_08", "cr_09"]
    alone = fact(spark, [staged_row("none", clicks=None)], settings)
    assert flagged(alone) == ["none"]


def test_floor_is_inclusive(spark, settings):
    rows = [staged_row(f"cr_{n}", impressions=n) for n in (999, 1000, 1001)]
    found = fact(spark, rows, settings)
    assert [found[f"cr_{n}"].meets_volume_floor for n in (999, 1000, 1001)] == [False, True, True]


def test_spend_share_ignores_unknown_spend(spark, settings):
    found = fact(spark, [staged_row("a", spend=30), staged_row("b", spend=None), staged_row("c", spend=70)], settings)
    assert [found[n].spend_share for n in "abc"] == [0.3, None, 0.7]


def test_groups_are_campaign_and_day(spark, settings):
    rows = [staged_row("a"), staged_row("b", campaign="other"), staged_row("c", event="01-02"),
            staged_row("d", campaign=None)]
    found = fact(spark, rows, settings)
    assert flagged(found) == ["a", "b", "c", "d"]
    assert {r.spend_share for r in found.values()} == {1.0}


def test_surrogate_key(spark, settings):
    import hashlib

    found = fact(spark, [staged_row()], settings)
    assert found["cr"].creative_daily_id == hashlib.md5(b"2026-01-01-cr").hexdigest()
    assert fact(spark, [staged_row(creative=None)], settings)[None].creative_daily_id is None


def random_staged(seed, size):
    dice = random.Random(seed)
    return [
        staged_row(
            f"cr_{i}",
            impressions=dice.choice([None, 0, 999, 1000, dice.randint(1000, 40000), 5000]),
            clicks=dice.choice([None, 0, 1, dice.randint(0, 900), 90000, 50]),
            spend=dice.choice([None, 0.0, round(dice.random() * 500, 2)]),
            conversions=dice.choice([None, 0, dice.randint(0, 9)]),
            campaign=dice.choice(["hot", "hot", "hot", "warm", f"c{dice.randint(0, 9)}", None]),
            event=dice.choice(["01-01", "01-02"]),
        )
        for i in range(size)
    ]


def in_windows(staged):
    """Share and rank as windows over whole campaign-days give them."""
    day = Window.partitionBy("campaign_id", "event_date")
    ranking = Window.partitionBy("campaign_id", "event_date", "meets_volume_floor").orderBy(F.desc("ctr"))
    spend = F.sum(F.col("spend").cast("decimal(18,2)")).over(day).cast("double")
    return with_ratios(staged).select(
        "event_date", "campaign_id", "creative_id",
        F.when(spend != 0, F.col("spend") / spend).alias("spend_share"),
        F.when(F.col("meets_volume_floor"), F.percent_rank().over(ranking)).alias("ctr_percentile_in_campaign_day"),
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_ranks_and_shares_equal_windows(spark, seed):
    staged = staged_rows(spark, random_staged(seed, 900))
    expected = in_windows(staged)
    assert comparable(creative_daily(staged), expected.columns) == comparable(expected, expected.columns)


def test_one_campaign_day_and_no_rows(spark):
    staged = staged_rows(spark, [staged_row(f"c{i}", impressions=1000 + i, clicks=i % 50) for i in range(3000)])
    expected = in_windows(staged)
    assert comparable(creative_daily(staged), expected.columns) == comparable(expected, expected.columns)
    assert creative_daily(staged.filter("false")).isEmpty()


def test_ranked_values_equal_plain_ranks(spark):
    dice = random.Random(5)
    rows = [
        (dice.choice(["a", "b", None]), dice.choice([None, 0.0, 0.5, dice.random(), dice.random() * 1e-6, dice.random() * 100]))
        for _ in range(2000)
    ]
    frame = spark.createDataFrame(rows, "g string, v double")
    counts = frame.groupBy("g", "v").agg(F.count("*").alias("n"))
    for descending in (True, False):
        order = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
        plain = frame.select(
            "g", "v", (F.rank().over(Window.partitionBy("g").orderBy(order)) - 1).cast("bigint").alias("ahead"),
            F.count("*").over(Window.partitionBy("g")).alias("total"),
        ).distinct()
        ranked = ranked_values(counts, ["g"], "v", 16.0, descending).select("g", "v", "ahead", "total")
        assert comparable(ranked) == comparable(plain)


@pytest.mark.parametrize("size", [1, 2, 10, 101, 250])
def test_exact_percentile(spark, size):
    dice = random.Random(size)
    frame = spark.createDataFrame([(dice.randint(0, 90),) for _ in range(size)] + [(None,)], "v bigint")
    expected = frame.agg(F.percentile("v", 0.1)).first()[0]
    assert exact_percentile(frame, "v", 0.1, 1e11).first()[0] == pytest.approx(expected, abs=1e-9)


def test_exact_percentile_of_nothing(spark):
    assert exact_percentile(spark.createDataFrame([], "v bigint"), "v", 0.1, 1e11).first()[0] is None


def test_windows_see_buckets_and_not_rows(spark):
    # One inside a value bucket, two over the buckets of a group: all add up counted values.
    fact = creative_daily(staged_rows(spark, [staged_row()]))
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and all("[sum(n#" in line or "sum(spend" in line for line in windows)
    assert "rank(" not in plan


def test_dimension(spark):
    staged = staged_rows(spark, [
        staged_row("a", event="01-05"), staged_row("a", event="01-02"), staged_row("b"),
    ])
    rows = {r.creative_id: r for r in dim_creative(staged).collect()}
    assert (str(rows["a"].first_seen_date), str(rows["a"].last_seen_date)) == ("2026-01-02", "2026-01-05")
    assert rows["a"].campaign_id == "cmp"
    assert attribute_conflicts(staged).isEmpty()
    assert tuple(entity_counts(dim_creative(staged)).first()) == (1, 1, 2)


def test_attribute_conflicts(spark):
    staged = staged_rows(spark, [
        staged_row("a", placement="main"), staged_row("a", event="01-02", placement="side"), staged_row("b"),
    ])
    rows = attribute_conflicts(staged).collect()
    assert [(r.creative_id, r.placement_varies, r.campaign_id_varies) for r in rows] == [("a", True, False)]
    assert {r.creative_id: r.placement for r in dim_creative(staged).collect()}["a"] == "main"


def test_an_unknown_rate_has_no_text(spark):
    from dayledger.functions.text import percent_text

    rows = spark.createDataFrame([(0.12345,), (None,)], "rate double")
    assert [r[0] for r in rows.select(percent_text(F.col("rate"))).collect()] == ["12.35%", None]


def test_keys_and_ratios_are_made_after_the_shuffles(spark):
    fact = creative_daily(staged_rows(spark, [staged_row()]))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "md5" in plan and plan.rindex("md5") < plan.index("Exchange")
