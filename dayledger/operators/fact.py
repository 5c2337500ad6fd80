"""The daily fact: metrics per creative and day, share of spend, CTR ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.functions import measures as m
from dayledger.operators.ranks import ranked_values

GROUP = ["campaign_id", "event_date"]
_LARGEST_CTR = 16.0

# The names and the order of the published columns.
FACT_COLUMNS = [
    "creative_daily_id",
    "event_date",
    "campaign_id",
    "adset_id",
    "creative_id",
    "creative_format",
    "placement",
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "video_completion_rate",
    "had_same_drop_duplicate",
    "ctr",
    "cpc",
    "cpa",
    "conversion_rate",
    "spend_share",
    "meets_volume_floor",
    "ctr_percentile_in_campaign_day",
    "is_top_decile_creative",
]


def with_ratios(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The fact without its two group measures: no shuffle.

    Unknown inputs stay unknown, the volume floor included.
    """
    return staged.withColumns(
        {
            "creative_daily_id": m.creative_day_id(),
            "ctr": m.click_through_rate(),
            "cpc": m.cost_per_click(),
            "cpa": m.cost_per_acquisition(),
            "conversion_rate": m.conversion_rate(),
            "meets_volume_floor": _meets_floor(settings),
        }
    )


def creative_daily(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The fact table from staging rows.

    A campaign-day of any size takes the same way and is never gathered in a task. Rows
    with the same CTR share a rank, so a map-side-combined aggregation keeps one row per
    campaign-day and CTR, with its spend; these are ranked in value buckets, and one join
    brings rank and spend of the campaign-day back. The join has one row per key on the
    right, and adaptive execution can split a skewed partition on either side.
    """
    return with_measures(with_ranks(staged, ranks(staged, settings)), settings)


def ranks(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per campaign-day and CTR: rows ranked before it, and what the campaign-day has in all."""
    rows = staged.withColumns({"ctr": m.click_through_rate(), "meets_volume_floor": _meets_floor(settings)})
    values = rows.groupBy(*GROUP, "ctr").agg(
        F.count_if("meets_volume_floor").alias("n"), F.sum(m.money("spend")).alias("spend")
    )
    return ranked_values(values, GROUP, "ctr", _LARGEST_CTR, descending=True, sums=["spend"]).select(
        F.col("campaign_id").alias("r_campaign"),
        F.col("event_date").alias("r_day"),
        F.col("ctr").alias("r_ctr"),
        "ahead",
        "total",
        F.col("spend_in_group").cast("double").alias("group_spend"),
    )


def with_ranks(staged: DataFrame, ranks: DataFrame) -> DataFrame:
    """Staging rows with the ``ranks`` row of each: the columns from which all others follow.

    What is shuffled are these; keys and ratios, wide as they are, come after.
    """
    rows = staged.select(*[name for name in FACT_COLUMNS if name in staged.columns])
    same = F.lit(True)
    keys = {"r_campaign": F.col("campaign_id"), "r_day": F.col("event_date"), "r_ctr": m.click_through_rate()}
    for other, key in keys.items():
        same = same & key.eqNullSafe(F.col(other))
    return rows.join(ranks, same).select(*rows.columns, "ahead", "total", "group_spend")


def with_measures(ranked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Fact rows from those of ``with_ranks``: no shuffle."""
    percent = F.when(F.col("total") > 1, F.col("ahead") / (F.col("total") - 1)).otherwise(0.0)
    rows = with_ratios(ranked, settings).withColumns(
        {
            "spend_share": m.ratio(F.col("spend"), F.col("group_spend")),
            "ctr_percentile_in_campaign_day": F.when(F.col("meets_volume_floor"), percent),
        }
    )
    return _with_flag(rows, settings)


def _meets_floor(settings: Settings) -> Column:
    return F.col("impressions") >= F.lit(settings.impression_floor)


def _with_flag(ranked: DataFrame, settings: Settings) -> DataFrame:
    percentile = F.col("ctr_percentile_in_campaign_day")
    flagged = F.coalesce(percentile <= F.lit(settings.top_share), F.lit(False))
    return ranked.select(*FACT_COLUMNS[:-1], flagged.alias("is_top_decile_creative"))
