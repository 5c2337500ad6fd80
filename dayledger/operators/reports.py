"""Aggregate reports on coverage, the volume floor and the flagged share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.operators.checks import lacking
from dayledger.operators.ranks import exact_percentile

_LARGEST_IMPRESSIONS = 1e11


def gap_split(fact: DataFrame, truth: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Truth rows the fact never got, on the outage day and on other days."""
    expected = truth.select(F.col("date").cast("date").alias("event_date"), "creative_id")
    return lacking(expected, fact).groupBy(
        (F.col("event_date") == F.lit(settings.outage_day)).alias("on_outage_day")
    ).agg(F.count("*").alias("lost_rows"))


def floor_calibration(fact: DataFrame) -> DataFrame:
    """One row: tenth percentile of daily impressions, share of creative-days above the floor."""
    share = fact.agg(
        F.count("impressions").alias("creative_days"),
        F.count_if("meets_volume_floor").alias("eligible_days"),
    )
    p10 = exact_percentile(fact, "impressions", 0.1, _LARGEST_IMPRESSIONS)
    return share.select(
        p10.scalar().alias("impressions_p10"),
        "creative_days",
        "eligible_days",
        (F.col("eligible_days") / F.nullif("creative_days", F.lit(0))).alias("eligible_share"),
    )


def flagged_share(fact: DataFrame) -> DataFrame:
    """Share of ranked creatives that are flagged, by size of the campaign-day."""
    groups = (
        fact.filter("meets_volume_floor")
        .groupBy("campaign_id", "event_date")
        .agg(
            F.count("*").alias("group_size"),
            F.count_if("is_top_decile_creative").alias("flagged"),
        )
    )
    sizes = groups.groupBy("group_size").agg(
        F.count("*").alias("campaign_days"), F.sum("flagged").alias("flagged")
    )
    return sizes.withColumn(
        "flagged_share", F.col("flagged") / (F.col("group_size") * F.col("campaign_days"))
    )
