"""Freshness: what is final, what is provisional, and the published top list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.functions import text
from dayledger.functions.measures import rounded


def today(drops: DataFrame) -> Column:
    """The newest delivery date: the data's own clock, not the wall clock.

    ``drops`` is any table with a ``_drop_date`` per drop that delivered rows: the raw
    table, or what the load log says about it.
    """
    return drops.agg(F.max("_drop_date")).scalar()


def latest_finalized_day(drops: DataFrame, settings: Settings = DEFAULTS) -> Column:
    return F.date_sub(today(drops), settings.lookback_days)


def finalized_top_creatives(
    fact: DataFrame, drops: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Top performers of the latest finalized day, unordered."""
    day = latest_finalized_day(drops, settings)
    return fact.filter((F.col("event_date") == day) & F.col("is_top_decile_creative")).select(
        "campaign_id",
        "creative_id",
        "creative_format",
        "placement",
        "impressions",
        "clicks",
        rounded(F.col("ctr"), 4).alias("ctr"),
    )


def in_report_order(top: DataFrame) -> DataFrame:
    """By campaign, best CTR first; the creative breaks ties."""
    return top.orderBy(
        F.asc_nulls_last("campaign_id"), F.desc_nulls_last("ctr"), F.asc_nulls_last("creative_id")
    )


def display_rows(top: DataFrame) -> DataFrame:
    """The top list as a reader sees it."""
    return top.select(
        "campaign_id",
        "creative_id",
        "creative_format",
        "placement",
        text.thousands_text(F.col("impressions")).alias("impressions"),
        text.thousands_text(F.col("clicks")).alias("clicks"),
        text.percent_text(F.col("ctr")).alias("ctr"),
    )


def freshness(
    drops: DataFrame, fact: DataFrame, files: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row of dates and counts. ``files``: ``(file_name, status)``, one row per file."""
    clock = drops.agg(F.max("_drop_date").alias("today"))
    days = fact.agg(F.max("event_date").alias("latest_available_day"))
    statuses = files.agg(
        F.count_if(F.col("status") == "loaded").alias("loaded_files"),
        F.count_if(F.col("status") == "quarantined").alias("quarantined_files"),
    )
    top = finalized_top_creatives(fact, drops, settings).agg(F.count("*").alias("top_creatives"))
    one_row = clock.select(
        "today",
        days.scalar().alias("latest_available_day"),
        F.date_sub("today", settings.lookback_days).alias("latest_finalized_day"),
        F.lit(settings.lookback_days).alias("lookback_days"),
        statuses.select(F.struct("loaded_files", "quarantined_files")).scalar().alias("files"),
        top.scalar().alias("top_creatives"),
    )
    return one_row.select(
        "today",
        "latest_available_day",
        "latest_finalized_day",
        F.date_diff("today", "latest_finalized_day").alias("lag_days"),
        "lookback_days",
        "files.loaded_files",
        "files.quarantined_files",
        F.when(F.col("files.quarantined_files") > 0, "warn").otherwise("ok").alias("files_status"),
        "top_creatives",
    )


def file_status_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("status").agg(
        F.count("*").alias("files"), F.sum("row_count").alias("rows")
    )
