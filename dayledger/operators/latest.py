"""Staging: typing and deduplication, latest delivery wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.measures import whole
from dayledger.functions.text import reversed_order
from dayledger.sources.schemas import STAGING_KEY


def typed(raw: DataFrame) -> DataFrame:
    """Raw rows with staging types, nothing dropped."""
    return raw.select(
        F.col("date").cast("date").alias("event_date"),
        "campaign_id",
        "adset_id",
        "creative_id",
        "creative_format",
        "placement",
        whole(F.col("impressions")).alias("impressions"),
        whole(F.col("clicks")).alias("clicks"),
        F.col("spend").cast("double").alias("spend"),
        whole(F.col("conversions")).alias("conversions"),
        "video_completion_rate",
        "_drop_date",
        "_source_file",
        "_row_in_file",
    )


def latest_deliveries(raw: DataFrame) -> DataFrame:
    """One row per key: the last row of the last drop that carried it.

    A single aggregation, not ``row_number``: the greatest
    (drop, position, file, ...) tuple of a key is found on the map side first, so
    a key that holds a third of all rows costs each map task one row to shuffle
    and never gathers in one task. Null drop dates sort lowest and so lose.

    Whether the winning drop repeated the key is read off the same pass: the
    second tuple mirrors position and file, so within the winning drop it finds
    the *first* row. Two different rows mean a repeat. A dated drop is one file;
    only undated rows can tie on position across files.
    """
    last = F.struct(
        "_drop_date",
        "_row_in_file",
        "_source_file",
        "creative_format",
        "placement",
        "impressions",
        "clicks",
        "spend",
        "conversions",
        "video_completion_rate",
    )
    first = F.struct(
        F.col("_drop_date"),
        _mirror(F.col("_row_in_file")).alias("position"),
        _tied_file(F.col("_drop_date"), F.col("_source_file")).alias("file"),
    )
    winners = typed(raw).groupBy(*STAGING_KEY).agg(
        F.max(last).alias("last"), F.max(first).alias("first")
    )
    single = _mirror(F.col("first.position")).eqNullSafe(F.col("last._row_in_file")) & F.col(
        "first.file"
    ).eqNullSafe(_tied_file(F.col("last._drop_date"), F.col("last._source_file")))
    return winners.select(
        *STAGING_KEY,
        "last.creative_format",
        "last.placement",
        "last.impressions",
        "last.clicks",
        "last.spend",
        "last.conversions",
        "last.video_completion_rate",
        F.col("last._drop_date").alias("loaded_from_drop_date"),
        F.col("last._source_file").alias("loaded_from_file"),
        (~single).alias("had_same_drop_duplicate"),
    )


def same_drop_repeats(raw: DataFrame) -> DataFrame:
    """Keys delivered more than once inside one drop, with their multiplicity."""
    return (
        typed(raw)
        .groupBy(*STAGING_KEY, "_drop_date")
        .agg(F.count("*").alias("same_drop_key_count"))
        .filter("same_drop_key_count > 1")
    )


def _tied_file(drop_date: Column, source_file: Column) -> Column:
    # Needed, and paid for, only where one "drop" can be several files.
    return F.when(drop_date.isNull(), reversed_order(source_file))


def _mirror(position: Column) -> Column:
    # ~x is -x - 1: the order of integers reversed, with no overflow.
    return F.bitwise_not(position)
