"""The creative dimension and its consistency check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ATTRIBUTES = ["campaign_id", "adset_id", "creative_format", "placement"]


def dim_creative(staged: DataFrame) -> DataFrame:
    """One row per creative: its attributes and observed active window.

    Attributes do not vary by contract. Should one vary, the least value is taken:
    a stated choice that a retried task cannot change; ``attribute_conflicts`` lists
    such creatives.
    """
    return (
        _variants(staged)
        .groupBy("creative_id")
        .agg(
            *[F.min(name).alias(name) for name in _ATTRIBUTES],
            F.min("first_seen_date").alias("first_seen_date"),
            F.max("last_seen_date").alias("last_seen_date"),
        )
    )


def attribute_conflicts(staged: DataFrame) -> DataFrame:
    """Creatives of which an attribute varies, and which one does."""
    varies = {name: F.min(name) != F.max(name) for name in _ATTRIBUTES}
    flags = [F.coalesce(v, F.lit(False)).alias(f"{name}_varies") for name, v in varies.items()]
    checked = _variants(staged).groupBy("creative_id").agg(*flags)
    return checked.filter(" or ".join(f"{name}_varies" for name in _ATTRIBUTES))


def entity_counts(dimension: DataFrame) -> DataFrame:
    """Distinct campaigns, ad sets and creatives."""
    return dimension.agg(
        F.count_distinct("campaign_id").alias("campaigns"),
        F.count_distinct("adset_id").alias("adsets"),
        F.count_distinct("creative_id").alias("creatives"),
    )


def _variants(staged: DataFrame) -> DataFrame:
    # With the attributes as grouping keys the buffer holds two dates only: a hash
    # aggregation that shrinks each map task to about one row per creative.
    return staged.groupBy("creative_id", *_ATTRIBUTES).agg(
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
    )
