"""The lookback window: which event days a run recomputes, and how they replace the old."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings


def lookback_start(target: DataFrame, settings: Settings = DEFAULTS) -> Column:
    """First recomputed event day, inclusive, as a lazy scalar over the target."""
    newest = target.agg(F.max("event_date")).scalar()
    return F.date_sub(newest, settings.lookback_days)


def stored_lookback_start(target: DataFrame, settings: Settings = DEFAULTS) -> date | None:
    """The same day as a literal, so that scans prune partitions; None asks for a full build.

    An empty target gives None: comparing with its null maximum would select nothing,
    on this run and on all that follow.
    """
    newest = target.agg(F.max("event_date")).first()[0]
    return None if newest is None else newest - timedelta(days=settings.lookback_days)


def within_lookback(raw: DataFrame, start: Column | date) -> DataFrame:
    return raw.filter(F.col("date") >= start)


def merged(target: DataFrame, recomputed: DataFrame, start: Column | date) -> DataFrame:
    """Target after a run: days before ``start`` as they were, the rest recomputed.

    Every day from ``start`` on is recomputed whole, so replacing days equals replacing
    keys, without matching keys (and without losing track of null ones). Stored tables
    do the same by overwriting ``event_date`` partitions.
    """
    kept = target.filter((F.col("event_date") < start) | F.col("event_date").isNull())
    return kept.unionByName(recomputed)
