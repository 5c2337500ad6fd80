"""The published snapshot: one JSON document of freshness, defects and top creatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.operators import defects, freshness
from dayledger.sources.tables import Store

_WITH_NULLS = {"ignoreNullFields": "false"}
_TOP_COLUMNS = [
    "campaign_id",
    "creative_id",
    "creative_format",
    "placement",
    "impressions",
    "clicks",
    "ctr",
]


def snapshot_head(summary: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: the fields of the document other than the top list."""
    # One entry per kind of defect, so a list of fixed length.
    by_kind = counts.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("defect_type", "defects"))))
    )
    return summary.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at"),
        F.col("today").cast("string").alias("today"),
        F.col("latest_available_day").cast("string").alias("latest_available_day"),
        F.col("latest_finalized_day").cast("string").alias("latest_finalized_day"),
        "lookback_days",
        "loaded_files",
        "quarantined_files",
        by_kind.scalar().alias("defect_counts"),
    )


def snapshot_lines(head: DataFrame, top: DataFrame) -> DataFrame:
    """The document as ordered lines ``(value)``: head, one line per top creative, tail.

    A document has to be one text, but its list can be of any length, so the list is
    never gathered: it is sorted across tasks, and the part files, read in the order
    of their names, are the document.
    """
    place = F.struct(
        F.col("campaign_id").isNull().alias("unnamed_last"),
        F.col("campaign_id"),
        F.coalesce(-F.col("ctr"), F.lit(float("inf"))).alias("best_first"),
        F.col("creative_id"),
        F.struct(*_TOP_COLUMNS).alias("row"),
    )
    placed = top.select(place.alias("place"))
    first = placed.agg(F.min("place")).scalar()
    separator = F.when(F.col("place") == first, " ").otherwise(",")
    entry = F.concat(separator, F.to_json("place.row", _WITH_NULLS))
    nowhere = F.lit(None).cast(placed.schema["place"].dataType)

    opening = F.regexp_replace(F.to_json(F.struct(*head.columns), _WITH_NULLS), r"\}$", "")
    head_line = F.concat(opening, F.lit(', "top_decile_by_campaign": ['))
    lines = (
        _line(head, 0, nowhere, head_line)
        .unionByName(_line(placed, 1, F.col("place"), entry))
        .unionByName(_line(head.select(F.lit(0)), 2, nowhere, F.lit("]}")))
    )
    return lines.orderBy("section", "place").select("value")


def write_snapshot(store: Store, settings: Settings = DEFAULTS) -> None:
    """Publish the snapshot of the stored tables as text under ``snapshot``."""
    fact, log = store.fact(), store.load_log()
    # The log knows which drops brought rows; raw itself is not read.
    drops = log.filter("row_count > 0").select(F.col("drop_date").alias("_drop_date"))
    summary = freshness.freshness(drops, fact, log, settings)
    head = snapshot_head(summary, defects.defect_counts(store.defect_log()))
    top = freshness.finalized_top_creatives(fact, drops, settings)
    snapshot_lines(head, top).write.mode("overwrite").text(store.path("snapshot"))


def _line(rows: DataFrame, section: int, place: Column, value: Column) -> DataFrame:
    return rows.select(F.lit(section).alias("section"), place.alias("place"), value.alias("value"))
