"""Defects that can be seen in the delivered rows themselves.

Every function returns ``(defect_type, event_date, drop_date, campaign_id, adset_id,
creative_id, detail)`` with ``detail`` a map of strings. A detector sees what is
observable, not what upstream intended: a blanked field in the first of two
deliveries also reads as a restatement, and counts need not equal an upstream log.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions.measures import clicks_exceed_impressions
from dayledger.sources.schemas import ATTRIBUTES, METRICS

KEY = ["date", "campaign_id", "adset_id", "creative_id"]

# The eight kinds of defect.
LATE = "late_arrival"
RESTATED = "restatement"
EXACT = "duplicate_exact"
NEAR = "duplicate_near"
MISSING_VALUE = "null_value"
IMPOSSIBLE = "clicks_exceed_impressions"
MISSING_DAY = "missing_day"
DRIFT = "schema_drift"

_DETAIL = "map<string,string>"
_COLUMNS = [
    "defect_type",
    "event_date",
    "drop_date",
    "campaign_id",
    "adset_id",
    "creative_id",
    "detail",
]


def key_drops(raw: DataFrame) -> DataFrame:
    """One row per key and drop: the metrics that survive in it, and which of them vary.

    A hash aggregation over fixed-width buffers; copies of a key inside a drop collapse
    before the shuffle.
    """
    surviving = {name: F.max_by(name, "_row_in_file") for name in METRICS}
    varied = {
        name: (F.min(name) < F.max(name))
        | ((F.count(name) > 0) & (F.count(name) < F.count("*")))
        for name in METRICS
    }
    return raw.groupBy(*KEY, "_drop_date", "_source_file").agg(
        *[value.alias(name) for name, value in surviving.items()],
        *[F.coalesce(v, F.lit(False)).alias(f"{name}_varies") for name, v in varied.items()],
    )


def last_delivered(drops: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The newest drop of every key with its metrics, from ``key_drops`` rows.

    ``before`` is an earlier result, of drops that all come before these.
    """
    columns = [*KEY, *METRICS, "_drop_date", "_source_file"]
    rows = drops.select(*columns)
    if before is not None:
        rows = rows.unionByName(before.select(*columns))
    values = [*METRICS, "_drop_date", "_source_file"]
    # Structs compare field by field, nulls first: the order that drops have.
    newest = F.max_by(F.struct(*values), F.struct("_drop_date", "_source_file"))
    return rows.groupBy(*KEY).agg(newest.alias("newest")).select(*KEY, "newest.*")


def delivery_defects(raw: DataFrame, kinds: Iterable[str] = (LATE, RESTATED, NEAR)) -> DataFrame:
    """Late arrivals, restatements and near duplicates, from one summary per key and drop."""
    return drop_defects(key_drops(raw), kinds=kinds)


def drop_defects(
    drops: DataFrame, before: DataFrame | None = None, kinds: Iterable[str] = (LATE, RESTATED, NEAR)
) -> DataFrame:
    """The same from ``key_drops`` rows; with ``before``, those of later drops only.

    ``before`` holds the ``last_delivered`` rows of all drops that come before these: the
    one row of a key that a new drop is compared with. What is ordered per key is its
    *drops*: bounded by the number of files, however many rows the key has.
    """
    summary = drops.withColumn("logged", F.lit(False))
    if before is not None:
        known = before.select(*KEY, *METRICS, "_drop_date", "_source_file", F.lit(True).alias("logged"))
        summary = summary.unionByName(known, allowMissingColumns=True)
    history = Window.partitionBy(*KEY).orderBy(F.asc_nulls_first("_drop_date"), "_source_file")
    values = F.struct(*METRICS)
    seen = summary.withColumns(
        {"values": values, "earlier": F.lag(F.struct("_drop_date", values.alias("values"))).over(history)}
    )
    had_earlier = F.col("earlier._drop_date").isNotNull()
    found = {
        LATE: F.when(
            ~had_earlier & (F.col("_drop_date") > F.col("date")),
            _found(LATE, {"delayed_by_days": F.date_diff("_drop_date", "date")}),
        ),
        RESTATED: F.when(
            had_earlier & ~_same_values(F.col("earlier.values"), F.col("values")),
            _found(
                RESTATED,
                {
                    "original_drop_date": F.col("earlier._drop_date"),
                    "wrong_values": _json(F.col("earlier.values")),
                    "corrected_values": _json(F.col("values")),
                },
            ),
        ),
        NEAR: F.when(
            F.expr(" or ".join(f"{name}_varies" for name in METRICS)),
            _found(
                NEAR,
                {
                    "jittered_field": F.concat_ws(
                        ",", *[F.when(F.col(f"{name}_varies"), F.lit(name)) for name in METRICS]
                    )
                },
            ),
        ),
    }
    return _exploded(seen.filter("not logged"), [found[kind] for kind in kinds])


def row_defects(
    raw: DataFrame, kinds: Iterable[str] = (MISSING_VALUE, IMPOSSIBLE)
) -> DataFrame:
    """Blank metrics (one record per field) and clicks above impressions: no shuffle."""
    found = {
        MISSING_VALUE: [
            F.when(F.col(name).isNull(), _found(MISSING_VALUE, {"field": F.lit(name)}))
            for name in METRICS
        ],
        IMPOSSIBLE: [
            F.when(
                clicks_exceed_impressions(),
                _found(
                    IMPOSSIBLE,
                    {
                        "impressions": F.col("impressions").cast("bigint"),
                        "clicks": F.col("clicks").cast("bigint"),
                    },
                ),
            )
        ],
    }
    return _exploded(raw, [entry for kind in kinds for entry in found[kind]])


def exact_duplicates(raw: DataFrame) -> DataFrame:
    """Rows delivered more than once, unchanged, in one drop: one record per such row."""
    columns = ["date", *ATTRIBUTES, *METRICS, "video_completion_rate"]
    copies = (
        raw.groupBy(*columns, "_drop_date", "_source_file")
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    return _exploded(copies, [_found(EXACT, {"copies": F.col("copies")})])


def missing_days(raw: DataFrame) -> DataFrame:
    """Days between the first and the last drop on which no drop arrived."""
    delivered = raw.filter("_drop_date is not null").groupBy("_drop_date").agg(
        F.count("*").alias("rows")
    )
    calendar = delivered.agg(F.min("_drop_date").alias("a"), F.max("_drop_date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("_drop_date")
    )
    absent = calendar.join(delivered, "_drop_date", "left_anti")
    return _calendar_defect(absent, MISSING_DAY, {})


def schema_drifts(layouts: DataFrame) -> DataFrame:
    """Drops whose layout differs from the drop before. Input: ``(drop_date, layout)``.

    One row per calendar day of delivery goes through the window, whatever the data size.
    """
    days = (
        layouts.filter("drop_date is not null and layout is not null")
        .groupBy("drop_date")
        .agg(F.max("layout").alias("layout"))
    )
    order = Window.partitionBy(F.lit(0)).orderBy("drop_date")
    changes = days.withColumn("before", F.lag("layout").over(order)).filter("before <> layout")
    return _calendar_defect(
        changes.withColumnRenamed("drop_date", "_drop_date"),
        DRIFT,
        {"from_layout": F.col("before"), "to_layout": F.col("layout")},
    )


def observed_layouts(raw: DataFrame) -> DataFrame:
    """Layout per drop as far as rows show it; null for a drop without video rows.

    Only the late layout carries completion rates, and only for video. For stored
    tables prefer the load log, which has the header of every file.
    """
    carries_rate = F.max(F.col("video_completion_rate").isNotNull())
    has_video = F.max(F.col("creative_format") == "video")
    return raw.groupBy(F.col("_drop_date").alias("drop_date")).agg(
        F.when(carries_rate, "late").when(has_video, "early").alias("layout")
    )


def defect_log(raw: DataFrame, layouts: DataFrame | None = None) -> DataFrame:
    """All defects of all kinds."""
    layouts = observed_layouts(raw) if layouts is None else layouts
    return new_defects(raw, key_drops(raw)).unionByName(calendar_defects(raw, layouts))


def new_defects(raw: DataFrame, drops: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Defects of rows. ``drops`` are the ``key_drops`` of ``raw``; ``before`` as for them."""
    log = drop_defects(drops, before)
    return log.unionByName(row_defects(raw)).unionByName(exact_duplicates(raw))


def calendar_defects(delivered: DataFrame, layouts: DataFrame) -> DataFrame:
    """Defects of days; of ``delivered`` only the drop dates are read."""
    return missing_days(delivered).unionByName(schema_drifts(layouts))


def defect_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("defect_type").agg(F.count("*").alias("defects"))


def _found(kind: str, detail: dict[str, Column]) -> Column:
    pairs = [part for name, value in detail.items() for part in (F.lit(name), value.cast("string"))]
    return F.struct(
        F.lit(kind).alias("defect_type"),
        (F.create_map(*pairs) if pairs else F.create_map()).cast(_DETAIL).alias("detail"),
    )


def _exploded(rows: DataFrame, candidates: list[Column]) -> DataFrame:
    return rows.select(
        F.explode(F.array_compact(F.array(*candidates))).alias("found"),
        F.col("date").alias("event_date"),
        F.col("_drop_date").alias("drop_date"),
        "campaign_id",
        "adset_id",
        "creative_id",
    ).select("found.defect_type", *_COLUMNS[1:-1], "found.detail")


def _calendar_defect(days: DataFrame, kind: str, detail: dict[str, Column]) -> DataFrame:
    nobody = F.lit(None).cast("string")
    return days.select(
        _found(kind, detail).alias("found"), F.col("_drop_date").alias("drop_date")
    ).select(
        "found.defect_type",
        F.col("drop_date").alias("event_date"),
        "drop_date",
        nobody.alias("campaign_id"),
        nobody.alias("adset_id"),
        nobody.alias("creative_id"),
        "found.detail",
    )


def _json(values: Column) -> Column:
    return F.to_json(values, {"ignoreNullFields": "false"})


def _same_values(left: Column, right: Column) -> Column:
    same = F.lit(True)
    for name in METRICS:
        same = same & left[name].eqNullSafe(right[name])
    return same
