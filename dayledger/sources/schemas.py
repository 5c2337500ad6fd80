"""Layouts of delivered files and schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The two accepted headers, compared as ordered lists.
EARLY_LAYOUT = [
    "date", "campaign_id", "adset_id", "creative_id", "creative_format",
    "placement", "impressions", "clicks", "spend", "conversions",
]
LATE_LAYOUT = [
    "date", "campaign_id", "adset_id", "creative_id", "creative_format",
    "placement", "impressions", "clicks", "cost", "conversions",
    "video_completion_rate",
]
LAYOUTS = {"early": EARLY_LAYOUT, "late": LATE_LAYOUT}

ATTRIBUTES = ["campaign_id", "adset_id", "creative_id", "creative_format", "placement"]
METRICS = ["impressions", "clicks", "spend", "conversions"]
STAGING_KEY = ["event_date", "campaign_id", "adset_id", "creative_id"]

DELIVERED = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(name, T.StringType()) for name in ATTRIBUTES]
    + [T.StructField(name, T.DoubleType()) for name in METRICS + ["video_completion_rate"]]
)

RAW = T.StructType(
    DELIVERED.fields
    + [
        T.StructField("_row_in_file", T.LongType()),
        T.StructField("_loaded_at", T.TimestampType()),
        T.StructField("_drop_date", T.DateType()),
        T.StructField("_source_file", T.StringType()),
    ]
)

LOAD_LOG = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        # What later runs need to know about a file without opening it again.
        T.StructField("drop_date", T.DateType()),
        T.StructField("layout", T.StringType()),
        T.StructField("first_event_date", T.DateType()),
        T.StructField("last_event_date", T.DateType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("file_name", T.StringType()),
    ]
)

STAGING = T.StructType(
    [T.StructField(name, T.StringType()) for name in ATTRIBUTES]
    + [
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("conversions", T.LongType()),
        T.StructField("video_completion_rate", T.DoubleType()),
        T.StructField("loaded_from_drop_date", T.DateType()),
        T.StructField("loaded_from_file", T.StringType()),
        T.StructField("had_same_drop_duplicate", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)

TRUTH = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(name, T.StringType()) for name in ATTRIBUTES]
    + [
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("conversions", T.LongType()),
    ]
)

DIMENSION = T.StructType(
    [T.StructField("creative_id", T.StringType())]
    + [
        T.StructField(name, T.StringType())
        for name in ("campaign_id", "adset_id", "creative_format", "placement")
    ]
    + [
        T.StructField("first_seen_date", T.DateType()),
        T.StructField("last_seen_date", T.DateType()),
    ]
)

FACT = T.StructType(
    [T.StructField("creative_daily_id", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in ATTRIBUTES]
    + [
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("conversions", T.LongType()),
        T.StructField("video_completion_rate", T.DoubleType()),
        T.StructField("had_same_drop_duplicate", T.BooleanType()),
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in ("ctr", "cpc", "cpa", "conversion_rate", "spend_share")
    ]
    + [
        T.StructField("meets_volume_floor", T.BooleanType()),
        T.StructField("ctr_percentile_in_campaign_day", T.DoubleType()),
        T.StructField("is_top_decile_creative", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)

DEFECT_LOG = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("drop_date", T.DateType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("adset_id", T.StringType()),
        T.StructField("creative_id", T.StringType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
        T.StructField("defect_type", T.StringType()),
        # The run that found it, or "calendar": days are looked at anew by every run.
        T.StructField("logged_in", T.StringType()),
    ]
)

# What the next run compares new drops with: the newest drop of every key, by event day
# (parts "day-..."), and the files that earlier runs profiled (parts "run-..."). Both sorts
# of rows are in one table so that they are published at once.
LAST_DELIVERED = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(name, T.StringType()) for name in ("campaign_id", "adset_id", "creative_id")]
    + [T.StructField(name, T.DoubleType()) for name in METRICS]
    + [
        T.StructField("_drop_date", T.DateType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("part", T.StringType()),
    ]
)

CHECK_RESULTS = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

CHECK_VIOLATIONS = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("creative_id", T.StringType()),
        T.StructField("record", T.StringType()),
        # When the checks ran; names sort by time.
        T.StructField("run", T.StringType()),
    ]
)
