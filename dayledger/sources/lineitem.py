"""Deliveries and truth derived from the ``lineitem`` table.

Gives the operators realistic input at any size: creative-days with late arrivals,
restatements, duplicates, blanks, impossible values, a lost drop and a layout change,
all from integer arithmetic on the keys. The SQL twin is in ``dayledger.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar of the derived deliveries.
_FIRST_DAY = "date'2026-01-01'"
_DAYS = 95
_LATE_LAYOUT_FROM = 50
_LOST_DROP = 70

_FORMATS = ["video", "still", "slides", "grid"]
_PLACEMENTS = ["main", "top", "side", "partner", "inline"]

# Which defect a creative-day has.
_GROUP = "(pk * 613 + day_index * 389 + q) % 250"


def _quoted(names: list[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)


# A creative and its day, from the keys and sums of its row.
_DESCRIPTION = [
    f"date_add({_FIRST_DAY}, cast(day_index as int)) as event_date",
    "concat('cmp_', pk % 25) as campaign_id",
    "concat('cmp_', pk % 25, '_adset_', pk % 3) as adset_id",
    "concat('cr_', pk) as creative_id",
    f"element_at(array({_quoted(_FORMATS)}), cast(pk % {len(_FORMATS)} as int) + 1) as creative_format",
    f"element_at(array({_quoted(_PLACEMENTS)}), cast(pk % {len(_PLACEMENTS)} as int) + 1) as placement",
    "if(h % 33 = 0, 0, q * 100) as impressions",
    "if(h % 33 = 0, 0, q * (1 + h % 7)) as clicks",
    "cast(price as double) as spend",
    "if(h % 33 = 0, 0, h % 4) as conversions",
]


def truth(spark: SparkSession, folder: str) -> DataFrame:
    """The correct numbers, one row per creative and day."""
    return _creative_days(spark, folder).select(
        F.col("event_date").alias("date"),
        "campaign_id",
        "adset_id",
        "creative_id",
        "creative_format",
        "placement",
        "impressions",
        "clicks",
        "spend",
        "conversions",
    )


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Delivered rows in the raw layout (without load time): every copy, nothing merged."""
    return described(copies(spark, folder))


def copies(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries as the few values that ``described`` makes their rows from, to be moved or kept instead of these."""
    planned = _sums(spark, folder).selectExpr(
        "*",
        "case when h % 100 < 90 then 0 when h % 100 < 96 then 1 when h % 100 < 99 then 2 else 3 end as delay",
        "case when g between 20 and 32 then cast(1 + g % 2 as int) else 0 end as correction",
    )
    # One row in, all its deliveries out: a single pass instead of a union of passes.
    return planned.selectExpr(
        "*",
        """explode(array_compact(array(
            'first',
            case when correction > 0 then 'corrected' end,
            case when g = 0 then 'repeated' end,
            case when g = 1 then 'altered' end))) as copy""",
    ).selectExpr(
        "*", "day_index + delay + if(copy = 'corrected', correction, 0) as drop_index"
    ).filter(f"drop_index <> {_LOST_DROP}").selectExpr(
        "pk",
        "cast(day_index as int) as day_index",
        "q",
        "cast(price as double) as price",
        "cast(h as int) as h",
        "correction > 0 as is_wrong_first",
        "copy",
        f"date_add({_FIRST_DAY}, cast(drop_index as int)) as _drop_date",
    )


def place_in_drop() -> Column:
    """Position of a row of ``copies`` in its drop.

    Distinct within a drop and increasing over the copies of a row, which is all that a
    position is used for; numbering the rows would need a sort per drop.
    """
    return F.expr(
        f"""(pk * {_DAYS} + day_index) * 4 + case copy when 'first' then 0 when 'corrected' then 1
              when 'repeated' then 2 else 3 end"""
    )


def described(copies: DataFrame) -> DataFrame:
    """The delivered rows of ``copies``, in their order."""
    return copies.selectExpr(
        "*",
        f"{_GROUP} as g",
        f"date_diff(_drop_date, {_FIRST_DAY}) as drop_index",
        "copy = 'first' as is_first",
        "if(copy = 'first' and is_wrong_first, 2, 1) as factor",
        *_DESCRIPTION,
    ).withColumn("_row_in_file", place_in_drop()).selectExpr(
        "event_date as date",
        "campaign_id",
        "adset_id",
        "creative_id",
        "creative_format",
        "placement",
        """cast(case when copy = 'altered' then impressions + 37
                     when is_first and g = 2 then null
                     else impressions * factor end as double) as impressions""",
        """cast(case when is_first and g = 3 then null
                     when is_first and g = 5 and impressions > 0 then impressions + 1
                     else clicks * factor end as double) as clicks""",
        "case when is_first and g = 4 then null else spend * factor end as spend",
        "cast(case when is_first and g = 6 then null else conversions * factor end as double) as conversions",
        f"""case when drop_index >= {_LATE_LAYOUT_FROM} and creative_format = 'video'
                 then 0.5d end as video_completion_rate""",
        "concat('drop_', _drop_date, '.csv') as _source_file",
        "_drop_date",
        "_row_in_file",
    )


def _creative_days(spark: SparkSession, folder: str) -> DataFrame:
    return _sums(spark, folder).selectExpr("*", *_DESCRIPTION)


def _sums(spark: SparkSession, folder: str) -> DataFrame:
    sums = (
        spark.read.parquet(f"{folder}/lineitem.parquet")
        .groupBy(F.expr("l_partkey as pk"), F.expr(f"dayofyear(l_shipdate) % {_DAYS} as day_index"))
        .agg(
            F.expr("sum(cast(l_quantity as bigint)) as q"),
            F.expr("sum(cast(l_linenumber as bigint)) as ln"),
            F.expr("sum(cast(l_extendedprice as decimal(18,2))) as price"),
        )
    )
    return sums.selectExpr(
        "*",
        "(pk * 7919 + day_index * 104729 + ln * 31) % 10000 as h",
        f"{_GROUP} as g",
    )
