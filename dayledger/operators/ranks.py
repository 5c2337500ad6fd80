"""Exact ranks inside groups of any size, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Value buckets per group; the running total over them is the only ordered pass
# that sees a whole group, so this is also its row bound.
_BUCKETS = 262_144


def ranked_values(
    values: DataFrame,
    groups: list[str],
    value: str,
    largest: float,
    descending: bool = False,
    sums: Sequence[str] = (),
) -> DataFrame:
    """Add ``ahead`` (rows sorting before this value) and ``total`` (rows in the group).

    Each column of ``sums`` is added up over the group, as ``<name>_in_group``.

    ``values`` holds one row per distinct value of a group with its row count ``n``,
    so ties are already collapsed. Values are cut into ordered buckets; rows ahead =
    rows in earlier buckets + rows with an earlier value in the same bucket. The
    bucket is a fixed, monotone function of the value (a fourth root, so small
    ratios spread as well as large ones): every task and every retry cuts alike.
    Values above ``largest`` share the last bucket, which affects balance only.
    Nulls sort last in either direction.
    """
    bucketed = values.withColumn("bucket", _bucket(F.col(value), largest, descending))
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    inside = Window.partitionBy(*groups, "bucket").orderBy(order)
    detailed = bucketed.withColumn("ahead_in_bucket", _before(inside))

    group = Window.partitionBy(*(groups or [F.lit(0)]))
    starts = (
        bucketed.groupBy(*groups, "bucket")
        .agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in sums])
        .select(
            *[F.col(name).alias(f"_{name}") for name in groups],
            F.col("bucket").alias("_bucket"),
            _before(group.orderBy("bucket")).alias("ahead_of_bucket"),
            F.sum("n").over(group).alias("total"),
            *[F.sum(name).over(group).alias(f"{name}_in_group") for name in sums],
        )
    )
    same = F.col("bucket") == F.col("_bucket")
    for name in groups:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return detailed.join(starts, same).select(
        *values.columns,
        (F.col("ahead_of_bucket") + F.col("ahead_in_bucket")).alias("ahead"),
        "total",
        *[f"{name}_in_group" for name in sums],
    )


def exact_percentile(rows: DataFrame, value: str, share: float, largest: float) -> DataFrame:
    """One row ``(percentile)``: linear interpolation between the two nearest rows."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranked = ranked_values(counts, [], value, largest)
    position = (F.col("total") - 1) * F.lit(float(share))

    def at(rank: Column) -> Column:
        covers = (F.col("ahead") <= rank) & (rank < F.col("ahead") + F.col("n"))
        return F.max(F.when(covers, F.col(value).cast("double")))

    return ranked.agg(
        at(F.floor(position)).alias("low"),
        at(F.ceil(position)).alias("high"),
        F.max(position - F.floor(position)).alias("part"),
    ).select((F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("percentile"))


def _before(ordered: Window) -> Column:
    rows = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(rows), F.lit(0))


def _bucket(value: Column, largest: float, descending: bool) -> Column:
    top = largest**0.25
    root = F.sqrt(F.sqrt(F.greatest(value.cast("double"), F.lit(0.0))))
    step = F.floor(F.least(root, F.lit(top)) * F.lit(_BUCKETS / top))
    ordered = -step if descending else step
    return F.when(value.isNull(), F.lit(_BUCKETS + 1)).otherwise(ordered)
