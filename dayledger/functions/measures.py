"""Column expressions for metrics: each ratio and rounding rule is written once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as a decimal: the result does not depend on the order in which
# tasks finish, so a retried task cannot change the last bits of a share.
MONEY = "decimal(28,6)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, null ("unknown") where the denominator is zero or null."""
    return numerator / F.nullif(denominator, F.lit(0))


def click_through_rate() -> Column:
    return ratio(F.col("clicks"), F.col("impressions"))


def cost_per_click() -> Column:
    return ratio(F.col("spend"), F.col("clicks"))


def cost_per_acquisition() -> Column:
    return ratio(F.col("spend"), F.col("conversions"))


def conversion_rate() -> Column:
    return ratio(F.col("conversions"), F.col("clicks"))


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def rounded(column: Column, digits: int) -> Column:
    """Round half up on the decimal text of a double, so near-ties have one answer."""
    return F.round(column.cast("decimal(38,10)"), digits).cast("double")


def whole(column: Column) -> Column:
    """Double to bigint, halves to even; a plain cast would truncate."""
    return F.rint(column).cast("bigint")


def creative_day_id() -> Column:
    """Surrogate key of a fact row; null if either part is null."""
    return F.md5(F.concat(F.col("event_date").cast("string"), F.lit("-"), F.col("creative_id")))


def clicks_exceed_impressions() -> Column:
    return F.col("clicks") > F.col("impressions")


def any_metric_missing() -> Column:
    return (
        F.col("impressions").isNull()
        | F.col("clicks").isNull()
        | F.col("spend").isNull()
        | F.col("conversions").isNull()
    )
