"""Data checks. A check is an entry of a registry: a name, a severity, and its violating rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.functions import measures as m
from dayledger.sources.schemas import METRICS

ERROR = "error"
WARN = "warn"

CREATIVE_DAY = ["event_date", "creative_id"]
REQUIRED_IN_FACT = ["creative_daily_id", "event_date", "campaign_id", "creative_id"]


class ChecksFailed(Exception):
    """At least one check of severity "error" found rows."""


def repeated_values(table: DataFrame, column: str) -> DataFrame:
    """Values that should be unique and are not. Nulls are another check's business."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("rows"))
        .filter("rows > 1")
    )


def missing_values(table: DataFrame, column: str) -> DataFrame:
    return table.filter(F.col(column).isNull())


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their row count.

    Children are counted per key before the join, so a frequent key is one row in it.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(column), column, "left_anti")


def impossible_clicks(fact: DataFrame) -> DataFrame:
    return fact.filter(m.clicks_exceed_impressions())


def reconciliation(
    fact: DataFrame, truth: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Truth rows of the lookback window that the fact lacks or contradicts.

    A truth row without a fact row of its creative-day is one issue, and so is every pair
    of a truth row and a fact row that differ. Rows with a defect that upstream never
    corrects are not compared. Rows that only the fact has are not reported here; see
    ``unexpected_in_fact``.

    Nothing is joined: both tables are counted by creative-day and values, then by
    creative-day. Of all pairs of a creative-day, those with equal values agree and the
    others differ. Each table is read once, and a creative-day of any number of rows is
    combined before the shuffle.
    """
    newest = fact.agg(F.max("event_date")).scalar()
    start = F.date_sub(newest, settings.lookback_days)
    expected = _in_cents(_dated(truth).filter(F.col("event_date") >= start))
    # Without a creative a fact row answers for no truth row.
    actual = _in_cents(fact.filter((F.col("event_date") >= start) & F.col("creative_id").isNotNull()))
    values = (
        _counted(expected, expected=F.lit(1), delivered=F.lit(0), compared=F.lit(0))
        .unionByName(
            _counted(
                actual, expected=F.lit(0), delivered=F.lit(1),
                compared=F.when(_uncorrected_defect(), 0).otherwise(1),
            )
        )
        .groupBy(*CREATIVE_DAY, *METRICS)
        .agg(*[F.sum(name).alias(name) for name in _COUNTS])
    )
    days = values.groupBy(*CREATIVE_DAY).agg(
        *[F.sum(name).alias(name) for name in _COUNTS],
        F.sum(F.col("expected") * F.col("compared")).alias("agreeing"),
    )
    absent = F.col("delivered") == 0
    differing = F.col("expected") * F.col("compared") - F.col("agreeing")
    found = days.select(
        *CREATIVE_DAY,
        F.when(absent, "missing_from_fct").otherwise("value_mismatch").alias("issue"),
        F.when(absent, F.col("expected")).otherwise(differing).alias("times"),
    )
    return _repeated(found.filter("times > 0"), "times")


def lacking(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows whose creative-day ``fact`` does not have.

    The fact is reduced to distinct creative-days first, on the map side too: an
    identifier shared by very many fact rows is one row in the join.
    """
    known = fact.select(*CREATIVE_DAY).distinct()
    return rows.join(known, CREATIVE_DAY, "left_anti")


def unexpected_in_fact(fact: DataFrame, truth: DataFrame) -> DataFrame:
    """Creative-days of fact rows that the truth does not know."""
    return lacking(fact.select(*CREATIVE_DAY), _dated(truth))


Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """Rows of a table that meet a condition. All such checks of a table share one scan."""

    name: str
    table: str
    violated: Callable[[], Column]
    severity: str = ERROR

    @property
    def reads(self) -> tuple[str, ...]:
        return (self.table,)


@dataclass(frozen=True)
class TableCheck:
    """Violating rows as a query of their own over the tables it reads."""

    name: str
    reads: tuple[str, ...]
    violations: Callable[[Tables, Settings], DataFrame]
    severity: str = ERROR
    # Column that says how many failures a violating row stands for; without it, one.
    weight: str | None = None


def _is_null(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNull()


REGISTRY: tuple[RowCheck | TableCheck, ...] = (
    *(RowCheck(f"not_null_fct_{name}", "fact", _is_null(name)) for name in REQUIRED_IN_FACT),
    RowCheck("clicks_lte_impressions", "fact", m.clicks_exceed_impressions, WARN),
    RowCheck("not_null_dim_creative_id", "dimension", _is_null("creative_id")),
    TableCheck(
        "unique_fct_creative_daily_id", ("fact",), lambda t, _: repeated_values(t["fact"], "creative_daily_id")
    ),
    TableCheck("unique_dim_creative_id", ("dimension",), lambda t, _: repeated_values(t["dimension"], "creative_id")),
    TableCheck(
        "relationships_fct_creative_id",
        ("fact", "dimension"),
        lambda t, _: orphans(t["fact"], t["dimension"], "creative_id"),
        weight="rows",
    ),
    TableCheck(
        "reconciliation_within_lookback",
        ("fact", "truth"),
        lambda t, settings: reconciliation(t["fact"], t["truth"], settings),
    ),
)


def applicable(tables: Tables, registry: Iterable[RowCheck | TableCheck] = REGISTRY) -> list[RowCheck | TableCheck]:
    """Checks whose tables are all there, in the registry's order; names have to be distinct."""
    entries = [check for check in registry if set(check.reads) <= set(tables)]
    names = [check.name for check in entries]
    if len(set(names)) < len(names):
        raise ValueError(f"checks of one name: {sorted({n for n in names if names.count(n) > 1})}")
    return entries


def violations(
    tables: Tables, registry: Iterable[RowCheck | TableCheck] = REGISTRY, settings: Settings = DEFAULTS
) -> DataFrame:
    """``(check_name, severity, failures, event_date, creative_id, record)``: violating rows of all checks.

    ``record`` is the row as JSON, ``failures`` what it counts for. Day and creative are
    null where a check's rows have none. Checks whose tables are not given do not run.
    """
    entries = applicable(tables, registry)
    by_table: dict[str, list[RowCheck]] = {}
    for check in entries:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
    parts = [_row_violations(tables[name], checks) for name, checks in by_table.items()]
    for check in entries:
        if isinstance(check, TableCheck):
            rows = check.violations(tables, settings)
            failures = F.lit(1) if check.weight is None else F.col(check.weight)
            parts.append(_kept(rows, F.lit(check.name), F.lit(check.severity), failures))
    if not parts:
        raise ValueError("no check can run on these tables")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def results_of(found: DataFrame, entries: Iterable[RowCheck | TableCheck]) -> DataFrame:
    """``(check_name, severity, failures, status)``, one row per check, from ``violations`` rows."""
    ran = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity")) for c in entries]
    checks = found.sparkSession.range(1).select(F.inline(F.array(*ran)))
    counted = found.groupBy("check_name").agg(F.sum("failures").alias("counted"))
    results = checks.join(counted, "check_name", "left").select(
        "check_name", "severity", F.coalesce("counted", F.lit(0).cast("bigint")).alias("failures")
    )
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn")
    return results.withColumn("status", status.otherwise("fail"))


def check_results(
    fact: DataFrame, dimension: DataFrame, truth: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Results of the registered checks; without ``truth``, of those that do not need it."""
    tables = {"fact": fact, "dimension": dimension} | ({} if truth is None else {"truth": truth})
    return results_of(violations(tables, settings=settings), applicable(tables))


def raise_on_errors(results: DataFrame) -> None:
    """Stop the run if a check of severity "error" failed; warnings only report."""
    failed = results.filter("status = 'fail'").orderBy("check_name").collect()
    if failed:
        raise ChecksFailed(", ".join(f"{row.check_name}: {row.failures}" for row in failed))


def _dated(truth: DataFrame) -> DataFrame:
    return truth.withColumn("event_date", F.col("date").cast("date"))


def _in_cents(table: DataFrame) -> DataFrame:
    return table.withColumn("spend", m.rounded(F.col("spend"), 2))


_COUNTS = ["expected", "delivered", "compared"]

# Longest array that a row is repeated by; rows that are repeated oftener take several.
_REPEATS = 10_000


def _counted(table: DataFrame, **counts: Column) -> DataFrame:
    return table.select(
        *CREATIVE_DAY, *METRICS, *[count.cast("bigint").alias(name) for name, count in counts.items()]
    )


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as many times as its column ``times`` says, without that column."""
    kept = [F.col(name) for name in rows.columns if name != times]
    last = F.floor((F.col(times) - 1) / _REPEATS)
    stretches = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_stretch"))
    left = F.least(F.lit(_REPEATS), F.col(times) - F.col("_stretch") * _REPEATS).cast("int")
    return stretches.select(*kept, F.explode(F.array_repeat(F.lit(0), left)).alias("_copy")).drop("_copy")


def _uncorrected_defect() -> Column:
    # Never unknown: with no metric missing the comparison has a definite answer.
    impossible = F.coalesce(m.clicks_exceed_impressions(), F.lit(False))
    return m.any_metric_missing() | impossible | F.col("had_same_drop_duplicate")


def _row_violations(table: DataFrame, checks: list[RowCheck]) -> DataFrame:
    violated = F.lit(False)
    for check in checks:
        violated = violated | check.violated()
    # A row that violates nothing, nearly all of them, ends at the filter.
    entries = [
        F.when(
            check.violated(),
            F.struct(F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity")),
        )
        for check in checks
    ]
    broken = table.filter(violated).select(
        F.explode(F.array_compact(F.array(*entries))).alias("_broken"), F.struct("*").alias("_row")
    )
    row = broken.select("_broken", "_row.*")
    return _kept(row, F.col("_broken.check_name"), F.col("_broken.severity"), F.lit(1))


def _kept(rows: DataFrame, name: Column, severity: Column, failures: Column) -> DataFrame:
    columns = [c for c in rows.columns if c != "_broken"]
    known = lambda column, kind: F.col(column) if column in columns else F.lit(None).cast(kind)
    return rows.select(
        name.alias("check_name"),
        severity.alias("severity"),
        failures.cast("bigint").alias("failures"),
        known("event_date", "date").alias("event_date"),
        known("creative_id", "string").alias("creative_id"),
        F.to_json(F.struct(*columns)).alias("record"),
    )
