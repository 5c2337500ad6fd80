"""Landing drop files in the raw table: once each, verbatim, unknown layouts set aside."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.config import DEFAULTS, Settings
from dayledger.functions import text
from dayledger.sources import files
from dayledger.sources.files import DropFile, Header, NewFile
from dayledger.sources.schemas import ATTRIBUTES, DELIVERED, LAYOUTS, LOAD_LOG, METRICS, RAW
from dayledger.sources.tables import COMPACT, Store

LOADED = "loaded"
QUARANTINED = "quarantined"

_EXTRA_FIELD = "_extra_field"
# Where the CSV reader keeps the line of a row with more or fewer fields.
_LINE = "_line"
# Prefix of parsed values beside their texts.
_PARSED = "_parsed_"


@dataclass(frozen=True)
class Outcome:
    file_name: str
    status: str
    row_count: int = 0
    reason: str = ""
    drop_date: date | None = None
    layout: str | None = None
    first_event_date: date | None = None
    last_event_date: date | None = None


@dataclass
class RunSummary:
    skipped: int
    outcomes: list[Outcome] = field(default_factory=list)

    @property
    def loaded(self) -> int:
        return sum(o.status == LOADED for o in self.outcomes)

    @property
    def quarantined(self) -> int:
        return sum(o.status == QUARANTINED for o in self.outcomes)

    @property
    def rows_loaded(self) -> int:
        return sum(o.row_count for o in self.outcomes)


def ingest(store: Store, folder: str, settings: Settings = DEFAULTS) -> RunSummary:
    """Load the files of ``folder`` that the load log does not know yet."""
    present = files.list_drops(store.spark, folder)
    new = files.unseen(store.spark, present, store.load_log())
    return ingest_files(store, new, skipped=len(present) - len(new), settings=settings)


def ingest_files(
    store: Store, new: list[NewFile], skipped: int = 0, settings: Settings = DEFAULTS
) -> RunSummary:
    """Load these files.

    Order of writes: raw partitions (one per file, so a repeated attempt overwrites),
    quarantine, load log last. A run that dies in between leaves files unlogged; the
    next run handles them again from the start.
    """
    if not new:
        return RunSummary(skipped)
    spark = store.spark
    headers = files.read_headers(spark, new)
    rejected = {f.name: reason for f in new if (reason := _refusal(f, headers[f.name]))}
    readable = [f for f in new if f.name not in rejected]

    with store.scratch() as scratch:
        outcomes = {name: Outcome(name, QUARANTINED, reason=why) for name, why in rejected.items()}
        if readable:
            # The CSV is parsed once. What follows reads the landed copy, in which row
            # positions are data and no longer depend on how a task was run.
            landed_path, blocks_path = f"{scratch}/landed", f"{scratch}/blocks"
            read_rows(spark, readable, headers).write.options(**COMPACT).parquet(landed_path)
            landed = spark.read.parquet(landed_path)
            _blocks(landed).write.parquet(blocks_path)
            blocks = spark.read.parquet(blocks_path)
            for outcome in _outcomes(blocks, readable, headers):
                outcomes[outcome.file_name] = outcome
            store.replace_partitions(
                "raw",
                numbered(landed, blocks, datetime.now(timezone.utc)),
                by=["_drop_date", "_source_file"],
                # Already about one file per input block; no shuffle needed.
                balance=False,
            )
        _quarantine(store, [f for f in new if outcomes[f.name].status == QUARANTINED])
    summary = RunSummary(skipped, [outcomes[f.name] for f in new])
    store.append("load_log", _log_rows(spark, summary.outcomes).coalesce(1))
    return summary


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Totals over load-log rows."""
    return outcomes.agg(
        F.count_if(F.col("status") == LOADED).alias("loaded"),
        F.count_if(F.col("status") == QUARANTINED).alias("quarantined"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_loaded"),
    )


def read_rows(
    spark: SparkSession, drops: list[DropFile], headers: dict[str, Header]
) -> DataFrame:
    """Rows of all layouts in the canonical columns, with file, block and unreadability.

    Every field is read as text and parsed here, so "NA" and its kin are blanks while
    any other text in a number or date marks the row unreadable. Short rows are filled
    with blanks; a field beyond the last column makes a row unreadable.
    """
    parts = []
    for layout, columns in LAYOUTS.items():
        paths = [f.path for f in drops if headers[f.name].layout == layout]
        if paths:
            parts.append(_read_layout(spark, paths, columns))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def numbered(landed: DataFrame, blocks: DataFrame, loaded_at: datetime) -> DataFrame:
    """Raw rows of the files that are readable throughout, numbered from zero in file order.

    Position = rows in earlier blocks of the file + position in the block. Only block
    counts are ordered per file, one per input split; rows are never sorted or gathered.
    """
    file = Window.partitionBy("_source_file")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumns(
            {
                "rows_before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
                "unreadable_in_file": F.sum("unreadable_rows").over(file),
            }
        )
        .filter("unreadable_in_file = 0")
        .select(
            "_source_file",
            "block",
            "rows_before",
            "first_position",
            text.drop_date(F.col("_source_file")).alias("_drop_date"),
        )
    )
    position = F.col("rows_before") + F.col("position") - F.col("first_position")
    return landed.join(starts, ["_source_file", "block"]).select(
        *[name for name in DELIVERED.fieldNames()],
        position.alias("_row_in_file"),
        F.lit(loaded_at).alias("_loaded_at"),
        "_drop_date",
        "_source_file",
    ).select(*RAW.fieldNames())


def _read_layout(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{name}` string" for name in [*columns, _EXTRA_FIELD, _LINE])
    # The header has been checked name by name, so reading by position is safe. Blocks
    # are lines: a quoted line break ends a row early. Its halves have too few fields, so
    # the reader keeps their lines, and the quotes in these do not pair.
    delivered = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        .option("escape", '"')
        .csv(paths)
        .withColumns(
            {
                "_source_file": files.file_name(),
                "block": F.col("_metadata.file_block_start"),
                "position": F.monotonically_increasing_id(),
            }
        )
    )
    if "cost" in columns:
        delivered = delivered.withColumnRenamed("cost", "spend")
    if "video_completion_rate" not in columns:
        delivered = delivered.withColumn("video_completion_rate", F.lit(None).cast("string"))

    numbers = [*METRICS, "video_completion_rate"]
    parsed = {"date": text.day(F.col("date")), **{n: text.number(F.col(n)) for n in numbers}}
    # Each field is parsed once; whether it could be read is told from its value.
    values = delivered.withColumns({f"{_PARSED}{name}": value for name, value in parsed.items()})
    unreadable = F.col(_EXTRA_FIELD).isNotNull() | text.has_open_quote(F.col(_LINE))
    for name in parsed:
        missing = F.col(f"{_PARSED}{name}").isNull()
        unreadable = unreadable | (missing & text.field(F.col(name)).isNotNull())
    return values.select(
        F.col(f"{_PARSED}date").alias("date"),
        *ATTRIBUTES,
        *[F.col(f"{_PARSED}{n}").alias(n) for n in numbers],
        "_source_file",
        "block",
        "position",
        unreadable.alias("unreadable"),
    )


def _blocks(landed: DataFrame) -> DataFrame:
    return landed.groupBy("_source_file", "block").agg(
        F.count("*").alias("rows"),
        F.min("position").alias("first_position"),
        F.count_if("unreadable").alias("unreadable_rows"),
        F.min("date").alias("first_event_date"),
        F.max("date").alias("last_event_date"),
    )


def _refusal(drop: NewFile, header: Header) -> str | None:
    """Why a file cannot be loaded, as far as its name and header tell."""
    if header.layout is None:
        return f"unrecognized columns: {header.columns}"
    if drop.dated and drop.drop_date is None:
        return "no such drop date"
    return None


def _outcomes(
    blocks: DataFrame, readable: list[NewFile], headers: dict[str, Header]
) -> list[Outcome]:
    # One row per file reaches the driver.
    totals = {
        row["_source_file"]: row
        for row in blocks.groupBy("_source_file")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("unreadable_rows").alias("unreadable_rows"),
            F.min("first_event_date").alias("first_event_date"),
            F.max("last_event_date").alias("last_event_date"),
        )
        .collect()
    }
    outcomes = []
    for drop in readable:
        total = totals.get(drop.name)
        known = {"drop_date": drop.drop_date, "layout": headers[drop.name].layout}
        if total is None:
            outcomes.append(Outcome(drop.name, LOADED, **known))
        elif total.unreadable_rows:
            reason = f"unreadable values in {total.unreadable_rows} row(s)"
            outcomes.append(Outcome(drop.name, QUARANTINED, reason=reason, **known))
        else:
            days = {k: total[k] for k in ("first_event_date", "last_event_date")}
            outcomes.append(Outcome(drop.name, LOADED, total.rows, **known, **days))
    return outcomes


def _quarantine(store: Store, rejected: list[DropFile]) -> None:
    """Keep every line of the rejected files; the files themselves stay where they are."""
    if not rejected:
        return
    lines = store.spark.read.text([f.path for f in rejected]).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        files.file_name().alias("file_name"),
    )
    store.replace_partitions("quarantine", lines, by=["file_name"], balance=False)


def _log_rows(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    now = datetime.now(timezone.utc)
    return spark.createDataFrame(
        [
            (
                o.file_name,
                o.status,
                o.row_count,
                now,
                o.reason,
                o.drop_date,
                o.layout,
                o.first_event_date,
                o.last_event_date,
            )
            for o in outcomes
        ],
        LOAD_LOG,
    )
