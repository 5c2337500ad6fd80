"""Keeping the stored defect log up to date, reading only drops that are not in it yet.

The log grows by one partition per run. What a run needs to know of earlier drops is the
newest delivery of each key, kept by event day; it reads and replaces the days that new
drops touch. That table, published last, also names the files profiled so far: a run that
dies before leaves a partition in the log that it does not know, and the next run starts
over from all drops.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators import defects
from dayledger.sources.ingest import LOADED
from dayledger.sources.schemas import DEFECT_LOG, LAST_DELIVERED
from dayledger.sources.tables import COMPACT, Store

_RUN, _DAY, _CALENDAR = "run-", "day-", "calendar"


def log_defects(store: Store, full_refresh: bool = False) -> DataFrame:
    """Profile drops that are not in the defect log yet, keep and return the whole log.

    The log equals one made from all drops at once. That needs new drops to come after
    those profiled, by drop date and file name; a run that finds one that does not, or the
    traces of a run that died, profiles all drops again. Layout changes come from the
    headers in the load log, and days without a drop from its drop dates.
    """
    loaded = store.load_log().filter(F.col("status") == LOADED)
    run = f"{_RUN}{uuid.uuid4().hex}"
    anew = full_refresh or not _continues(store, loaded)
    files = loaded if anew else pending(store, loaded)
    files = files.select(F.col("file_name").alias("_source_file"), F.col("drop_date").alias("_drop_date"))
    raw = store.raw() if anew else delivered_in(store, files)

    with store.scratch() as folder:
        spark = store.spark
        summary = defects.key_drops(raw)
        summary.write.options(**COMPACT).parquet(f"{folder}/drops")
        drops = spark.read.schema(summary.schema).parquet(f"{folder}/drops")
        before = None if anew else _before(store, drops)

        found = defects.new_defects(raw, drops, before).withColumn("logged_in", F.lit(run))
        days = defects.calendar_defects(
            loaded.filter("row_count > 0").select(F.col("drop_date").alias("_drop_date")),
            loaded.select("drop_date", "layout"),
        )
        log = found.unionByName(days.withColumn("logged_in", F.lit(_CALENDAR))).select(*DEFECT_LOG.fieldNames())
        newest = defects.last_delivered(drops, before).withColumn("part", _day_part())
        profiled = files.withColumn("part", F.lit(run))
        state = newest.unionByName(profiled, allowMissingColumns=True).select(*LAST_DELIVERED.fieldNames())

        if anew:
            store.replace("defect_log", log, by=["logged_in"])
            store.replace("last_delivered", state, by=["part"])
        else:
            store.replace_partitions("defect_log", log, by=["logged_in"], instead_of=_CALENDAR)
            store.replace_partitions("last_delivered", state, by=["part"])
    return store.defect_log()


def pending(store: Store, loaded: DataFrame) -> DataFrame:
    """Load-log rows of the files that are not profiled yet."""
    return loaded.join(_profiled(store), loaded["file_name"] == F.col("_source_file"), "left_anti")


def delivered_in(store: Store, files: DataFrame) -> DataFrame:
    """Raw rows of some files ``(_source_file, _drop_date)``, read from the oldest drop of these on."""
    oldest = files.agg(F.count_if(F.col("_drop_date").isNull()), F.min("_drop_date")).first()
    raw = store.raw()
    undated = F.col("_drop_date").isNull()
    since = F.lit(False) if oldest[1] is None else F.col("_drop_date") >= F.lit(oldest[1])
    raw = raw.filter(undated | since if oldest[0] else since)
    # A list of file names, one for each file of a run.
    return raw.join(files.select("_source_file"), "_source_file", "left_semi").select(*raw.columns)


def _continues(store: Store, loaded: DataFrame) -> bool:
    """Whether all pending drops come after those profiled, and the log has nothing of a dead run."""
    runs = {part for part in store.parts("last_delivered", "part") if part.startswith(_RUN)}
    if not runs or store.parts("defect_log", "logged_in") - runs - {_CALENDAR}:
        return False
    first = pending(store, loaded).agg(F.min(F.struct("drop_date", "file_name"))).first()[0]
    last = _profiled(store).agg(F.max(F.struct("_drop_date", "_source_file"))).first()[0]
    return first is None or last is None or _place(first) > _place(last)


def _place(drop) -> tuple[date, str]:
    return (drop[0] or date.min, drop[1])


def _profiled(store: Store) -> DataFrame:
    return store.last_delivered().filter(F.col("part").startswith(_RUN)).select("_drop_date", "_source_file")


def _before(store: Store, drops: DataFrame) -> DataFrame:
    """Newest earlier deliveries on the event days of new drops."""
    # Calendar days as literals, so that the scan prunes all other days.
    days = [row[0] for row in drops.select(_day_part()).distinct().collect()]
    return store.last_delivered().filter(F.col("part").isin(days))


def _day_part():
    return F.concat(F.lit(_DAY), F.coalesce(F.col("date").cast("string"), F.lit("none")))
