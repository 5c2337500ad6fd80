"""The daily refresh driven by file arrival, with Structured Streaming.

The file source finds new drops and its checkpoint remembers them; each batch takes a
bounded number of files through the same ingestion and refresh as the batch plan.
Latest-wins needs ranks over late rows of a stored window, which a streaming aggregate
cannot overwrite, hence ``foreachBatch``. Batches may be repeated after a failure: the
load log skips files already in, and the refresh replaces whole days.

Files that arrived together have one lookback window, however many batches they take. It
is pinned in the store before the first batch and released after the last one, so that a
run that takes over from one that died keeps to it.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dayledger.config import DEFAULTS, Settings
from dayledger.plans.incremental import stored_lookback_start
from dayledger.plans.refresh import rebuild_staging, refresh_marts
from dayledger.sources import files
from dayledger.sources.ingest import LOADED, ingest_files
from dayledger.sources.tables import Store

# Schema of Spark's "binaryFile" source.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def follow_drops(
    store: Store, folder: str, checkpoint: str, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Handle all drops present and not yet seen, then return the query, which has ended.

    ``checkpoint`` has to lie on shared storage. Files are announced by path only;
    their content is not read by the stream itself. A batch has ``files_per_batch`` of
    them at most. The result is that of one batch run over all these files: days before
    the pinned window stay as they were, and the others are brought up to date. The
    first batch recomputes the window, the others the days of it that their files touch.
    Empty files are not announced; the batch plan's listing finds and quarantines them.
    """
    run = _Run(store, folder, settings)
    query = (
        store.spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", settings.files_per_batch)
        .load(folder)
        .select("path")
        .writeStream.foreachBatch(run.handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    # Raises if a batch failed; the window then stays pinned for the run that goes on.
    query.awaitTermination()
    files.remove(store.spark, _pin(store))
    return query


class _Run:
    """The batches of one call, which share a lookback window."""

    def __init__(self, store: Store, folder: str, settings: Settings):
        self._store, self._folder, self._settings = store, folder, settings
        # None stands for all days: the target had none when the files arrived.
        self._start = _pinned_start(store, settings)
        self._window_done = False

    def handle(self, arrived: DataFrame, _batch: int) -> None:
        store = self._store
        # Paths only: one short row per file of the batch.
        names = {row.path.rsplit("/", 1)[-1] for row in arrived.collect()}
        present = [f for f in files.list_drops(store.spark, self._folder) if f.name in names]
        new = files.unseen(store.spark, present, store.load_log())
        ingest_files(store, new, skipped=len(present) - len(new), settings=self._settings)
        if not store.has("raw"):
            return
        # Also when nothing was new: a repeated batch may have died right here before.
        everything = self._start is None
        if self._window_done:
            first = self._first_day(names)
            if first is None and not everything:
                return
            start = max([day for day in (first, self._start) if day is not None], default=date.max)
        else:
            start = self._start
        rebuild_staging(store, start, undated=everything)
        refresh_marts(store, self._settings, since=start, undated=everything)
        self._window_done = True

    def _first_day(self, names: set[str]) -> date | None:
        """Oldest event day in the loaded files of a batch."""
        batch = self._store.spark.createDataFrame([(name,) for name in names], "file_name string")
        loaded = self._store.load_log().filter(F.col("status") == LOADED)
        return loaded.join(F.broadcast(batch), "file_name", "left_semi").agg(F.min("first_event_date")).first()[0]


def _pin(store: Store) -> str:
    return f"{store.path('_arrivals')}/window.json"


def _pinned_start(store: Store, settings: Settings) -> date | None:
    """First day of the window: as a run that did not end pinned it, else pinned now."""
    if files.exists(store.spark, _pin(store)):
        day = json.loads(files.read_text(store.spark, _pin(store)))["start"]
        return None if day is None else date.fromisoformat(day)
    start = stored_lookback_start(store.staging(), settings)
    text = json.dumps({"start": None if start is None else start.isoformat()})
    files.publish_text(store.spark, _pin(store), text)
    return start
