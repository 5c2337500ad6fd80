"""The stored tables: where they are, how they are read and written.

Raw, quarantine and load log only grow, or repeat a file's partition; what counts in
them is settled by the load log, written last. All other tables are replaced, in whole or
by day, and readers must never see half of that. Their rows lie in version folders, and a
manifest says which version each partition is read from. A replacement writes a new
version first and its manifest last, so one that dies leaves the table as it was.
"""

from __future__ import annotations

import atexit
import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.sources import files
from dayledger.sources.schemas import (
    CHECK_RESULTS,
    CHECK_VIOLATIONS,
    DEFECT_LOG,
    DIMENSION,
    FACT,
    LAST_DELIVERED,
    LOAD_LOG,
    QUARANTINE,
    RAW,
    STAGING,
    TRUTH,
)


# Tables that are replaced.
VERSIONED = {
    "staging", "dim_creative", "fct_creative_daily", "check_results", "check_violations",
    "defect_log", "last_delivered",
}
_VERSION, _MANIFESTS = "version", "_manifests"

# How tables are written: smaller than by Spark's default codec.
COMPACT = {"compression": "zstd"}

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Store:
    """Parquet tables under one root on the cluster's shared storage."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def has(self, table: str) -> bool:
        if table in VERSIONED:
            return bool(self._manifests(table))
        return files.exists(self.spark, self.path(table))

    def raw(self) -> DataFrame:
        """Every delivered row, as delivered; duplicates and superseded rows included."""
        return self._read("raw", RAW)

    def load_log(self) -> DataFrame:
        """One row per file ever handled."""
        return self._read("load_log", LOAD_LOG)

    def staging(self) -> DataFrame:
        return self._read("staging", STAGING)

    def dimension(self) -> DataFrame:
        return self._read("dim_creative", DIMENSION)

    def fact(self) -> DataFrame:
        return self._read("fct_creative_daily", FACT)

    def check_results(self) -> DataFrame:
        return self._read("check_results", CHECK_RESULTS)

    def check_violations(self) -> DataFrame:
        """Violating rows of all checks and runs."""
        return self._read("check_violations", CHECK_VIOLATIONS)

    def defect_log(self) -> DataFrame:
        return self._read("defect_log", DEFECT_LOG).drop("logged_in")

    def last_delivered(self) -> DataFrame:
        return self._read("last_delivered", LAST_DELIVERED)

    def parts(self, table: str, by: str) -> set[str]:
        """Values of the partition column of a replaced table, as published."""
        return {name.removeprefix(f"{by}=") for name in self._manifest(table)}

    def quarantine(self) -> DataFrame:
        """Lines of rejected files; ``block, position`` is their order in the file."""
        return self._read("quarantine", QUARANTINE)

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.options(**COMPACT).mode("append").parquet(self.path(table))

    def replace(
        self, table: str, rows: DataFrame, by: list[str] | None = None, then: Step = lambda rows: rows
    ) -> None:
        """Replace the whole table.

        ``then`` makes the table's rows from ``rows`` where they are written, so that only
        ``rows`` are shuffled into its partitions.
        """
        writer = then(_balanced(rows, by)).write.options(**COMPACT)
        version = uuid.uuid4().hex
        (writer.partitionBy(*by) if by else writer).parquet(self._version(table, version))
        self._publish(table, self._partitions(table, version, by))

    def replace_partitions(
        self,
        table: str,
        rows: DataFrame,
        by: list[str],
        balance: bool = True,
        instead_of: str | None = None,
        then: Step = lambda rows: rows,
    ) -> None:
        """Replace the partitions that ``rows`` has; all others stay untouched.

        ``instead_of`` is a partition of a versioned table that goes even if ``rows`` has
        nothing for it. ``then`` is as for ``replace``.
        """
        rows = then(_balanced(rows, by) if balance else rows)
        if table in VERSIONED:
            version = uuid.uuid4().hex
            rows.write.options(**COMPACT).partitionBy(*by).parquet(self._version(table, version))
            kept = {n: v for n, v in self._manifest(table).items() if n != f"{by[0]}={instead_of}"}
            self._publish(table, kept | self._partitions(table, version, by))
            return
        (
            rows.write.options(**COMPACT)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self.path(table))
        )

    def _version(self, table: str, version: str) -> str:
        return f"{self.path(table)}/{_VERSION}={version}"

    def _partitions(self, table: str, version: str, by: list[str] | None) -> dict[str, str]:
        """Partition folders of a version, or the version itself, by the version."""
        if not by:
            return {"": version}
        if len(by) > 1:
            raise ValueError("a replaced table has one partition column")
        names = files.names_in(self.spark, self._version(table, version))
        return {name: version for name in names if name.startswith(f"{by[0]}=")}

    def _manifests(self, table: str) -> list[str]:
        return [n for n in files.names_in(self.spark, f"{self.path(table)}/{_MANIFESTS}") if n.endswith(".json")]

    def _manifest(self, table: str, back: int = 1) -> dict[str, str]:
        """Version of each partition, as last published; with ``back`` 2 the time before."""
        names = self._manifests(table)
        if len(names) < back:
            return {}
        return json.loads(files.read_text(self.spark, f"{self.path(table)}/{_MANIFESTS}/{names[-back]}"))

    def _publish(self, table: str, partitions: dict[str, str]) -> None:
        names = self._manifests(table)
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        files.publish_text(self.spark, f"{self.path(table)}/{_MANIFESTS}/{number:012d}.json", json.dumps(partitions))
        # Queries that run may still read what the manifest before names.
        kept = {f"{_VERSION}={v}" for v in [*partitions.values(), *self._manifest(table, 2).values()]}
        for name in files.names_in(self.spark, self.path(table)):
            if name.startswith(f"{_VERSION}=") and name not in kept:
                files.remove(self.spark, f"{self.path(table)}/{name}")
        for name in names[:-1]:
            files.remove(self.spark, f"{self.path(table)}/{_MANIFESTS}/{name}")

    @contextmanager
    def scratch(self) -> Iterator[str]:
        """A folder of this run for intermediate tables, removed when the run is through.

        On the shared storage the cluster names for checkpoints, so that executors that
        replace lost ones find it; under the store's root where none is named.
        """
        folder = scratch_folder(self.spark, default=self.path("_scratch"))
        try:
            yield folder
        finally:
            files.remove(self.spark, folder)

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        # A given schema keeps partition columns from being guessed, and an absent
        # table is an empty one.
        if table not in VERSIONED:
            if not self.has(table):
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).parquet(self.path(table))
        places = [f"{self._version(table, version)}/{name}".rstrip("/") for name, version in sorted(self._manifest(table).items())]
        if not places:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*places)
        return read.select(*schema.fieldNames())


def scratch_folder(spark: SparkSession, default: str | None = None) -> str:
    """A new folder name on storage that the cluster shares, removed when the process ends.

    Shared storage is what ``spark.checkpoint.dir`` names, else ``default``, else the
    session's warehouse; never a folder of one machine's own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or default
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
    atexit.register(_forget, folder)
    return folder


def _forget(folder: str) -> None:
    # The session may have ended by now, so this goes without it.
    try:
        if folder.startswith("file:"):
            fs.LocalFileSystem().delete_dir("/" + folder.removeprefix("file:").lstrip("/"))
        elif "://" in folder:
            store, path = fs.FileSystem.from_uri(folder)
            store.delete_dir(path)
        else:
            fs.LocalFileSystem().delete_dir(folder)
    except OSError:
        pass


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` written once to the cluster's shared scratch storage and read back.

    For a result that several consumers read: they share one computation, prune
    columns, and lost executors cost a read instead of the lineage.
    """
    spark = rows.sparkSession
    folder = scratch_folder(spark)
    rows.write.options(**COMPACT).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """The correct daily numbers, a CSV with a header."""
    return spark.read.schema(TRUTH).option("header", True).csv(path)


def _balanced(rows: DataFrame, by: list[str] | None) -> DataFrame:
    # Few files per partition, and adaptive execution splits a partition that is too
    # large for one task and merges the small ones.
    return rows.hint("rebalance", *[F.col(name) for name in by]) if by else rows
