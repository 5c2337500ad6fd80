"""Drop files: what is there, which are new, which layout each has.

Only file metadata and the beginning of one line per new file pass through the driver
here; tasks find these lines, rows never leave them.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import text
from dayledger.sources.schemas import LAYOUTS

# Characters of a first line that reach the driver. One that is longer is no accepted
# header, as these have some 150.
_SHOWN = 10_000


@dataclass(frozen=True)
class DropFile:
    name: str
    path: str


@dataclass(frozen=True)
class NewFile(DropFile):
    # Named like a dated drop, and the date in the name if it exists.
    dated: bool
    drop_date: date | None


@dataclass(frozen=True)
class Header:
    columns: list[str]
    # "early", "late", or None for a header that is neither.
    layout: str | None


def list_drops(spark: SparkSession, folder: str) -> list[DropFile]:
    """Files ending in ``.csv``, by name. Names Hadoop treats as hidden are left out."""
    path, fs = _file_system(spark, folder)
    jvm = spark._jvm
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, "*.csv")) or []
    files = [
        DropFile(status.getPath().getName(), status.getPath().toString())
        for status in statuses
        if status.isFile()
    ]
    return sorted((f for f in files if f.name[0] not in "._"), key=lambda f: f.name)


def unseen(spark: SparkSession, files: list[DropFile], load_log: DataFrame) -> list[NewFile]:
    """Files whose name the load log does not have, whether loaded or quarantined."""
    if not files:
        return []
    listed = spark.createDataFrame([(f.name, f.path) for f in files], "file_name string, path string")
    new = listed.join(load_log.select("file_name"), "file_name", "left_anti").select(
        "file_name",
        "path",
        text.has_drop_name(F.col("file_name")).alias("dated"),
        text.drop_date(F.col("file_name")).alias("drop_date"),
    )
    found = [NewFile(row.file_name, row.path, row.dated, row.drop_date) for row in new.collect()]
    return sorted(found, key=lambda f: f.name)


def read_headers(spark: SparkSession, files: list[DropFile]) -> dict[str, Header]:
    """First line of each file that is not blank, classified. Order and case of the columns matter.

    The least (block, position) of the lines with content, per file: an aggregate that
    every task combines, however many blank lines come before and wherever splits are.
    """
    if not files:
        return {}
    lines = spark.read.text([f.path for f in files]).select(
        file_name().alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        F.regexp_replace("value", "^\ufeff+", "").alias("line"),
    )
    shown = F.struct("block", "position", F.substring("line", 1, _SHOWN).alias("line"))
    first = lines.filter(F.col("line").rlike(r"(?U)\S")).groupBy("file_name").agg(F.min(shown).alias("first"))
    found = {row.file_name: row.line for row in first.select("file_name", "first.line").collect()}
    return {f.name: _classified(found.get(f.name, "")) for f in files}


def file_name() -> Column:
    """Name of the file a row was read from."""
    # Spark gives it URI-encoded. There "+" is itself; url_decode would make it a space.
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, none if it is not there."""
    path, fs = _file_system(spark, folder)
    statuses = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "*")) or []
    return sorted(status.getPath().getName() for status in statuses)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file that is either there as a whole or not at all."""
    folder, _, name = path.rpartition("/")
    draft, fs = _file_system(spark, f"{folder}/.{name}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{path} could not be published")


def move(spark: SparkSession, source: str, target: str) -> None:
    path, fs = _file_system(spark, source)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def _classified(line: str) -> Header:
    columns = next(csv.reader([line]), [])
    matching = [name for name, layout in LAYOUTS.items() if columns == layout]
    return Header(columns, matching[0] if matching else None)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
