"""What the operators of this subpackage share: tables, shared storage, bytes of texts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The folder of a session in one process that names none.
_OWN: list[str] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; a null key counts as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("null"))), F.lit(modulus))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a session in one process (``local[...]``) may go without; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="dayledger-"))
        atexit.register(remove, _OWN[0])
    return _OWN[0]


def remove(folder: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    try:
        store, path = filesystem(folder)
        store.delete_dir(path)
    except (OSError, FileNotFoundError):
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder. It is removed when this Python process ends."""
    folder = f"{shared_folder(spark)}/dayledger-llm/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, folder)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back: lineage ends here."""
    folder = scratch(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI as tasks see it, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def text_keys(text: Column) -> Column:
    """A 64-bit key for each text; null counts as the empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def payloads(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], texts: str, bound: int) -> Iterator[pa.Table]:
    """Batches gathered to tables of about ``bound`` bytes of text, for work that gains from size."""
    held, size = [], 0
    for batch in batches:
        start, column = 0, batch.column(texts)
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        for row, length in enumerate(lengths):
            size += int(length)
            if size >= bound:
                held.append(batch.slice(start, row + 1 - start))
                yield pa.Table.from_batches(held)
                start, held, size = row + 1, [], 0
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
