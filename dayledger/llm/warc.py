"""WARC archives: a writer with revisit records, and a splittable reader.

Writing: every record is a gzip member of its own. Records with equal payloads (SHA-1) of at
least ``least_bytes`` bytes become one response, that of the least id, and revisits to it,
which keep the HTTP header with the payload's length but no payload. A task writes its archives in the
shared folder under temporary names and renames them when they are whole, so a task that runs again or
twice leaves the same files.

Reading: archives are cut into byte ranges, each a row. A task looks in its range for the gzip magic,
decodes the candidate as a member, and takes it if what comes out begins as a WARC record
and is as long as its header says. From there members follow each other. A range owns the records
that start in it and reads past its end for the last one. A magic number in the middle of
compressed data fails one of these tests, and the search goes on at the next byte.

Both sides use the store that the URI names (local or shared disk, or what pyarrow's file systems
reach). Defined results: null payloads are empty; a null or repeated id is written as a
record like any other, equal payloads under one id counting as that id's response; no rows, no archives. A record is held in
memory as a whole, a range is not. Further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import filesystem, payloads, stored

MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 18


@dataclass(frozen=True)
class Settings:
    least_bytes: int = 0  # smaller payloads are never revisits
    archive_bytes: int = 64 << 20  # an archive is closed when it has grown to this
    split_bytes: int = 8 << 20
    level: int = 6


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, digest: str) -> bytes:
    """The record's bytes, before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:dayledger:page:{page_id}>"]
    head += [f"WARC-Target-URI: {''.join(url.splitlines())}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:dayledger:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def with_originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, html, original): the least id with the same payload, null where that does not matter.

    Copies of a payload are counted by digest before the pages meet them; html itself is
    never a key.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    copies = marked.filter(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = marked.join(copies, "digest", "left")
    original = F.when((F.col("size") >= least_bytes) & (F.col("original") != F.coalesce("page_id", F.col("original") - 1)), F.col("original"))
    return joined.select("page_id", "url", "html", original.alias("original"))


def _writer(folder: str, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        store.create_dir(root, recursive=True)
        written: list[tuple[str, int]] = []
        sink, name, temporary, size = None, "", "", 0

        def close() -> None:
            nonlocal sink, size
            if sink is not None:
                sink.close()
                store.move(f"{root}/{temporary}", f"{root}/{name}")
                written.append((name, size))
                sink, size = None, 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "original")]
            for page_id, original, url, payload in zip(*columns, payloads(batch.column("url")), payloads(batch.column("html")), strict=True):
                if sink is None:
                    name = f"part-{part:06d}-{len(written):04d}.warc.gz"
                    temporary = f".{name}.{uuid.uuid4().hex}"
                    sink = store.open_output_stream(f"{root}/{temporary}", compression=None)
                data = member(record(page_id, url.decode("utf-8", "replace"), payload, original, original is not None, digest_text(payload)), settings.level)
                sink.write(data)
                size += len(data)
                if size >= settings.archive_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in written], pa.string()), pa.array([s for _, s in written], pa.int64())], ["file", "size"])

    return run


def write(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write the archives; the result lists them (file, size)."""
    rows = with_originals(pages.select("page_id", "url", "html"), settings.least_bytes)
    return stored(rows.mapInArrow(_writer(folder, settings), "file string, size long"), "archives")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(file, size) of the archives of a folder that something else wrote; names only pass the driver."""
    store, root = filesystem(folder)
    found = [(f.base_name, f.size) for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".warc.gz") and not f.base_name.startswith(".")]
    return spark.createDataFrame(sorted(found), "file string, size long")


class _Window:
    """Bytes of a file by absolute position, read in chunks and let go from the left."""

    def __init__(self, source: pa.NativeFile, start: int) -> None:
        self.source, self.start, self.data = source, start, b""

    def more(self) -> bool:
        self.source.seek(self.start + len(self.data))
        chunk = self.source.read(_CHUNK)
        self.data += chunk
        return bool(chunk)

    def drop(self, position: int) -> None:
        self.data = self.data[position - self.start :]
        self.start = position


def _member_at(window: _Window) -> tuple[bytes, int] | None:
    """Content and length of the member at the window's start, or None if there is no WARC record."""
    inflate, out, at, checked = zlib.decompressobj(31), [], 0, False
    while not inflate.eof:
        if at == len(window.data) and not window.more():
            return None
        try:
            out.append(inflate.decompress(window.data[at : at + _CHUNK]))
        except zlib.error:
            return None
        at = min(len(window.data), at + _CHUNK)
        if not checked and sum(map(len, out)) >= 7:
            out, checked = [b"".join(out)], True
            if not out[0].startswith(b"WARC/1."):
                return None
    content = b"".join(out)
    head, mark, block = content.partition(b"\r\n\r\n")
    length = _headers(head).get("content-length", "")
    if not (content.startswith(b"WARC/1.") and mark and length.isdigit() and len(block) == int(length) + 4):
        return None
    return content, at - len(inflate.unused_data)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def records(source: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The records of an archive that start in a byte range."""
    window = _Window(source, start)
    while window.start < end:
        at = window.data.find(MAGIC)
        if at < 0:
            keep = window.start + max(0, len(window.data) - len(MAGIC) + 1)
            window.drop(keep)
            if not window.more():
                return
            continue
        window.drop(window.start + at)
        if window.start >= end:
            return
        found = _member_at(window)
        if found is None:
            window.drop(window.start + 1)
            continue
        yield found[0]
        window.drop(window.start + found[1])


def _page_number(text: str) -> int | None:
    number = text.rpartition(":")[2].rstrip(">")
    return int(number) if number.lstrip("-").isdigit() else None


def parsed(content: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload)."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = _headers(head)
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").rpartition(":")[2]
    if kind == "revisit":
        size, payload = int(_headers(http).get("content-length", "0")), None
    else:
        size = len(payload)
        if digest_text(payload) != digest:
            raise ValueError(f"payload of {headers.get('warc-record-id')} does not match its digest")
    refers = _page_number(headers["warc-refers-to"]) if "warc-refers-to" in headers else None
    return _page_number(headers.get("warc-record-id", "")), size, digest, kind, refers, headers.get("warc-target-uri"), payload


_FIELDS = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]


def read(files: DataFrame, folder: str, settings: Settings = Settings(), with_payload: bool = True) -> DataFrame:
    """One row per record of the listed archives (file, size)."""
    names = [name for name, _ in _FIELDS if with_payload or name != "payload"]
    step = settings.split_bytes
    splits = files.filter("size > 0").select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(step).cast("long"))).alias("start"))
    tasks = max(1, min(100_000, files.select(F.sum(F.ceil(F.col("size") / step))).first()[0] or 1))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
        made = {name: pa.array(list(c), kind) for (name, kind), c in zip(_FIELDS, columns, strict=True) if name in names}
        return pa.RecordBatch.from_arrays(list(made.values()), list(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows, size = [], 0
                with store.open_input_file(f"{root}/{file}") as source:
                    for content in records(source, start, start + step):
                        row = parsed(content)
                        rows.append(row)
                        size += len(row[-1] or b"") if with_payload else 64
                        if size >= 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    kinds = {"page_id": "long", "payload_bytes": "long", "refers_to": "long", "payload": "binary"}
    return splits.repartition(tasks, "file", "start").mapInArrow(run, ", ".join(f"{name} {kinds.get(name, 'string')}" for name in names))
