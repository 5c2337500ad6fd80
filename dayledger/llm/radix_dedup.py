"""Removal of repeated passages: a depth-limited radix sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a smaller
doc_id, or earlier in the same document). Suffixes matter through ``length`` bytes only, so
they are told apart by digits, the widest first, and a group that a digit leaves alone is done:

1. The first digit is a gram of 32 bytes. Each window of ``length`` bytes has an anchor, the
   gram in it with the least hash (the leftmost of equals). Equal windows have equal anchors
   at equal places, so suffixes can be sorted from their anchors. All windows with one anchor form a run.
   Groups of runs with equal grams: a run that is alone has no repeated window. If all runs
   of a group have the same bytes, every run but the earliest is repeated as a whole.
2. Other groups hold different runs. The second digit is the whole run: of equal runs all but
   the earliest are repeated as a whole, and only the earliest goes on.
3. The third digit splits a run into blocks of eight windows and takes the bytes that all
   eight share. Groups are told apart as in the first pass.
4. The last digit are the seven bytes that are left: groups of equal windows.

Digits longer than eight bytes are compared by hash: 64 bits each of gram and run, 64 bits of
gram and block together. Before each shuffle a task settles what it sees repeated itself and sends one row for
each gram, so a passage that sits in a third of all documents sends a row per task.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing. Rows
of one doc_id with one text are one document: they get the same result and do
not count as copies of each other. Different texts of one doc_id are different documents, in the order of a hash
of the text. A null doc_id counts as the least. Texts of any length are read in stretches.
Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from dayledger.llm.common import payloads, pieces, stored, text_keys

LENGTH = 100
_GRAM = 32
_BLOCK = 8
_STRETCH = 1 << 18  # windows hashed at a time
_GATHERED = 16 << 20  # bytes of text that a task settles together
_READ = 1 << 20  # bytes of text that it holds at a time
_SENT = 1 << 10  # rows that a task is sent at a time
_VISITED = 1 << 8  # documents that a visit holds as Python objects
_SETTLED = 1 << 18  # blocks that a task settles together
_NO_DOC = -(1 << 63)

# Rows of a pass: a span that a task has settled; a run whose gram the task saw alone; a run whose
# gram the task saw with different runs; the sign of such a gram for other tasks; a finished document.
_MARK, _PROBE, _KNOWN, _SIGN, _DONE = range(5)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram that starts at each byte, by doubling."""
    value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(29)
    factor, size = 0xD6E8FEB86659FD93, 1
    while size < _GRAM:
        value = value[:-size] * np.uint64(factor) + value[size:]
        factor, size = factor * factor % (1 << 64), size * 2
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xFF51AFD7ED558CCD)
    return value ^ (value >> np.uint64(32))


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams the place of the least, the leftmost of equals."""
    bits = np.uint64(max(1, len(hashes)).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    least, size = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if width > size:
        least = np.minimum(least[: size - width], least[width - size :])
    return (least & low).astype(np.int64)


def runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Text number, first window, windows after it, anchor from the first window, gram hash and run hash."""
    found: list[list[np.ndarray]] = []
    batch: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        data = b"".join(part for _, _, part in batch)
        lengths = np.array([len(part) for _, _, part in batch])
        ends = np.cumsum(lengths)
        hashes = _gram_hashes(np.frombuffer(data, dtype=np.uint8))
        anchor = _anchors(hashes, length - _GRAM + 1)
        part = np.repeat(np.arange(len(batch)), lengths)[: len(anchor)]
        window = np.flatnonzero(np.arange(len(anchor)) + length <= ends[part])
        anchor = anchor[window]
        new = np.ones(len(window), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        begin, end = window[first], window[last]
        digest = [xxh3_64_intdigest(data[a:b]) for a, b in zip(begin.tolist(), (end + length).tolist(), strict=True)]
        of = part[begin]
        shift = np.array([at for _, at, _ in batch]) - (ends - lengths)
        number = np.array([n for n, _, _ in batch])
        found.append([number[of], begin + shift[of], end - begin, anchor[first] - begin, hashes[anchor[first]].view(np.int64), np.array(digest, dtype=np.uint64).view(np.int64)])

    for number, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, _STRETCH):
            part = text[at : at + _STRETCH + length - 1]
            batch.append((number, at, part))
            size += len(part)
            if size >= _STRETCH:
                flush()
                batch, size = [], 0
    if batch:
        flush()
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    return tuple(np.concatenate(columns) for columns in zip(*found, strict=True))


def settle(doc: np.ndarray, at: np.ndarray, key: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a task can tell about its own rows: indices of repeated, probe, known and sign rows.

    ``whole`` is compared within ``key``. Repeated: an equal row is earlier. Of the others, those
    whose key has no second value are probes; those of keys with several values are known to differ, and
    one of them per key goes out as a sign for other tasks.
    """
    order = np.lexsort((at, doc, whole, key))
    k, w = key[order], whole[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
    group = np.cumsum(fresh) - 1
    first = order[fresh]
    leader = first[group]
    later = (doc[order] != doc[leader]) | (at[order] != at[leader])
    repeated = order[~fresh & later]
    values = key[first]  # sorted by key
    starts = np.ones(len(values), dtype=bool)
    starts[1:] = values[1:] != values[:-1]
    of = np.cumsum(starts) - 1
    several = np.bincount(of, minlength=1)[of] > 1 if len(values) else np.zeros(0, dtype=bool)
    return repeated, first[~several], first[several], first[several & starts]


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of each document, joined."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = doc[1:] != doc[:-1]
    number = np.cumsum(fresh) - 1
    reach = end + number * (int(end.max()) + 1)  # a later document starts above all earlier ends
    reach = np.maximum.accumulate(reach) - number * (int(end.max()) + 1)
    fresh[1:] |= begin[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    return doc[at], begin[at], np.maximum.reduceat(end, at)


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), _NO_DOC).to_numpy(zero_copy_only=False)


_FIRST = "route long, kind int, key long, whole long, doc long, at long, span int, lead int"


def _outcomes(doc: np.ndarray, at: np.ndarray, span: np.ndarray, key: np.ndarray, whole: np.ndarray, length: int) -> Iterator[tuple]:
    """What a task has settled, in parts of a bounded number of rows: kind, routes, doc, at, span, indices (none for spans to remove)."""
    repeated, probe, known, sign = settle(doc, at, key, whole)
    begin = at[repeated]
    mark = _merged(doc[repeated], begin, begin + span[repeated] + length)
    for of in _ranges(len(mark[0])):
        yield _MARK, mark[0][of] * 31 + mark[1][of], mark[0][of], mark[1][of], mark[2][of] - mark[1][of], None
    for kind, rows in ((_PROBE, probe), (_KNOWN, known), (_SIGN, sign)):
        for of in _ranges(len(rows)):
            i = rows[of]
            yield kind, doc[i] * 0x5851F42D4C957F2D + at[i] if kind == _KNOWN else key[i], doc[i], at[i], span[i], i


def _ranges(n: int, rows: int = 1 << 15) -> Iterator[slice]:
    return (slice(at, at + rows) for at in range(0, n, rows))


def _first_pass(length: int):
    def settled(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, at, span, lead, key, whole = (np.concatenate(columns) for columns in zip(*held, strict=True))
        held.clear()
        for kind, route, docs, begin, spans, i in _outcomes(doc, at, span, key, whole, length):
            zero = np.zeros(len(route), dtype=np.int64)
            others = (zero, zero, zero) if i is None else (key[i], whole[i], lead[i])
            columns = [route, np.full(len(route), kind, dtype=np.int32), others[0], others[1], docs, begin, spans.astype(np.int32), others[2].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["route", "kind", "key", "whole", "doc", "at", "span", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for table in pieces(batches, "text", _READ):
            ids, texts = _ids(table.column("doc_id").combine_chunks()), payloads(table.column("text").combine_chunks())
            number, at, span, lead, key, whole = runs(texts, length)
            held.append((ids[number], at, span.astype(np.int32), lead.astype(np.int32), key, whole))
            size += sum(map(len, texts))
            if size >= _GATHERED:
                yield from settled(held)
                size = 0
        if held:
            yield from settled(held)

    return run


def _parts(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a bounded number of rows."""
    return (batch.slice(of.start, rows) for of in _ranges(batch.num_rows, rows))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile goes to Python in small batches. Spark sends 10,000 rows at once, which, with the
    doubling of their buffers, take several times the bytes of their texts, in and beside the JVM's heap.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), _SENT) if int(before) > 0 else _SENT))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _judged(rows: DataFrame, length: int) -> DataFrame:
    """Rows after a pass's shuffle: spans to remove (``to`` is set), and rows whose group holds different values.

    A group is the probes and signs of one route: at most one for each task. Known rows and spans have
    routes of their own, so that they spread; no group outgrows the number of tasks.
    """
    kind = F.col("kind")
    group = Window.partitionBy("route", F.when(kind == _SIGN, _PROBE).otherwise(kind))
    differ = (kind == _KNOWN) | F.max(kind == _SIGN).over(group) | (F.min("whole").over(group) != F.max("whole").over(group))
    judged = rows.withColumn("differ", differ).withColumn("place", F.rank().over(group.orderBy("doc", "at")))
    judged = judged.filter((kind == _MARK) | ((kind != _SIGN) & (F.col("differ") | (F.col("place") > 1))))
    to = F.when(kind == _MARK, F.col("at") + F.col("span")).when(~F.col("differ"), F.col("at") + F.col("span") + length)
    return judged.withColumn("to", to).drop("route", "kind", "differ", "place")


_BLOCKS = "route long, kind int, key long, whole long, doc long, at long, span int, low int, edge binary, out_doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, text_key long"


def _unpacked(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value) if value else b""


@cache
def _press() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


def _packed(text):  # with types, Spark would ask which kind of function it is
    """Texts are compressed for the way through the shuffle."""
    return _press().compress(text) if text else b""


def _pack_texts(docs: DataFrame) -> DataFrame:
    """(doc, packed). A plain function of rows, as a task of it holds a hundred texts and no Arrow batch of them, whoever runs it; declared
    not to be deterministic, so that Spark neither joins before nor packs twice.
    """
    pack = F.udf(_packed, "binary").asNondeterministic()
    return docs.select(F.coalesce("doc_id", F.lit(_NO_DOC)).alias("doc"), pack(F.col("text").cast("binary")).alias("packed"))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes and runs removed, and what is left. The spans may overlap in any order."""
    kept, removed, count, reach = [], 0, 0, 0
    for begin, end in sorted(spans):
        if begin > reach or count == 0:
            kept.append(text[reach:begin])
            count += 1
            removed += end - begin
            reach = end
        elif end > reach:
            removed += end - reach
            reach = end
    kept.append(text[reach:])
    return removed, count, b"".join(kept)


def _blocks(text: bytes, run_rows: list, length: int) -> Iterator[tuple]:
    """Blocks of a text's runs: (gram, block hash, hash of all its bytes, first window, its place, windows after it, edge bytes)."""
    for row in run_rows:
        at, span, lead, key = row["at"], row["span"], row["lead"], row["key"]
        anchor = at + lead
        first, last = -lead, span - lead
        for block in range(first // _BLOCK, last // _BLOCK + 1):
            base = anchor + block * _BLOCK
            low, high = max(first - block * _BLOCK, 0), min(last - block * _BLOCK, _BLOCK - 1)
            core = xxh3_64_intdigest(text[base + _BLOCK - 1 : base + length], block & 0xFF)
            whole = xxh3_64_intdigest(text[base + low : base + high + length], (low << 4) | high)
            edge = text[base + low : base + _BLOCK - 1] + text[base + length : base + length + high]
            yield key, core, whole, base + low, low, high - low, edge


def _second_visit(length: int, with_text: bool):
    """Documents without undecided runs are finished; runs of others are split into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in (part for batch in batches for part in _parts(batch, _VISITED)):
            done: list[tuple] = []
            rows: list[tuple] = []
            columns = (part.column(c).to_pylist() for c in ("doc", "packed", "spans", "runs"))
            for doc, value, spans, undecided in zip(*columns, strict=True):
                text = _unpacked(value)
                if undecided:
                    rows += [(doc, *block) for block in _blocks(text, undecided, length)]
                else:
                    done.append(_finished(doc, text, spans, with_text))
            if done:
                columns = dict(zip(("out_doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text_key"), map(list, zip(*done, strict=True)), strict=True))
                yield _block_batch(len(done), route=np.zeros(len(done), dtype=np.int64), kind=np.full(len(done), _DONE), **columns)
            if rows:
                held.append(_block_columns(rows))
                size += len(rows)
            if size >= _SETTLED:
                yield from _settled_blocks(held, length)
                size = 0
        if held:
            yield from _settled_blocks(held, length)

    return run


def _text_key(text: bytes) -> int:
    """What ``text_keys`` gives."""
    return (xxh64_intdigest(text, 42) + (1 << 63)) % (1 << 64) - (1 << 63)


def _finished(doc: int, text: bytes, spans: list | None, with_text: bool) -> tuple:
    removed, count, kept = _cut(text, [(s["at"], s["to"]) for s in spans or []])
    return doc, len(text), removed, count, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None, _text_key(text)


def _block_columns(rows: list[tuple]) -> tuple:
    """(doc, joint hash, hash of all bytes, first window, its place, windows after it, edge bytes) as arrays."""
    doc, key, core, whole, at, low, span, edge = zip(*rows, strict=True)
    core, whole = (np.array(c, dtype=np.uint64).view(np.int64) for c in (core, whole))
    return np.array(doc, dtype=np.int64), core ^ np.array(key, dtype=np.int64), whole, np.array(at, dtype=np.int64), np.array(low, dtype=np.int32), np.array(span, dtype=np.int32), pa.array(edge, pa.binary())


def _settled_blocks(held: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    *columns, edges = zip(*held, strict=True)
    doc, joint, whole, at, low, span = map(np.concatenate, columns)
    edge = pa.concat_arrays(edges)
    held.clear()
    for kind, route, docs, begin, spans, i in _outcomes(doc, at, span, joint, whole, length):
        others = {} if i is None else {"key": joint[i], "whole": whole[i], "low": low[i], "edge": edge.take(pa.array(i))}
        yield _block_batch(len(route), route=route, kind=np.full(len(route), kind), doc=docs, at=begin, span=spans, **others)


def _block_batch(n: int, **columns) -> pa.RecordBatch:
    """Rows of a visit; the columns that are not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [field.split() for field in _BLOCKS.split(", ")]
    given = [pa.array(columns[name], kinds[k]) if name in columns else pa.nulls(n, kinds[k]) for name, k in fields]
    return pa.RecordBatch.from_arrays(given, [name for name, _ in fields])


def _last_visit(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole, _VISITED)):
            done = [_finished(doc, _unpacked(value), spans, with_text) for doc, value, spans in zip(*(batch.column(c).to_pylist() for c in ("doc", "packed", "spans")), strict=True)]
            columns = list(zip(*done, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text_key"])

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, text_key long"


def _per_document(marks: DataFrame) -> DataFrame:
    return marks.groupBy("doc").agg(F.collect_list(F.struct("at", "to")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and on demand
    the text ``kept``, without characters that a cut has divided, and the ``text_key`` of the whole text.

    Where rows of one doc_id, or without one, have different texts, documents are numbered in their order first.
    """
    if length != LENGTH and length < _GRAM + _BLOCK:
        raise ValueError("length too short")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = text_keys(F.col("text"))
    if slim.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most")).filter("least <> most").isEmpty():
        result = _remove(slim, length, with_text)
    else:
        rows = slim.select("doc_id", key.alias("key")).distinct()
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(n, "doc_id", "key").sortWithinPartitions("doc_id", "key").withColumn("number", F.monotonically_increasing_id())
        rows = stored(rows.select(F.col("doc_id").alias("own_id"), "key", "number"), "documents")
        numbered = slim.join(rows, F.col("doc_id").eqNullSafe(F.col("own_id")) & (key == F.col("key"))).select(F.col("number").alias("doc_id"), "text")
        result = _remove(numbered, length, with_text).withColumnRenamed("doc_id", "number").join(rows.select("number", F.col("own_id").alias("doc_id")), "number")
    result = result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text_key")
    return result if with_text else result.drop("kept", "text_key")


def _remove(slim: DataFrame, length: int, with_text: bool) -> DataFrame:
    """The result for documents of which each has its own doc_id."""
    # First digit: the anchor's gram.
    with _small_batches(slim.sparkSession):
        first = stored(_judged(slim.mapInArrow(_first_pass(length), _FIRST), length), "grams")
    marks = first.filter("to is not null").select("doc", "at", "to")

    # Second digit: the whole run.
    place = F.rank().over(Window.partitionBy("key", "whole").orderBy("doc", "at"))
    second = first.filter("to is null").withColumn("place", place)
    second = stored(second.select("key", "doc", "at", "span", "lead", F.when(F.col("place") > 1, F.col("at") + F.col("span") + length).alias("to")), "runs")
    marks = marks.unionByName(second.filter("to is not null").select("doc", "at", "to"))
    undecided = second.filter("to is null").groupBy("doc").agg(F.collect_list(F.struct("at", "span", "lead", "key")).alias("runs"))

    # Third digit: blocks of windows, read from the texts. Documents without any are finished on the way.
    packed = _pack_texts(slim)
    visited = packed.join(_per_document(marks), "doc", "left").join(undecided, "doc", "left")
    with _small_batches(slim.sparkSession):
        visited = stored(visited.mapInArrow(_second_visit(length, with_text), _BLOCKS), "blocks")
    finished = visited.filter(F.col("kind") == _DONE).select(F.col("out_doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text_key")
    blocks = visited.filter(F.col("kind") < _DONE).select("route", "kind", "key", "whole", "doc", "at", "span", "low", "edge")
    third = stored(_judged(blocks, length), "judged")
    marks = marks.unionByName(third.filter("to is not null").select("doc", "at", "to"))

    # Last digit: the bytes left of each window.
    window = third.filter("to is null").select("key", "doc", "at", "low", "edge", F.explode(F.sequence("low", F.col("low") + F.col("span"))).alias("i"))
    i, low = F.col("i"), F.col("low")
    own = F.concat(F.substring("edge", i - low + 1, _BLOCK - 1 - i), F.substring("edge", _BLOCK - low, i))
    window = window.select("key", "i", own.alias("own"), "doc", (F.col("at") + i - low).alias("at"))
    least = window.groupBy("key", "i", "own").agg(F.min(F.struct("doc", "at")).alias("least"), F.count("*").alias("n")).filter("n > 1")
    last = window.join(least, ["key", "i", "own"]).filter(F.struct("doc", "at") > F.col("least")).select("doc", "at", (F.col("at") + length).alias("to"))
    marks = marks.unionByName(last)

    # The texts that had undecided runs.
    open_docs = undecided.select("doc")
    rest = packed.join(open_docs, "doc", "left_semi").join(_per_document(marks.join(open_docs, "doc", "left_semi")), "doc", "left")
    result = finished.unionByName(rest.mapInArrow(_last_visit(length, with_text), _RESULT))
    return result.withColumn("doc_id", F.when(F.col("doc_id") != _NO_DOC, F.col("doc_id")))

