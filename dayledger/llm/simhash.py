"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits. Two of them that differ in at most three bits differ in at most one
bit of their lower or of their upper half. The anchors of a half are the words of the perfect
Hamming code of length 31 (covering radius 1) over its first 31 bits: every fingerprint has
exactly one anchor within radius 1, its home, and is replicated to every anchor within radius
1 + 1. If two fingerprints differ in at most one bit of a half, the home of either is among
the replicas of the other, so comparing each anchor's homes with its replicas finds all links.
The threshold decides into how many parts the fingerprint is cut (``parts``): two parts serve
up to three bits, four parts up to seven.

Only distinct fingerprints are compared. An anchor with many of them is split first: its
members differ in at most the threshold from each other on the rest of the fingerprint, so
they agree in at least one of ``threshold + 1`` slices of the rest, and are compared per slice
value. What is left is compared in blocks, and only a spanning forest of its links leaves the
task. Components come from alternating large-star and small-star steps over these links.

Defined results: null and empty texts have fingerprint zero, linked like any other. Repeated
rows with one doc_id are repeated in the result. Text of any length is hashed in stretches.
Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from dayledger.llm.common import payloads, stored

SHINGLE = 3
MAX_BITS = 3
_SEED = 42
_STRETCH = 200_000
_CODE = 31
#: Anchors with more members than this are split by slices of the rest of the fingerprint.
CROWDED = 512


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the hashes of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    ones, total = np.zeros(64, dtype=np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, total, _STRETCH):
        part = words[at : at + _STRETCH + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        if len(part) < shingle:
            spans = [(0, len(joined))]
        else:
            spans = zip(starts[: len(part) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[a:b], _SEED) for a, b in spans], dtype=np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) of every row, and between them its long columns ``keys``; ``fp`` holds the 64 bits as a signed long."""
    names = ["doc_id", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text, shingle) for text in payloads(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(values.view(np.int64))], [*names, "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, "text").mapInArrow(run, ", ".join(f"{name} long" for name in [*names, "fp"]))


def syndromes(words: np.ndarray) -> np.ndarray:
    """For 31-bit words: the number (1 to 31) of the bit to flip to reach the Hamming code, or 0."""
    found = np.zeros(len(words), dtype=np.int64)
    for bit in range(_CODE):
        found ^= ((words >> bit) & 1) * (bit + 1)
    return found


def anchors(fps: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (index of the fingerprint, anchor key, whether it is home) of all replicas."""
    index, keys, home = [], [], []
    width = 64 // parts
    for part in range(parts):
        bits = (fps.view(np.uint64) >> np.uint64(part * width)).astype(np.int64) & ((1 << min(width, _CODE)) - 1)
        if width < _CODE:
            bits |= part << width  # a narrow part fills its word with its number
        syndrome = syndromes(bits)
        nearest = np.where(syndrome > 0, bits ^ (1 << np.maximum(0, syndrome - 1)), bits)
        nearest = np.where(syndrome > 0, nearest, bits)
        prefix = np.int64(part) << 32
        index.append(np.arange(len(fps)))
        keys.append(nearest | prefix)
        home.append(np.ones(len(fps), dtype=bool))
        # Words at distance 2: flip bits i and j whose numbers add (xor) to the syndrome.
        for bit in range(_CODE):
            other = (syndrome ^ (bit + 1)) - 1
            at = np.flatnonzero((syndrome > 0) & (other > bit))
            index.append(at)
            keys.append((bits[at] ^ (1 << bit) ^ (np.int64(1) << other[at])) | prefix)
            home.append(np.zeros(len(at), dtype=bool))
    return np.concatenate(index), np.concatenate(keys), np.concatenate(home)


def replicas(distinct: DataFrame, parts: int) -> DataFrame:
    """(anchor, home, fp): every fingerprint at each anchor within covering radius plus threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                index, keys, home = anchors(part, parts)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(home), pa.array(part[index])], ["anchor", "home", "fp"])

    return distinct.mapInArrow(run, "anchor long, home boolean, fp long")


def _forest(fps: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links within one group, as edges of a spanning forest; homes are compared with everyone."""
    members, at = np.unique(fps, return_inverse=True)
    parent = np.arange(len(members))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i in np.unique(at[home]).tolist():
        near = np.flatnonzero(np.bitwise_count(members ^ members[i]) <= max_bits)
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((members[i], members[j]))
    return edges


def _links(max_bits: int):
    def close(table: np.ndarray) -> pa.RecordBatch:
        """The links of whole groups: runs of rows with one anchor and one slice."""
        edges: list[tuple[int, int]] = []
        new = (table[1:, :2] != table[:-1, :2]).any(axis=1)
        starts = np.flatnonzero(np.concatenate([[True], new]))
        ends = np.append(starts[1:], len(table))
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            home = table[a:b, 3] > 0
            if home.any():
                edges += _forest(np.ascontiguousarray(table[a:b, 2]).view(np.uint64), home, max_bits)
        values = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values[:, 0]), pa.array(values[:, 1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; the last group of a batch may go on in the next."""
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.column_stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in ("anchor", "slice", "fp", "home")])
            if held and (table[-1, :2] == held[0][0, :2]).all():
                held.append(table)
                continue
            table = np.concatenate([*held, table])
            others = np.flatnonzero((table[:, :2] != table[-1, :2]).any(axis=1))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield close(table[:cut])
            held = [table[cut:]]
        if held:
            yield close(np.concatenate(held))

    return run


def slices(fp: Column, anchor: Column, parts: int, pieces: int) -> Column:
    """Values of the ``pieces`` slices of the bits outside the anchor's part, each with its number."""
    width = 64 // parts
    part = F.shiftright(anchor, 32).cast("int")
    rotated = fp
    for number in range(1, parts):
        rotated = F.when(part == number, F.shiftrightunsigned(fp, number * width).bitwiseOR(F.shiftleft(fp, 64 - number * width))).otherwise(rotated)
    rest = F.shiftrightunsigned(rotated, width)
    size = -(-(64 - width) // pieces)
    return F.array(*[F.shiftrightunsigned(rest, i * size).bitwiseAND(F.lit((1 << size) - 1)) * pieces + i for i in range(pieces)])


def links(distinct: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within ``max_bits`` of each other."""
    parts = 2 if max_bits <= 3 else 4
    if max_bits > 7:
        raise ValueError("at most 7 bits")
    placed = replicas(distinct, parts)
    sizes = placed.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > crowded)
    marked = placed.join(sizes, "anchor", "left")
    cut = F.when(F.col("n").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(slices(F.col("fp"), F.col("anchor"), parts, max_bits + 1))
    grouped = marked.select("anchor", "home", "fp", F.explode(cut).alias("slice")).select("anchor", "slice", "fp", "home")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grouped.repartition(n, "anchor", "slice").sortWithinPartitions("anchor", "slice")
    return dealt.mapInArrow(_links(max_bits), "u long, v long").filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; the root is the least node of its component.

    Large-star and small-star steps in turn. Neither gathers a node's neighbours: each takes
    their least by a combined aggregate and joins it back.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges, before = stored(edges, "edges"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def representatives(docs: DataFrame, key: Column, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, key) of one row of each component: the least doc_id, nulls last, then the least ``key``, a long from the text."""
    marked = fingerprints(docs.select("doc_id", key.alias("text_key"), "text"), shingle, ("text_key",))
    first = F.min(F.struct(F.isnull("doc_id").alias("without"), "doc_id", "text_key")).alias("first")
    distinct = stored(marked.groupBy("fp").agg(first), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("first", F.coalesce("root", "fp").alias("root"))
    return classes.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", F.col("first.text_key").alias("key"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    members = classes.join(least, "root").select("fp", "component_id")
    return marked.join(members, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
