"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set holds its distinct word n-grams. Two sets of sizes a and b link when their
intersection is at least ``percent`` of their union. If the n-grams of every set are ordered rarest first,
by one order for all, linked sets share an n-gram among the first ``a - ceil(a * percent / 100) + 1`` of each,
their prefixes. N-grams of one set alone come first of all and can be shared by no two sets, so
most texts have nothing else in their prefix and never reach the join.

1. Equal texts are one text. Only texts whose key meets another one in a bitmap of fixed size are shuffled for that.
2. Frequencies: each task sends, for about ``_GATHERED`` bytes of text, one row per shard of the hashes
   with the distinct n-grams and their counts, already added up. Shards grow in number with the corpus, not in size.
3. Each shard tells the pieces which of their n-grams occur in other sets too, and how often. Shards that hold
   far more than their share, because some n-gram is in a large part of all texts, are split.
4. Rows of one n-gram in the prefixes meet. Two rows are a candidate if sizes allow a link (length
   filter) and what is left of both sets behind this n-gram does (positional filter). Each pair
   is verified once, whatever number of n-grams it shares: a suffix filter compares how many n-grams lie between
   quantiles of the hashes, then the intersection is counted.
5. Only components are wanted, so what is linked already is not compared again. In a first few rounds each row of an
   n-gram is compared with one row only (``STARS``), and thousands of near copies become one
   component at the cost of a pair each. Then every row outside the largest component of its n-gram is compared
   with all rows of other components there, in blocks of rows, each in a task of its own.
6. Texts with n-grams of many rows (``CROWDED``) carry a sketch for that: the parities of how many of the set's n-grams fall on each
   of some bits. Sketches differ in no more bits than sets in n-grams, so most rows that don't link are told apart without
   a candidate (bitmap filter). First a row is compared with one block of the others only, and meets the nearest of a few
   other components (``NEAREST``), which joins most of a group; what is still apart after that meets in full.

Defined results: a null or empty text, or one of blanks, has an empty set and links with nothing, not even with equal ones;
its component is its own doc_id. A text of fewer words than an n-gram has its whole sequence as the only one. Equal
sets always link. Repeated rows are repeated in the result; texts of one doc_id, or of none, are told apart by their text;
a component without any doc_id has component_id null. No rows give no rows. Texts of any length are
read in stretches. Further columns of the input are ignored.

N-grams are told apart by hashes of over 40 bits, texts by 64.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from dayledger.llm.common import payloads, pieces, stored
from dayledger.llm.simhash import components

SHINGLE = 5
PERCENT = 80
#: Rounds in which each row is compared with one row per n-gram.
STARS = 2
#: Rows of one n-gram that are compared in one block.
BLOCK = 1024
#: N-grams with more rows than this have sketches of their sets compared before pairs are made.
CROWDED = 64
#: Components that a row of a crowded n-gram meets before all that is still apart meets.
NEAREST = 8
#: Bits of a sketch at most, a power of two.
SKETCH_BITS = 1 << 17
_GATHERED = 8 << 20
_STRETCH = 1 << 20
_SHARD_GRAMS = 2_000_000
_LOCAL = 40  # bits of a hash behind those of its shard
_BITS = 24
_BLANK = re.compile(rb"[ \t\n\r\x0b\f]")


class _Hashes(dict):
    """Hashes of words, those of short ones remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxh3_64_intdigest(word)
        if len(word) <= 32:
            self[word] = value
        return value


def word_hashes(text: bytes, known: _Hashes) -> np.ndarray:
    found, at = [], 0
    while at < len(text):
        end = at + _STRETCH
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        words = text[at:end].lower().split()
        found.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
        at = end
        if len(known) > 100_000:
            known.clear()
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def shingles(text: bytes, width: int, known: _Hashes) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of ``width`` words; all words as one, if there are fewer."""
    words = word_hashes(text, known)
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        total = (total ^ words[j : len(total) + j]) * np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(32)
    return np.unique(total)


def least_overlap(sizes: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes, added up, link."""
    return F.ceil(sizes * percent / (100 + percent))


# Numbers of a few bytes. Sorted ones go as differences of as many bytes as come out shortest, one to four: however sparse they
# are, none takes more than four. The greatest value stands for itself and goes on; the first byte is the width.


def _narrow(values: np.ndarray, width: int = 5) -> bytes:
    """The low bytes of each."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, width: int = 5) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.view("<i8").reshape(-1)


def coded(sorted_keys: np.ndarray) -> bytes:
    """Of numbers of 32 bits."""
    steps = np.diff(sorted_keys.astype(np.int64), prepend=0)
    sizes = {w: w * (len(steps) + int((steps // ((1 << 8 * w) - 1)).sum())) for w in range(1, 5)}
    width = min(sizes, key=sizes.get)
    more, rest = np.divmod(steps, (1 << 8 * width) - 1)
    out = np.full(sizes[width] // width, (1 << 8 * width) - 1, dtype=np.int64)
    out[np.cumsum(more + 1) - 1] = rest
    return bytes([width]) + _narrow(out, width)


def decoded(data: bytes) -> np.ndarray:
    steps = _wide(data[1:], data[0])
    return np.cumsum(steps)[steps != (1 << 8 * data[0]) - 1]


# Texts


def _marked(batch: pa.RecordBatch, bitmap: np.ndarray, want: bool) -> pa.RecordBatch:
    """Rows whose text may occur again, or those whose text surely doesn't."""
    at = batch.column("node").to_numpy(zero_copy_only=False) & ((1 << _BITS) - 1)
    marked = (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return batch.filter(pa.array(marked == want))


def _repeated(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_marked(batch, bitmap, True) for batch in batches)

    return run


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """One bit per value of the keys' low bits: 2 MB, whatever their number."""
    low = F.col("node").bitwiseAND((1 << _BITS) - 1)
    words = nodes.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(node & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (_BITS - 6), dtype=np.uint64)
    for row in words:
        bitmap[row["word"]] = np.uint64(row["bits"] % (1 << 64))
    return bitmap


class Once:
    """Every distinct text once: rows of (node, text) of which only those that may occur again are shuffled."""

    def __init__(self, keyed: DataFrame, bitmap: np.ndarray) -> None:
        self.keyed, self.bitmap = keyed, bitmap
        self.again = keyed.mapInArrow(_repeated(bitmap), "node long, text string").groupBy("node").agg(F.first("text").alias("text"))

    def rows(self, make, width: int) -> DataFrame:
        """What ``make`` gives for the keys and sets of the texts, a piece at a time."""

        def run(skip: np.ndarray | None):
            return lambda batches: (row for nodes, sets in _sets(batches, width, skip) for row in make(nodes, sets))

        return self.keyed.mapInArrow(run(self.bitmap), _ROWS).unionByName(self.again.mapInArrow(run(None), _ROWS))


def _sets(batches: Iterator[pa.RecordBatch], width: int, skip: np.ndarray | None) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Keys and sets of the texts of one piece after another, without those marked in ``skip``."""
    known = _Hashes()
    left = batches if skip is None else (_marked(batch, skip, False) for batch in batches)
    for table in pieces(left, "text", _GATHERED):
        sets = [shingles(text, width, known) for text in payloads(table.column("text").combine_chunks())]
        yield table.column("node").to_numpy().astype(np.int64), sets


# Frequencies: rows of pieces and shards

_ROWS = "shard long, kind int, salt int, piece long, a binary, b binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [field.split()[0] for field in _ROWS.split(", ")])


def _count_rows(bits: int):
    """For each piece and shard the distinct n-grams, 32 bits behind those of the shard, and in how many texts each is."""

    def make(nodes: np.ndarray, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        grams = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]) >> np.uint64(32 - bits)
        grams, counts = np.unique(grams, return_counts=True)
        shards, starts = np.unique(grams >> np.uint64(32), return_index=True)
        ends = [*starts[1:].tolist(), len(grams)]
        for shard, a, b in zip(shards.tolist(), starts.tolist(), ends, strict=True):
            yield _batch([(shard, 0, 0, None, coded(grams[a:b] & np.uint64(0xFFFFFFFF)), counts[a:b].astype("<u4").tobytes())])

    return make


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows that come sorted by a column, as (value, its rows); the rows must be read before the next value."""
    rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        value = ahead[column]

        def own(value=value) -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and ahead[column] == value:
                row, ahead = ahead, None
                yield row
                ahead = next(rows, None)

        yield value, own()


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard the n-grams of more than one text, with their frequencies, and how many there are in all."""
    for shard, rows in _runs(batches, "shard"):
        parts, held = [], 0
        for row in rows:
            parts.append((decoded(row["a"]).astype(np.uint32), np.frombuffer(row["b"], dtype="<u4").astype(np.int64)))
            held += len(parts[-1][0])
            if len(parts) > 1 and held > 2 * len(parts[0][0]) + 500_000:
                parts = [_added(parts)]
                held = len(parts[0][0])
        keys, counts = _added(parts)
        more = counts > 1
        yield _batch([(shard, 0, 0, int(counts.sum()), coded(keys[more]), np.minimum(counts[more], (1 << 32) - 1).astype("<u4").tobytes())])


def _posting_rows(bits: int, salts: dict[int, int]):
    """For each piece and shard the n-grams with the numbers of their texts, and one row with the texts' keys and sizes."""

    def make(nodes: np.ndarray, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        piece = (xxh3_64_intdigest(nodes.tobytes()) >> 1) - (1 << 62)  # the same if the task runs again
        yield _batch([((1 << bits) + piece % (1 << bits), 2, 0, piece, nodes.tobytes(), sizes.tobytes())])
        grams = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])
        owner, shard = np.repeat(np.arange(len(sets)), sizes), (grams >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        grams, owner, shard = grams[order], owner[order], shard[order]
        local = ((grams >> np.uint64(64 - _LOCAL - bits)) & np.uint64((1 << _LOCAL) - 1)).astype(np.int64)
        shards, starts = np.unique(shard, return_index=True)
        for s, a, b in zip(shards.tolist(), starts.tolist(), [*starts[1:].tolist(), len(grams)], strict=True):
            yield _batch([(s, 1, piece % salts.get(s, 1), piece, _narrow(local[a:b]), coded(owner[a:b]))])

    return make


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece and shard the n-grams that occur in other texts too: shard, hash, text number and frequency."""
    keys = counts = np.zeros(0, dtype=np.int64)
    for (shard, _), rows in ((value, own) for value, own in _runs_by_two(batches)):
        keys = counts = np.zeros(0, dtype=np.int64)
        for row in rows:
            if row["kind"] == 2:
                yield _batch([(-1, 0, 0, row["piece"], row["a"], row["b"])])
            elif row["kind"] == 0:
                keys, counts = decoded(row["a"]), np.frombuffer(row["b"], dtype="<u4")
            elif len(keys):
                local = _wide(row["a"])
                owner = decoded(row["b"])
                asked = local >> (_LOCAL - 32)
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                met = keys[at] == asked
                if met.any():
                    both = owner[met].astype("<u4").tobytes() + counts[at[met]].astype("<u4").tobytes()
                    yield _batch([(shard, 1, 0, row["piece"], _narrow(local[met]), both)])


def _runs_by_two(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    def marked() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.StructArray.from_arrays([batch.column("shard"), batch.column("salt")], ["shard", "salt"])
            yield batch.append_column("pair", pair)

    return (((pair["shard"], pair["salt"]), rows) for pair, rows in _runs(marked(), "pair"))


_NODES = "node long, n long, own long, grams array<long>"


def _prefixed(percent: int):
    """Of each text its size and how many n-grams it alone has; of those that can link, the others, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, "piece"):
            head, found = next(rows), []
            nodes, sizes = (np.frombuffer(head[c], dtype=np.int64) for c in ("a", "b"))
            for row in rows:
                owner, count = np.frombuffer(row["b"], dtype="<u4").reshape(2, -1)
                found.append(np.stack([owner.astype(np.int64), count.astype(np.int64), _wide(row["a"]) | (row["shard"] << _LOCAL)]))
            owner, count, gram = np.concatenate([np.zeros((3, 0), dtype=np.int64), *found], axis=1)
            shared = np.bincount(owner, minlength=len(nodes))
            able = (sizes > 0) & (100 * shared >= percent * sizes)
            kept = able[owner]
            owner, count, gram = owner[kept], count[kept], gram[kept]
            order = np.lexsort((gram, count, owner))
            ends = np.concatenate([[0], np.cumsum(np.where(able, shared, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(gram[order]), mask=pa.array(~able))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sizes), pa.array(sizes - shared), lists], ["node", "n", "own", "grams"])

    return run


def sets_of(once: Once, bytes_of_text: int, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, n, own, grams) of every text, stored: its size, how many n-grams it alone has, the others if it can link."""
    spark = once.keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, int(bytes_of_text / 6 / _SHARD_GRAMS).bit_length())
    counts = once.rows(_count_rows(bits), width).repartition(parts, "shard").sortWithinPartitions("shard")
    counts = stored(counts.mapInArrow(_add_up, _ROWS), "frequencies")
    # Shards of more than four times their share, because of n-grams that are in a large part of all texts.
    large = counts.filter(F.col("piece") > 4 * _SHARD_GRAMS).select("shard", F.ceil(F.col("piece") / (2 * _SHARD_GRAMS)).cast("int").alias("salts"))
    salts = {row["shard"]: row["salts"] for row in large.collect()}
    known = counts.join(large, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    known = known.select("shard", "kind", "salt", F.lit(None).cast("long").alias("piece"), "a", "b")
    asked = once.rows(_posting_rows(bits, salts), width).unionByName(known)
    asked = asked.repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    answers = asked.mapInArrow(_answers, _ROWS).repartition(parts, "piece").sortWithinPartitions("piece", "kind")
    return stored(answers.mapInArrow(_prefixed(percent), _NODES), "sets")


# Candidates


def prefixes(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(gram, node, n, rest): n-grams of the prefixes; ``rest`` counts those of the set from this one on."""
    least = F.ceil(F.col("n") * percent / 100)
    able = nodes.filter("grams is not null").select("node", "n", F.size("grams").alias("shared"), F.posexplode(F.slice("grams", 1, (F.size("grams") - least + 1).cast("int"))).alias("at", "gram"))
    return able.select("gram", "node", "n", (F.col("shared") - F.col("at")).cast("long").alias("rest"))


def _possible(percent: int, one: str, other: str) -> Column:
    """Length and positional filter."""
    a, b = F.col(f"{one}.n"), F.col(f"{other}.n")
    close = 100 * F.least(a, b) >= percent * F.greatest(a, b)
    return close & (F.least(f"{one}.rest", f"{other}.rest") >= least_overlap(a + b, percent))


def _verified(percent: int):
    """Pairs that link: suffix filter, then the intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, sizes = batch.column("u"), batch.column("v"), batch.column("sizes").to_numpy(zero_copy_only=False)
            ones, others, good = batch.column("ones"), batch.column("others"), []
            for i in range(batch.num_rows):
                a, b = (np.sort(c[i].values.to_numpy(zero_copy_only=False)) for c in (ones, others))
                needed = -(-int(sizes[i]) * percent // (100 + percent))
                cuts = a[[len(a) // 4, len(a) // 2, 3 * len(a) // 4]]
                between = [np.diff(np.searchsorted(x, cuts), prepend=0, append=len(x)) for x in (a, b)]
                if np.minimum(*between).sum() >= needed and len(np.intersect1d(a, b, assume_unique=True)) >= needed:
                    good.append(i)
            yield pa.RecordBatch.from_arrays([u.take(pa.array(good, pa.int64())), v.take(pa.array(good, pa.int64()))], ["u", "v"])

    return run


def verified(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) that link."""
    able = nodes.filter("grams is not null")
    both = pairs.join(able.select(F.col("node").alias("v"), F.col("n").alias("size"), F.col("grams").alias("others")), "v")
    both = both.join(able.select(F.col("node").alias("u"), "n", F.col("grams").alias("ones")), "u")
    return both.select("u", "v", (F.col("n") + F.col("size")).alias("sizes"), "ones", "others").mapInArrow(_verified(percent), "u long, v long")


def _ordered(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("u"), F.greatest(one, other).alias("v")]


def sketch(grams: np.ndarray, most: int = SKETCH_BITS) -> bytes:
    """Parities of how many n-grams fall on each bit; a power of two of bits, four for each n-gram at least, up to a bound."""
    bits = min(max(64, 1 << (4 * len(grams) - 1).bit_length()), most)
    return np.packbits(np.bincount(grams & (bits - 1), minlength=bits) & 1, bitorder="little").tobytes()


def apart(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many bits a sketch differs from each of others, as rows of 64-bit words; the longer are folded to the shorter."""
    width = min(one.shape[-1], others.shape[-1])
    one, others = (np.bitwise_xor.reduce(x.reshape(*x.shape[:-1], -1, width), axis=-2) for x in (one, others))
    return np.bitwise_count(one ^ others).sum(axis=1, dtype=np.int64)


def _sketched(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams.values.to_numpy(zero_copy_only=False) for grams in batch.column("grams")]
            made = [pa.array([len(grams) for grams in sets], pa.int64()), pa.array([sketch(grams, most) for grams in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *made], ["node", "shared", "sketch"])

    return run


def sketches(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, shared, sketch) of the texts in crowded n-grams: how many n-grams it shares with others, and their sketch."""
    crowded = rows.groupBy("gram").agg(F.count("*").alias("size")).filter(F.col("size") > CROWDED)
    wanted = rows.join(crowded, "gram", "left_semi").select("node").distinct()
    able = nodes.filter("grams is not null").join(wanted, "node", "left_semi")
    return able.select("node", "grams").mapInArrow(_sketched(SKETCH_BITS), "node long, shared long, sketch binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by block, one table for each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tasks = batch.column("task").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tasks)) + 1).tolist(), len(tasks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and b > a and held[0].column("task")[0].as_py() != tasks[a]:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _crossed(percent: int, nearest: int):
    """Candidates of each block: rows outside the largest component of the n-gram against rows of other components.

    With ``nearest`` only the nearest sketches of so many components.
    """

    def met(rows: pa.Table) -> np.ndarray:
        node, root, n, rest, shared, probe = (rows.column(c).to_numpy() for c in ("node", "root", "n", "rest", "shared", "probe"))
        words = [np.frombuffer(x, dtype="<u8") for x in rows.column("sketch").to_pylist()]
        widths = np.array([len(x) for x in words])
        widths[probe > 0] = -1
        others = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths[probe == 0])}
        stacked = {w: np.stack([words[j] for j in at]) for w, at in others.items()}
        found = [np.zeros((2, 0), dtype=np.int64)]
        for i in np.flatnonzero(probe > 0).tolist():
            near, far = [], []
            for w, at in others.items():
                needed = -(-(n[i] + n[at]) * percent // (100 + percent))
                fits = (root[at] != root[i]) & (100 * np.minimum(n[i], n[at]) >= percent * np.maximum(n[i], n[at])) & (np.minimum(rest[i], rest[at]) >= needed)
                differ = np.zeros(int(fits.sum()), dtype=np.int64)
                if w and len(words[i]) and len(differ):
                    differ = apart(words[i], stacked[w][fits])
                    close = differ <= (shared[i] + shared[at] - 2 * needed)[fits]
                    differ, fits[fits] = differ[close], close
                near.append(at[fits])
                far.append(differ)
            at, differ = np.concatenate(near), np.concatenate(far)
            if nearest:
                at = at[np.argsort(differ, kind="stable")]
                at = at[np.sort(np.unique(root[at], return_index=True)[1])[:nearest]]
            found.append(np.stack([np.minimum(node[i], node[at]), np.maximum(node[i], node[at])]))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            found = met(rows)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["u", "v"])

    return run


def _crossing(rows: DataFrame, percent: int, block: int, nearest: int = 0) -> DataFrame:
    """All candidates (u, v) of different components; rows have columns gram, node, n, rest, root, shared, sketch.

    With ``nearest`` only so many for each row, from one block of the others.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("gram", "root").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("gram").agg(F.sum("size").alias("all"), F.max(F.struct("size", "root")).alias("most")).filter(F.col("all") > F.col("most.size"))
    cut = lambda n: F.ceil(n / block).cast("int")
    rows = rows.join(sizes.select("gram", F.col("most.root").alias("major"), cut(F.col("all") - F.col("most.size")).alias("outer"), cut(F.col("all")).alias("inner")), "gram")
    place = F.xxhash64("node")
    if nearest:
        outer, inner = F.lit(0), F.pmod(F.xxhash64(F.lit(1), "node"), F.col("inner")).cast("int")
    else:
        outer, inner = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("outer", "inner"))
    others = rows.withColumn("o", outer).withColumn("i", F.pmod(place, F.col("inner")).cast("int")).withColumn("probe", F.lit(0))
    probes = rows.filter("root <> major").withColumn("i", inner).withColumn("o", F.lit(0) if nearest else F.pmod(place, F.col("outer")).cast("int")).withColumn("probe", F.lit(1))
    both = others.unionByName(probes.select(*others.columns)).select(F.xxhash64("gram", "o", "i").alias("task"), "node", "root", "n", "probe", "rest", "shared", "sketch")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(n, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(_crossed(percent, nearest), "u long, v long").distinct()


def linked(nodes: DataFrame, percent: int = PERCENT, stars: int = STARS, block: int = BLOCK) -> DataFrame:
    """(node, root) of all nodes that link with others; nodes as ``sets_of`` gives them."""
    rows = stored(prefixes(nodes, percent), "prefixes")
    edges, tested = [], []
    roots = None

    def rooted() -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def verify(pairs: DataFrame) -> None:
        nonlocal roots
        if tested:
            pairs = pairs.join(functools.reduce(DataFrame.unionByName, tested), ["u", "v"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            return
        tested.append(pairs)
        edges.append(stored(verified(pairs, nodes, percent), "links"))
        roots = components(functools.reduce(DataFrame.unionByName, edges))

    for turn in range(stars):
        # The row that the others of an n-gram are compared with: of its largest component, the first by a hash of the turn.
        own = rooted()
        choice = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "n", "rest")).alias("head")
        heads = own.groupBy("gram", "root").agg(F.count("*").alias("size"), choice)
        heads = heads.groupBy("gram").agg(F.count("*").alias("roots"), F.max(F.struct("size", (-F.col("head.draw").cast("decimal(20,0)")).alias("order"), "root", "head")).alias("best")).filter("roots > 1")
        met = own.join(heads.select("gram", F.col("best.root").alias("major"), "best.head"), "gram").filter("root <> major")
        met = met.withColumn("mine", F.struct("node", "n", "rest")).filter(_possible(percent, "mine", "head"))
        verify(met.select(*_ordered(F.col("node"), F.col("head.node"))).distinct())
    marks = stored(sketches(nodes, rows), "sketches")
    if not marks.isEmpty():
        verify(_crossing(rooted().join(marks, "node"), percent, block, NEAREST))
    marked = rooted().join(marks, "node", "left").withColumn("shared", F.coalesce("shared", F.lit(0).cast("long"))).withColumn("sketch", F.coalesce("sketch", F.lit(b"")))
    verify(_crossing(marked, percent, block))
    return roots if roots is not None else rows.select("node", F.col("node").alias("root")).limit(0)


def join(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, stars: int = STARS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    texts = keyed.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"), F.max(F.octet_length("text")).alias("size"))
    texts = stored(texts, "texts")
    once = Once(keyed.select("node", "text"), _bitmap(texts.filter(F.col("rows") > 1)))
    nodes = sets_of(once, int(texts.agg(F.sum("size")).first()[0] or 0), width, percent)
    members = texts.join(nodes.select("node", "n"), "node").join(linked(nodes, percent, stars, block), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    members = members.join(least, "root").select("node", "n", "component_id")
    found = keyed.select("doc_id", "node").join(members, "node")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
