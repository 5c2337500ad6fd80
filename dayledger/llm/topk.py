"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, block by block. No scores are kept: a pass
counts each query's scores in equal bins of its interval, the counts of all candidate blocks
are added, and the interval shrinks to the bin that holds the k-th highest score. With ``bins``
bins it takes a few passes until a bin is one integer wide: the k-th value. A last pass
emits the scores above it, and of those equal to it as many as are missing, least id first.

The k-th score of all candidates is no lower than that of a part of them. So the first interval begins at
the best k-th score that a block is sure of, if any block has k, and a task need not report bins below its own
k-th score: a pass sends at most k bins per query and task.

Blocks have a fixed number of vectors, whose components take as few bytes as they fit in. Blocks of candidates
are in groups, blocks of queries in slices. Each task of a pass holds one group, through which it runs one slice, so
a pass shuffles the candidates once for each slice and the queries once for each group. Intervals
stay one row per block of queries. No row of vectors or intervals is broadcast or comes to the driver.

Components are turned into ``floor(scale * x)``. Defined results: null vectors and vectors with null or
non-finite components take no part; vectors of different lengths have no score with each other; a candidate is not its query's result,
by id; a query with fewer than k candidates gets all. Repeated ids count once per
row. Integer scores beyond 2**53 are computed in 64 bits and wrap around beyond 2**63.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.common import stored

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
OWN = ["q_block", "dim"]
# Scores that are held at once, products of components in a task's share of a pass, tasks of a pass, and bytes of a group or slice.
TILE, WORK, TASKS, HELD = 1 << 21, 1 << 33, 1 << 8, 1 << 25


@dataclass(frozen=True)
class Settings:
    k: int = 20
    scale: float = 64.0
    bins: int = 256
    query_block: int = 2048
    candidate_block: int = 8192


def quantised(vectors: DataFrame, scale: float) -> DataFrame:
    """(id, v): integer vectors of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    return rows.select(F.col("vec_id").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


def _least(v: np.ndarray) -> np.ndarray:
    """The same integers, of as few bytes as they fit in."""
    low, high = v.min(initial=0), v.max(initial=0)
    return v.astype(next(kind for kind in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max))


def _record(kinds: dict[str, pa.DataType], *row: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds.values(), strict=True)], list(kinds))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block and vector length: ids and components as bytes."""
    held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        block, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "id"))
        column = batch.column("v")
        starts, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        lengths = np.diff(starts)
        for key in sorted(set(zip(block.tolist(), lengths.tolist(), strict=True))):
            at = np.flatnonzero((block == key[0]) & (lengths == key[1]))
            held.setdefault(key, []).append((ids[at], _least(values[starts[at][:, None] + np.arange(key[1])])))
    kinds = {"block": pa.int64(), "dim": pa.int64(), "n": pa.int64(), "ids": pa.binary(), "data": pa.binary()}
    for block, dim in sorted(held):
        ids, data = (np.concatenate(x) for x in zip(*held.pop((block, dim)), strict=True))
        order = np.argsort(ids, kind="stable")
        yield _record(kinds, block, dim, len(ids), ids[order].astype(np.int64).tobytes(), data[order].tobytes())


def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows dealt by hash to blocks of about ``size``, one packed row each; and the number of blocks."""
    n = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n))).repartition(n, "block").sortWithinPartitions("block")
    return stored(dealt.mapInArrow(_packed, "block long, dim long, n long, ids binary, data binary"), name), n


class _Block:
    """Vectors of a block that have one length, by id; of a block of queries with their intervals."""

    def __init__(self, row: dict):
        self.number, self.dim, self.ids = row["block"], row["dim"], np.frombuffer(row["ids"], dtype=np.int64)
        cells = len(self.ids) * self.dim
        self.data = np.frombuffer(row["data"], dtype=f"i{len(row['data']) // cells if cells else 1}").reshape(len(self.ids), self.dim)
        self.largest = max(-int(self.data.min(initial=0)), int(self.data.max(initial=0)))
        self.low, self.width, self.missing = (None if row[x] is None else np.frombuffer(row[x], dtype=np.int64) for x in ("low", "width", "missing"))


def _scores(q: _Block, c: _Block) -> Iterator[tuple[int, int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """Matrices of integer scores of some queries in turn: first query, end, scores, and the places of equal ids in them."""
    most = q.largest * c.largest * max(1, q.dim)
    # Sums that a kind of float holds exactly; others in 64 bits.
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    side, other = q.data.astype(kind), c.data.astype(kind).T
    begin, end = np.searchsorted(c.ids, q.ids, "left"), np.searchsorted(c.ids, q.ids, "right")
    step = max(1, TILE // len(c.ids))
    for start in range(0, len(q.ids), step):
        stop = min(start + step, len(q.ids))
        count = (end - begin)[start:stop]
        same = np.repeat(np.arange(stop - start), count)
        yield start, stop, side[start:stop] @ other, (same, np.arange(len(same)) - np.repeat(np.cumsum(count) - count - begin[start:stop], count))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, list[_Block]]]:
    """Each block of queries with the blocks of candidates of its task and length, which come first in a task."""
    task, held = None, {}
    for row in _rows(batches):
        if row["task"] != task:
            task, held = row["task"], {}
        if not row["asked"]:
            held.setdefault(row["dim"], []).append(_Block(row))
        elif row["dim"] in held:
            yield _Block(row), held[row["dim"]]


def _sure(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The highest score of each row, and a score that at least k of the row reach: the k-th of highest ones of k and more parts."""
    n = scores.shape[1]
    parts = min(n, 8 * k)
    whole = n // parts * parts
    best = scores[:, :whole].reshape(len(scores), -1, parts).max(axis=1)
    if whole < n:
        np.maximum(best[:, : n - whole], scores[:, whole:], out=best[:, : n - whole])
    return best.max(axis=1), np.partition(best, parts - k, axis=1)[:, parts - k] if k <= parts else None


def _range_pass(k: int):
    """Each query's lowest and highest score in the task's candidates, how many scores there are, and a score that k of them reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, candidates in _met(batches):
            low, high, sure, n = (np.full(len(q.ids), x, dtype=np.int64) for x in (MOST, LEAST, LEAST, 0))
            for c in candidates:
                for start, stop, scores, same in _scores(q, c):
                    at, exact = slice(start, stop), scores.dtype == np.int64
                    others = len(c.ids) - np.bincount(same[0], minlength=stop - start)
                    scores[same] = MOST if exact else np.inf
                    lowest = scores.min(axis=1)
                    scores[same] = LEAST if exact else -np.inf
                    highest, reached = _sure(scores, k)
                    some = others > 0
                    n[at] += others
                    low[at][some] = np.minimum(low[at][some], lowest[some].astype(np.int64))
                    high[at][some] = np.maximum(high[at][some], highest[some].astype(np.int64))
                    if reached is not None:
                        enough = others >= k
                        enough[enough] = reached[enough] > (LEAST if exact else -np.inf)
                        sure[at][enough] = np.maximum(sure[at][enough], reached[enough].astype(np.int64))
            yield _record(RANGES, q.number, q.dim, *(x.tobytes() for x in (low, high, sure, n)))

    return run


def _running(cells: np.ndarray, counts: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells that differ, their places and counts, and how many scores of the place lie in higher bins. Cells count bins from the top down."""
    cells, where = np.unique(cells, return_inverse=True)
    total = np.zeros(len(cells), dtype=np.int64)
    np.add.at(total, where, counts)
    place, before = cells // bins, np.cumsum(total) - total
    return cells, place, total, before - before[np.searchsorted(place, place, "left")]


def _found(q: _Block, c: _Block, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places of queries, of candidates, scores) that are no lower than ``low``, of wanted queries, by place."""
    for start, stop, scores, _ in _scores(q, c):
        # A limit that a float rounds is beyond all scores of the block.
        at = np.flatnonzero(scores >= np.where(wanted, q.low, MOST)[start:stop, None].astype(scores.dtype))
        row, column = at // len(c.ids) + start, at % len(c.ids)
        score = scores.ravel()[at].astype(np.int64)
        other = wanted[row] & (q.ids[row] != c.ids[column])
        yield row[other], column[other], score[other]


def _step(width: np.ndarray, bins: int) -> np.ndarray:
    return np.maximum(1, (width - 1) // bins + 1)


def _count_pass(bins: int):
    """Counts of each query's scores by bin, from the top down to the k-th score of the task's candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, candidates in _met(batches):
            step, cells = _step(q.width, bins), [(np.zeros(0, dtype=np.int64),) * 2]
            for c in candidates:
                for place, _, score in _found(q, c, q.width > 1):  # one is the k-th value already
                    inside = score - q.low[place] < q.width[place]
                    place, score = place[inside], score[inside]
                    cells.append(np.unique(place * bins + bins - 1 - (score - q.low[place]) // step[place], return_counts=True))
            cell, place, count, above = _running(*(np.concatenate(x) for x in zip(*cells, strict=True)), bins)
            good = above < q.missing[place]
            yield _record(COUNTS, q.number, q.dim, cell[good].tobytes(), count[good].tobytes())

    return run


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores above the k-th value, and of those equal to it each block's least ids."""
    for q, candidates in _met(batches):
        for c in candidates:
            for place, column, score in _found(q, c, q.missing > 0):
                equal = score == q.low[place]
                ties = np.cumsum(equal) - equal
                kept = ~equal | (ties - ties[np.searchsorted(place, place, "left")] < q.missing[place])  # ids rise within a block
                yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (q.ids[place], c.ids[column], score)], ["query_id", "vec_id", "score"])


RANGES = {"q_block": pa.int64(), "dim": pa.int64(), "low": pa.binary(), "high": pa.binary(), "sure": pa.binary(), "n": pa.binary()}
COUNTS = {"q_block": pa.int64(), "dim": pa.int64(), "cell": pa.binary(), "count": pa.binary()}
STATE = {"q_block": pa.int64(), "dim": pa.int64(), "low": pa.binary(), "width": pa.binary(), "missing": pa.binary(), "widest": pa.int64()}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {'long' if kind == pa.int64() else 'binary'}" for name, kind in kinds.items())


def _arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.frombuffer(value, dtype=np.int64) for value in table[name].to_pylist()]


def _state(key: tuple, low: np.ndarray, width: np.ndarray, missing: np.ndarray) -> pa.Table:
    return pa.Table.from_batches([_record(STATE, *(x.as_py() for x in key), low.tobytes(), width.tobytes(), missing.tobytes(), int(width.max(initial=0)))])


def _intervals(k: int):
    """The first interval of each query of a block, from the ranges of all tasks."""

    def run(key: tuple, ranges: pa.Table) -> pa.Table:
        low, high, sure, n = (reduce(_arrays(ranges, name)) for name, reduce in (("low", np.minimum.reduce), ("high", np.maximum.reduce), ("sure", np.maximum.reduce), ("n", np.add.reduce)))
        low, some = np.where(sure > LEAST, sure, low), n > 0
        width = np.where(some, high - np.where(some, low, high) + 1, 0)
        if (width[some] < 1).any():
            raise OverflowError("scores of one query lie further apart than 64 bits tell")
        return _state(key, np.where(some, low, 0), width, np.minimum(n, k))

    return run


def _narrowed(bins: int):
    """Each interval shrunk to the bin in which the running count from the top reaches what is missing."""

    def run(key: tuple, counts: pa.Table, state: pa.Table) -> pa.Table:
        low, width, missing = (_arrays(state, name)[0].copy() for name in ("low", "width", "missing"))
        cell, place, count, above = _running(*(np.concatenate(_arrays(counts, name)) for name in ("cell", "count")), bins)
        hit = (above < missing[place]) & (above + count >= missing[place])
        place, number, above = place[hit], bins - 1 - cell[hit] % bins, above[hit]
        if not np.array_equal(place, np.flatnonzero(width > 1)):
            raise RuntimeError("the counts of a query end before its k-th score")
        step = _step(width, bins)[place]
        low[place] += number * step
        width[place] = np.minimum(step, width[place] - number * step)
        missing[place] -= above
        return _state(key, low, width, missing)

    return run


def _tasks(queries: DataFrame, candidates: DataFrame, most_slices: int, most_groups: int) -> tuple[int, int]:
    """Numbers of slices of queries and groups of candidates: bounded in bytes, and with the least shuffled."""
    size = [F.sum(F.octet_length("ids") + F.octet_length("data")), F.sum("n"), F.sum(F.col("n") * F.col("dim"))]
    (q_bytes, q, _), (c_bytes, _, c_cells) = ([x or 0 for x in side.agg(*size).first()] for side in (queries, candidates))
    tasks = min(TASKS, ceil(q * c_cells / WORK))
    groups = min(most_groups, max(1, ceil(c_bytes / HELD), min(tasks, ceil(sqrt(tasks * c_bytes / max(1, q_bytes))))))
    slices = min(most_slices, max(1, ceil(q_bytes / HELD), ceil(tasks / groups)))
    return slices, min(most_groups, max(groups, ceil(tasks / slices)))


def top_k(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query. ``is_query``: of ``vec_id``."""
    k, bins = settings.k, settings.bins
    rows = quantised(vectors, settings.scale)
    asked = quantised(vectors.filter(is_query), settings.scale)
    candidates, c_blocks = blocks(rows, settings.candidate_block, "candidates")
    queries, q_blocks = blocks(asked, settings.query_block, "queries")
    slices, groups = _tasks(queries, candidates, q_blocks, c_blocks)
    interval = ["low", "width", "missing"]

    def every(first: Column, step: int, n: int) -> Column:
        return F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: first + i * step)).alias("task")

    held = candidates.select(every(F.col("block") % groups * slices, 1, slices), F.lit(False).alias("asked"), "block", "dim", "ids", "data", *(F.lit(None).cast("binary").alias(x) for x in interval))

    def meet(state: DataFrame, work: Callable, schema: str) -> DataFrame:
        """What a pass makes of each block of queries and group of candidates."""
        sent = state.select(every(F.col("block") % slices, slices, groups), F.lit(True).alias("asked"), "block", "dim", "ids", "data", *interval)
        return held.unionByName(sent).repartition(slices * groups, "task").sortWithinPartitions("task", "asked", "block").mapInArrow(work, schema)

    def known(state: DataFrame) -> DataFrame:
        # Merged, as what is small in a file may not be small in the driver.
        return queries.join(state.withColumnRenamed("q_block", "block").hint("merge"), ["block", "dim"])

    ranges = meet(queries.select("*", *(F.lit(None).cast("binary").alias(x) for x in interval)), _range_pass(k), _ddl(RANGES))
    state = stored(ranges.groupBy(*OWN).applyInArrow(_intervals(k), _ddl(STATE)), "intervals")
    while (state.agg(F.max("widest")).first()[0] or 0) > 1:
        counts = meet(known(state), _count_pass(bins), _ddl(COUNTS))
        state = stored(counts.groupBy(*OWN).cogroup(state.groupBy(*OWN)).applyInArrow(_narrowed(bins), _ddl(STATE)), "intervals")
    # What is above the k-th value is k - missing scores, so the window holds k rows and the blocks' ties.
    best = meet(known(state), _last_pass, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
