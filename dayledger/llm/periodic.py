"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, at
least ``exponent`` periods and ``least`` words long. Each of its words occurs in it at least ``exponent`` times.

1. Splitting: in each segment (first, a text) words that occur fewer than ``exponent`` times belong to no run and split it.
   Words are counted again in the parts, until no part loses a word. Parts shorter than ``least`` words go. All segments of
   several texts take each step together, and only those that lost words are looked at again.
2. Lags: what survives is joined with separators, longest segments first. For a lag q only segments of at least
   ``exponent * q`` words count. A run of period q contains whole blocks between multiples of q, and these blocks are equal: their
   hashes, differences of one running sum, are compared at the multiples alone, so all lags together take about n log n
   steps. Around equal blocks the words themselves are compared at distance q. A stretch that was found with
   a smaller period is no new run, as that period then divides q; within it, multiples of its period are not compared again.

Defined results: null and empty texts have no words and no run; their collapsed text is empty. Repeated rows, and rows without
doc_id, are judged each for itself. Runs are sorted by start, then period, and may overlap. Texts of any length are split into
words in stretches. No rows give no rows. Further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import payloads, pieces

EXPONENT = 4
LEAST = 6
_GATHERED = 4 << 20
_STRETCH = 1 << 20
_BLANK = re.compile(rb"[ \t\n\r\x0b\f]")
_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + _STRETCH
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        yield text[at:end].split()
        at = end


def word_numbers(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    parts = [np.fromiter((known.setdefault(word, len(known)) for word in words), dtype=np.int64) for words in _stretches(text)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def survivors(words: np.ndarray, segment: np.ndarray, exponent: int, least: int) -> list[tuple[int, int]]:
    """(start, end) of the segments that no rare word splits; ``segment`` numbers the words' texts, in order."""
    place, done = np.arange(len(words)), []
    while len(place):
        now, own = words[place], segment
        distinct, at = np.unique(now, return_inverse=True)
        _, group, counts = np.unique(own * len(distinct) + at, return_inverse=True, return_counts=True)
        kept = counts[group] >= exponent
        lost = np.bincount(own, weights=~kept) > 0
        place, own = place[kept], own[kept]
        if not len(place):
            break
        first = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(own) != 0)])
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(place)))
        stable = ~lost[own[starts]]
        done += [(a, a + n) for a, n in zip(place[starts[stable & (lengths >= least)]].tolist(), lengths[stable & (lengths >= least)].tolist(), strict=True)]
        again = ~stable & (lengths >= least)
        segment = np.repeat(np.cumsum(again) - 1, lengths)[np.repeat(again, lengths)]
        place = place[np.repeat(again, lengths)]
    return done


def _mixed(words: np.ndarray) -> np.ndarray:
    value = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def lag_scan(words: np.ndarray, segments: list[tuple[int, int]], exponent: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs within the segments."""
    segments = sorted(segments, key=lambda s: s[0] - s[1])
    if not segments:
        return []
    # Segments one after another, a number of its own between them.
    sizes = np.array([b - a for a, b in segments], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    line = np.full(begins[-1], -1, dtype=np.int64)
    for (a, b), at in zip(segments, begins.tolist(), strict=False):
        line[at : at + b - a] = words[a:b]
    line[begins[1:] - 1] = -1 - np.arange(len(segments))
    base = 0xD1342543DE82EF95
    powers = np.full(len(line), base, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(line) * powers, dtype=np.uint64)])
    found: dict[tuple[int, int], int] = {}
    known = np.zeros((0, 3), dtype=np.int64)
    shift = 1
    for lag in range(1, int(sizes[0]) // exponent + 1):
        shift = shift * base % (1 << 64)
        until = int(begins[np.searchsorted(-sizes, -exponent * lag, side="right")])
        blocks = np.diff(sums[: until + 1 : lag])
        # A run holds at least exponent - 1 whole blocks, so exponent - 2 pairs of equal neighbours.
        equal = blocks[1:] == blocks[:-1] * np.uint64(shift)
        if not equal.any():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]])))
        for j, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - j < exponent - 2:
                continue
            low, high = j * lag, (end + 1) * lag
            if len(known) and ((known[:, 0] <= low) & (known[:, 1] >= high) & (lag % known[:, 2] == 0)).any():
                continue
            low, high = max(0, low - lag), min(len(line), high + lag)
            same = line[low : high - lag] == line[low + lag : high]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
            for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
                run = (low + a, low + b + lag)
                if run[1] - run[0] >= max(least, exponent * lag) and run not in found:
                    found[run] = lag
                    known = np.append(known, [[*run, lag]], axis=0)
    runs = []
    for (a, b), lag in found.items():
        number = int(np.searchsorted(begins, a, side="right")) - 1
        back = segments[number][0] - int(begins[number])
        runs.append((a + back, b + back, lag))
    return runs


def runs_of(texts: list[np.ndarray], exponent: int = EXPONENT, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, given as numbers of words."""
    begins = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    words = np.concatenate([*texts, np.zeros(0, dtype=np.int64)])
    segment = np.repeat(np.arange(len(texts)), np.diff(begins))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b, period in lag_scan(words, survivors(words, segment, exponent, least), exponent, least):
        number = int(np.searchsorted(begins, a, side="right")) - 1
        found[number].append((a - int(begins[number]), b - a, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def _collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one blank, of each run only the first period."""
    parts, at = [], 0
    cuts = sorted((start + period, start + length) for start, length, period in runs)
    for words in _stretches(text):
        for a, b in reversed(cuts):
            if a < at + len(words) and b > at:
                words = words[: max(0, a - at)] + [None] * (min(b - at, len(words)) - max(0, a - at)) + words[max(0, b - at) :]
        at += len(words)
        if kept := [word for word in words if word is not None]:
            parts.append(b" ".join(kept))
    return b" ".join(parts).decode("utf-8", "replace")


def _judge(exponent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pieces(batches, "text", _GATHERED):
            texts, known = payloads(table.column("text").combine_chunks()), {}
            numbers = [word_numbers(text, known) for text in texts]
            found = runs_of(numbers, exponent, least)
            lists = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns = [
                table.column("doc_id").combine_chunks(),
                pa.array([len(words) for words in numbers], pa.int64()),
                pa.array(lists, kind),
                pa.array([_collapsed(text, runs) for text, runs in zip(texts, found, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs, and its text with one period of each run."""
    if exponent < 3:
        raise ValueError("at least three periods")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_judge(exponent, least), f"doc_id long, n_words long, runs {_RUN}, collapsed string")


def words(text: Column) -> Column:
    """The words of a text column as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\x0B\f]+"), lambda word: word != "")


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, the first of equal ones; null without runs."""
    better = lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.get(runs, F.lit(0)), better))
