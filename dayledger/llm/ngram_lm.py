"""Language-model scoring with a weighted backoff automaton.

States are contexts of up to ``order - 1`` words that occur in training texts. Reading a word either
takes an arc (the context with the word occurs in training) and pays the arc's weight, or pays
the state's failure weight and tries again from the context without its first word; the root
has an arc for every word. A text is read once from left to right, carrying the state and
adding log10 probabilities.

Smoothing interpolates orders (Jelinek and Mercer): the arc of h and w weighs
``s * c(hw)/c(h) + (1 - s) * p(w | shorter h)``, failure weighs ``1 - s``, with s for each order the
share of n-gram occurrences that are not the only one of their kind (Good and Turing). The
root smooths by adding a half: ``(c + 0.5) / (N + 0.5 (V + 1))``, so probabilities of all known
words and one unknown sum to one. Texts begin in the state of the start mark and close with an end token.

Counts are of the whole training corpus. Texts are gathered in blocks; a block sends its
distinct n-grams (64-bit hashes in order, as differences) with its training counts to shards of the
hash space, these add up and answer, and the block's part of the automaton is compiled from the answers. So
no task holds more of the model than its texts reach, and a frequent n-gram is one
entry per block.

Defined results: a null text is empty and scores its end token. Without training texts every
probability of an unknown word is one. Repeated rows count and are scored as often as they occur. A
text is never divided, so a block is at least as large as its largest text. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from dayledger.llm.common import payloads, pieces, stored

_END = b" end"  # no word has a blank
_START = b" start"
_PIECE = 4096


@dataclass(frozen=True)
class Settings:
    order: int = 2
    block_bytes: int = 6 << 20
    shard_tokens: int = 2_000_000


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).tobytes())


def _expand(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising 64-bit values as differences, bytes of equal weight together."""
    steps = np.diff(values, prepend=np.uint64(0))
    return _squeeze(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(_expand(data, "u1").reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def text_blocks(docs: DataFrame, training: Column, settings: Settings) -> DataFrame:
    """(block, docs, trains, lengths, words, tokens): texts as numbers of their block's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        for number, table in enumerate(pieces(batches, "text", settings.block_bytes)):
            place: dict[bytes, int] = {_START: 0, _END: 1}
            parts, lengths = [], []
            for text in payloads(table.column("text").combine_chunks()):
                words = text.lower().split()
                for word in words:
                    if word not in place:
                        place[word] = len(place)
                parts.append(np.fromiter(map(place.__getitem__, words), dtype=np.uint32, count=len(words)))
                lengths.append(len(words))
            hashes = np.array([xxh3_64_intdigest(word) for word in place], dtype=np.uint64)
            tokens = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
            columns = [pa.array([first + number]), pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([table.column("training").to_pylist()], pa.list_(pa.bool_()))]
            columns += [pa.array([lengths], pa.list_(pa.int64())), pa.array([hashes.tobytes()], pa.binary()), pa.array([_squeeze(tokens)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "docs", "trains", "lengths", "words", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), "text")
    return rows.mapInArrow(run, "block long, docs array<long>, trains array<boolean>, lengths array<long>, words binary, tokens binary")


@dataclass(frozen=True)
class Grams:
    """A block's token rows with start and end marks, and its distinct n-grams of each order."""

    words: np.ndarray  # of each token, place in the block's words
    doc: np.ndarray  # of each token
    step: np.ndarray  # tokens before it in its text, the start mark being 0
    distinct: list[np.ndarray]  # by order, from 1: rising hashes
    at: list[np.ndarray]  # by order: for each token the place of the n-gram that ends there, or -1


def grams(hashes: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, order: int) -> Grams:
    size = lengths + 2
    ends = np.cumsum(size)
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), size)
    step = (np.arange(len(doc)) - np.repeat(ends - size, size)).astype(np.int32)
    words = np.ones(len(doc), dtype=np.int32)  # the end token
    words[step == 0] = 0
    words[(step > 0) & (step < np.repeat(size, size) - 1)] = tokens
    value = hashes[words]
    distinct, at, gram = [], [], value
    for k in range(1, order + 1):
        if k > 1:
            longer = np.zeros_like(gram)
            longer[1:] = (gram[:-1] ^ (gram[:-1] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + value[1:]
            gram = longer * np.uint64(0xFF51AFD7ED558CCD)
            gram ^= gram >> np.uint64(32)
        there = np.flatnonzero(step >= k - 1)
        found, place = np.unique(gram[there], return_inverse=True)
        index = np.full(len(doc), -1, dtype=np.int32)
        index[there] = place
        distinct.append(found)
        at.append(index)
    return Grams(words, doc, step, distinct, at)


def _of_row(row: dict, order: int) -> Grams:
    hashes = np.frombuffer(row["words"], dtype=np.uint64)
    return grams(hashes, np.array(row["lengths"], dtype=np.int64), _expand(row["tokens"], "<u4"), order)


def _cuts(values: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of hashes begins among rising values."""
    edges = np.array([(i << 64) // shards for i in range(shards)], dtype=np.uint64)
    return np.append(np.searchsorted(values, edges), len(values))


def requests(blocks: DataFrame, shards: int, order: int) -> DataFrame:
    """(gram_order, shard, block, keys, counts): each block's distinct n-grams by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                own = _of_row(row, order)
                trains = np.array(row["trains"], dtype=bool)[own.doc]
                for k in range(order):
                    index = own.at[k]
                    counts = np.bincount(index[(index >= 0) & trains], minlength=len(own.distinct[k])).astype("<u4")
                    cut = _cuts(own.distinct[k], shards)
                    full = [s for s in range(shards) if cut[s + 1] > cut[s]]
                    keys = [pack_sorted(own.distinct[k][cut[s] : cut[s + 1]]) for s in full]
                    number = [_squeeze(counts[cut[s] : cut[s + 1]]) for s in full]
                    columns = [pa.array([k + 1] * len(full), pa.int32()), pa.array(full, pa.int64()), pa.array([row["block"]] * len(full), pa.int64()), pa.array(keys, pa.binary()), pa.array(number, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["gram_order", "shard", "block", "keys", "counts"])

    return blocks.mapInArrow(run, "gram_order int, shard long, block long, keys binary, counts binary")


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    """A shard's answer to each block, and in one more row (no block) what it knows of the corpus."""
    keys = [unpack_sorted(x) for x in group["keys"]]
    counts = np.concatenate([_expand(x, "<u4") for x in group["counts"]]).astype(np.int64)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(every)).astype(np.int64)
    answers = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
    out = group[["gram_order", "shard", "block"]].assign(answer=[_squeeze(a.astype("<u8")) for a in answers], tokens=0, kinds=0, single=0)
    order = int(group["gram_order"].iloc[0])
    if order == 1:  # the start mark is a context, not a token
        total = total[every != np.uint64(xxh3_64_intdigest(_START))]
    known = {"gram_order": order, "shard": group["shard"].iloc[0], "block": None, "answer": None, "tokens": total.sum(), "kinds": (total > 0).sum(), "single": (total == 1).sum()}
    return pd.concat([out.astype({"block": "Int64"}), pd.DataFrame([known]).astype({"block": "Int64"})], ignore_index=True)


_ANSWER = "gram_order int, shard long, block long, answer binary, tokens long, kinds long, single long"


@dataclass(frozen=True)
class Corpus:
    tokens: int
    kinds: int
    shares: list[float]  # of seen mass, for orders from 2


def corpus_of(answers: DataFrame, order: int) -> Corpus:
    sums = {r["gram_order"]: r for r in answers.filter("block is null").groupBy("gram_order").agg(*[F.sum(c).alias(c) for c in ("tokens", "kinds", "single")]).collect()}
    shares = []
    for k in range(2, order + 1):
        row = sums.get(k)
        shares.append(min(0.95, 1 - row["single"] / row["tokens"]) if row and row["tokens"] else 0.0)
    return Corpus(int(sums[1]["tokens"]) if 1 in sums else 0, int(sums[1]["kinds"]) if 1 in sums else 0, shares)


@dataclass(frozen=True)
class Automaton:
    """Of a block: by order, whether each distinct n-gram is in training, and its arc's weight."""

    known: list[np.ndarray]
    weight: list[np.ndarray]
    failure: list[float]  # of a state with as many words as the place in the list; the root has none


def compile_automaton(own: Grams, counts: list[np.ndarray], corpus: Corpus) -> Automaton:
    p = [(counts[0] + 0.5) / (corpus.tokens + 0.5 * (corpus.kinds + 1))]
    known = [counts[0] > 0]
    for k in range(1, len(counts)):
        at = own.at[k]
        token = np.zeros(len(counts[k]), dtype=np.int64)
        there = np.flatnonzero(at >= 0)
        token[at[there]] = there  # any place where the n-gram ends
        share, context, shorter = corpus.shares[k - 1], own.at[k - 1][token - 1], own.at[k - 1][token]
        seen = counts[k] > 0
        p.append(np.where(seen, share * counts[k] / np.maximum(1, counts[k - 1][context]) + (1 - share) * p[k - 1][shorter], 1.0))
        known.append(seen)
    return Automaton(known, [np.log10(x) for x in p], [0.0, *(float(np.log10(1 - s)) for s in corpus.shares)])


def traverse(own: Grams, automaton: Automaton, texts: int) -> np.ndarray:
    """log10 probability of each text: all texts are read side by side, a token of each at a time.

    Long texts are read in pieces; a piece starts at the root and first reads as many earlier
    tokens as a state can hold, without adding them, which leads to the state carried over.
    """
    order = len(automaton.known)
    back = order - 1
    start = np.flatnonzero(own.step == 0)
    length = np.diff(np.append(start, len(own.step)))
    count = np.maximum(1, -(-(length - 1) // _PIECE))
    doc = np.repeat(np.arange(texts), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = start[doc] + 1 + nth * _PIECE  # the first token that counts
    end = np.minimum(begin + _PIECE, (start + length)[doc])
    lead = np.minimum(back, begin - start[doc])  # tokens read before it
    run = end - begin + lead
    by = np.argsort(-run, kind="stable")
    doc, begin, run, lead = doc[by], begin[by], run[by], lead[by]
    at = begin - lead
    state = np.zeros(len(doc), dtype=np.int64)  # words of context
    total = np.zeros(len(doc))
    live = len(doc)
    for t in range(int(run[0]) if len(run) else 0):
        live = int(np.searchsorted(-run, -t, side="left"))
        token, here = at[:live] + t, state[:live]
        paid = np.zeros(live)
        reached = np.zeros(live, dtype=np.int64)
        open_ = np.ones(live, dtype=bool)
        for k in range(order, 0, -1):  # an arc of order k leaves a state with k - 1 words
            trying = np.flatnonzero(open_ & (here >= k - 1))
            gram = own.at[k - 1][token[trying]]
            found = (gram >= 0) & ((automaton.known[k - 1][gram]) if k > 1 else np.ones(len(gram), dtype=bool))
            hit = trying[found]
            paid[hit] += automaton.weight[k - 1][gram[found]]
            # After an unknown word the state is the root.
            reached[hit] = k if k > 1 else automaton.known[0][gram[found]]
            open_[hit] = False
            if k > 1:
                paid[trying[~found]] += automaton.failure[k - 1]
        state[:live] = np.minimum(reached, back)
        total[:live] += np.where(t >= lead[:live], paid, 0.0)
    return np.bincount(doc, weights=total, minlength=texts)


def _score_block(order: int, corpus: Corpus):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        answered = group[group["answer"].notna()].sort_values(["gram_order", "shard"])
        row = group[group["answer"].isna()].iloc[0]
        own = _of_row(row, order)
        counts = []
        for k in range(1, order + 1):
            parts = [_expand(a, "<u8").astype(np.int64) for a in answered[answered["gram_order"] == k]["answer"]]
            counts.append(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))
            if len(counts[-1]) != len(own.distinct[k - 1]):
                raise RuntimeError("a block's n-grams and their counts differ in number")
        texts = len(row["docs"])
        score = traverse(own, compile_automaton(own, counts, corpus), texts)
        real = own.step > 0
        c = counts[0][own.at[0][real]]
        doc = own.doc[real]
        base = np.bincount(doc, weights=np.log10((c + 0.5) / (corpus.tokens + 0.5 * (corpus.kinds + 1))), minlength=texts)
        known = np.bincount(doc, weights=c > 0, minlength=texts).astype(np.int64)
        return pd.DataFrame({"doc_id": pd.array(list(row["docs"]), dtype="Int64"), "training": list(row["trains"]), "n_tokens": np.bincount(doc, minlength=texts), "n_known": known, "base_score": base, "score": score})

    return run


def score(docs: DataFrame, training: Column, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    order = settings.order
    blocks = stored(text_blocks(docs, training, settings), "text-blocks")
    tokens = blocks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    shards = max(1, -(-tokens // settings.shard_tokens))
    answers = stored(requests(blocks, shards, order).groupBy("gram_order", "shard").applyInPandas(_add_up, _ANSWER), "counts")
    corpus = corpus_of(answers, order)
    mine = answers.filter("block is not null").select("block", "gram_order", "shard", "answer")
    both = blocks.unionByName(mine, allowMissingColumns=True)
    scored = both.groupBy("block").applyInPandas(_score_block(order, corpus), "doc_id long, training boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))
