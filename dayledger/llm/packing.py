"""Packing: first-fit decreasing with a tournament tree of bin capacities, in random groups.

Texts become token ids with a public tokenizer and one end id. A document is cut into pieces of
at most ``capacity`` ids: full ones, and a rest. The stored pieces are numbered and dealt by a hash of the number to groups of about
``group_pieces``, and every group is packed on its own: pieces by falling length, each into
the first sequence with room. A tournament tree over the sequences, whose inner nodes hold the
greatest room below them, finds that sequence in a logarithmic number of steps.

Groups grow in number, not in size, and no document or doc_id, not even none, weighs on one group, as pieces are
dealt one by one. All that is lost to padding is the open end of each group's last sequences.

Defined results: a null or empty text is one piece, the end id. Repeated rows are packed once
each. Pieces of equal length go by (doc_id, start). No document, no sequence. Further columns of
the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import payloads, stored

CAPACITY = 4096
_CACHE = 100_000
# The tokenizer's own rule for words, over plain characters in lower case (fixed values).
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]*")
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return {byte: byte if byte in plain else next(others) for byte in range(256)}


class Encoder:
    """Texts to little-endian 32-bit ids, equal to the tokenizer's own, each distinct word encoded once.

    For a byte-level vocabulary of lower-cased words whose splitting rule is ``_WORDS``. Stretches
    between blanks do not depend on each other. Those of plain characters (ASCII and Latin-1
    letters, which no normal form changes) are split here and their words given to the
    tokenizer's model; others go through the whole tokenizer. Caches are emptied when full.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        words = _WORDS.findall(text.lower())
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            if len(self.words) > _CACHE:
                self.words.clear()
            for word in [word for word in set(words) if word not in self.words]:
                spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                self.words[word] = array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()
            return b"".join(map(self.words.__getitem__, words))

    def _other(self, stretch: str) -> bytes:
        if len(self.stretches) > _CACHE // 4:
            self.stretches.clear()
        if stretch not in self.stretches:
            ids = self.tokenizer.encode(stretch, add_special_tokens=False).ids
            self.stretches[stretch] = array("I", ids).tobytes()
        return self.stretches[stretch]

    def __call__(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return self._plain(text)
        parts = text.replace("\n", " ").split(" ")
        return b"".join(self._plain(part) if _PLAIN.fullmatch(part) and "<|" not in part else self._other(part) for part in parts)


def tokenised(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: where it starts in its document, its length and the crc32 of its ids."""
    end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)  # its caches end with the task
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), payloads(batch.column("text")), strict=True):
                ids = encode(text.decode("utf-8", "replace")) + end
                total = len(ids) // 4
                rows += [(doc, at // 4, len(part := ids[at : at + step]) // 4, zlib.crc32(part), total) for at in range(0, len(ids), step)]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


class Tournament:
    """First sequence with enough room, by a tree whose nodes hold the greatest room below them."""

    def __init__(self, sequences: int, capacity: int) -> None:
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The sequence, and the room that it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        before = room[node]
        room[node] = before - length
        leaf = node
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return leaf - self.leaves, before


def first_fit_decreasing(lengths: Iterable[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; the lengths must fall."""
    lengths = list(lengths)
    tree = Tournament(len(lengths), capacity)
    sequence, offset = [], []
    for length in lengths:
        at, before = tree.place(length)
        sequence.append(at)
        offset.append(capacity - before)
    return sequence, offset


def _pack_group(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "number"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = first_fit_decreasing(group["length"], capacity)
        return group.assign(sequence_id=group["bin_group"] * (1 << 32) + np.array(sequence, dtype=np.int64), offset=offset).drop(columns=["bin_group", "number"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = 4096, seed: int = 5) -> DataFrame:
    """Give every piece its sequence and its offset in it; ``number`` tells the pieces apart."""
    groups = max(1, round(pieces.count() / group_pieces))
    dealt = pieces.withColumn("bin_group", F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("bin_group").applyInPandas(_pack_group(capacity), _PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents."""
    pieces = tokenised(docs, tokenizer, end_id, capacity).withColumn("number", F.monotonically_increasing_id())
    return pack(stored(pieces, "pieces"), capacity)
