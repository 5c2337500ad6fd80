"""Benchmark decontamination by template canonicalisation.

Benchmark items and documents are read as templates: numbers, units and names become typed
placeholders, other words are lower-cased and lose the marks around them. A second reading takes names for
words, for copies in other letter case; a third one takes capitalised words at the start of sentences for
names; a fourth one takes everything for words, numbers by their value and with the signs between them, so it finds exact copies
only. Letters of scripts that are written without blanks are tokens each. Windows of eight
template tokens (all of an item, if it is shorter) meet in a hash join; the hash holds the
template and which of its slots have equal values. Windows of one item on one
diagonal (place in the document minus place in the item) are then checked together: the item's slot
values must map to the document's one to one. So a question asked again with other numbers is
found, and a text that only has the same outline with clashing values is not.

A word that starts a sentence may stand for another only if it is a name: no function word, and in
documents and benchmark not more often in lower case than capitalised within sentences. Only words that the windows met ask
about are counted, in a second pass over the texts.

A document is contaminated if one item has ``least_windows`` consistent windows in it (all
of them, if it has fewer).

Documents are filtered by a bitmap of fixed size over the hashes of the benchmark's windows
before the join; it passes more as the benchmark grows, and the join decides in any case.
Items with one text are one item, the one with the least item_id. Otherwise every item keeps all
its windows, also those it shares with others. A match needs ``least_windows`` of an item's windows, so it has one
of them even if the ``least_windows - 1`` most common ones are left out: only the others are
looked up in the join, and all windows of an item are then compared where one was met. A
beginning that many items share thus meets nothing, unless it is long enough to be a match.

Defined results: null and empty texts, and items of nothing but signs, match nothing; items with fewer than ``least_tokens``
tokens, and windows with fewer than half plain words, are found in exact copies only. An empty benchmark
contaminates nothing. Repeated rows get one result each; documents are told apart by their whole text, so different texts of one doc_id, or of
none, are different documents. A long text is read as a whole, in one piece. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from dayledger.llm.common import payloads, pieces, stored, text_keys

UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles meter meters metre metres "
    "mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons ml l liter liters litre litres "
    "second seconds sec minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees mph kmh kph watt watts volt volts"
)
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"

OPENERS = (
    "a an the this that these those if when while where what which who whom whose why how there here it he she they we i you "
    "his her its their our my your is are was were be do does did can could will would shall should may might must has have had "
    "in on at of for from to by with and or but not no so as than then let find given suppose each every all some any after before"
)

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,/:]*%?$")
_WORD, _NUM, _UNIT, _NAME, _NOTHING = range(5)
_READINGS = _TYPED, _PLAIN, _BEGUN, _EXACT = 1, 2, 4, 8
_MARKS = " .,;:!?\"'()[]{}`_“”‘’„«»…"  # around a token, without a value
# Scripts without blanks between words: Thai to Tibetan, Burmese, Khmer, Japanese, Chinese and their marks.
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3400-\u9fff\uf900-\ufaff\uff00-\uffef\U0001b000-\U0001b16f\U00020000-\U0003ffff])")
_CACHE = 350_000
_GATHERED = 1 << 20
_BITS = 24


@dataclass(frozen=True)
class Settings:
    window: int = 8
    least_tokens: int = 4
    least_windows: int = 5


class Tokens(dict):
    """What is known of each distinct word: its plain hash, its kind within and at the start of a sentence. Lasts for a task."""

    def __init__(self) -> None:
        super().__init__()
        self.openers = set(OPENERS.encode().split())
        self.kinds = dict.fromkeys(UNITS.encode().split(), _UNIT) | dict.fromkeys(NUMBER_WORDS.encode().split(), _NUM)
        self.fresh: list[bytes] = []
        self.hash, self.exact = (np.zeros(0, dtype=np.uint64) for _ in range(2))
        self.kind = np.zeros(0, dtype=np.int8)
        self.ends, self.opener = (np.zeros(0, dtype=bool) for _ in range(2))

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        self[word] = at
        self.fresh.append(word)
        return at

    def _read(self, word: bytes) -> tuple[int, int, int, bool, bool]:
        """Plain hash, hash with value, kind, whether it ends a sentence, whether it is a function word."""
        core = word.rstrip(b".,;:!?")
        if len(word) > 1 and core.isalpha():  # plain letters and marks behind them
            low = core.lower()
            value = xxh3_64_intdigest(low)
            return value, value, self.kinds.get(low, _WORD if core[0] >= 97 else _NAME), word[-1:] in b".!?:" or word[-2:-1] in b".!?", low in self.openers
        text = word.decode("utf-8", "replace")
        core = _EDGES.sub("", text)
        low = core.lower()
        value = xxh3_64_intdigest(low.encode())
        if not core:
            kind = _NOTHING
        elif _NUMBER.match(core):
            kind = _NUM
        else:
            kind = self.kinds.get(low.encode(), _NAME if core[0].isupper() else _WORD)  # a name, unless it starts a sentence
        exact = value if kind in (_WORD, _NAME) else xxh3_64_intdigest(text.lower().strip(_MARKS).encode())
        return value, exact, kind, text[-1:] in ".!?:" or text[-2:-1] in ".!?", low.encode() in self.openers

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHE:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.fresh:
            start = len(self) - len(self.fresh)
            values = zip(*map(self._read, self.fresh), strict=True)
            for name, column in zip(("hash", "exact", "kind", "ends", "opener"), values, strict=True):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old[:start], np.array(column, dtype=old.dtype)]))
            self.fresh = []
        return at


@dataclass(frozen=True)
class Template:
    """Tokens of several texts in a row: text number, place in the text, plain hash, kind, capitalised at the start of a sentence,
    hash with value, and of the signs before the token.
    """

    text: np.ndarray
    place: np.ndarray
    hash: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    exact: np.ndarray
    signs: np.ndarray


def _spaced(text: bytes) -> bytes:
    return text if text.isascii() else _UNSPACED.sub(r" \1 ", text.decode("utf-8", "replace")).encode()


def templates(texts: list[bytes], known: Tokens) -> Template:
    """The texts' tokens, one text after another."""
    split = [_spaced(text).split() for text in texts]
    lengths = np.array([len(words) for words in split], dtype=np.int64)
    number = np.repeat(np.arange(len(texts)), lengths)
    at = known([word for words in split for word in words])
    kind, ends, value = known.kind[at], known.ends[at], known.hash[at]
    starts = np.ones(len(at), dtype=bool)
    starts[1:] = ends[:-1] | (number[1:] != number[:-1])
    begins = (kind == _NAME) & starts
    kind = np.where(begins, _WORD, kind)
    begins &= ~known.opener[at]
    kept = kind != _NOTHING
    signs = _signs_before(known.exact[at], kept)
    number, kind, value, begins, exact = number[kept], kind[kept], value[kept], begins[kept], known.exact[at][kept]
    first = np.ones(len(number), dtype=bool)
    first[1:] = number[1:] != number[:-1]
    begin = np.flatnonzero(first)
    place = np.arange(len(number)) - np.repeat(begin, np.diff(np.append(begin, len(number))))
    return Template(number, place, value, kind, begins, exact, signs)


def _signs_before(exact: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """For each token that is kept, a hash of the signs between it and the last one, in their order; 0 without any."""
    at, signs = np.flatnonzero(kept), np.zeros(kept.sum(), dtype=np.uint64)
    gap = np.diff(np.concatenate([[-1], at])) - 1
    for step in range(int(gap.max(initial=0)), 0, -1):
        has = np.flatnonzero(gap >= step)
        signs[has] = (signs[has] ^ exact[at[has] - step]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(step)
    return signs


def _counts(marked: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """How many of the tokens of each window are marked."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return total[start + width] - total[start]


def readings(template: Template, width: int, literal: bool) -> Iterator[tuple[Template, np.ndarray, np.ndarray]]:
    """Readings of the windows: the template, starts of the windows that identify something, and their readings.

    A window that several readings read alike comes once, with the bits of them all. The template as it is; names
    taken for plain words, as texts in other letter case have none; capitalised words at the start of sentences taken for names; everything by its value.
    """
    n = len(template.hash) - width + 1
    start = np.flatnonzero(template.text[: max(0, n)] == template.text[width - 1 :])
    # What numbers, units and signs make of a window is left to its exact reading.
    valued = _counts((template.kind == _NUM) | (template.kind == _UNIT), start, width) > 0
    if literal or valued.any():
        fresh = np.ones(len(start), dtype=bool) if literal else valued
        read = replace(template, hash=template.exact, kind=np.full(len(template.kind), _WORD, dtype=template.kind.dtype))
        yield read, start[fresh], np.full(fresh.sum(), _EXACT)
    if literal:
        return
    names = _counts(template.kind == _NAME, start, width) > 0
    plain = template.kind == _WORD
    half = 2 * _counts(plain, start, width) >= width
    begins = _counts(template.first, start, width) > 0
    yield template, start[half], (_TYPED + _PLAIN * ~names + _BEGUN * ~begins + _EXACT * ~(names | valued))[half]
    if names.any():
        read = replace(template, kind=np.where(template.kind == _NAME, _WORD, template.kind))
        fresh = names & (2 * _counts(read.kind == _WORD, start, width) >= width)
        yield read, start[fresh], (_PLAIN + _EXACT * ~valued)[fresh]
    if begins.any():
        read = replace(template, kind=np.where(template.first, _NAME, template.kind))
        fresh = begins & (2 * _counts(read.kind == _WORD, start, width) >= width)
        yield read, start[fresh], np.full(fresh.sum(), _BEGUN)


def outlines(template: Template, start: np.ndarray, width: int, bits: np.ndarray) -> np.ndarray:
    """Hash of each window's words and kinds of slots; in exact readings also of the signs between its tokens."""
    sign = np.where(template.kind == _WORD, template.hash, (template.kind.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    total = np.full(len(start), width, dtype=np.uint64)
    for j in range(width):
        if j == 1 and (bits == _EXACT).any():
            sign = sign + template.signs
        total = (total ^ sign[start + j]) * np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(32)
    return total


def window_hashes(template: Template, start: np.ndarray, width: int, outline: np.ndarray) -> np.ndarray:
    """Hash of each window's outline and of which slots have equal values: pairs of slots, told apart by their places."""
    found = outline.copy()
    slotted = np.flatnonzero(_counts(template.kind != _WORD, start, width) > 1)
    if len(slotted):
        base = start[slotted]
        for i in range(width):
            for j in range(i + 1, width):
                a, b = base + i, base + j
                equal = (template.kind[a] != _WORD) & (template.kind[a] == template.kind[b]) & (template.hash[a] == template.hash[b])
                found[slotted] += equal * np.uint64((i * 64 + j + 1) * 0x2545F4914F6CDD1D % (1 << 64))
    return found


def _slots(template: Template, start: int, width: int) -> list[int]:
    part = slice(start, start + width)
    return template.hash[part][template.kind[part] != _WORD].view(np.int64).tolist()


def _doubts(template: Template, start: int, width: int, bits: int) -> list[int] | None:
    """The values of slots that are names only if words at the start of sentences are."""
    part = slice(start, start + width)
    return template.hash[part][template.first[part]].view(np.int64).tolist() if bits == _BEGUN else None


_WINDOWS = "id long, place long, width int, outline long, hash long, slots array<long>, doubts array<long>, readings int, of array<int>"


def _item_windows(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for table in pieces(batches, "text", _GATHERED):
            ids = table.column("id").to_pylist()
            rows = []
            for number, text in zip(ids, payloads(table.column("text").combine_chunks()), strict=True):
                template = templates([text], known)
                if not len(template.hash):
                    continue
                width = min(settings.window, len(template.hash))
                own = []
                for read, start, bits in readings(template, width, width < settings.least_tokens):
                    outline = outlines(read, start, width, bits)
                    found = window_hashes(read, start, width, outline)
                    own += [(number, s, width, o, h, _slots(read, s, width), _doubts(read, s, width, b), b) for s, o, h, b in zip(start.tolist(), outline.view(np.int64).tolist(), found.view(np.int64).tolist(), bits.tolist(), strict=True)]
                of = [sum(row[7] & bit > 0 for row in own) for bit in _READINGS]
                rows += [(*row, of) for row in own]
            yield _window_batch(rows)

    return run


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [field.split() for field in _WINDOWS.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def _hit(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64((1 << _BITS) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _document_windows(widths: list[int], bitmap: np.ndarray, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for table in pieces(batches, "text", _GATHERED):
            ids = table.column("id").to_pylist()
            rows = []
            whole = templates(payloads(table.column("text").combine_chunks()), known)
            for width, (template, start, bits) in ((w, r) for w in widths for r in readings(whole, w, w < settings.least_tokens)):
                outline = outlines(template, start, width, bits)
                passed = np.flatnonzero(_hit(bitmap, outline))
                start, outline = start[passed], outline[passed]
                found = window_hashes(template, start, width, outline)
                for s, o, h, b in zip(start.tolist(), outline.view(np.int64).tolist(), found.view(np.int64).tolist(), bits[passed].tolist(), strict=True):
                    rows.append((ids[template.text[s]], int(template.place[s]), width, o, h, _slots(template, s, width), _doubts(template, s, width, b), b, None))
            yield _window_batch(rows)

    return run


def _word_counts(bitmap: np.ndarray):
    """Of the words that the bitmap lets pass: how often they are in lower case and capitalised within sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Tokens(), Counter()

        def out() -> pa.RecordBatch:
            lower, upper = ([total[value, kind] for value in values] for kind in (_WORD, _NAME))
            return pa.RecordBatch.from_arrays([pa.array(np.array(values, dtype=np.uint64).view(np.int64)), pa.array(lower, pa.int64()), pa.array(upper, pa.int64())], ["hash", "lower", "upper"])

        for table in pieces(batches, "text", _GATHERED):
            split = [_spaced(text).split() for text in payloads(table.column("text").combine_chunks())]
            at = known([word for words in split for word in words])
            within = np.zeros(len(at), dtype=bool)
            within[1:] = ~known.ends[at[:-1]]
            begins = np.cumsum([0, *map(len, split)])[:-1]
            within[begins[begins < len(at)]] = False
            asked = _hit(bitmap, known.hash) & ((known.kind == _WORD) | (known.kind == _NAME))
            chosen = at[asked[at] & within]
            words, counts = np.unique(chosen, return_counts=True)
            for word, n in zip(words.tolist(), counts.tolist(), strict=True):
                total[int(known.hash[word]), int(known.kind[word])] += n
            if len(total) > 200_000:
                values = sorted({value for value, _ in total})
                yield out()
                total = Counter()
        values = sorted({value for value, _ in total})
        yield out()

    return run


def _bitmap(frame: DataFrame, column: str) -> np.ndarray:
    """One bit per value of a column's low bits: 2 MB, whatever the frame's size."""
    low = F.col(column).bitwiseAND((1 << _BITS) - 1)
    words = frame.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (_BITS - 6), dtype=np.uint64)
    for row in words:
        bitmap[row["word"]] = np.uint64(row["bits"] % (1 << 64))
    return bitmap


def _looked_up(own: DataFrame, settings: Settings) -> DataFrame:
    """(hash, width, item, place) of windows of which every match has one: all but an item's ``least_windows - 1`` most common ones.

    Readings with fewer windows match with all of theirs; the least common one of each is among them.
    """
    sizes = own.groupBy("hash", "width").agg(F.count("*").alias("size"))
    sized = own.join(sizes, ["hash", "width"])
    places = sized.groupBy("item", "place").agg(F.max("size").alias("size"), F.bit_or("readings").alias("readings"))
    item = Window.partitionBy("item")
    order = item.orderBy("size", "place")
    kept = F.row_number().over(order) <= F.count("*").over(item) - settings.least_windows + 1
    for bit in _READINGS:
        has = F.col("readings").bitwiseAND(bit) > 0
        kept |= has & (F.count_if(has).over(order) == 1)
    return sized.select("hash", "width", "item", "place").join(places.withColumn("kept", kept).filter("kept").select("item", "place"), ["item", "place"])


def _of_names(met: DataFrame, texts: DataFrame) -> DataFrame:
    """Without windows in which a word that starts a sentence stands for another and is no name in the texts."""
    doubtful = lambda values, doubts: F.when(F.array_contains(doubts, values), F.array(values)).otherwise(F.array().cast("array<long>"))
    changed = F.filter("pairs", lambda p: p["a"] != p["b"])
    doubts = F.flatten(F.transform(changed, lambda p: F.concat(doubtful(p["a"], F.coalesce("doubts", F.array().cast("array<long>"))), doubtful(p["b"], F.coalesce("found_doubts", F.array().cast("array<long>"))))))
    met = stored(met.withColumn("asked", doubts).drop("doubts", "found_doubts"), "met-windows")
    asked = stored(met.select(F.explode("asked").alias("hash")).distinct(), "asked")
    if asked.isEmpty():
        return met
    words = texts.mapInArrow(_word_counts(_bitmap(asked, "hash")), "hash long, lower long, upper long")
    known = words.join(asked, "hash").groupBy("hash").agg(F.sum("lower").alias("lower"), F.sum("upper").alias("upper")).filter("lower > upper")
    key = ["doc_id", "item", "diagonal", "at", "readings"]
    no_names = met.select(*key, F.explode("asked").alias("hash")).join(known, "hash").select(*[F.col(c).alias(f"no_{c}") for c in key]).distinct()
    same = F.lit(True)
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"no_{c}"))
    return met.join(no_names, same, "left_anti")


def matches(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, n_windows, of_windows, reworded): consistent matches, best diagonal of each pair."""
    items = items.select(F.col("item_id").cast("long").alias("id"), "text").groupBy("text").agg(F.min(F.struct("id")).alias("least"))
    items = items.select(F.xxhash64("text").alias("item"), "least.id", "text")
    own = items.select(F.col("item").alias("id"), "text").mapInArrow(_item_windows(settings), _WINDOWS)
    own = stored(own.withColumnRenamed("id", "item"), "benchmark-windows")
    widths = sorted(row["width"] for row in own.select("width").distinct().collect())
    found = docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_document_windows(widths, _bitmap(own, "outline"), settings), _WINDOWS)
    read = stored(found, "document-windows").dropDuplicates(["id", "width", "place", "readings"])
    found = read.select("hash", "width", F.col("id").alias("doc_id"), F.col("place").alias("at"), F.col("slots").alias("values"), F.col("doubts").alias("found_doubts"))

    # Where one of the windows looked up is met, all windows of the item are compared.
    met = found.join(_looked_up(own, settings), ["hash", "width"]).select("doc_id", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    wanted = met.join(own, "item").withColumn("at", F.col("place") + F.col("diagonal")).withColumnRenamed("doc_id", "in_doc")
    met = wanted.join(found, ["hash", "width", "at"]).filter(F.col("in_doc").eqNullSafe(F.col("doc_id")))
    pairs = F.transform(F.arrays_zip("slots", "values"), lambda p: F.struct(p["slots"].alias("a"), p["values"].alias("b")))
    met = met.select("doc_id", "item", "diagonal", "at", "readings", "of", "doubts", "found_doubts", pairs.alias("pairs"))
    met = _of_names(met, docs.select("text").unionByName(items.select("text")))
    counts = [F.size(F.collect_set(F.when(F.col("readings").bitwiseAND(bit) > 0, F.col("at")))).alias(f"n{bit}") for bit in _READINGS]
    grouped = met.groupBy("doc_id", "item", "diagonal").agg(
        F.size(F.collect_set("at")).alias("n"), *counts, F.max("of").alias("of"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("map")
    )
    from_side = F.array_distinct(F.transform("map", lambda p: p["a"]))
    to_side = F.array_distinct(F.transform("map", lambda p: p["b"]))
    one_to_one = (F.size(from_side) == F.size("map")) & (F.size(to_side) == F.size("map"))
    enough = F.col("n") >= settings.least_windows
    for i, bit in enumerate(_READINGS):
        enough |= (F.col("of")[i] > 0) & (F.col(f"n{bit}") >= F.col("of")[i])
    good = grouped.filter(one_to_one & enough).withColumn("reworded", F.exists("map", lambda p: p["a"] != p["b"]))
    good = good.join(items.select("item", F.col("id").alias("item_id")), "item").withColumn("of", F.greatest(F.array_max("of"), "n"))
    best = good.groupBy("doc_id", "item_id").agg(F.max(F.struct("n", (~F.col("reworded")).alias("same"), "of")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.n").alias("n_windows"), F.col("m.of").cast("long").alias("of_windows"), (~F.col("m.same")).alias("reworded"))


def decontaminate(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, contaminated, item_id, n_windows, of_windows, reworded) of every document: its best match."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", text_keys(F.col("text")))
    found = matches(keyed.select(F.col("key").alias("doc_id"), "text"), items, settings)
    best = found.groupBy("doc_id").agg(F.max(F.struct("n_windows", (-F.col("item_id")).alias("least"), "item_id", "of_windows", "reworded")).alias("m"))
    best = best.select(F.col("doc_id").alias("key"), "m.item_id", "m.n_windows", "m.of_windows", "m.reworded")
    joined = keyed.select("doc_id", "key").join(best, "key", "left")
    return joined.select("doc_id", F.col("n_windows").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_windows", F.lit(0)).alias("n_windows"), "of_windows", "reworded")
