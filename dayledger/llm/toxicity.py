"""Toxicity: weak supervision of a linear classifier.

Many voters look at a text, each for one thing: a lexicon of insults, threats or slurs by
theme, a pattern (insult addressed to the reader, shouting, dense insults), or a single word
or word stem that a sample of labelled rows shows to go with the label. A generative label model treats
every vote, and the label where there is one, as a noisy view of a hidden class. Expectation
maximisation estimates each voter's accuracy (its rate of firing in either class), then the
correlations of voters within a class; a voter that others echo is weighted down by them.
The posterior of the hidden class is the target of a logistic classifier over the votes and
their counts, which scores every whole text.

The model is fitted on a bounded sample, drawn by hash: ``sample_rows`` labelled rows. Voters
and weights have a fixed bound, so that the model fits each task.

Defined results: a null text is empty; an empty text gets the score of a text without any vote.
A repeated label row counts as often as it occurs,
a null or other label not at all. Without a labelled row of both
classes the lexicon voters alone decide, at a fixed prior. Words are runs of letters, so that
marks around or between words hide nothing. Further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import payloads, stored

LEXICONS = {
    "wits": "idiot idiots moron morons stupid dumb imbecile fool fools dimwit halfwit cretin idiota imbécil dummkopf blöd dumm crétin stupide abruti",
    "worth": "worthless loser losers scum trash garbage vermin useless pathetic basura escoria inútil abschaum wertlos versager müll ordure déchet minable",
    "disgust": "disgusting filthy vile revolting sickening asqueroso repugnante ekelhaft widerlich dégoûtant répugnant",
    "mockery": "clown clowns freak weirdo coward payaso witzfigur bouffon",
    "hostility": "hate despise kill destroy odio matar hasse töten haine tuer",
    "profanity": "shit crap damn bastard bitch fuck fucking ass mierda scheiße merde putain",
}

_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
_ADDRESSED = re.compile(rb"\b(?:you|your|u|du|tu|vous|eres)\b\W+(?:\w+\W+)?$")
_END = b" "
_STEM = (4, 9)  # bytes of the shortest and the longest beginning
_SHOUT = re.compile(rb"!{2,}")
_PATTERNS = ["any", "several", "many", "dense", "addressed", "shouting"]


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 8000  # the expected number of labelled rows that the model is fitted on
    mined_words: int = 64  # the most words or stems that become voters of their own
    candidates: int = 512  # those looked at
    mined_z: float = 5.0  # how far above chance such a stem must be in class 1, in deviations
    least_rows: int = 5  # labelled rows of the sample that must have it
    rounds: int = 30
    prior: float = 0.1  # share of class 1 where no label tells
    seed: int = 11


@dataclass(frozen=True)
class Model:
    known: Lexicon
    weights: np.ndarray
    bias: float


class Lexicon:
    """Themes by word, own voters by stem. A stem is the first bytes of a word and its end mark."""

    def __init__(self, stems: list[bytes]) -> None:
        self.stems = {stem: i for i, stem in enumerate(stems)}
        self.themes = {word.encode(): i for i, theme in enumerate(LEXICONS.values()) for word in theme.split()}
        self.heads = {(word + _END)[: _STEM[0]] for word in self.themes} | {stem[: _STEM[0]] for stem in stems}


def stems_of(word: bytes) -> set[bytes]:
    """The word as a whole (with its end mark), and its beginnings."""
    marked = word + _END
    return {marked, *(marked[:size] for size in range(_STEM[0], min(_STEM[1], len(word)) + 1))}


def voices(text: bytes, lexicon: Lexicon) -> np.ndarray:
    """Votes (0 or 1), then what the classifier sees besides them: logarithms of two counts."""
    lowered = text.lower()
    words = _WORD.findall(lowered)
    themes, own = np.zeros(len(LEXICONS)), np.zeros(len(lexicon.stems))
    hits, heads = 0, lexicon.heads
    for word in words:
        if (word + _END)[: _STEM[0]] not in heads:
            continue
        theme = lexicon.themes.get(word)
        if theme is not None:
            themes[theme] = 1
            hits += 1
        if found := stems_of(word) & lexicon.stems.keys():
            own[[lexicon.stems[stem] for stem in found]] = 1
    addressed = bool(hits) and any(
        found[0] in lexicon.themes and _ADDRESSED.search(lowered, max(0, found.start() - 24), found.start()) for found in _WORD.finditer(lowered)
    )
    patterns = [hits > 0, hits > 2, hits > 5, hits * 50 > len(words), addressed, bool(hits and _SHOUT.search(text))]
    return np.concatenate([themes, patterns, own, [np.log1p(hits), np.log1p(own.sum())]])


def label_model(votes: np.ndarray, labels: np.ndarray, settings: Settings) -> np.ndarray:
    """The posterior of class 1 for every row. ``labels``: 0, 1, or -1 where there is none."""
    observed = np.column_stack([votes, labels == 1])
    seen = np.ones_like(observed, dtype=bool)
    seen[:, -1] = labels >= 0
    known = labels[labels >= 0]
    prior = float(np.clip(known.mean(), 0.01, 0.99)) if len(set(known.tolist())) == 2 else settings.prior
    lexical = votes[:, : len(LEXICONS)].any(axis=1)
    post = np.where(labels >= 0, np.where(labels == 1, 0.95, 0.02 * prior), np.where(lexical, 0.8, 0.05))
    echo = np.ones(observed.shape[1])
    for step in range(settings.rounds):
        on = (post[:, None] * observed * seen).sum(axis=0)
        fires = [((1 - post)[:, None] * observed * seen).sum(axis=0), on]
        size = [((1 - post)[:, None] * seen).sum(axis=0), (post[:, None] * seen).sum(axis=0)]
        rate = [np.clip((f + 0.5) / (n + 1.0), 1e-3, 1 - 1e-3) for f, n in zip(fires, size, strict=True)]
        if step == settings.rounds // 2:  # correlations within a class, once the accuracies have settled
            off = (observed - np.where(post[:, None] > 0.5, rate[1], rate[0])) * seen
            deviation = np.sqrt((off * off).mean(axis=0)) + 1e-9
            correlation = (off.T @ off) / len(off) / np.outer(deviation, deviation)
            np.fill_diagonal(correlation, 0)
            echo = 1 / (1 + np.clip(correlation, 0, 1).sum(axis=0))
            echo[-1] = 1  # the label, where there is one, is no echo of the voters
        gain = observed * np.log(rate[1] / rate[0])  # a voter that does not fire abstains
        gain[:, -1] += (1 - observed[:, -1]) * np.log((1 - rate[1][-1]) / (1 - rate[0][-1]))  # a label does not
        z = np.log(prior / (1 - prior)) + (gain * seen * echo).sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return post


def logistic(x: np.ndarray, target: np.ndarray, penalty: float = 1e-4, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Linear classifier on soft targets, by Newton steps on the penalised likelihood."""
    wide = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(wide.shape[1], penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(wide.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(wide @ weights, -30, 30)))
        slope = wide.T @ (p - target) / len(x) + ridge * weights
        curve = (wide * (p * (1 - p))[:, None]).T @ wide / len(x) + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return weights[:-1], float(weights[-1])


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of either class each stem occurs."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(payloads(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
            counts[label].update({stem for word in set(_WORD.findall(text.lower())) for stem in stems_of(word)})
    stems = sorted(counts[0].keys() | counts[1].keys())
    columns = [pa.array(stems, pa.binary()), pa.array([counts[0][s] for s in stems], pa.int64()), pa.array([counts[1][s] for s in stems], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["stem", "clean", "toxic"])


def candidates(rows: DataFrame, settings: Settings) -> list[bytes]:
    """The stems that stand out most in class 1: far above chance, and mostly in class 1."""
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    counts = rows.mapInArrow(_stem_counts, "stem binary, clean bigint, toxic bigint").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = F.col("clean") + F.col("toxic")
    z = (F.col("toxic") - share * both) / F.sqrt(share * (1 - share) * both + 0.1)
    good = (both >= settings.least_rows) & (F.col("toxic") > F.col("clean")) & (z >= settings.mined_z)
    best = counts.withColumn("z", z).filter(good).orderBy(F.desc("z"), F.desc(F.length("stem")), "stem").limit(settings.candidates)
    return [bytes(row["stem"]) for row in best.collect()]


def choose(has: np.ndarray, labels: np.ndarray, settings: Settings) -> list[int]:
    """Greedy cover of class 1: the stem that stands out most among rows not yet reached, longest of equals.

    ``has``: rows x candidates. Leaves one stem for each family of inflected or nested stems.
    """
    chosen: list[int] = []
    open_rows = labels == 1
    share = max(1e-3, min(0.999, float(labels.mean()))) if len(labels) else 0.5
    misses = has[labels == 0].sum(axis=0)
    while len(chosen) < settings.mined_words and open_rows.any() and has.shape[1]:
        hits = has[open_rows].sum(axis=0)
        z = (hits - share * (hits + misses)) / np.sqrt(share * (1 - share) * (hits + misses) + 0.1)
        best = int(z.argmax())  # candidates come in order: of equals the longest first
        if z[best] < settings.mined_z or hits[best] < settings.least_rows:
            break
        chosen.append(best)
        open_rows &= ~has[:, best]
    return chosen


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text)."""
    known = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.filter(draw < min(1.0, settings.sample_rows / max(1, n)))
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("toxic", "text")
    rows = stored(rows, "toxic-sample")
    found = candidates(rows, settings)
    wide = Lexicon(found)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [voices(text, wide) for text in payloads(batch.column("text"))]
            index = [np.flatnonzero(v[:-2]).tolist() for v in seen]
            counts = [v[-2:].tolist() for v in seen]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(index, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float64()))], ["toxic", "index", "counts"])

    drawn_votes = sorted((tuple(r) for r in rows.mapInArrow(votes, "toxic int, index array<int>, counts array<double>").collect()), key=repr)
    target = np.array([r[0] for r in drawn_votes], dtype=np.int64)
    fixed = len(LEXICONS) + len(_PATTERNS)
    x = np.zeros((len(drawn_votes), fixed + len(found)))
    for i, row in enumerate(drawn_votes):
        x[i, row[1]] = 1
    chosen = choose(x[:, fixed:] > 0, target, settings)
    lexicon = Lexicon([found[i] for i in chosen])
    x = np.column_stack([x[:, :fixed], x[:, [fixed + i for i in chosen]]])
    x = np.column_stack([x, [row[2][0] for row in drawn_votes], np.log1p(x[:, fixed:].sum(axis=1))])
    if len(set(target.tolist())) == 2:
        weights, bias = logistic(x, label_model(x[:, :-2], target, settings))
    else:  # nothing to learn from: lexicon hits decide
        weights, bias = np.zeros(x.shape[1]), float(np.log(settings.prior / (1 - settings.prior)))
        weights[-2] = 4.0
    return Model(lexicon, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([voices(text, model.known) for text in payloads(batch.column("text"))]).reshape(batch.num_rows, len(model.weights))
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
