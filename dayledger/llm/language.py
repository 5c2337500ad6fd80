"""Language identification: averaged hashed subword embeddings under a linear softmax.

A word is seen as its character n-grams (1 to 4), a blank standing for its ends, hashed to
buckets. A text is the average of the embeddings of all its n-grams; a linear softmax over it gives a probability
per language. Training is stochastic gradient descent in numpy on a bounded sample of labelled
rows. A quarter of the sample is kept apart to calibrate the softmax temperature and the
confidence below which a text is rejected.

Prediction uses the whole text, in stretches of bounded memory. As averaging is linear,
embeddings and softmax weights fold into one score per bucket and language.

Defined results: null, empty and letterless texts are ``und`` with score 0 and rejected. Ties go to the language first in order. With no
labelled row at all every text is ``und``. Repeated rows are judged alike, and each may be drawn for training, with the others of its key.
Further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import payloads

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_STRETCH = 1 << 20


@dataclass(frozen=True)
class Settings:
    buckets: int = 8192
    dim: int = 16
    rows_per_language: int = 600  # the expected size of the training sample, per language
    rows: int = 12_000  # and in all; with many languages each gets fewer rows
    epochs: int = 15
    batch: int = 32
    rate: float = 0.5
    scale: float = 10.0  # of the averages, for steps of a useful size
    rejected_share: float = 0.002  # share of labelled texts that calibration lets go
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float


def gram_counts(text: bytes, buckets: int) -> np.ndarray:
    """How often the text has n-grams of each bucket (``buckets``: a power of two)."""
    plain = f" {' '.join(text.decode('utf-8', 'replace').lower().split())} "
    total = np.zeros(buckets, dtype=np.int64)
    shift = np.uint32(33 - buckets.bit_length())
    for at in range(0, len(plain), _STRETCH):
        # Three characters more, for n-grams that begin in this stretch and end in the next.
        points = np.frombuffer(plain[at : at + _STRETCH + 3].encode("utf-32-le", "replace"), dtype=np.uint32)
        begins = min(len(points), _STRETCH)
        inner = points != 32
        code, found = points * np.uint32(0x01000193), []
        inside = np.ones(max(0, len(points) - 1), dtype=bool)  # no blank between the first and the last
        for size in (1, 2, 3, 4):
            if size > 1:
                code = (code[:-1] ^ points[size - 1 :]) * np.uint32(0x01000193)
            if size > 2:
                inside = inside[:-1] & inner[size - 2 : -1]
            valid = (inner if size == 1 else inside[: len(code)])[:begins]
            mixed = (code[:begins] + np.uint32(size)) * np.uint32(0x9E3779B1) >> shift
            found.append(mixed[valid])
        total += np.bincount(np.concatenate(found), minlength=buckets)
    return total


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text) or _LETTER.search(text.decode("utf-8", "replace")))


def sample(labelled: DataFrame, key: str, settings: Settings) -> DataFrame:
    """Rows drawn by hash, about as many from each language, at most ``rows_per_language``, and ``rows`` in all; the same on every run."""
    counts = labelled.groupBy("lang").agg(F.count("*").alias("of_lang"))
    each = min(settings.rows_per_language, settings.rows / max(1, counts.count()))
    # A list of at most ``rows`` languages goes to all tasks. Languages beyond it are no larger than its last one.
    large = counts.filter(F.col("of_lang") > each).orderBy(F.desc("of_lang"), "lang").limit(settings.rows)
    listed = large.agg(F.count("*").alias("n"), F.min("of_lang").alias("least")).first()
    rest = 1.0 if listed["n"] < settings.rows else each / listed["least"]
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.coalesce(F.lit(float(each)) / F.col("of_lang"), F.lit(rest))
    return labelled.join(F.broadcast(large), "lang", "left").filter(draw < share).drop("of_lang")


def _features(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, count = [], []
            for text in payloads(batch.column("text")):
                seen = gram_counts(text, buckets)
                at = np.flatnonzero(seen)
                index.append(at.astype("<i4").tobytes())
                count.append((seen[at] / max(1, seen.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(index, pa.binary()), pa.array(count, pa.binary())], ["lang", "index", "share"])

    return run


def train(labelled: DataFrame, key: str = "doc_id", settings: Settings = Settings()) -> Model:
    """Learn from columns ``text`` and ``lang`` of labelled rows; ``key`` only draws the sample."""
    rows = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select(F.col(key).alias("key"), "text", "lang")
    drawn = sample(rows, "key", settings).select("text", "lang").mapInArrow(_features(settings.buckets), "lang string, index binary, share binary").collect()
    drawn = sorted((row["lang"], bytes(row["index"]), bytes(row["share"])) for row in drawn if row["index"])
    return fit([row[0] for row in drawn], [row[1:] for row in drawn], settings)


def _dense(rows: list, buckets: int) -> np.ndarray:
    """Shares of the buckets in some of the rows; all of them are never laid out at once."""
    x = np.zeros((len(rows), buckets), dtype=np.float32)
    for i, (index, share) in enumerate(rows):
        x[i, np.frombuffer(index, dtype="<i4")] = np.frombuffer(share, dtype="<f4")
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(labels: list[str], rows: list, settings: Settings) -> Model:
    """Stochastic gradient descent, then temperature and rejection threshold on the rows kept apart."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((settings.buckets, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(labels))
    apart = order[: len(order) // 4]
    learn = order[len(order) // 4 :]
    number = {language: i for i, language in enumerate(languages)}
    y = np.array([number[label] for label in labels])
    share = 1.0 / np.maximum(1, np.bincount(y[learn], minlength=len(languages)))
    weight = (share / share.mean())[y]  # every language counts alike
    embed = rng.normal(0, 0.1, (settings.buckets, settings.dim))
    soft, bias = np.zeros((settings.dim, len(languages))), np.zeros(len(languages))
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for at in range(0, len(learn), settings.batch):
            i = learn[at : at + settings.batch]
            x = _dense([rows[j] for j in i], settings.buckets)
            hidden = x @ embed * settings.scale
            off = _softmax(hidden @ soft + bias)
            off[np.arange(len(i)), y[i]] -= 1
            off *= weight[i, None] / len(i)
            back = off @ soft.T
            soft -= rate * hidden.T @ off
            bias -= rate * off.sum(axis=0)
            embed -= rate * settings.scale * (x.T @ back)
        learn = rng.permutation(learn)
    scores = embed @ soft * settings.scale
    checked = apart if len(apart) else learn
    parts = [_dense([rows[j] for j in checked[at : at + 256]], settings.buckets) @ scores for at in range(0, len(checked), 256)]
    z, true = np.concatenate(parts) + bias, y[checked]
    loss = lambda t: -np.log(np.maximum(1e-12, _softmax(z / t)[np.arange(len(true)), true])).mean()
    temperature = min(np.geomspace(0.5, 5, 33), key=loss)
    sure = np.sort(_softmax(z / temperature).max(axis=1))
    threshold = min(0.5, float(sure[int(settings.rejected_share * len(sure))]))
    return Model(languages, scores, bias, float(temperature), threshold)


def score_texts(model: Model, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text."""
    names, sure = [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        if not model.languages or not has_letter(text):
            names.append(UNDETERMINED)
            continue
        counts = gram_counts(text, len(model.scores))
        z = (counts @ model.scores / counts.sum() + model.bias) / model.temperature
        p = _softmax(z[None])[0]
        names.append(model.languages[int(p.argmax())])
        sure[i] = p.max()
    return names, sure


def _said(model: Model):
    """A function of a text column: the language, how sure, whether rejected. Other columns stay where they are."""

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def said(texts: pa.Array) -> pa.Array:
        names, sure = score_texts(model, payloads(texts))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure), pa.array(sure < model.threshold)], ["lang_pred", "score", "rejected"])

    return said


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with ``lang_pred``, ``score`` and ``rejected``."""
    kept = [F.col(f"`{c}`") for c in keep]
    both = docs.select(F.struct(*kept).alias("kept"), _said(model)(F.col("text")).alias("said"))
    return both.select(*[F.col(f"kept.`{c}`") for c in keep], "said.lang_pred", "said.score", "said.rejected")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    return docs.filter(~_said(model)(F.col("text"))["rejected"])
