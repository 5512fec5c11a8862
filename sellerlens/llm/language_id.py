"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

* **Features.** Character 1- to 3-grams of the case-folded text are hashed into
  ``dims`` buckets; a document is its bucket counts, dampened by log(1 + tf),
  weighted by IDF and scaled to length one. Document frequencies come from all
  training documents (one row per bucket reaches the driver).
* **Training.** Follow-the-regularised-leader with per-coordinate rates and an
  elastic-net penalty (L1 keeps the weights sparse) over at most ``per_class``
  documents of each language, lowest id hashes first; a bounded sample, so one
  task holds it. A hash threshold from the language's row count thins the rows
  before any shuffle, so a language with most rows sends no more than others. Every fifth of them is set aside for calibration.
* **Calibration.** One temperature, found by golden-section search on the
  calibration part's log loss, divides the scores before the softmax.
* **Prediction** covers every whole text.

Only text and lang of training documents are learnt from; whether a document
is one is the caller's column ``train``.

Cases: a null text, or one without a letter, is ``und`` with score 0; without
labelled training documents every text is; ties go to the smaller language
name; repeated rows are judged alike; an empty table gives an empty result;
columns besides (doc_id, text, lang, train) are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import map_arrow

DIMS = 1 << 15
PER_CLASS = 1000
# A language's rows are thinned by id hash to about this many times its sample before they are ranked.
SPARE = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
LETTER = re.compile(r"[^\W\d_]")

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


def buckets(text: str, dims: int = DIMS) -> np.ndarray:
    """Hash buckets of all character 1-, 2- and 3-grams."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype="<u4").astype(U) + U(1)
    shift = U(64 - (dims - 1).bit_length())
    one = c * _A
    two = one[:-1] + c[1:] * _B
    three = two[:-1] + c[2:] * _C
    x = np.concatenate((one, two, three))
    x = (x ^ (x >> U(29))) * _B
    return (x >> shift).astype(np.int64)


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a text, length one."""
    tf = np.bincount(buckets(text, len(idf)), minlength=len(idf))
    at = np.flatnonzero(tf)
    w = np.log1p(tf[at]) * idf[at]
    return at, w / (math.sqrt(float(w @ w)) or 1.0)


def document_frequency(train: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and their number, over all training documents."""
    def run(batches):
        df, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    df += np.bincount(buckets(text, dims), minlength=dims) > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["bucket", "df"])

    rows = map_arrow(train.select("text"), run, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(dims, np.int64)
    n = 0
    for r in rows:
        if r.bucket < 0:
            n = r.df
        else:
            df[r.bucket] = r.df
    return df, n


class Ftrl:
    """FTRL-proximal state of a multinomial model; weights appear lazily from z and n."""

    def __init__(self, dims: int, classes: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros((dims, classes)), np.zeros((dims, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1.0
        g = np.outer(x, p)
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores with the least log loss."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.mean(np.log(softmax(scores / math.exp(t))[np.arange(len(y)), y] + 1e-12))
    a, b, g = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return math.exp((a + b) / 2)


def fit(train: DataFrame, idf: np.ndarray, sizes: dict[str, int], per_class: int = PER_CLASS, epochs: int = EPOCHS):
    """(weights, temperature) from the bounded labelled sample, trained in one task."""
    classes = sorted(sizes)
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = F.lit(0)
    for lang, n in sizes.items():
        limit = F.when(F.col("lang") == lang, F.lit(math.ceil((1 << 30) * min(1.0, SPARE * per_class / n)))).otherwise(limit)
    order = Window.partitionBy("lang").orderBy("_s", "doc_id", F.xxhash64("text"))
    sample = (
        train.select("doc_id", "lang", "text", spot.alias("_s")).where(F.col("_s") < limit)
        .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_class).select("text", "lang", "_r").repartition(1)
    )

    def run(batches):
        data = []
        for b in batches:
            for text, lang, rank in zip(*(c.to_pylist() for c in b.columns)):
                data.append((rank, classes.index(lang), *features(text, idf)))
        data.sort(key=lambda x: x[:2])
        data = [(at, x, y, rank % 5 == 0) for rank, y, at, x in data]
        model = Ftrl(len(idf), len(classes))
        for _ in range(epochs):
            for at, x, y, held in data:
                if not held:
                    model.learn(at, x, y)
        w = model.weights()
        held = [(x @ w[at], y) for at, x, y, h in data if h]
        t = temperature(np.array([s for s, _ in held]), np.array([y for _, y in held], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([t], pa.float64())], names=["w", "t"])

    row = map_arrow(sample, run, "w binary, t double").first()
    return np.frombuffer(row.w).reshape(len(idf), len(classes)), row.t


def identify(docs: DataFrame, dims: int = DIMS, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, train, lang_pred, score) for every row of ``docs`` (doc_id, text, lang, train)."""
    d = docs.select("doc_id", "text", "lang", "train")
    train = d.where("train AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(sizes)
    if classes:
        df, n = document_frequency(train, dims)
        idf = np.log((n + 1) / (df + 1)) + 1.0
        weights, t = fit(train, idf, sizes, per_class)

    def one(text):
        if not classes or not text or not LETTER.search(text):
            return "und", 0.0
        at, x = features(text, idf)
        p = softmax(x @ weights[at] / t)
        k = int(p.argmax())
        return classes[k], float(p[k])

    def run(batches):
        for b in batches:
            out = [one(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=["doc_id", "train", "lang_pred", "score"])

    return map_arrow(d.select("doc_id", "text", "train"), run,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, train boolean, lang_pred string, score double")
