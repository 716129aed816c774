"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators, a linear support vector
machine with hinge loss weighs them, fitted by dual coordinate descent.

Features are the distinct hashed words and word pairs of the whole text, and a few letter-shape marks of
words, so that unseen words still tell.  The fit uses a bounded sample of labelled documents; scoring is
one pass over all texts.

Defined results: NULL, empty and wordless texts have only the empty-text mark and get the score the model gives it.
Without learning rows of both labels every score is 0.5.  A document labelled twice counts with its lowest label.
Repeated rows are scored each; other columns are ignored, or kept where asked for (``score`` gives way to the result).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, kinds, labelled_sample, table, texts_of

#: Labelled documents that the fit uses at most.
LEARN_DOCS = 4_000
DIMENSIONS = 1 << 18
SMOOTHING, COST, EPOCHS = 1.0, 1.0, 12
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def shape(word: bytes) -> bytes:
    """Letter shape of a word: letters a or A, digits 0, other signs as they are, runs shortened to one."""
    out = bytearray()
    for b in word[:32]:
        c = 97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
        if not out or out[-1] != c:
            out.append(c)
    return b"\0" + bytes(out)


class Hashes(dict):
    """Hash of a word and of its shape, remembered for frequent words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = zlib.crc32(word) << 32 | zlib.crc32(shape(word))
        return value


def features(text: bytes | None, hashes: Hashes, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Distinct feature numbers of a whole text: words, neighbouring words, word shapes, share of repeats."""
    words = (text or b"").split()
    if not words:
        return np.array([0], np.int64)
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    pair = (word[:-1] * _PAIR + word[1:]) * _PAIR >> np.uint64(20)
    distinct = np.unique(word)
    # Marks of repetition and of shapes, in twelfths: independent of the words themselves and of the length.
    marks = [int(12 * len(distinct) / len(words)), 100 + int(12 * np.mean(form == form[0]))]
    forms, counts = np.unique(form, return_counts=True)
    frequent = (forms * np.uint64(16) + np.minimum(15, 12 * counts // len(words)).astype(np.uint64)) * _PAIR >> np.uint64(30)
    found = np.concatenate([distinct % np.uint64(dimensions), pair % np.uint64(dimensions), frequent % np.uint64(dimensions),
                            np.array(marks, np.uint64) + np.uint64(1)])
    return np.unique(found).astype(np.int64)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, dimensions: int, smoothing: float) -> np.ndarray:
    """Log of a feature's share among the label 1 documents over its share among the others."""
    counts = np.full((2, dimensions), smoothing)
    for row, label in zip(rows, labels):
        counts[label, row] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1]) - np.log(counts[0])


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float,
                            epochs: int) -> tuple[np.ndarray, float]:
    """Linear support vectors with hinge loss: weights and bias.  Rows are scaled to unit length."""
    sign = np.where(labels == 1, 1.0, -1.0)
    n = len(rows)
    values = [scale[r] / max(np.linalg.norm(scale[r]), 1e-9) for r in rows]
    limit = cost * n / (2.0 * np.array([np.sum(sign == s) for s in sign]))  # rarer labels weigh more
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(n)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(n):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), limit[i])  # the squared norm with the bias is 2
            change = (new - alpha[i]) * sign[i]
            if change:
                weights[rows[i]] += change * values[i]
                bias += change
                alpha[i] = new
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weights, bias


def fit(sample: DataFrame, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Ratios, weights and bias from a bounded sample ``doc_id, text, label``; None without both labels."""

    def extract(batches):
        for batch in batches:
            hashes = Hashes()
            found = [features(t, hashes, dimensions).astype("<i4").tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array(found, pa.binary())],
                                             names=["doc_id", "label", "found"])

    got = sorted(sample.select("doc_id", "text", F.col("label").cast("int")).mapInArrow(
        extract, "doc_id string, label int, found binary").collect())
    labels = np.array([1 if r["label"] else 0 for r in got], np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    rows = [np.frombuffer(r["found"], "<i4").astype(np.int64) for r in got]
    ratios = log_count_ratios(rows, labels, dimensions, SMOOTHING)
    weights, bias = dual_coordinate_descent(rows, labels, ratios, COST, EPOCHS)
    return ratios, weights, bias


def score(docs: DataFrame, model, keep: list[str] | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """Every row of ``docs`` with the columns ``keep`` (``doc_id``) and ``score``, over 0.5 where the margin is positive."""
    keep = [c for c in keep or ["doc_id"] if c != "score"]
    ratios, weights, bias = model if model else (None, None, 0.0)
    if model:
        used = weights * ratios
        used, ratios = used.astype("f4"), ratios.astype("f4")

    def predict(batches):
        hashes = Hashes()
        for batch in batches:
            scores = []
            for text in texts_of(batch):
                margin = 0.0
                if model:
                    row = features(text, hashes, dimensions)
                    margin = float(used[row].sum(dtype="f8")) / max(float(np.linalg.norm(ratios[row])), 1e-9) + bias
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, 2 * margin)))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], names=[*keep, "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(predict, kinds(docs, keep) + ", score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", LEARN_DOCS))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
