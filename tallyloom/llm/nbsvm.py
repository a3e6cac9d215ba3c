"""Quality by Naive Bayes support vectors: byte n-grams scaled by log-count ratios, a linear hinge-loss fit on top.

The model is fitted in one task on a bounded sample of labelled texts; scoring reads every text whole.
"""

from __future__ import annotations

import operator
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bytes_of, id_and_text
from tallyloom.llm.files import in_arrow, in_pandas

BITS = 16
ORDERS = (1, 2, 3, 4)  # each one longer than the one before; four bytes fill the key
REPEATS = (2, 3, 5, 9)
MULTIPLIER = np.uint32(0x9E3779B1)
STRIP = 1 << 20  # bytes hashed at once


def ngram_set(text: bytes) -> np.ndarray:
    """The hashed n-grams that a text holds, ascending: of bytes, and of one word repeated."""
    seen = np.zeros(1 << BITS, bool)
    for at in range(0, len(text), STRIP):
        # a strip reads on into the next one, so that no n-gram is lost between them
        data = np.frombuffer(text[at : at + STRIP + ORDERS[-1] - 1], np.uint8).astype(np.uint32)
        grams = np.zeros(len(data), np.uint32)
        for order in ORDERS:
            if len(data) < order:
                break
            grams = (grams[: len(data) - order + 1] << np.uint32(8)) | data[order - 1 :]
            seen[((grams + np.uint32(order)) * MULTIPLIER) >> np.uint32(32 - BITS)] = True
    words = text.split()
    same = bytes(map(operator.eq, words, words[1:]))
    for order in REPEATS:
        if bytes([1]) * (order - 1) in same:
            seen[order] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class Model:
    """Score of a text: 1 / (1 + exp(-(slope * margin + shift)))."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, grams: np.ndarray) -> float:
        scaled = self.ratios[grams]
        norm = float(np.sqrt(scaled @ scaled)) or 1.0
        return float(scaled @ self.weights[grams]) / norm + self.bias

    def score(self, text: bytes) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(ngram_set(text)) + self.shift, -500, 500))))


def log_count_ratios(sets: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << BITS))
    for grams, label in zip(sets, good):
        counts[int(label), grams] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, cost: float, passes: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss support vector machine; each class has half of the whole cost."""
    sign = np.where(good, 1.0, -1.0)
    limit = np.where(good, cost / max(1, good.sum()), cost / max(1, (~good).sum())) * len(rows) / 2
    square = np.array([values @ values + 1.0 for _, values in rows])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(1 << BITS), 0.0
    order, draw = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(passes):
        draw.shuffle(order)
        largest = 0.0
        for i in order:
            grams, values = rows[i]
            gradient = sign[i] * (weights[grams] @ values + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                largest = max(largest, abs(step))
                weights[grams] += step * values
                bias += step
                alpha[i] = new
        if largest < 1e-4:
            break
    return weights, bias


def _scaled(sets: list[np.ndarray], ratios: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit length, so that long texts do not outweigh short ones."""
    return [(grams, (v := ratios[grams]) / (float(np.sqrt(v @ v)) or 1.0)) for grams in sets]


def _sigmoid_fit(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed labels, each class with half of the weight."""
    n1, n0 = good.sum(), (~good).sum()
    weight = np.where(good, 0.5 / n1, 0.5 / n0) * len(good)
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, at = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p) * weight)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ ((p - target) * weight))
        at = at - step
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit(sets: list[np.ndarray], good: np.ndarray, *, cost: float = 1.0, passes: int = 30) -> Model:
    """Fit on about four fifths, calibrate on the rest, then fit the weights on all. One class alone: a constant score."""
    nothing = np.zeros(1 << BITS)
    if good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(nothing, nothing, 0.0, 1.0, float(np.log(share / (1 - share))))
    test = np.random.default_rng(11).random(len(sets)) < 0.2
    slope, shift = 1.0, 0.0
    if len(set(good[test])) == 2 and len(set(good[~test])) == 2:
        own = [s for s, t in zip(sets, test) if not t]
        ratios = log_count_ratios(own, good[~test])
        weights, bias = dual_coordinate_descent(_scaled(own, ratios), good[~test], cost, passes)
        part = Model(ratios, weights, bias, 1.0, 0.0)
        margins = np.array([part.margin(s) for s, t in zip(sets, test) if t])
        slope, shift = _sigmoid_fit(margins, good[test])
    ratios = log_count_ratios(sets, good)
    weights, bias = dual_coordinate_descent(_scaled(sets, ratios), good, cost, passes)
    return Model(ratios, weights, bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", sample_rows: int = 6_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most `sample_rows` labelled texts, those with the smallest hash of their id.

    Rows without label or id are left out, a null text counts as empty, an id with several labels once for each. The
    sample's ids are broadcast, so no text is shuffled but the sample's, to the one task that fits. Without labels the
    score is one half everywhere.
    """
    named = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("doc_id is not null and label is not null").distinct()
    chosen = named.orderBy(F.xxhash64("doc_id"), "label").limit(sample_rows)
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # sample_rows rows at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [ngram_set(t).astype("<i4").tobytes() for t in bytes_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(grams, pa.binary())], ["doc_id", "label", "grams"])

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label", "grams"])
        model = fit([np.frombuffer(g, "<i4") for g in frame["grams"]], (frame["label"] > 0).to_numpy())
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    sets = in_arrow(texts.select("doc_id", "text", "label"), features, "doc_id long, label int, grams binary")
    models = in_pandas(sets.withColumn("all", F.lit(0)).groupBy("all"), docs.sparkSession, fitted, "model binary").collect()  # one row of fixed size
    return pickle.loads(bytes(models[0]["model"])) if models else fit([], np.zeros(0, bool))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score per input row; a null text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shared.value.score(t) for t in bytes_of(batch)], pa.float64())], ["doc_id", "score"])

    own = id_and_text(docs, id_col, text_col)
    return in_arrow(own.withColumn("doc_id", own["doc_id"].cast("long")), rate, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, *, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text scores `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) >= least for t in bytes_of(batch, text_col)], pa.bool_()))

    return in_arrow(docs, sift, docs.schema)
