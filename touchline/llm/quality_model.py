"""Quality classifier: naive Bayes support vectors.

n-gram indicators (character-class 3-grams at levels of their share, repeated word n-grams) are scaled by the classes'
log-count ratios; a linear hinge-loss model over them is fitted by dual coordinate descent on a bounded sample of
labelled rows (PER_CLASS of each label, first in a hash order). Its margin becomes a probability by a logistic fit.

Defined cases: null and empty texts have no n-gram and get the score of the intercept; with one label or none to learn
from every score is the sample's mean (0.5 if there is none); repeated rows are scored each; an empty table gives an
empty result; whole texts count, in scans of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import crc_mod, map_batches, materialize, table
from touchline.llm.features import SHAPE_SIZE, fit_logistic, labelled_ids, shape_indicators, sigmoid, thinned
from touchline.llm.kernels import words

PER_CLASS, COST, EPOCHS, SMOOTH, MIN_ROWS, CUT = 2000, 0.1, 30, 1.0, 5, 0.3


def indicators(column: pa.Array) -> list[np.ndarray]:
    out = []
    for row, hashes in words(column):
        out.append(shape_indicators(column[row].as_py() or "", hashes))
    return out


def sample(docs: DataFrame, labels: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Indicator rows and labels of the training sample; its ids are at most 2 * PER_CLASS, so they are broadcast."""
    ids = labelled_ids(labels, label, PER_CLASS, 5)
    if not ids:
        return np.zeros((0, SHAPE_SIZE), np.uint8), np.zeros(0)
    chosen = docs.sparkSession.createDataFrame(ids, "id long, y int")
    rows = materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("y", "text", "doc_id"), "sample")
    rows = thinned(rows, 4 * PER_CLASS)

    def pack(texts: pa.Array) -> dict[str, pa.Array]:
        return {"bits": pa.array([np.packbits(x).tobytes() for x in indicators(texts)], pa.binary())}

    got = map_batches(rows, pack, "bits binary", ["doc_id", "y"], ["text"]).orderBy("doc_id", "bits").collect()
    if not got:
        return np.zeros((0, SHAPE_SIZE), np.uint8), np.zeros(0)
    bits = np.frombuffer(b"".join(bytes(r.bits) for r in got), np.uint8).reshape(len(got), -1)
    return np.unpackbits(bits, axis=1)[:, :SHAPE_SIZE], np.array([r.y for r in got], float)


def dual_descent(x: np.ndarray, sign: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """w of min |w|^2 / 2 + cost * sum of hinge losses, by coordinate descent over the dual."""
    order = np.random.default_rng(3)
    norm = np.einsum("ij,ij->i", x, x)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)):
            if norm[i] <= 0:
                continue
            new = min(max(alpha[i] - (sign[i] * (x[i] @ w) - 1) / norm[i], 0.0), cost)
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4 * cost:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """Used slots, their folded weights, and intercept, slope and offset of the probability."""
    if len(y) == 0 or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return np.zeros(0, int), np.zeros(0), 0.0, 0.0, float(np.log(p / (1 - p)))
    used = np.flatnonzero((x.sum(0) >= MIN_ROWS) & (x.sum(0) < len(x)))
    f = x[:, used].astype(np.float64)
    one, zero = f[y == 1].sum(0) + SMOOTH, f[y == 0].sum(0) + SMOOTH
    ratio = np.log(one / ((y == 1).sum() + 2 * SMOOTH)) - np.log(zero / ((y == 0).sum() + 2 * SMOOTH))
    scaled = np.hstack([f * ratio, np.ones((len(f), 1))])
    w = dual_descent(scaled, np.where(y == 1, 1.0, -1.0), COST, EPOCHS)
    margin = scaled @ w
    a, b = fit_logistic(margin[:, None], y)
    return used, w[:-1] * ratio, float(w[-1]), float(a), float(b)


def apply(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """keep columns with score; the model is a vector of at most SHAPE_SIZE weights."""
    used, weights, bias, a, b = model
    dense = np.zeros(SHAPE_SIZE)
    dense[used] = weights

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        margins = np.array([dense[np.flatnonzero(x)].sum() for x in indicators(texts)])
        return {"score": pa.array(sigmoid(a * (margins + bias) + b), pa.float64())}

    return map_batches(docs, run, "score double", keep, ["text"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(*sample(docs, table(spark, sf_dir, "labels"), "quality"))
    out = apply(docs, model, ["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
