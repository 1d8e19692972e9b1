"""Language identification by string kernels: blended-spectrum presence kernel, Nyström landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of hashed 1- to 3-grams of letters present in both, over the geometric mean of
their numbers. A bounded sample of labelled rows (about TRAIN_ROWS in all or LEAST_ROWS a language, dealt evenly over all languages by a hash) is fitted
on the driver; scores of all documents are products of a batch's presence matrix with the landmarks' matrix folded
with the regression's weights, which is the same sum in another order.

Defined cases: a null text or one without a letter is `und` with score 0, as is every text if nothing can be learned;
with one learned language every other text gets it with score 1; repeated rows are scored each; an empty table gives
an empty result; whole texts count, in scans that overlap, so long texts need bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import crc_mod, map_batches, table
from touchline.llm.features import spectrum

BITS, TRAIN_ROWS, LEAST_ROWS, LANDMARKS, RIDGE, SHARPNESS, BATCH = 14, 3000, 8, 256, 1e-3, 4.0, 64


def sample(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(lang, packed presence) of about TRAIN_ROWS labelled texts that are not held out, LEAST_ROWS of each language at least."""
    pool = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 4) != 2))
    counts = [(r.lang, r.n) for r in pool.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not counts:
        return []
    quota = max(LEAST_ROWS, TRAIN_ROWS // len(counts))
    rate = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(1.0, quota / n))]), F.col("lang"))
    # by id and text, so that rows without an id or with one id are thinned alike
    place = F.pmod(F.xxhash64(F.lit("pick"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = pool.where(place < rate).select("lang", "text")

    def pack(texts: pa.Array) -> dict[str, pa.Array]:
        return {"bits": pa.array([np.packbits(spectrum(t.as_py() or "", BITS)[0]).tobytes() for t in texts], pa.binary())}

    return [(r.lang, bytes(r.bits)) for r in map_batches(picked, pack, "bits binary", ["lang"], ["text"]).orderBy("lang", "bits").collect()]


def fit(rows: list[tuple[str, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the folded (slots x languages) weights and the intercepts."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros(0)
    x = np.unpackbits(np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    y = np.where(np.array([lang for lang, _ in rows])[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    at = np.unique(np.linspace(0, len(rows) - 1, min(LANDMARKS, len(rows))).astype(int))
    marks = x[at]
    kmm, knm = (marks @ marks.T).astype(np.float64), (x @ marks.T).astype(np.float64)
    value, vector = np.linalg.eigh(kmm)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    phi = knm @ root
    mean = phi.mean(0)
    centred = phi - mean
    w = np.linalg.solve(centred.T @ centred + RIDGE * len(rows) * np.eye(phi.shape[1]), centred.T @ (y - y.mean(0)))
    return langs, (marks.T.astype(np.float64) @ (root @ w)).astype(np.float32), y.mean(0) - mean @ w


def predict(texts: list[str | None], model: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs, weights, bias = model
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    for lo in range(0, len(texts), BATCH):
        part = texts[lo : lo + BATCH]
        seen = np.zeros((len(part), 1 << BITS), np.float32)
        known = np.zeros(len(part), bool)
        for k, text in enumerate(part):
            if text:
                row, known[k] = spectrum(text, BITS)
                seen[k] = row
        if not langs:
            continue
        f = (seen @ weights) / np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1)) + bias
        best = f.argmax(1)
        e = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
        top = (e / e.sum(1, keepdims=True))[np.arange(len(part)), best]
        for k in np.flatnonzero(known):
            names[lo + k], scores[lo + k] = langs[best[k]], min(1.0, float(top[k]))
    return names, scores


def identify(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """keep columns with lang_pred and score; the model is a vector for each learned language."""

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        names, scores = predict(texts.to_pylist(), model)
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

    return map_batches(docs, run, "lang_pred string, score double", keep, ["text"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(sample(docs)), ["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
