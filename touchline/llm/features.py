"""Hashed n-gram indicators of whole texts and small training samples for the text models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.base import crc_mod
from touchline.llm.kernels import repeated_words

#: Code points scanned at a time; longer texts take several scans that overlap by an n-gram.
SCAN = 1 << 20
_LETTER = np.zeros(1 << 16, np.uint32)
for _c in range(1 << 16):
    if not 0xD800 <= _c < 0xE000 and (_s := chr(_c)).isalpha():
        _LETTER[_c] = ord(_s.lower()) if len(_s.lower()) == 1 else _c
# classes of characters: letters by case, digits, blanks, line ends, and each ASCII sign for itself
_CLASS = np.full(1 << 16, 1, np.uint32)
for _c in range(1 << 16):
    if 0xD800 <= _c < 0xE000:
        continue
    _s = chr(_c)
    _CLASS[_c] = 2 if _s.islower() else 3 if _s.isupper() else 4 if _s.isdigit() else 6 if _s in "\n\r" else 5 if _s.isspace() else (8 + _c) if _c < 128 else 7 if _s.isalpha() else 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def scans(text: str, overlap: int):
    for at in range(0, max(len(text), 1), SCAN):
        yield code_points(text[max(0, at - overlap) : at + SCAN])


def _slots(symbols: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashed slots of all n-grams of symbols."""
    h = np.full(max(0, len(symbols) - n + 1), n, np.uint32)
    for j in range(n):
        h = (h ^ symbols[j : j + len(h)]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def spectrum(text: str, bits: int, longest: int = 3) -> tuple[np.ndarray, bool]:
    """Presence of the blended 1- to longest-gram spectrum of letters (others are blanks); whether there is a letter."""
    seen = np.zeros(1 << bits, np.uint8)
    letters = False
    for cp in scans(text, longest - 1):
        low = np.where(cp < 1 << 16, _LETTER[np.minimum(cp, (1 << 16) - 1)], cp)
        letters |= bool(low.any())
        for n in range(1, longest + 1):
            seen[_slots(low, n, bits)] = 1
    return seen, letters


SHAPE_BITS, LEVELS, EXTRA = 12, (0.0, 1 / 128, 1 / 32, 1 / 8), 40
SHAPE_SIZE = len(LEVELS) * (1 << SHAPE_BITS) + EXTRA
_STEPS = np.array([0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8])


def shape_indicators(text: str, hashes: np.ndarray) -> np.ndarray:
    """Indicators of character-class 3-grams at four levels of their share, and of repeated word n-grams at ten levels.

    hashes: the text's word hashes in order.
    """
    count = np.zeros(1 << SHAPE_BITS, np.int64)
    for cp in scans(text, 0):
        kinds = _CLASS[np.minimum(cp, (1 << 16) - 1)]
        count += np.bincount(_slots(kinds, 3, SHAPE_BITS), minlength=1 << SHAPE_BITS)
    share = count / max(1, count.sum())
    n = max(1, len(hashes))
    again = float((hashes[1:] == hashes[:-1]).sum()) / n
    known = 1 - len(np.unique(hashes)) / n
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    known2 = 1 - len(np.unique(pairs)) / max(1, len(pairs)) if len(pairs) else 0.0
    rates = [again, known, known2, repeated_words(hashes, 8) / n]
    return np.concatenate([*((share > x) for x in LEVELS), *((r > _STEPS) for r in rates)]).astype(np.uint8)


def labelled_ids(labels: DataFrame, label: str, per_class: int, modulus: int) -> list[tuple[int, int]]:
    """At most per_class ids of each value 0 and 1, those first in a hash order, among rows whose crc32 mod modulus isn't 0."""
    pool = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod("doc_id", modulus) != 0)).groupBy("doc_id").agg(F.max(label).alias("y"))
    order = F.md5(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).cast("binary"))
    found: list[tuple[int, int]] = []
    for y in (0, 1):
        found += [(r.doc_id, y) for r in pool.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class).select("doc_id").collect()]
    return found


def thinned(rows: DataFrame, most: int) -> DataFrame:
    """rows, or if they are more than most (ids that repeat), about so many of them by a hash of id and text."""
    count = rows.count()
    if count <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int((1 << 20) * most / count))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression by Newton's method; x: rows by few features."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) / len(y) + ridge * np.append(w[:-1], 0)
        hess = (a * (p * (1 - p))[:, None]).T @ a / len(y) + np.diag(np.append(np.full(len(w) - 1, ridge), 1e-9))
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
