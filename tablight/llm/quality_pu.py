"""Quality classification by non-negative positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled web text is all
training documents. First a logistic classifier tells positives from unlabelled
text on one half of the sample; on the other half the class prior is estimated
from its best bin (Garg et al. 2021): the least ratio of the shares of unlabelled
and of positive texts above a cut, with a confidence margin. Then a classifier
minimises the non-negative unbiased risk (Kiryo et al. 2017)

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

by Adam; when the bracket goes under zero, its gradient is followed upwards.

Features come from the text alone: square roots of the shares of all pairs of
neighbouring byte classes (``PAIRS``), and shares of repeated words, shingles and
lines. The fit uses at most ``max_rows`` positives and as many unlabelled rows,
those with the smallest hash of the id (documented bound); scoring covers all.

Defined results. Null or empty text: the features of nothing, scored as any
other. No positives: score 0 for all. A document with both labels is not a
positive. Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship
from .wordhash import shingles, words

MAX_ROWS = 6_000
CUT = 0.7
#: Byte classes; every other ASCII byte, then all bytes of non-ASCII text, are one class each.
GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b"!", b"?", b":;", b"'\"", b"()[]{}", b"|", b"#", b"%", b"&", b"$", b"*", b"<>=/\\", b"-_~", b"@"]
_CLASS = np.full(256, len(GROUPS) + 1, np.int64)
_CLASS[:128] = len(GROUPS)
for _i, _g in enumerate(GROUPS):
    _CLASS[np.frombuffer(_g, np.uint8)] = _i
N_CLASSES = len(GROUPS) + 2
PAIRS = N_CLASSES * N_CLASSES
N_FEATURES = PAIRS + 6


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    n = len(texts)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    doc = np.repeat(np.arange(n), size)
    cls = _CLASS[buf]
    inside = doc[1:] == doc[:-1]
    key = (doc[:-1] * PAIRS + cls[:-1] * N_CLASSES + cls[1:])[inside]
    pair = np.bincount(key, minlength=n * PAIRS).reshape(n, PAIRS).astype(np.float32)
    pair = np.sqrt(pair / np.maximum(pair.sum(axis=1, keepdims=True), 1))
    w = words(texts)
    count = np.bincount(w.doc, minlength=n).astype(float)
    least = np.maximum(count, 1)
    again = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1]) if len(w.hash) else np.zeros(0, bool)
    order = np.lexsort((w.hash, w.doc))
    hs, ds = w.hash[order], w.doc[order]
    known = (hs[1:] == hs[:-1]) & (ds[1:] == ds[:-1]) if len(hs) else np.zeros(0, bool)
    sdoc, _ = shingles(w, 3)
    windows = np.maximum(count - 2, 1)
    extra = np.stack(
        [
            np.bincount(w.doc[1:], weights=again, minlength=n) / least if len(w.hash) else np.zeros(n),
            np.bincount(ds[1:], weights=known, minlength=n) / least if len(hs) else np.zeros(n),
            1 - np.minimum(np.bincount(sdoc, minlength=n) / windows, 1),
            np.bincount(w.doc, weights=w.end - w.start, minlength=n) / least / 10,
            np.log1p(count) / 10,
            (count == 0).astype(float),
        ],
        axis=1,
    )
    return np.hstack([pair, extra.astype(np.float32)])


@dataclass
class PuModel:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = (features(texts) - self.mean) / self.scale
        return _sigmoid(x @ self.weight + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _adam(x_pos: np.ndarray, x_unl: np.ndarray, prior: float | None, steps: int, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear classifier. prior None: positives against unlabelled rows."""
    d = x_pos.shape[1]
    theta, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    pos, unl = np.hstack([x_pos, np.ones((len(x_pos), 1), x_pos.dtype)]), np.hstack([x_unl, np.ones((len(x_unl), 1), x_unl.dtype)])
    for t in range(1, steps + 1):
        sp, su = _sigmoid(pos @ theta), _sigmoid(unl @ theta)
        up = pos.T @ (sp - 1) / len(pos)  # gradient of the loss of positives called good
        down_u = unl.T @ su / len(unl)
        if prior is None:
            g = (up + down_u) / 2
        else:
            down_p = pos.T @ sp / len(pos)
            neg = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            bracket = down_u - prior * down_p
            g = prior * up + bracket if neg >= 0 else -bracket
        g = g + decay * np.append(theta[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def best_bin_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in the unlabelled scores, by the best bin."""
    cuts = np.unique(pos)
    above_p = 1 - np.searchsorted(np.sort(pos), cuts, side="left") / len(pos)
    above_u = 1 - np.searchsorted(np.sort(unl), cuts, side="left") / len(unl)
    margin = np.sqrt(np.log(4 / delta) / (2 * len(unl))) + np.sqrt(np.log(4 / delta) / (2 * len(pos)))
    at = int(np.argmin((above_u + margin) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[at] / above_p[at], 0.01, 0.99))


def fit_pu(positives: np.ndarray, unlabelled: np.ndarray, steps: int = 400) -> PuModel | None:
    """Fit on feature rows; None without positives or unlabelled rows."""
    if not len(positives) or not len(unlabelled):
        return None
    mean = unlabelled.mean(axis=0)
    scale = np.maximum(unlabelled.std(axis=0), 0.02)
    p, u = (positives - mean) / scale, (unlabelled - mean) / scale
    prior = 0.5
    if len(p) > 3 and len(u) > 3:
        w, b = _adam(p[::2], u[::2], None, steps // 2)
        prior = best_bin_prior(p[1::2] @ w + b, u[1::2] @ w + b)
    w, b = _adam(p, u, prior, steps)
    return PuModel(mean, scale, w, b, prior)


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> PuModel | None:
    """``labels`` (key, quality); ``train`` a boolean column over ``docs``."""
    ship(docs.sparkSession)
    good = labels.where(F.col("quality").isNotNull()).groupBy(key).agg(F.min("quality").alias("_q")).where("_q = 1").select(key)
    rows = docs.where(train).select(key, F.col(text).cast("string").alias("_text"))
    first = F.xxhash64(key)
    ids = rows.select(key)
    pos_ids = ids.join(good, key).distinct().orderBy(first, key).limit(max_rows)
    unl_ids = ids.distinct().orderBy(first, key).limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, "_text", 500_000):
            x = features(texts)
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], names=["x"])

    def sample(chosen: DataFrame) -> np.ndarray:
        picked = rows.join(F.broadcast(chosen), key, "left_semi")  # at most max_rows ids
        got = picked.mapInArrow(run, "x binary").orderBy("x").limit(2 * max_rows).collect()
        return np.array([np.frombuffer(r["x"], np.float16) for r in got], np.float32).reshape(len(got), N_FEATURES)

    return fit_pu(sample(pos_ids), sample(unl_ids))


def score_quality(docs: DataFrame, model: PuModel | None, keep: list[Column | str], text: str = "text", cut: float = CUT) -> DataFrame:
    """``keep`` columns plus score and predicted (1 if score >= cut) of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    sel = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sel.drop("_text").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in chunks(batches, "_text", 1_000_000):
            score = np.zeros(len(texts)) if m is None else m.score(texts)
            cols = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score, pa.float64())], names=[*part.schema.names[:-1], "score"])

    return sel.mapInArrow(run, f"{fields}, score double").withColumn("predicted", (F.col("score") >= cut).cast("int"))
