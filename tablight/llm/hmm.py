"""Hidden Markov language model over word classes, trained by Baum-Welch counts.

Tokens are lower-cased words and one end per text. Every text is coded once: texts
are dealt by hash into buckets of bounded size, a bucket lists its distinct tokens
(64-bit hashes) and writes its texts as places in that list. Token counts of the
whole training corpus are one aggregate over the buckets' lists and go back to
the buckets that hold the token, so the vocabulary is never collected.

Model. Each token has a class: the ``n_top`` most frequent training tokens and
the end have their own, all others share ``n_suffix`` classes by the hash of their
last three bytes. K latent states emit classes; a class emits its tokens by
smoothed counts, with one unseen token per class:

    p(text) = sum over state paths of  prod p(state'|state) p(class|state)  *  prod p(token|class)

Start values are the class totals of all training texts, spread at random over the
states. Every round's expected counts are summed over all training texts in all
partitions (fixed-point, so the sums do not depend on their order) and re-estimate
the parameters, until a round raises the log likelihood of the training texts by
less than ``SETTLED`` of itself; ``ROUNDS`` only ends a run that does not settle.
Training cuts texts into segments of ``SEGMENT`` tokens; scoring does
not: the scaled forward recursion gives the exact log likelihood of whole texts.

Only parameters (K x classes) and class totals reach the driver: bounded.

Defined results. Null or empty text: the end alone. Repeated rows are scored (and
learned) each. No training rows: both scores are 0 per token. Null ids are kept.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship
from .wordhash import mix, words

STATES, N_TOP, N_SUFFIX, SEGMENT, ROUNDS = 8, 4_096, 2_048, 256, 100
SETTLED = 1e-6
BUCKET_BYTES = 12_000_000
FIXED = float(1 << 20)
_U = np.uint64
END_HASH = _U(0x0123456789ABCDEF)
_END_SUFFIX = -1


def _suffixes(w, n_suffix: int) -> np.ndarray:  # noqa: ANN001
    """Suffix class of each word: hash of its last three bytes, after ASCII
    punctuation at the end is taken off (unless nothing would be left)."""
    punct = np.zeros(256, bool)
    punct[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
    end = w.end.copy()
    for _ in range(3):
        end -= (end - 1 > w.start) & punct[w.buf[end - 1]]
    key = np.zeros(len(end), _U)
    for k in range(3):
        at = end - 1 - k
        key = key * _U(257) + np.where(at >= w.start, w.buf[np.maximum(at, 0)].astype(_U) + _U(1), _U(0))
    return (mix(key) % _U(n_suffix)).astype(np.int32)


def code_texts(docs: DataFrame, key: str, text: str, train: Column, n_suffix: int, bucket_bytes: int) -> DataFrame:
    """One row per bucket: keys, train flags, lengths and token places of its
    texts; hash, suffix class and training count of its distinct tokens."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(8))).first()[0] or 0
    n = max(1, int(-(-size // bucket_bytes)))
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", F.length("text")), F.lit(n)))

    def code(part: pd.DataFrame) -> pd.DataFrame:
        w = words([t.encode() for t in part["text"]])
        n_docs = len(part)
        per = np.bincount(w.doc, minlength=n_docs)
        out = np.empty(int(per.sum()) + n_docs, _U)
        sfx = np.full(len(out), _END_SUFFIX, np.int32)
        ends = np.cumsum(per + 1) - 1
        body = np.ones(len(out), bool)
        body[ends] = False
        out[ends], out[body], sfx[body] = END_HASH, w.hash, _suffixes(w, n_suffix)
        vocab, first, place = np.unique(out, return_index=True, return_inverse=True)
        seen = np.repeat(part["train"].to_numpy(bool), per + 1)
        count = np.bincount(place[seen], minlength=len(vocab)).astype(np.int64)
        return pd.DataFrame(
            {
                "bucket": [part["bucket"].iloc[0]],
                "keys": [part["key"].tolist()],
                "train": [part["train"].tolist()],
                "sizes": [(per + 1).astype(np.int64).tobytes()],
                "codes": [place.astype(np.int32).tobytes()],
                "vocab": [vocab.tobytes()],
                "suffix": [sfx[first].tobytes()],
                "count": [count.tobytes()],
            }
        )

    schema = f"bucket long, keys array<{kind}>, train array<boolean>, sizes binary, codes binary, vocab binary, suffix binary, count binary"
    return materialise(rows.groupBy("bucket").applyInPandas(code, schema), "hmm-coded")


def token_counts(coded: DataFrame) -> DataFrame:
    """(token, suffix, n, buckets): training counts and where the token occurs."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                v, s, c = np.frombuffer(r["vocab"], np.int64), np.frombuffer(r["suffix"], np.int32), np.frombuffer(r["count"], np.int64)
                for i in range(0, len(v), 50_000):
                    j = min(len(v), i + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(v[i:j]), pa.array(s[i:j]), pa.array(c[i:j]), pa.array(np.full(j - i, r["bucket"], np.int64))], names=["token", "suffix", "n", "bucket"])

    rows = coded.select("bucket", "vocab", "suffix", "count").mapInArrow(lists, "token long, suffix int, n long, bucket long")
    counts = rows.groupBy("token", "suffix").agg(F.sum("n").alias("n"), F.collect_list("bucket").alias("buckets"))
    return materialise(counts.where("n > 0"), "hmm-counts")


@dataclass
class Classes:
    """Class numbering: top tokens by place in ``top`` (sorted), then suffixes, then the end."""

    top: np.ndarray
    n_suffix: int
    log_in: np.ndarray  # log10 of the smoothed total of each class
    total: int
    distinct: int
    counts: np.ndarray | None = None  # training tokens of each class

    @property
    def size(self) -> int:
        return len(self.top) + self.n_suffix + 1

    def of(self, vocab: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        out = len(self.top) + suffix.astype(np.int64)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, vocab), len(self.top) - 1)
            out = np.where(self.top[at] == vocab, at, out)
        return np.where(suffix == _END_SUFFIX, self.size - 1, out)


def learn_classes(counts: DataFrame, n_top: int, n_suffix: int) -> Classes:
    own = counts.where(F.col("suffix") >= 0)
    most = own.orderBy(F.desc("n"), "token").limit(n_top).select("token", "n").toPandas().sort_values("token")
    top = most["token"].to_numpy(np.int64)
    chosen = counts.sparkSession.createDataFrame(pd.DataFrame({"token": top})) if len(top) else None
    rest = own.join(F.broadcast(chosen), "token", "left_anti") if chosen is not None else own
    per = rest.groupBy("suffix").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    everything = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = np.zeros(n_suffix), np.zeros(n_suffix)
    n[per["suffix"]], v[per["suffix"]] = per["n"], per["v"]
    total = int(everything["n"] or 0)
    per_class = np.concatenate([most["n"].to_numpy(float), n])
    return Classes(top, n_suffix, np.log10(n + 0.5 * (v + 1)), total, int(everything["v"] or 0), np.append(per_class, total - per_class.sum()))


@dataclass
class Params:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (states, classes)
    loglik: float = 0.0  # of the texts, where these are counts


def random_params(states: int, unigram: np.ndarray, seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    emit = (unigram + 1e-7)[None, :] * rng.gamma(1.0, 1.0, (states, len(unigram)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Params(np.full(states, 1.0 / states), move, emit / emit.sum(axis=1, keepdims=True))


def segments(cls: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the pieces of at most ``width`` tokens of each text."""
    first = np.cumsum(sizes) - sizes
    n = -(-sizes // width)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(first, n) + at * width
    return begin, np.minimum(width, np.repeat(first + sizes, n) - begin)


def expected_counts(cls: np.ndarray, begin: np.ndarray, length: np.ndarray, p: Params, block: int = 1_024) -> Params:
    """Baum-Welch counts of the segments under ``p`` (scaled forward-backward), with
    their log likelihood (natural)."""
    k, c = p.emit.shape
    out = Params(np.zeros(k), np.zeros((k, k)), np.zeros((k, c)))
    emit = np.ascontiguousarray(p.emit.T, np.float32)
    start, move = p.start.astype(np.float32), p.move.astype(np.float32)
    order = np.argsort(-length, kind="stable")
    for i in range(0, len(order), block):
        ids = order[i : i + block]
        b, ln = begin[ids], length[ids]
        steps = int(ln[0])
        live = np.searchsorted(-ln, -np.arange(steps), side="left")  # segments longer than t
        at = np.concatenate([[0], np.cumsum(live)])  # step t has the rows at[t] to at[t + 1]
        step = np.repeat(np.arange(steps), live)
        symbol = cls[b[np.arange(at[-1]) - at[step]] + step]
        seen = emit[symbol]
        alpha, scale = np.empty((at[-1], k), np.float32), np.empty(at[-1], np.float32)
        a = None
        for t in range(steps):
            lo, hi = at[t], at[t + 1]
            a = (start if t == 0 else a[: hi - lo] @ move) * seen[lo:hi]
            s = a.sum(axis=1)
            a /= s[:, None]
            alpha[lo:hi], scale[lo:hi] = a, s
        out.loglik += float(np.log(scale).sum(dtype=float))
        seen /= scale[:, None]
        beta = np.ones((live[-1] if steps else 0, k), np.float32)
        for t in range(steps - 1, -1, -1):
            lo, hi = at[t], at[t + 1]
            alpha[lo:hi] *= beta
            if t:
                right = seen[lo:hi] * beta
                before = at[t - 1]
                out.move += p.move * (alpha[before : before + hi - lo].T @ right)
                beta = np.ones((lo - before, k), np.float32)
                beta[: hi - lo] = right @ move.T
        out.start += alpha[: at[1]].sum(axis=0)
        for j in range(k):
            out.emit[j] += np.bincount(symbol, weights=alpha[:, j], minlength=c)
    return out


def re_estimate(n: Params, unigram: np.ndarray) -> Params:
    """Parameters from counts; emissions back off to the unigram of classes."""
    k = len(n.start)
    emit = n.emit + 50.0 * unigram[None, :] + 1e-9
    return Params((n.start + 1) / (n.start.sum() + k), (n.move + 1) / (n.move.sum(axis=1, keepdims=True) + k), emit / emit.sum(axis=1, keepdims=True))


def forward(cls: np.ndarray, sizes: np.ndarray, p: Params) -> np.ndarray:
    """log10 p(class sequence) of each text by the scaled forward recursion."""
    out = np.zeros(len(sizes))
    emit = np.ascontiguousarray(p.emit.T)
    order = np.argsort(-sizes, kind="stable")
    begin, ln = (np.cumsum(sizes) - sizes)[order], sizes[order]
    total, a = np.zeros(len(order)), None
    steps = int(ln[0]) if len(ln) else 0
    live = np.searchsorted(-ln, -np.arange(steps), side="left")
    for t in range(steps):
        n = live[t]
        e = emit[cls[begin[:n] + t]]
        a = (p.start * e) if t == 0 else (a[:n] @ p.move) * e
        s = a.sum(axis=1)
        a /= s[:, None]
        total[:n] += np.log10(s)
    out[order] = total
    return out


def _unpack(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["codes"], np.int32), np.frombuffer(r["vocab"], np.int64), np.frombuffer(r["suffix"], np.int32)


def _train_part(r: dict, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Classes and sizes of the training texts of a bucket."""
    sizes, codes, vocab, suffix = _unpack(r)
    keep = np.array(r["train"], bool)
    return classes.of(vocab, suffix)[codes[np.repeat(keep, sizes)]], sizes[keep]


def fit_hmm(coded: DataFrame, classes: Classes, states: int = STATES, rounds: int = ROUNDS) -> Params:
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast(classes)
    size = classes.size
    cols = coded.select("bucket", "train", "sizes", "codes", "vocab", "suffix")

    def count(p: Params):  # noqa: ANN202
        params = spark.sparkContext.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(params.value.start)
            sums = Params(np.zeros(k), np.zeros((k, k)), np.zeros((k, size)))
            for b in batches:
                for r in b.to_pylist():
                    cls, sizes = _train_part(r, shared.value)
                    if len(sizes):
                        got = expected_counts(cls, *segments(cls, sizes, SEGMENT), params.value)
                        sums.start += got.start
                        sums.move += got.move
                        sums.emit += got.emit
                        sums.loglik += got.loglik
            flat = np.concatenate([sums.start, sums.move.ravel(), sums.emit.ravel(), [sums.loglik]])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.rint(flat[at] * FIXED).astype(np.int64))], names=["at", "n"])

        return run

    unigram = (classes.counts + 0.01) / (classes.total + 0.01 * size)
    p, last = random_params(states, unigram), None
    for _ in range(rounds):
        sums = cols.mapInArrow(count(p), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # one number per parameter
        flat = np.zeros(states + states * states + states * size + 1)
        flat[sums["at"]] = sums["n"] / FIXED
        n = Params(flat[:states], flat[states : states + states**2].reshape(states, states), flat[states + states**2 : -1].reshape(states, size), float(flat[-1]))
        p = re_estimate(n, unigram)
        if last is not None and n.loglik - last <= SETTLED * abs(n.loglik):
            break
        last = n.loglik
    return p


def hmm_scores(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", states: int = STATES, n_top: int = N_TOP, n_suffix: int = N_SUFFIX, rounds: int = ROUNDS, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, trained) of every row."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[key].dataType.simpleString()
    coded = code_texts(docs, key, text, train, n_suffix, bucket_bytes)
    counts = token_counts(coded)
    classes = learn_classes(counts, n_top, n_suffix)
    params = spark.sparkContext.broadcast(fit_hmm(coded, classes, states, rounds) if classes.total else None)
    shared = spark.sparkContext.broadcast(classes)

    def score(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        c: Classes = shared.value
        out = []
        for r in part.to_dict("records"):
            sizes, codes, vocab, suffix = _unpack(r)
            n = np.zeros(len(vocab))
            if len(known):
                at = np.searchsorted(vocab.view(_U), known["token"].to_numpy(np.int64).view(_U))
                n[at] = known["n"].to_numpy()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            base = np.log10(n + 0.5) - np.log10(c.total + 0.5 * (c.distinct + 1))
            base_score = np.bincount(doc, weights=base[codes], minlength=len(sizes))
            full = base_score
            if params.value is not None:
                cls = c.of(vocab, suffix)
                shares = (cls >= len(c.top)) & (cls < c.size - 1)
                inside = np.where(shares, np.log10(n + 0.5) - c.log_in[np.where(shares, cls - len(c.top), 0)], 0.0)
                full = forward(cls[codes], sizes, params.value) + np.bincount(doc, weights=inside[codes], minlength=len(sizes))
            out.append(
                pd.DataFrame(
                    {"key": list(r["keys"]), "trained": list(r["train"]), "n_tokens": sizes, "n_known": np.bincount(doc, weights=(n > 0)[codes], minlength=len(sizes)).astype(np.int64), "train_tokens": np.full(len(sizes), c.total, np.int64), "base_score": base_score, "score": full}
                )
            )
        return pd.concat(out) if out else pd.DataFrame({x: [] for x in ("key", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score")})

    back = counts.select(F.explode("buckets").alias("bucket"), "token", "n")
    schema = f"key {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return coded.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInPandas(score, schema).withColumnRenamed("key", key)
