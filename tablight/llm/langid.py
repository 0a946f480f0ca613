"""Language identification by bit-sliced Bloom filters of letter n-grams.

Training counts the n-grams of the lower-cased texts of every labelled document
per language (one pass, partial counts per task, one aggregate). A language's
set holds the n-grams that make up at least ``min_share`` of its n-grams and occur
at least ``rival`` times as often in it, relatively, as in any other language --
passages quoted from another language thus stay out. A share bounds the set: at
most 1/min_share n-grams per language and order, whatever the corpus.

The sets go into one filter whose cells are bit masks over the languages: an
n-gram sets its language's bit in ``hashes`` cells. Looking up an n-gram is the AND
of its cells: the mask of all languages containing it. For a text the masks'
bits are counted per language, corrected for the language's false-positive rate
f: (count - f n) / (1 - f). The language with most n-grams wins (ties: the first
in alphabetical order); the score is its share of the text's n-grams.

Cells are 64-bit words; more than 64 languages use several planes. The filter's
size is fixed by ``min_share`` (about 8 cells per n-gram), so its broadcast is.

Defined results. Null text or no letter: ``und``, score 0. No labelled document:
``und``, score 0 for all. Null language labels are not learned. Repeated rows are
learned and returned each. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship
from .wordhash import mix

ORDERS = (2, 3, 4)
MIN_SHARE = 2e-6
RIVAL = 0.02
HASHES = 3
UNDEFINED = "und"
_U = np.uint64
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> is a letter (Unicode categories L*), built once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[bytes], orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram hash) of all n-grams of letters and word borders, and
    per text whether it has a letter. A border is written as one blank; blanks
    stand only at the ends of an n-gram."""
    lowered = [t.decode().lower() for t in texts]
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    cp = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le"), np.uint32)
    letter = _letters()[cp]
    doc = np.repeat(np.arange(len(lowered)), sizes)
    has = np.zeros(len(lowered), bool)
    has[doc[letter]] = True
    keep = letter.copy()  # one blank per border
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1] & ~letter[1:]
    sym, doc, letter = np.where(letter, cp, 32)[keep].astype(_U), doc[keep], letter[keep]
    docs, hashes = [], []
    n = len(sym)
    for k in orders:
        if n < k:
            continue
        h, inner = np.zeros(n - k + 1, _U), np.ones(n - k + 1, bool)
        for j in range(k):
            h = h * _U(0x100000001B3) + sym[j : n - k + 1 + j]
            if 0 < j < k - 1:
                inner &= letter[j : n - k + 1 + j]
        inner &= (letter[: n - k + 1] | letter[k - 1 :]) & (doc[: n - k + 1] == doc[k - 1 :])
        docs.append(doc[: n - k + 1][inner])
        hashes.append(mix(h[inner] + _U(k)))
    none = np.zeros(0, np.int64)
    return (np.concatenate(docs) if docs else none), (np.concatenate(hashes) if hashes else none.astype(_U)), has


@dataclass
class LangFilter:
    langs: list[str]
    planes: np.ndarray  # (planes, cells) of 64-bit masks
    false_rate: np.ndarray
    orders: tuple[int, ...]
    hashes: int

    def masks(self, h: np.ndarray) -> np.ndarray:
        """(planes, n) masks of the languages that contain each n-gram."""
        cells = _U(self.planes.shape[1] - 1)
        out = np.full((len(self.planes), len(h)), _U(0xFFFFFFFFFFFFFFFF))
        step = mix(h ^ _U(0x5851F42D4C957F2D)) | _U(1)
        for i in range(self.hashes):
            out &= self.planes[:, (h + _U(i) * step) & cells]
        return out

    def score(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        doc, h, has = grams(texts, self.orders)
        n = np.bincount(doc, minlength=len(texts)).astype(float)
        masks = self.masks(h)
        hits = np.zeros((len(self.langs), len(texts)))
        for i in range(len(self.langs)):
            bit = (masks[i // 64] >> _U(i % 64)) & _U(1)
            hits[i] = np.bincount(doc, weights=bit, minlength=len(texts))
        f = self.false_rate[:, None]
        fixed = np.clip((hits - f * n) / (1 - f), 0, None)
        best = np.argmax(fixed, axis=0)
        score = np.where(has, np.clip(fixed[best, np.arange(len(texts))] / np.maximum(n, 1), 0, 1), 0.0)
        return [self.langs[b] if ok else UNDEFINED for b, ok in zip(best, has, strict=True)], score


def count_grams(docs: DataFrame, text: str, lang: str, orders: tuple[int, ...]) -> DataFrame:
    """(lang, gram, n): n-gram counts of every labelled document."""
    sel = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def fold(parts: list) -> tuple[np.ndarray, np.ndarray]:
            u, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return u, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(u)).astype(np.int64)

        for part, texts in chunks(batches, "_text"):
            langs = np.array(part.column(0).to_pylist(), object)
            doc, h, _ = grams(texts, orders)
            of = langs[doc] if len(doc) else langs[:0]
            for one in set(langs):
                u, c = np.unique(h[of == one], return_counts=True)
                parts = held.setdefault(one, [])
                parts.append((u, c))
                if len(parts) >= 16:
                    held[one] = [fold(parts)]
        for one, parts in held.items():
            u, c = fold(parts)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(c)], names=["lang", "gram", "n"])

    return sel.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_language_filter(
    docs: DataFrame, text: str = "text", lang: str = "lang", orders: tuple[int, ...] = ORDERS, min_share: float = MIN_SHARE, rival: float = RIVAL, hashes: int = HASHES
) -> LangFilter | None:
    """Learn the filter from all rows with a language; None if there are none."""
    from .common import materialise, release

    ship(docs.sparkSession)
    counts = materialise(count_grams(docs, text, lang, orders), "lang-grams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(total), "lang").withColumn("share", F.col("n") / F.col("total"))  # one row per language
    top = share.groupBy("gram").agg(F.max("share").alias("top"))
    sure = share.where(F.col("share") >= min_share).join(top, "gram").where(F.col("share") >= rival * F.col("top"))
    found = sure.select("lang", "gram").toPandas()  # at most 1/min_share rows per language
    release(counts)
    langs = sorted(found["lang"].unique())
    if not langs:
        return None
    per = found["gram"].nunique()
    cells = 1 << max(10, int(np.ceil(np.log2(8 * per))))
    out = LangFilter(langs, np.zeros((-(-len(langs) // 64), cells), _U), np.zeros(len(langs)), tuple(orders), hashes)
    for i, one in enumerate(langs):
        h = found.loc[found["lang"] == one, "gram"].to_numpy(np.int64).view(_U)
        step = mix(h ^ _U(0x5851F42D4C957F2D)) | _U(1)
        slice_ = np.zeros(cells, bool)
        for k in range(hashes):
            slice_[((h + _U(k) * step) & _U(cells - 1)).astype(np.int64)] = True
        out.planes[i // 64][slice_] |= _U(1 << (i % 64))
        out.false_rate[i] = slice_.mean() ** hashes
    return out


_FILTER: dict[str, LangFilter | None] = {}


def predict_language(docs: DataFrame, model: LangFilter | None, keep: list[Column | str], text: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred and score of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    sel = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    kept = sel.drop("_text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _FILTER:
            _FILTER.clear()
            _FILTER[name] = shared.value
        m = _FILTER[name]
        for part, texts in chunks(batches, "_text"):
            if m is None:
                pred, score = [UNDEFINED] * len(texts), np.zeros(len(texts))
            else:
                pred, score = m.score(texts)
            cols = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*part.schema.names[:-1], "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return sel.mapInArrow(run, f"{fields}, lang_pred string, score double")
