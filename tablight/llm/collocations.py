"""Phrase collocations from sorted count streams.

Words are counted per language; those that occur ``min_count`` times get ids, and
every other word ends a phrase (no frequent phrase holds it). Pairs of neighbours
are counted next, then windows of three to five words all of whose pairs are frequent.
All counts come from sorted streams that are read in order, never from tables of
phrases by hash:

* Pairs and windows in prefix order (range partitions, sorted by their words): those
  that start with a phrase are neighbours, so run sums at every depth are the counts
  of all phrases. A run that touches the edge of a partition gives a partial sum;
  partial sums are added up before the threshold.
* Phrases in prefix order: the first parts of a phrase and its extensions to the
  right stand around it, so one pass with a stack gives the counts of all its first
  parts and its most frequent extension.
* Phrases in suffix order (sorted by their words from the end): the same pass gives
  the counts of all last parts and the most frequent extension to the left.
* Both streams are merge-joined in lockstep, phrase by phrase. A phrase whose first
  parts lie in an earlier partition finds them in a list of at most four phrases a
  partition.

An extension by one word is enough for the redundancy test: counts never grow with
the phrase, so if a longer phrase around it is as frequent, the one-word extension
between them is too. Scores are Python integers.

Word ids follow frequency. The ``dictionary`` most frequent ones are broadcast; a
word beyond them is rare by construction (at most one ``dictionary``-th of all
words), and its id comes by a join with the distinct words of a block of rows.
Frequent pairs are broadcast as a sorted array while there are at most ``PAIRS``
(16 MB); beyond, windows are not shortened by them, which costs rows but changes no
count.

Defined results. Null text: no words. Null language: ``und``. Repeated rows count
each. Empty table, or no phrase of ``min_count``: no rows. Ties in rank go by count,
then by the phrase in byte order. Other columns, the key too, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablight.functions.ranking import global_rank

from .common import chunks, materialise, release, ship

MIN_COUNT, MAX_WORDS, LIMIT, COVER_PERCENT = 100, 5, 2000, 100
DICTIONARY, WORD_BYTES = 500_000, 256
FLUSH_WORDS, FLUSH_IDS = 400_000, 8_000_000
PAIRS = 2_000_000
_WIDTH = 31  # bits of an id: two ids make a long
#: A-Z in lower case; piece ends as line breaks; tabs as blanks.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_GRAM = [f"g{i}" for i in range((MAX_WORDS + 1) // 2)]


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text in order, a line break between pieces, empty strings where
    blanks meet."""
    return raw.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _by_language(part: pa.RecordBatch) -> dict[str, list[int]]:
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(part.column(0).to_pylist()):
        rows.setdefault(lang, []).append(i)
    return rows


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n); the row without a word holds the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(b"\n", None)
                c.pop(b"", None)
                words = [None, *c]
                counts = [sum(c.values()), *c.values()]
                cols = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "word", "n"])
            held.clear()

        for part, texts in chunks(batches, "text"):
            for lang, rows in _by_language(part).items():
                c = held.setdefault(lang, Counter())
                for i in rows:
                    c.update(tokens(texts[i]))
            if sum(map(len, held.values())) > FLUSH_WORDS:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _ranks(ids: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """For each place, the rank (from 1; 0: none) of the frequent phrase of
    ``len(known) + 1`` words that starts there. Array k of ``known`` is sorted and holds
    the rank of the first k + 1 words and the id of the next as one number."""
    rank = ids
    for k, array in enumerate(known):
        key = np.where(rank[: len(ids) - k - 1] > 0, (rank[: len(ids) - k - 1] << _WIDTH) | ids[k + 1 :], -1)
        at = np.searchsorted(array, key)
        hit = at < len(array)
        hit[hit] = array[at[hit]] == key[hit]
        rank = np.zeros(len(ids), np.int64)
        rank[: len(key)] = np.where(hit, at + 1, 0)
    return rank


def windows_of(ids: np.ndarray, max_words: int, known: list[np.ndarray]) -> np.ndarray:
    """Windows (rows of ``max_words`` ids, 0 after their end), one for each place in
    ``ids``, where 0 ends a phrase: all their parts of ``len(known) + 1`` words are
    frequent, and they have more words than these."""
    n, part = len(ids), len(known) + 1
    out = np.zeros((max_words, n), np.int64)
    if n <= part:
        return out[:, :0]
    go = _ranks(ids, known) > 0
    alive = go.copy()
    for k in range(max_words):
        if k >= part:
            step = k - part + 1
            alive[: max(n - step, 0)] &= go[step:]
            alive[max(n - step, 0) :] = False
        out[k, : max(n - k, 0)] = np.where(alive[: max(n - k, 0)], ids[k:], 0)
    return out[:, out[part] > 0]


def _packed(w: np.ndarray) -> list[np.ndarray]:
    """Two ids a long, in an order that sorts as the words do."""
    cols = []
    for k in range(0, len(w), 2):
        second = w[k + 1] if k + 1 < len(w) else 0
        cols.append((w[k] << _WIDTH) | second)
    return cols


def _sorted_counts(cols: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    first = np.ones(len(order), bool)
    first[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    at = np.flatnonzero(first)
    return [c[at] for c in cols], np.add.reduceat(n[order], at) if len(at) else n[:0]


def window_counts(
    docs: DataFrame, dictionary: dict[str, dict[bytes, int]], max_words: int, extra: DataFrame | None = None, known: list[np.ndarray] | None = None
) -> DataFrame:
    """(g0, g1, ..., n): distinct windows of each task with their counts. ``extra``
    holds ids of words outside the dictionary by block: (block, lang, word, id)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)
    frequent = spark.sparkContext.broadcast(known or [])
    names = _GRAM[: (max_words + 1) // 2]
    schema = ", ".join(f"{g} long" for g in names) + ", n long"

    def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
        packed = [np.concatenate(c) for c in zip(*held, strict=True)]
        held.clear()
        cols, n = _sorted_counts(packed, np.ones(len(packed[0]), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, n)], names=[*names, "n"])

    def counted(parts: Iterator[tuple[dict[bytes, int], list[bytes]]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, texts in parts:
            found: list[np.ndarray] = []
            for raw in texts:
                found.append(np.fromiter(map(ids.get, filter(None, tokens(raw)), repeat(0)), np.int64))
                found.append(np.zeros(1, np.int64))
            w = windows_of(np.concatenate(found), max_words, frequent.value)
            held.append(_packed(w))
            size += w.size
            if size > FLUSH_IDS:
                yield flushed(held)
                size = 0
        if size:
            yield flushed(held)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[dict[bytes, int], list[bytes]]]:
            for part, texts in chunks(batches, "text"):
                for lang, rows in _by_language(part).items():
                    yield shared.value.get(lang, {}), [texts[i] for i in rows]

        return counted(parts())

    if extra is None:
        return docs.mapInArrow(plain, schema)

    def joined(block: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        def parts() -> Iterator[tuple[dict[bytes, int], list[bytes]]]:
            for lang, rows in block.groupby("lang"):
                own = more[more["lang"] == lang]
                ids = shared.value.get(lang, {}) | {w.encode(): int(i) for w, i in zip(own["word"], own["id"], strict=True)}
                yield ids, [(t or "").encode() for t in rows["text"]]

        found = [b.to_pandas() for b in counted(parts())]
        return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in (*names, "n")})

    return docs.groupBy("block").cogroup(extra.groupBy("block")).applyInPandas(joined, schema)


def ids_beyond(docs: DataFrame, outside: DataFrame, dictionary: dict[str, dict[bytes, int]]) -> DataFrame:
    """(block, lang, word, id): for each block of rows, ids of its words that are
    frequent but outside the dictionary (``outside``: lang, word, id). Such a word holds a small share of all
    words, so its join key is never hot."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            found = set()
            for lang, block, raw in zip(part.column(0).to_pylist(), part.column(part.schema.get_field_index("block")).to_pylist(), texts, strict=True):
                known = shared.value.get(lang, {})
                found.update((block, lang, w) for w in set(tokens(raw)) if w not in known)
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "lang", "word"])

    words = docs.select("lang", "block", "text").mapInArrow(run, "block long, lang string, word string").distinct()
    return words.join(outside, ["lang", "word"]).select("block", "lang", "word", "id")


def phrase_counts(windows: DataFrame, min_count: int, min_words: int, max_words: int) -> DataFrame:
    """(w array<int>, n) of every phrase of ``min_words`` to ``max_words`` words with
    ``min_count``: run sums over the windows in prefix order."""
    names = _GRAM[: (max_words + 1) // 2]
    low = (1 << _WIDTH) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_runs: list[tuple[tuple[int, ...], int, bool] | None] = [None] * (max_words + 1)  # key, sum, touches the start
        seen = False

        def emit(rows: list[tuple[tuple[int, ...], int]]) -> pa.RecordBatch:
            w = pa.array([r[0] for r in rows], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([w, pa.array([r[1] for r in rows], pa.int64())], names=["w", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            packed = [b.column(i).to_numpy() for i in range(len(names))]
            n = b.column(len(names)).to_numpy()
            w = np.stack([x for p in packed for x in (p >> _WIDTH, p & low)])[:max_words]
            rows: list[tuple[tuple[int, ...], int]] = []
            change = np.zeros(b.num_rows, bool)
            change[0] = True
            for k in range(1, max_words + 1):
                change[1:] |= w[k - 1, 1:] != w[k - 1, :-1]
                if k < min_words:
                    continue
                at = np.flatnonzero(change)
                sums = np.add.reduceat(n, at)
                whole = w[k - 1, at] > 0  # windows that end earlier are no phrase of k words
                last = len(at) - 1
                keep = np.flatnonzero(whole & ((sums >= min_count) | (np.arange(len(at)) == 0) | (np.arange(len(at)) == last)))
                before = open_runs[k]
                open_runs[k] = None
                merged = False
                for r in keep:
                    key, total = tuple(w[:k, at[r]].tolist()), int(sums[r])
                    from_start = r == 0 and not seen
                    if r == 0 and before is not None and before[0] == key:
                        total, from_start, merged = total + before[1], before[2], True
                    if r == last:
                        open_runs[k] = (key, total, from_start)
                    elif total >= min_count or from_start:
                        rows.append((key, total))
                if before is not None and not merged and (before[1] >= min_count or before[2]):
                    rows.append(before[:2])
            seen = True
            if rows:
                yield emit(rows)
        rest = [r[:2] for r in open_runs if r is not None]
        if rest:
            yield emit(rest)

    ordered = windows.repartitionByRange(*names).sortWithinPartitions(*names)
    partial = ordered.select(*names, "n").mapInArrow(run, "w array<int>, n long")
    return partial.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


_STREAM = "w array<int>, n long, parts array<long>, longer long"


def stream_pass(phrases: DataFrame) -> DataFrame:
    """One pass over phrases (w, n) in the order of w: adds ``parts``, the counts of
    the proper first parts by length, and ``longer``, the count of the most frequent
    phrase with one more word (0: none). First parts in an earlier partition are null;
    each such part also gives a row without n, with the ``longer`` found here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # [phrase, count or None, longer]
        for b in batches:
            out: list[tuple] = []

            def pop() -> None:
                w, n, longer = stack.pop()
                out.append((w, n, [s[1] for s in stack], longer))

            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                while stack and w[: len(stack[-1][0])] != stack[-1][0]:
                    pop()
                for k in range(len(stack) + 1, len(w)):
                    stack.append([w[:k], None, 0])
                if stack:
                    stack[-1][2] = max(stack[-1][2], n)
                stack.append([w, n, 0])
            yield batch(out)
        out = []
        while stack:
            w, n, longer = stack.pop()
            out.append((w, n, [s[1] for s in stack], longer))
        yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = [pa.list_(pa.int32()), pa.int64(), pa.list_(pa.int64()), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["w", "n", "parts", "longer"])

    return phrases.select("w", "n").repartitionByRange("w").sortWithinPartitions("w").mapInArrow(run, _STREAM)


def _missing(stream: DataFrame, phrases: DataFrame) -> dict[tuple[int, ...], tuple[int, int]]:
    """First parts that lie in an earlier partition than some phrase: {words: (count,
    most frequent extension found elsewhere)}. At most four a partition."""
    parts = stream.where("n IS NULL").groupBy("w").agg(F.max("longer").alias("longer"))
    rows = phrases.join(F.broadcast(parts), "w").select("w", "n", "longer").collect()
    return {tuple(r["w"]): (r["n"], r["longer"]) for r in rows}


def score(w: tuple[int, ...], a: int, total: int, left: list[int], right: list[int]) -> tuple[int, int, int]:
    """(score, l, r) of the lowest-scoring cut, ties to the shortest first part."""
    cuts = [(1000 * a * total // (left[k - 1] * right[len(w) - k - 1]), k) for k in range(1, len(w))]
    low, k = min(cuts)
    return low, left[k - 1], right[len(w) - k - 1]


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    limit: int = LIMIT, cover_percent: int = COVER_PERCENT, dictionary: int = DICTIONARY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``limit`` best phrases a language."""
    spark = docs.sparkSession
    ship(spark)
    sel = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counts = materialise(word_counts(sel).where(F.col("word").isNull() | (F.col("n") >= min_count)), "phrases-words")
    totals = counts.where("word IS NULL").select("lang", F.col("n").alias("total"))
    words = counts.where("word IS NOT NULL")
    vocab = materialise(global_rank(words, [F.desc("n"), F.col("lang"), F.col("word")], rank_col="id").withColumn("id", F.col("id") + 1), "phrases-vocabulary")

    # the most frequent words of bounded length and number go to every task
    held: dict[str, dict[bytes, int]] = {}
    for r in vocab.where((F.col("id") <= dictionary) & (F.octet_length("word") <= WORD_BYTES)).collect():
        held.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
    outside = vocab.where((F.col("id") > dictionary) | (F.octet_length("word") > WORD_BYTES))
    if outside.isEmpty():
        outside, rows, extra = None, sel, None
    else:
        # block numbers are stored with the rows: they must not change when a task runs again
        rows = materialise(sel.withColumn("block", F.expr("monotonically_increasing_id() div 64")), "phrases-rows")
        extra = ids_beyond(rows, outside, held)
    known: list[np.ndarray] = []
    found, top = [], min(2, max_words)
    while True:
        windows = materialise(window_counts(rows, held, top, extra, known), "phrases-windows")
        counted = materialise(phrase_counts(windows, min_count, len(known) + 2, top), "phrases-counted")
        release(windows)
        if top == max_words:
            found.append(counted)
            break
        if counted.count() > PAIRS:
            top = max_words  # counts again what this step counted
            continue
        found.append(counted)
        w = counted.select(*[F.col("w")[k].cast("long").alias(f"w{k}") for k in range(top)]).toPandas().to_numpy(np.int64)
        rank = _ranks(w[:, : top - 1].ravel(), known)[:: top - 1] if len(w) else w[:, 0]
        known.append(np.sort((rank << _WIDTH) | w[:, -1]))
        top = max_words
    long_phrases = found[0]
    for more in found[1:]:
        long_phrases = long_phrases.unionByName(more)
    single = vocab.select(F.array(F.col("id").cast("int")).alias("w"), "n")
    phrases = materialise(long_phrases.unionByName(single), "phrases-counts")

    prefix = materialise(stream_pass(phrases), "phrases-prefix")
    reverse = phrases.select(F.reverse("w").alias("w"), "n")
    suffix = materialise(stream_pass(reverse), "phrases-suffix")
    lost = spark.sparkContext.broadcast((_missing(prefix, phrases), _missing(suffix, reverse)))

    left = prefix.where("n IS NOT NULL AND size(w) > 1").select("w", "n", F.col("parts").alias("left"), F.col("longer").alias("longer_right"))
    right = suffix.where("n IS NOT NULL AND size(w) > 1").select(F.reverse("w").alias("w"), F.col("parts").alias("right"), F.col("longer").alias("longer_left"))
    both = left.join(right.hint("merge"), "w")
    both = named(both, held, outside).join(F.broadcast(totals), "lang")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lost_left, lost_right = lost.value
        for df in batches:
            rows = []
            for r in df.itertuples(index=False):
                w = tuple(r.w)
                back = w[::-1]
                a = int(r.n)
                longer = max(int(r.longer_left), int(r.longer_right), lost_left.get(w, (0, 0))[1], lost_right.get(back, (0, 0))[1])
                if 100 * longer >= cover_percent * a:
                    continue
                l_parts = [int(x) if x is not None and x == x else lost_left[w[: k + 1]][0] for k, x in enumerate(r.left)]
                r_parts = [int(x) if x is not None and x == x else lost_right[back[: k + 1]][0] for k, x in enumerate(r.right)]
                low, lc, rc = score(w, a, int(r.total), l_parts, r_parts)
                rows.append((r.lang, r.phrase, a, lc, rc, int(r.total), low))
            yield pd.DataFrame(rows, columns=["lang", "phrase", "a", "l", "r", "n", "score"])

    judged = both.mapInPandas(judge, "lang string, phrase string, a long, l long, r long, n long, score long")
    judged = materialise(judged, "phrases-judged")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the best of each part of a language first, so that no task ranks a whole language
    salts = max(8, judged.count() // 50_000)
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    some = judged.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= limit)
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def named(phrases: DataFrame, held: dict[str, dict[bytes, int]], outside: DataFrame | None) -> DataFrame:
    """Adds ``lang`` and ``phrase`` to phrases (w, ...). Words of the dictionary, the
    only ones that can be in many phrases, are looked up in the tasks; the others join."""
    shared = phrases.sparkSession.sparkContext.broadcast({i: (lang, w.decode()) for lang, ids in held.items() for w, i in ids.items()})

    @F.pandas_udf("lang string, words array<string>")
    def known(ids: pd.Series) -> pd.DataFrame:
        found = [[shared.value.get(int(i), (None, None)) for i in w] for w in ids]
        return pd.DataFrame({"lang": [next((x for x, _ in f if x is not None), None) for f in found], "words": [[x for _, x in f] for f in found]})

    out = phrases.withColumn("known", known("w")).select("*", "known.*").drop("known")
    if outside is None:
        return out.withColumn("phrase", F.array_join("words", " ")).drop("words")
    beyond = outside.select(F.col("id").cast("int").alias("id"), F.col("word").alias("found"), F.col("lang").alias("found_lang"))
    slots = out.select("w", F.posexplode(F.arrays_zip("w", "words")).alias("pos", "slot")).where("slot.words IS NULL")
    filled = slots.join(beyond, F.col("slot.w") == F.col("id")).groupBy("w").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "found"))).alias("at"), F.max("found_lang").alias("found_lang")
    )
    out = out.join(filled, "w", "left").withColumn("lang", F.coalesce("lang", "found_lang"))
    word = F.transform("words", lambda x, i: F.coalesce(x, F.element_at("at", i)))
    return out.withColumn("phrase", F.array_join(word, " ")).drop("words", "at", "found_lang")
