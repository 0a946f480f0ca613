"""Quality rules and a hashed n-gram log-likelihood ratio, DataFrame functions only.

The base rules count words, symbols, repeated lines and words in repeated
three-word windows of each text with array functions on the row itself. The
method compares two multinomials over hashed n-grams of words, of all orders up to
``n`` (1 or 2): one of a trusted target (documents with a trusted label), one of the raw corpus
(all documents). A document's verdict is its mean log ratio per n-gram, at least
``threshold``: length-normalised and deterministic.

Corpus counts are one aggregate per bucket with map-side partial sums (at most
``n_buckets`` rows per task are shuffled). Scoring explodes bucket numbers only,
joins the weights -- ``n_buckets`` rows, a bound known beforehand, hence the
broadcast -- and sums per document before its only shuffle.

Defined results. Null text: empty, no words, base_failed. Repeated rows are
counted and returned each. Texts without n-grams score 0. Empty trusted set: all
ratios 0, the method keeps everything. Other columns are ignored.

Repeated windows: a text whose window hashes are all distinct has none. Else the pairs of 64-bit hash
and place are sorted; equal neighbours are compared word by word, so a collision
marks nothing by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SPACE = r"[ \t\n\x0B\f\r]+"
SYMBOLS = r"[#*$%&|<>]+"
N_BUCKETS = 1 << 17
SMOOTH = 10.0
THRESHOLD = -0.15


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_t", t).withColumn("_w", _words(F.col("_t")))
    word = lambda i: F.get(F.col("_w"), i.cast("int"))
    places = F.when(F.size("_w") >= 3, F.sequence(F.lit(0), F.size("_w") - 3)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("_v", F.transform(places, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    placed = F.transform(F.col("_v"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_v")) < F.size("_v"), F.sort_array(placed)).otherwise(none))
    at = lambda i: F.get(F.col("_s"), i)

    def same(a: Column, b: Column) -> Column:
        p, q = a["i"], b["i"]
        return (a["h"] == b["h"]) & (word(p) == word(q)) & (word(p + 1) == word(q + 1)) & (word(p + 2) == word(q + 2))

    repeated = F.sort_array(
        F.transform(
            F.filter(
                F.col("_s"),
                lambda v, i: F.coalesce(same(v, at(i - 1)), F.lit(False)) | F.coalesce(same(v, at(i + 1)), F.lit(False)),
            ),
            lambda v: v["i"],
        )
    )
    out = out.withColumn("_r", repeated)
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    out = out.withColumn("_l", lines)
    return out.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.aggregate(
            F.transform(
                F.col("_r"),
                lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_r"), i + 1) - p, F.lit(3))).cast("long"),
            ),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ).alias("n_repeat_words"),
    )


def ngram_buckets(docs: DataFrame, keep: list[str], text: str = "text", n: int = 2, n_buckets: int = N_BUCKETS) -> DataFrame:
    """(keep, bucket): one row per word and, for ``n`` = 2, per pair of neighbours, all in generated code."""
    if n not in (1, 2):
        raise ValueError("n is 1 or 2")
    rows = docs.select(*keep, F.split(F.coalesce(F.col(text), F.lit("")), SPACE).alias("_w"))
    bucket = lambda *g: F.pmod(F.xxhash64(*g), F.lit(n_buckets)).cast("int")
    if n == 1:
        rows = rows.select(*keep, F.explode("_w").alias("_g")).where("_g != ''")
        return rows.select(*keep, bucket("_g").alias("bucket"))
    pairs = F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0))).alias("b"))
    rows = rows.select(*keep, F.explode(pairs).alias("_g")).where("_g.a != ''")
    both = F.array(bucket("_g.a"), F.when(F.col("_g.b") != "", bucket("_g.a", "_g.b")))
    return rows.select(*keep, F.explode(both).alias("bucket")).where("bucket IS NOT NULL")


def fit_llr(docs: DataFrame, trusted: Column, text: str = "text", n: int = 2, n_buckets: int = N_BUCKETS, smooth: float = SMOOTH) -> DataFrame:
    """(bucket, weight): log ratio of the trusted to the raw multinomial, for
    every bucket that occurs. ``trusted`` is a boolean column of ``docs``. Each
    bucket gets ``smooth`` extra grams in the target and as many, relatively, in
    the raw corpus: what the corpus hardly holds weighs next to nothing."""
    grams = ngram_buckets(docs.select(F.coalesce(trusted, F.lit(False)).alias("_y"), text), ["_y"], text, n, n_buckets)
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum(F.col("_y").cast("long")).alias("target"))
    counts = materialise(counts, "llr-counts")
    total = counts.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    raw, target = float(total["r"] or 0), float(total["t"] or 0)
    if target == 0:
        return counts.select("bucket", F.lit(0.0).alias("weight"))
    ratio = (F.col("target") + smooth) / (F.col("raw") * (target / raw) + smooth)
    return counts.select("bucket", F.log(ratio).alias("weight"))


def llr_scores(docs: DataFrame, weights: DataFrame, keys: list[str], text: str = "text", n: int = 2, n_buckets: int = N_BUCKETS) -> DataFrame:
    """(keys, llr): mean weight of the n-grams of the rows with these keys; no row
    where there are no n-grams. The keys name the text (an id and a text hash)."""
    grams = ngram_buckets(docs, keys, text, n, n_buckets)
    return grams.join(F.broadcast(weights), "bucket").groupBy(*keys).agg(F.avg("weight").alias("llr"))


def quality_rules(
    docs: DataFrame,
    trusted: Column,
    key: str = "doc_id",
    text: str = "text",
    n: int = 2,
    n_buckets: int = N_BUCKETS,
    threshold: float = THRESHOLD,
    min_words: int = 50,
    max_repeat_pct: int = 50,
) -> DataFrame:
    """One row per row of ``docs``: key, the base counts, base_failed, llr, kept."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"), trusted.alias("_y"))
    rows = rows.withColumn("_h", F.xxhash64("_text", F.length("_text")))
    weights = materialise(fit_llr(rows, F.col("_y"), "_text", n, n_buckets), "llr-weights")
    scores = llr_scores(rows, weights, [key, "_h"], "_text", n, n_buckets).select(F.col(key).alias("_k"), F.col("_h").alias("_g"), "llr")
    base = base_counts(rows.drop("_y"), "_text").drop("_text")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    llr = F.coalesce(F.col("llr"), F.lit(0.0))
    out = base.join(scores, base[key].eqNullSafe(F.col("_k")) & (base["_h"] == F.col("_g")), "left")
    out = out.withColumn("base_failed", failed).withColumn("llr", llr)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"
    )
