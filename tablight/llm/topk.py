"""Exact top-k inner products by a pivot-distance index.

Vectors are made integer and lifted by one coordinate, sqrt(M^2 - |x|^2) with M
the largest norm, so that the largest inner product with a query (lifted by 0) is
the smallest distance. Every vector is keyed by its nearest pivot and the
distance to it; a pivot's vectors are cut into annuli by distance, hot annuli
(copies) are salted into blocks of bounded size. A query first opens the annuli
whose distance range lies nearest to its own distance from their pivot; its k-th
best score there bounds the answer. By the triangle inequality no vector of an
annulus [lo, hi] of pivot p is nearer to q than max(0, d(q,p) - hi, lo - d(q,p)):
the remaining annuli open only if that allows a score of at least the bound.

Pivots come from a bounded, documented sample (``sample`` rows with the smallest
hash of the id, farthest-first); every row is indexed. Queries meet blocks in
bounded groups (query salt, block); scores are exact integers (doubles while
below 2^53, else Python integers; a score beyond 64 bits raises). The table of annuli has n_pivots * n_rings
rows at most, so its broadcast is bounded.

Defined results. Vectors null or with null or non-finite components take no part,
nor do rows with a null id, which no result could name; ids of other types than
integers raise. Shorter vectors count as padded with zeros. Equal vectors tie by id.
Repeated ids are different candidates, but a query never finds rows of its own id;
equal rows of one query id are one query, rows of one query id with different
vectors are one query each, ranked together by id. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, ship

N_PIVOTS, N_RINGS, SAMPLE, BLOCK, PROBE = 16, 8, 2_048, 4_096, 4


def _usable(vec: str) -> F.Column:
    v = F.col(vec)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two int64 matrices."""
    wide = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if wide < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def _matrix(raw: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), dim)


def _top(ids: np.ndarray, scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of each row; ids are sorted."""
    scores = np.where(ids[None, :] == own[:, None], np.iinfo(np.int64).min, scores)
    order = np.argsort(-scores.astype(np.float64) if np.abs(scores).max(initial=0) < 2**53 else ~scores, axis=1, kind="stable")[:, :k]
    row = np.repeat(np.arange(len(own)), order.shape[1])
    col = order.ravel()
    keep = ids[col] != own[row]
    return row[keep], ids[col[keep]], scores[row[keep], col[keep]]


def top_k(vectors: DataFrame, is_query: F.Column, key: str = "vec_id", vec: str = "embedding", k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, key, score): per query its ``k`` best other rows."""
    spark = vectors.sparkSession
    ship(spark)
    if not isinstance(vectors.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer column")
    rows = vectors.where(_usable(vec) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.transform(F.col(vec), lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )
    facts = rows.agg(F.max(F.size("v")).alias("dim"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("top")).first()
    dim, top = int(facts["dim"] or 0), float(facts["top"] or 0.0)
    if dim == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long").withColumnRenamed("vec_id", key)
    some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    pts = np.zeros((len(some), dim + 1))
    for i, v in enumerate(some["v"]):
        pts[i, : len(v)] = v
    pts[:, dim] = np.sqrt(np.maximum(top - (pts[:, :dim] ** 2).sum(axis=1), 0))
    chosen, far = [0], np.linalg.norm(pts - pts[0], axis=1)
    while len(chosen) < min(N_PIVOTS, len(pts)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, np.linalg.norm(pts - pts[chosen[-1]], axis=1))
    pivots = spark.sparkContext.broadcast(pts[chosen])

    def distances(m: np.ndarray, lift: np.ndarray) -> np.ndarray:
        p = pivots.value
        d2 = ((m.astype(float) ** 2).sum(axis=1) + lift**2)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * (m.astype(float) @ p[:, :dim].T + lift[:, None] * p[None, :, dim])
        return np.sqrt(np.maximum(d2, 0))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(2)
            m = np.zeros((len(v), dim), np.int64)
            size = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy()
            at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            m[np.repeat(np.arange(len(v)), size), at] = flat
            lift = np.sqrt(np.maximum(top - (m.astype(float) ** 2).sum(axis=1), 0))
            d = distances(m, lift)
            near = np.argmin(d, axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in m], pa.binary()), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(m)), near])], names=["id", "q", "v", "pivot", "dist"]
            )

    indexed = materialise(rows.mapInArrow(index, "id long, q boolean, v binary, pivot int, dist double"), "topk-index")
    cuts = indexed.groupBy("pivot").agg(F.percentile_approx("dist", [i / N_RINGS for i in range(1, N_RINGS)], 1000).alias("cuts"))
    ring = F.size(F.filter(F.array_distinct("cuts"), lambda c: c < F.col("dist")))
    ringed = indexed.join(F.broadcast(cuts), "pivot").withColumn("ring", (F.col("pivot") * N_RINGS + ring).cast("int")).drop("cuts")
    rings = ringed.groupBy("ring", "pivot").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.count(F.lit(1)).alias("n")).toPandas()
    rings["salts"] = np.maximum(1, -(-rings["n"] // BLOCK))
    shared = spark.sparkContext.broadcast(rings)
    salts = spark.createDataFrame(rings[["ring", "salts"]].astype("int64"))
    blocks = ringed.join(F.broadcast(salts), "ring").select("ring", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "id", "v")
    blocks = materialise(blocks, "topk-blocks")
    queries = indexed.where("q").select("id", "v").distinct()
    q_salts = max(1, -(-queries.count() // BLOCK))

    def plan(first: bool):  # noqa: ANN202
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            r = shared.value
            for b in batches:
                if not len(b):
                    continue
                m = _matrix(b["v"], dim)
                d = distances(m, np.zeros(len(m)))[:, r["pivot"].to_numpy()]
                lo, hi = r["lo"].to_numpy(), r["hi"].to_numpy()
                gap = np.maximum(np.maximum(d - hi, lo - d), 0.0)
                near = np.argsort(gap + 1e-9 * np.abs(d - (lo + hi) / 2), axis=1, kind="stable")
                opened = np.zeros(gap.shape, bool)
                np.put_along_axis(opened, near[:, : min(PROBE, len(r))], True, axis=1)
                if not first:
                    norm = (m.astype(float) ** 2).sum(axis=1)[:, None]
                    room = np.maximum(gap * (1 - 1e-7) - 1e-6 * (1 + np.sqrt(top)), 0.0)
                    best = (norm + top - room**2) / 2
                    opened = ~opened & (best * (1 + 1e-9) + 1.0 >= b["bound"].fillna(-np.inf).to_numpy()[:, None])
                row, col = np.nonzero(opened)
                out = pd.DataFrame({"ring": r["ring"].to_numpy()[col].astype("int32"), "n_salts": r["salts"].to_numpy()[col], "id": b["id"].to_numpy()[row], "v": b["v"].to_numpy()[row], "bound": b["bound"].to_numpy()[row]})
                yield out

        return run

    def visit(asked: DataFrame) -> DataFrame:
        asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_salts") - 1))).withColumn("qs", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(q_salts)))
        # a block is sent only to the query groups that open its annulus
        opened = asked.select("ring", "qs").distinct().groupBy("ring").agg(F.collect_list("qs").alias("all_qs"))
        here = blocks.join(opened, "ring").select("ring", "salt", "id", "v", F.explode("all_qs").alias("qs"))

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype("int64")
            b = b.sort_values("id", kind="stable")
            out, own, ids, right = [], a["id"].to_numpy(), b["id"].to_numpy(), _matrix(b["v"], dim)
            bound = a["bound"].fillna(-np.inf).to_numpy()
            for i in range(0, len(a), 512):
                s = _dots(_matrix(a["v"].iloc[i : i + 512], dim), right)
                row, found, score = _top(ids, s, own[i : i + 512], k)
                ok = score >= bound[i : i + 512][row]
                out.append(pd.DataFrame({"query_id": own[i : i + 512][row[ok]], "id": found[ok], "score": score[ok]}))
            return pd.concat(out)

        return asked.groupBy("ring", "salt", "qs").cogroup(here.groupBy("ring", "salt", "qs")).applyInPandas(meet, "query_id long, id long, score long")

    kind = "ring int, n_salts long, id long, v binary, bound double"
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    start = queries.withColumn("bound", F.lit(None).cast("double")).mapInPandas(plan(True), kind)
    near = materialise(visit(start).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"), "topk-near")
    least = F.min("score").cast("double")
    least = least - F.abs(least) * 1e-15  # never above the integer it stands for
    bound = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, least).alias("bound"))
    rest = queries.join(bound, queries["id"] == bound["query_id"], "left").select("id", "v", "bound").mapInPandas(plan(False), kind)
    found = near.unionByName(visit(rest))
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
    )
