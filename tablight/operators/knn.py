"""Exact k-nearest-neighbour classification (Euclidean), with a k search by
cross-validated accuracy.

Neighbours are found by ``functions.nearest``: distances on the first principal
axes bound the whole distance, so a query meets only the blocks of train rows that
can hold one of its k nearest, and few pairs are computed on all axes. Distance
ties go to the lower train key; vote ties go to the smallest class, as
scikit-learn's vote does.

For the k search the largest k is ranked once, with train rows masked when
they share the query's fold, and every smaller k reuses a prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.functions.nearest import Found, nearest_rows
from tablight.functions.ranking import global_rank
from tablight.functions.rounds import written

def is_vector(df: DataFrame, name: str) -> bool:
    from pyspark.ml.linalg import VectorUDT

    return isinstance(df.schema[name].dataType, VectorUDT)


def as_array(col: str | Column, df: DataFrame) -> Column:
    """A vector or numeric-array column as array<double>."""
    name = col if isinstance(col, str) else None
    if name and is_vector(df, name):
        return vector_to_array(F.col(name))
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("array<double>")


def _numbered_keys(train: DataFrame, query: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Both sides with integer keys. Integer keys stay as they are; keys of another
    sortable type are numbered in their order, and the dictionary (num, key) is returned."""
    kinds = [x.schema["key"].dataType for x in (train, query)]
    if all(isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for t in kinds):
        return *[x.withColumn("key", F.col("key").cast("long")) for x in (train, query)], None
    if kinds[0] != kinds[1]:
        raise ValueError(f"keys of different types: {kinds[0].simpleString()}, {kinds[1].simpleString()}")
    names = train.select("key").unionByName(query.select("key")).where("key IS NOT NULL").distinct()
    names = written(global_rank(names, [F.col("key")], rank_col="num").select("num", "key"), "knn-keys")
    return *[x.join(names, "key").drop("key").withColumnRenamed("num", "key") for x in (train, query)], names


def _folds(fold: str | None, df: DataFrame, side: int) -> Column:
    """Folds as numbers that two rows share only if both have that fold."""
    if fold is None:
        return F.lit(side).cast("long")
    whole = isinstance(df.schema[fold].dataType, T.IntegralType)
    return F.when(F.col(fold).isNull(), F.lit(-1 - side).cast("long")).otherwise(F.col(fold).cast("long") if whole else F.xxhash64(fold))


def _find(train: DataFrame, query: DataFrame, k: int, features: str, train_key: str, query_key: str, label: str, fold: str | None, exclude_self: bool, block_rows: int) -> tuple[Found | None, DataFrame | None]:
    t = train.select(
        F.col(train_key).alias("key"), as_array(features, train).alias("vec"),
        F.col(label).cast("double").alias("label"), _folds(fold, train, 0).alias("fold"),
    )
    q = query.select(F.col(query_key).alias("key"), as_array(features, query).alias("vec"), _folds(fold, query, 1).alias("fold"))
    t, q, names = _numbered_keys(t, q)
    return nearest_rows(t, q, k, exclude_self, block_rows), names


def knn_neighbors(
    train: DataFrame, query: DataFrame, k: int, features: str, train_key: str, query_key: str,
    label: str = "label", fold: str | None = None, exclude_self: bool = False, block_rows: int = 2048,
) -> DataFrame:
    """qkey, rank (0-based), tkey, distance, tlabel for the k nearest train rows.

    Keys are unique, of any sortable type. Rows whose key or vector is null, or whose
    vector holds a null or non-finite component, take no part; a null fold is
    shared with no row.
    """
    found, names = _find(train, query, k, features, train_key, query_key, label, fold, exclude_self, block_rows)
    if found is None:
        empty = f"qkey {query.schema[query_key].dataType.simpleString()}, rank int, tkey {train.schema[train_key].dataType.simpleString()}, distance double, tlabel double"
        return train.sparkSession.createDataFrame([], empty)
    rows = found.rows
    if names is not None:
        for c in ("qkey", "tkey"):
            rows = rows.join(names.select(F.col("num").alias(c), F.col("key").alias(f"{c}_name")), c).drop(c).withColumnRenamed(f"{c}_name", c)
    return rows.select("qkey", "rank", "tkey", F.sqrt("d2").alias("distance"), "tlabel")


def knn_work(
    train: DataFrame, query: DataFrame, k: int, features: str, train_key: str, query_key: str,
    label: str = "label", fold: str | None = None, exclude_self: bool = False, block_rows: int = 2048,
) -> DataFrame:
    """One row: all_pairs, met (pairs that came together in a task) and full (pairs
    computed on all axes), the work that the bounds left over."""
    found, _ = _find(train, query, k, features, train_key, query_key, label, fold, exclude_self, block_rows)
    row = (found.work.all_pairs, found.work.met, found.work.full) if found else (0, 0, 0)
    return train.sparkSession.createDataFrame([row], "all_pairs long, met long, full long")


def vote(neighbors: DataFrame, ks: Sequence[int]) -> DataFrame:
    """qkey, k, prediction: majority label of the first k neighbours (ties ->
    smallest label), for every k in ``ks`` from one ranked table."""
    ks_arr = F.array(*[F.lit(int(x)) for x in ks])
    ex = neighbors.select("qkey", "rank", "tlabel", F.explode(ks_arr).alias("k")).where(F.col("rank") < F.col("k"))
    counts = ex.groupBy("qkey", "k", "tlabel").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("qkey", "k").agg(
        F.min_by("tlabel", F.struct((-F.col("n")).alias("nn"), F.col("tlabel").alias("l"))).alias("prediction")
    )


def knn_predict(
    train: DataFrame, test: DataFrame, k: int, features: str, key: str, label: str = "label", block_rows: int = 2048
) -> DataFrame:
    """Test rows with ``prediction`` from a k-NN vote over the train rows."""
    nb = knn_neighbors(train, test, k, features, key, key, label, block_rows=block_rows)
    pred = vote(nb, [k]).select(F.col("qkey").alias(key), "prediction")
    return test.join(pred, on=key, how="left")


def knn_search(
    df: DataFrame, ks: Sequence[int], features: str, key: str, label: str = "label", fold: str = "fold",
    block_rows: int = 2048,
) -> dict:
    """Mean cross-validated accuracy per k; the first best k wins.

    Each row is a query against the rows of the other folds, which is exactly
    every fold's validation pass; the neighbour table is built once for max(ks).
    """
    ks = list(ks)
    nb = knn_neighbors(df, df, max(ks), features, key, key, label, fold=fold, block_rows=block_rows)
    pred = vote(nb, ks)
    truth = df.select(F.col(key).alias("qkey"), F.col(label).cast("double").alias("y"), F.col(fold).alias("f"))
    acc = (
        pred.join(truth, "qkey")
        .groupBy("k", "f")
        .agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("acc"))
        .groupBy("k")
        .agg(F.avg("acc").alias("cv_accuracy"))
        .collect()
    )
    scores = {r["k"]: r["cv_accuracy"] for r in acc}
    best = ks[0]
    for k in ks:
        if scores.get(k, -1) > scores.get(best, -1):
            best = k
    return {"scores": scores, "best_k": best}
