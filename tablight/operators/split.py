"""Reproducible splits and folds keyed on a row key, independent of how the
data happens to be partitioned.

Every row's position comes from ``md5('<seed>:<key>')``. The scalable split
compares the first 8 hex digits with a threshold -- a pure projection, no
shuffle, identical on any engine with md5. The exact split (test size
``ceil(test * n)``) and the stratified folds need ranks; those come from the
range-partitioned global rank, never from a single-partition window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablight.functions.columns import quoted
from tablight.functions.ranking import global_rank


def row_hash(key: str | Column, seed: int = 42) -> Column:
    k = F.col(quoted(key)) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hash_threshold(fraction: float) -> str:
    """8-hex-digit threshold: prefix < threshold holds for ``fraction`` of hashes."""
    return format(min(0xFFFFFFFF + 1, int(round(fraction * 16**8))), "08x") if fraction < 1 else "g"


def train_test_split(
    df: DataFrame, key: str, test: float = 0.2, seed: int = 42, exact: bool = False, split_col: str = "split"
) -> DataFrame:
    """Add ``split`` = 'test' | 'train'.

    exact=False: a row is test when its hash prefix is below the threshold
    (about ``test`` of the rows, no shuffle). exact=True: exactly
    ``ceil(test * n)`` rows with the smallest hashes are test.
    """
    h = row_hash(key, seed)
    if not exact:
        is_test = F.substring(h, 1, 8) < F.lit(hash_threshold(test))
        return df.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    n = df.count()
    n_test = int(math.ceil(test * n))
    ranked = global_rank(df.withColumn("_h", h), [F.col("_h"), F.col(quoted(key))], rank_col="_r")
    return ranked.withColumn(
        split_col, F.when(F.col("_r") < n_test, F.lit("test")).otherwise(F.lit("train"))
    ).drop("_h", "_r")


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, fold_col: str = "fold"
) -> DataFrame:
    """fold = (rank of the row inside its class, by hash) mod k: every fold
    gets the same share of each class (+-1 row)."""
    ranked = global_rank(
        df.withColumn("_h", row_hash(key, seed)), [F.col("_h"), F.col(quoted(key))], partition_cols=[label], rank_col="_r"
    )
    return ranked.withColumn(fold_col, (F.col("_r") % k).cast("int")).drop("_h", "_r")


def hash_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Unstratified folds from the hash alone (no shuffle)."""
    h = F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn(fold_col, (h % k).cast("int"))


def train_val_split_by_group(
    df: DataFrame, group: str, order: Sequence[str], validation: float = 0.2, split_col: str = "split"
) -> DataFrame:
    """Per group, the first ``validation`` share of rows (in ``order``) validate,
    the rest train (the folder-per-class 80/20 split of image sets)."""
    ranked = global_rank(df, [F.col(quoted(c)) for c in order], partition_cols=[group], rank_col="_r")
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(F.col(quoted(group)).alias("_g"), "_n")
    j = ranked.join(sizes, F.col(quoted(group)).eqNullSafe(F.col("_g"))).drop("_g")
    n_val = F.floor(F.col("_n") * F.lit(validation))
    return j.withColumn(split_col, F.when(F.col("_r") < n_val, F.lit("validation")).otherwise(F.lit("train"))).drop("_r", "_n")
