"""Blocked pairing of two row sets for distance-based operators.

Rows are hashed on their (unique) key into blocks of about ``block_rows``
rows; every (left block, right block) pair becomes one cogroup task that sees
two bounded pandas frames. Pairs are computed in numpy inside the task and
never materialised as rows: a task emits only its reduced result (k best
neighbours per row, per-cluster distance sums, ...). Because blocks come
from a hash of a unique key, a hot label or cluster cannot make a task large.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def n_blocks(n_rows: int, block_rows: int) -> int:
    return max(1, int(math.ceil(n_rows / max(1, block_rows))))


def pair_blocks(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, fn, schema,
    block_rows: int = 2048, n_left: int | None = None, n_right: int | None = None,
) -> DataFrame:
    """cogroup(left block, right block) for every block pair, ``fn(lpdf, rpdf)``.

    Left rows are replicated once per right block and right rows once per left
    block, so the shuffled volume is n_left * rb + n_right * lb rows, with
    lb, rb about n / block_rows.
    """
    nl = n_blocks(n_left if n_left is not None else left.count(), block_rows)
    nr = n_blocks(n_right if n_right is not None else right.count(), block_rows)
    lb = F.pmod(F.xxhash64(F.col(left_key)), F.lit(nl))
    rb = F.pmod(F.xxhash64(F.col(right_key)), F.lit(nr))
    lx = left.withColumn("_lb", lb).withColumn("_rb", F.explode(F.sequence(F.lit(0), F.lit(nr - 1))))
    rx = right.withColumn("_rb", rb).withColumn("_lb", F.explode(F.sequence(F.lit(0), F.lit(nl - 1))))
    # fresh column ids: left and right are often the same rows (a self-pairing)
    rx = rx.select(*[F.col(c).alias(c) for c in rx.columns])
    return lx.groupBy("_lb", "_rb").cogroup(rx.groupBy("_lb", "_rb")).applyInPandas(fn, schema)


_NP = {"long": np.int64, "int": np.int32, "double": np.float64, "float": np.float32, "boolean": bool}


def empty_frame(schema) -> pd.DataFrame:
    """A zero-row pandas frame whose dtypes match a Spark schema (Arrow-safe)."""
    return pd.DataFrame({f.name: np.array([], dtype=_NP.get(f.dataType.simpleString(), object)) for f in schema.fields})


def as_matrix(series: pd.Series) -> np.ndarray:
    """A pandas column of equal-length arrays -> 2-D float64 matrix."""
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.values])


def row_chunk(n_cols: int, dims: int, budget_bytes: int = 32 << 20) -> int:
    """Rows per chunk so a (rows x n_cols x dims) float64 tensor fits the budget."""
    return max(1, min(256, budget_bytes // max(1, n_cols * max(1, dims) * 8)))


def sq_distances(Q: np.ndarray, T: np.ndarray, chunk: int | None = None):
    """Yield (row offset, exact squared distances of a chunk of Q rows to all T).

    Differences are taken directly (not by the dot-product expansion) so
    distances are exact to rounding and ties behave the same everywhere. The
    chunk adapts to the block size and dimension so the temporary difference
    tensor stays within a fixed memory budget.
    """
    if chunk is None:
        chunk = row_chunk(T.shape[0], T.shape[1] if T.ndim == 2 else 1)
    for s in range(0, Q.shape[0], chunk):
        diff = Q[s : s + chunk, None, :] - T[None, :, :]
        yield s, np.einsum("ijk,ijk->ij", diff, diff)
