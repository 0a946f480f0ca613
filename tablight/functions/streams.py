"""Groups of a sorted stream, batch by batch.

``applyInPandas`` holds a whole group. Rows that are dealt by their group and sorted
by it (``grouped_stream``) can be read with ``groups`` instead: every group is an
iterator of Arrow slices, so a task holds one batch and what its kernel keeps, and
many tiny groups cost little each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def grouped_stream(df: DataFrame, group: Sequence[str], order: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Rows of a group together in one partition, sorted by group and ``order``. A few long
    groups name a number of ``partitions`` that keeps most of them apart."""
    dealt = df.repartition(partitions, *group) if partitions else df.repartition(*group)
    return dealt.sortWithinPartitions(*group, *order)


def _slices(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(b.num_rows, bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        at = np.flatnonzero(change)
        for s, e in zip(at, np.append(at[1:], b.num_rows), strict=True):
            yield tuple(k[s] for k in keys), b.slice(s, e - s)


def groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """(key, slices) of each group of a stream sorted by its first ``n_keys`` columns,
    which hold no nulls."""
    for key, found in groupby(_slices(batches, n_keys), key=lambda x: x[0]):
        yield key, (b for _, b in found)


def matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """A list column of one length as a matrix."""
    return np.asarray(column.flatten(), kind).reshape(-1, width)
