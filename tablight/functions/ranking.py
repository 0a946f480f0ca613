"""Global ranks and running sums without a single-partition window.

A window with no PARTITION BY sends every row to one task. Here the rows are
range-partitioned on the ordering (Spark samples the bounds, so a hot group
spans several partitions), each partition is sorted locally, and per-partition
totals -- one small row per (partition, group) -- give every partition its
offset. The offsets table is tiny and joins back cheaply.

The ordering must be total (end it with a unique key). The range-partitioned,
id-stamped rows are written once with a reliable ``checkpoint()`` (to the
cluster's checkpoint folder): the offsets and the rows then read the same
partitions, even when the input order -- and so the sampled range bounds --
would differ between two evaluations, and a lost executor re-reads the
checkpoint instead of re-sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablight.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def _by_range(df: DataFrame, n: int | None, cols: Sequence) -> DataFrame:
    """Range partitions; without a number adaptive execution sizes them."""
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    partition_cols: Sequence[str] = (),
    rank_col: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 0-based rank of each row within its ``partition_cols`` group."""
    parts = [F.col(c) for c in partition_cols]
    r = _by_range(df, num_partitions, [*parts, *order]).sortWithinPartitions(*parts, *order)
    r = r.withColumn("_mid", F.monotonically_increasing_id())
    r = r.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_idx", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    ensure_checkpoint_dir(df.sparkSession)
    r = r.checkpoint()
    counts = r.groupBy("_pid", *partition_cols).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_idx").alias("_first")
    )
    w = Window.partitionBy(*parts).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    # null-safe: rows whose group is null are a group of their own
    offs = offs.toDF("_opid", *[f"_g{i}" for i in range(len(partition_cols))], "_first", "_off")
    same = F.col("_pid") == F.col("_opid")
    for i, c in enumerate(partition_cols):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = r.join(offs, same, "inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_idx") - F.col("_first")).alias(rank_col))


def running_sums(
    df: DataFrame,
    order: Sequence[Column],
    value_cols: Sequence[str],
    prefix: str = "cum_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order`` (total order).

    Each range partition sums locally (a window per partition id, so no task
    sees more than one range), and adds the totals of all earlier partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    r = _by_range(df, num_partitions, order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    totals = r.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in value_cols]
    )
    wl = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = r.select("*", *[F.sum(c).over(wl).alias(f"_l_{c}") for c in value_cols])
    out = local.join(F.broadcast(offs), on="_pid", how="inner")
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{prefix}{c}") for c in value_cols],
    )
