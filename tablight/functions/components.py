"""Connected components of an edge table by alternating large-star and
small-star rounds (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii 2014:
"Connected Components in MapReduce and Beyond"), which converges in
O(log^2 n) rounds on any graph -- long paths included -- while the edge set
never grows beyond O(|E|).

Before the rounds every task replaces runs of ``SLICE_EDGES`` of its edges by stars
with the same components (``functions.forest``), which leaves at most one edge a
node and run. Where one run held all edges, the stars are the answer.

Each star step is one aggregate (the smallest neighbour of every node) and
one join. After a few rounds most edges of a giant component hang on one node, so
the join is salted for nodes of high degree: there are at most ``2 * HOT_SHARE``
nodes with more than |E| / HOT_SHARE edge ends, a bound that holds for any graph
and makes their list safe to broadcast. Every step is written to the cluster's
checkpoint folder and read back (``functions.rounds``), so lineage and the
planner's size estimates stay small and a lost executor recomputes one step;
superseded steps are deleted. A round that leaves the edge count and two hash
sums unchanged is the last; every component is then a star around its smallest
node.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablight.functions.forest import star_forest
from tablight.functions.rounds import drop_written, written

HOT_SHARE, SALTS = 256, 32
SLICE_EDGES = 500_000


def _stars(edges: DataFrame, slice_edges: int) -> DataFrame:
    """(a, b, run): the edges of each run of a task as stars around smallest nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def star() -> pa.RecordBatch:
            a, b = star_forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([uuid.uuid4().hex] * len(a))], names=["a", "b", "run"])

        for batch in batches:
            for at in range(0, batch.num_rows, slice_edges):
                part = batch.slice(at, slice_edges)
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
                size += part.num_rows
                if size >= slice_edges:
                    yield star()
                    held.clear()
                    size = 0
        if size:
            yield star()

    e = edges.select("a", "b").where((F.col("a") != F.col("b")) & F.col("a").isNotNull() & F.col("b").isNotNull())
    # dealt by both ends, so that a node with many edges is not one task; small inputs become one partition
    return e.repartition(F.xxhash64("a", "b")).mapInArrow(run, "a long, b long, run string")


def _sym(pairs: DataFrame) -> DataFrame:
    """(a, b) pairs -> both directions as (src, dst), no self loops, distinct."""
    e = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).where(F.col("src") != F.col("dst"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def _with_min(e: DataFrame, smallest: DataFrame, n_edges: int) -> DataFrame:
    """``e`` (src, dst) joined with ``smallest`` (src, m, degree) on src, salted
    where the degree is above |E| / HOT_SHARE."""
    hot = smallest.where(F.col("degree") > max(1, n_edges // HOT_SHARE)).select(F.col("src").alias("hot"))
    keyed = e.join(F.broadcast(hot), e.src == F.col("hot"), "left").withColumn(
        "salt", F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("dst"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    )
    n = F.when(F.col("degree") > max(1, n_edges // HOT_SHARE), F.lit(SALTS - 1)).otherwise(F.lit(0)).cast("long")
    many = smallest.select("src", "m", F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("salt"))
    return keyed.drop("hot").join(many.hint("merge"), ["src", "salt"]).drop("salt")


def _large_star(e: DataFrame, n_edges: int) -> DataFrame:
    """Every strictly larger neighbour of v is linked to min(v, neighbours of v)."""
    m = e.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("m"), F.count(F.lit(1)).alias("degree"))
    linked = _with_min(e.where(F.col("dst") > F.col("src")), m, n_edges).select(F.col("dst").alias("a"), F.col("m").alias("b"))
    return written(_sym(linked), "components-large")


def _small_star(e: DataFrame, n_edges: int) -> DataFrame:
    """v and its not-larger neighbours are linked to the smallest of them."""
    le = e.where(F.col("dst") <= F.col("src"))
    m = le.groupBy("src").agg(F.min("dst").alias("m"), F.count(F.lit(1)).alias("degree"))
    linked = _with_min(le, m, n_edges).select(F.col("dst").alias("a"), F.col("m").alias("b"))
    return written(_sym(linked.unionByName(m.select(F.col("src").alias("a"), F.col("m").alias("b")))), "components-small")


def _state(e: DataFrame) -> tuple:
    """Edge count and two order-free hash sums: equal when the sets are."""
    h, g = F.xxhash64("src", "dst"), F.xxhash64("dst", "src")
    kind = "decimal(38,0)"
    return tuple(e.agg(F.count(F.lit(1)), F.sum(h.cast(kind)), F.sum(g.cast(kind))).first())


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200, slice_edges: int = SLICE_EDGES) -> DataFrame:
    """nodes(node long), edges(a long, b long) -> (node, comp): comp is the
    smallest node of the component (a node without edges is its own).
    ``max_rounds`` is far above what any graph needs; passing it raises."""
    stars = written(_stars(edges, slice_edges), "components-stars")
    runs = stars.agg(F.min("run"), F.max("run")).first()
    if runs[0] == runs[1]:
        comp = stars.select(F.col("a").alias("src"), F.col("b").alias("comp"))
    else:
        e = written(_sym(stars), "components-edges")
        drop_written(stars)
        state = _state(e)
        for _ in range(max_rounds):
            if not state[0]:
                break
            large = _large_star(e, state[0])
            small = _small_star(large, state[0])
            drop_written(e, large)
            before, e, state = state, small, _state(small)
            if state == before:
                break
        else:
            raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
        comp = e.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("comp"))
    base = nodes.select("node").distinct()
    # both have a row a node, few bytes each: a merge join keeps them off the driver
    return base.join(comp.hint("merge"), base.node == comp.src, "left").select(
        "node", F.coalesce(F.col("comp"), F.col("node")).alias("comp")
    )
