"""Exact nearest rows with pruning by an orthogonal transform.

Vectors are turned onto the first principal axes of a sample; the length of what the
axes leave over is one more coordinate. A rotation keeps distances, and two leftovers
differ by at least the difference of their lengths, so the squared distance of these
few *low* coordinates never exceeds the true one. It serves as a bound three times:

1. Train rows fall into the leaves of a median tree on low coordinates (at most
   ``MAX_LEAVES`` of about ``block_rows`` rows, built from the sample). Each query meets
   its nearest leaf first, then the leaves of its block; the k-th distance found there
   is its limit.
2. A query only meets leaves whose box is within its limit so far.
3. Of those, pairs beyond the limit by their low coordinates are dropped before
   a distance is computed.

Leaves say what is compared, *blocks* what is shuffled: neighbours in the tree share a
block of an ``n / BLOCKS``-th of the train rows, at most ``BLOCK_ROWS``, and a larger leaf
has blocks of its own. A query is copied once to each block with a leaf that it must
meet and brings back at most k rows from there, so up to ``BLOCKS * BLOCK_ROWS`` train
rows the copies of a row do not grow with the table, even where nothing is pruned.

The sample decides how much is pruned, never what is found. Distances of the result
are taken from differences of the given vectors; bounds give way by a rounding
margin. A task holds one train block and a slice of queries; the queries of a
much asked block are dealt to several tasks by the counted number of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablight.functions.rounds import drop_written, written
from tablight.functions.streams import grouped_stream, groups, matrix

LOW_AXES, SAMPLE_ROWS, MAX_LEAVES, TASK_QUERIES = 16, 16_384, 1024, 32_768
BLOCKS, BLOCK_ROWS = 24, 32_768
CELLS, GATHER, MARGIN = 2_000_000, 100_000, 1e-9


@dataclass
class LowSpace:
    """The turned coordinates: centre, axes (as columns), and whether they are all."""

    centre: np.ndarray
    axes: np.ndarray

    def turn(self, x: np.ndarray) -> np.ndarray:
        x = x - self.centre
        low = x @ self.axes
        if self.axes.shape[1] == len(self.centre):
            return low
        rest = x - low @ self.axes.T
        return np.column_stack([low, np.sqrt(np.einsum("ij,ij->i", rest, rest))])


@dataclass
class Tree:
    """A full binary tree as arrays: node i has the children 2i+1 and 2i+2."""

    dim: np.ndarray
    cut: np.ndarray
    depth: int

    def leaf(self, low: np.ndarray) -> np.ndarray:
        at, row = np.zeros(len(low), np.int64), np.arange(len(low))
        for _ in range(self.depth):
            at = 2 * at + 1 + (low[row, self.dim[at]] > self.cut[at])
        return at - (2**self.depth - 1)


def median_tree(low: np.ndarray, depth: int) -> Tree:
    """Cuts at the median of the coordinate that varies most, from a sample."""
    dim, cut = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    held = {0: low}
    for node in range(2**depth - 1):
        x = held.pop(node)
        if len(x):
            dim[node] = np.argmax(x.var(axis=0))
            cut[node] = np.median(x[:, dim[node]])
        right = x[:, dim[node]] > cut[node]
        held[2 * node + 1], held[2 * node + 2] = x[~right], x[right]
    return Tree(dim, cut, depth)


@dataclass
class Leaves:
    """Boxes of the leaves that hold rows, the first block and how many blocks each one has."""

    number: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    block: np.ndarray
    parts: np.ndarray

    def inside(self, block: int) -> Leaves:
        """The leaves that have rows in a block."""
        at = np.flatnonzero((self.block <= block) & (block < self.block + self.parts))
        return Leaves(*(x[at] for x in (self.number, self.lo, self.hi, self.block, self.parts)))

    def bounds(self, low: np.ndarray) -> np.ndarray:
        """Squared distances of rows to boxes, reduced by the rounding margin."""
        out = np.zeros((len(low), len(self.number)))
        for j in range(low.shape[1]):
            x = low[:, j : j + 1]
            gap = np.maximum(np.maximum(self.lo[:, j] - x, x - self.hi[:, j]), 0.0)
            out += gap * gap
        reach = np.square(np.maximum(abs(self.lo), abs(self.hi))).sum(axis=1)
        return out - MARGIN * (np.square(low).sum(axis=1)[:, None] + reach)


@dataclass
class Work:
    """Pairs of queries and rows of the leaves they met, and those computed on all axes."""

    all_pairs: int
    met: int
    full: int


@dataclass
class Found:
    """``rows``: qkey, tkey, d2, tlabel, rank (from 0)."""

    rows: DataFrame
    work: Work


def _checked(df: DataFrame, width: int) -> DataFrame:
    """Rows that can take part: a key, and ``width`` finite components."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    wrong = F.raise_error(F.lit(f"vectors must have {width} components"))
    return df.where("key IS NOT NULL AND vec IS NOT NULL").where(~bad).withColumn("vec", F.when(F.size("vec") == width, F.col("vec")).otherwise(wrong))


def _lists(low: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(low) + 1, dtype=np.int32) * low.shape[1], pa.array(low.ravel()))


def _low_space(rows: DataFrame, width: int) -> tuple[LowSpace, np.ndarray]:
    some = rows.select("vec", F.xxhash64("key").alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    x = np.array([r["vec"] for r in some], float).reshape(len(some), width)
    centre = x.mean(axis=0)
    values, axes = np.linalg.eigh((x - centre).T @ (x - centre))
    space = LowSpace(centre, axes[:, np.argsort(-values, kind="stable")[:LOW_AXES]])
    return space, space.turn(x)


def _dealt(sizes: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each leaf: neighbours share a block of at most
    ``most`` rows, a larger leaf has its own blocks."""
    first, parts, block, held = [], [], -1, most
    for n in sizes:
        if held + n > most:
            block, held = block + 1, 0
        first.append(block)
        parts.append(max(1, -(-n // most)))
        block += parts[-1] - 1
        held = held + n if parts[-1] == 1 else most
    return np.array(first, np.int64), np.array(parts, np.int64)


def _indexed(train: DataFrame, width: int, block_rows: int) -> tuple[DataFrame, LowSpace, Leaves]:
    """Train rows written with their low coordinates and leaf; the boxes of the leaves."""
    n = train.count()
    space, low = _low_space(train, width)
    depth = 0
    while 2**depth < MAX_LEAVES and 2**depth * block_rows < n and 2 ** (depth + 1) * 8 <= len(low):
        depth += 1
    tree = median_tree(low, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            turned = space.turn(matrix(b.column(1), width))
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(turned), pa.array(tree.leaf(turned))], names=["key", "vec", "label", "fold", "low", "leaf"])

    rows = written(train.mapInArrow(run, "key long, vec array<double>, label double, fold long, low array<double>, leaf long"), "nearest-train")
    lows = [F.col("low")[j] for j in range(low.shape[1])]
    boxes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(x) for x in lows]).alias("lo"), F.array(*[F.max(x) for x in lows]).alias("hi"))
    found = sorted(boxes.collect())  # one row a leaf, at most MAX_LEAVES
    most = max(block_rows, min(BLOCK_ROWS, -(-n // BLOCKS)))
    first, parts = _dealt([r["n"] for r in found], most)
    leaves = Leaves(np.array([r["leaf"] for r in found], np.int64), np.array([r["lo"] for r in found]), np.array([r["hi"] for r in found]), first, parts)
    of_leaf = np.zeros((2, 2**depth), np.int64)
    of_leaf[:, leaves.number] = first, np.maximum(parts, 1)
    start, number = (F.array(*[F.lit(int(x)) for x in row])[F.col("leaf").cast("int")] for row in of_leaf)
    return rows.withColumn("block", start + F.pmod(F.xxhash64("key"), number)), space, leaves


_QUERY = "key long, vec array<double>, fold long, low array<double>, lim double, block long"


def _first_blocks(query: DataFrame, width: int, space: LowSpace, leaves: Leaves) -> DataFrame:
    """Queries with their low coordinates, no limit yet, and one block of the nearest leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            low = space.turn(matrix(b.column(1), width))
            near = np.concatenate([leaves.bounds(low[s : s + 512]).argmin(axis=1) for s in range(0, len(low), 512)])
            block = leaves.block[near] + b.column(0).to_numpy() % leaves.parts[near]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), _lists(low), pa.array(np.full(len(low), np.inf)), pa.array(block)],
                names=["key", "vec", "fold", "low", "lim", "block"],
            )

    return query.mapInArrow(run, _QUERY)


def _opened(lows: np.ndarray, limits: np.ndarray, homes: np.ndarray, leaves: Leaves) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) of the blocks that queries must still see: those with a leaf within
    the limit, but the one they saw first."""
    i, j = np.nonzero(leaves.bounds(lows) <= limits[:, None])
    n = leaves.parts[j]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, block = np.repeat(i, n), np.repeat(leaves.block[j], n) + at
    new = block != homes[i]
    wide = int((leaves.block + leaves.parts).max())
    return np.divmod(np.unique(i[new] * wide + block[new]), wide)


def _asked(first: DataFrame, n_low: int, leaves: Leaves, counted: bool) -> DataFrame:
    """A row for each block that a query opens; ``counted``: only their number by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 512):
                b = whole.slice(s, 512)
                low, lim, home = matrix(b.column(3), n_low), b.column(4).to_numpy(), b.column(5).to_numpy()
                i, block = _opened(low, lim, home, leaves)
                if counted:
                    block, n = np.unique(block, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(n)], names=["block", "n"])
                    continue
                for c in range(0, len(i), 2048):
                    rows = pa.Table.from_batches([b]).take(pa.array(i[c : c + 2048])).set_column(5, "block", pa.array(block[c : c + 2048]))
                    yield from rows.combine_chunks().to_batches()

    src = first.select("key", "vec", "fold", "low", "lim", "block")
    return src.mapInArrow(run, "block long, n long" if counted else _QUERY)


def _products(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and the margin of each."""
    scale = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
    return scale - 2.0 * (a @ b.T), MARGIN * scale


def best_of(q: dict, t: dict, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, train row, squared distance) of the k nearest of each query within
    its limit, ordered by query, distance, train key; and the pairs computed in full."""
    out, full = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
    step = max(1, CELLS // max(1, len(t["key"])))
    for s in range(0, len(q["key"]), step):
        part = {c: v[s : s + step] for c, v in q.items()}
        low, margin = _products(part["low"], t["low"])
        limit = part["lim"][:, None]
        wanted = low <= limit + margin
        if exclude_self:
            wanted &= part["key"][:, None] != t["key"][None, :]
        wanted &= part["fold"][:, None] != t["fold"][None, :]
        at = np.flatnonzero(wanted.any(axis=1))
        cells = len(at) * len(t["key"])
        many = wanted.sum() > cells // 20
        if many:  # a product on all axes and its k-th value come first
            d2, margin = _products(part["at"][at], t["at"])
            d2[~wanted[at]] = np.inf
            if k < d2.shape[1]:
                kth = np.partition(d2 + margin, k - 1, axis=1)[:, k - 1 : k]
                wanted[at] &= d2 <= np.minimum(kth, limit[at]) + margin
        i, j = np.nonzero(wanted)
        full += cells if many else len(i)
        d2 = np.empty(len(i))
        for c in range(0, len(i), GATHER):
            diff = part["vec"][i[c : c + GATHER]] - t["vec"][j[c : c + GATHER]]
            d2[c : c + GATHER] = np.einsum("ij,ij->i", diff, diff)
        fit = d2 <= part["lim"][i]
        i, j, d2 = i[fit], j[fit], d2[fit]
        order = np.lexsort((t["key"][j], d2, i))
        i, j, d2 = i[order], j[order], d2[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[keep] + s, j[keep], d2[keep]))
    i, j, d2 = (np.concatenate(x) for x in zip(*out, strict=True))
    return i, j, d2, full


def best_of_leaves(q: dict, t: dict, here: Leaves, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``best_of`` for train rows sorted by ``leaf``. A query meets its nearest leaf first
    and then those within its limit so far. Also gives the number of rows each query met."""
    out, met, full = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], np.zeros(len(q["key"]), np.int64), 0
    ends = np.column_stack([np.searchsorted(t["leaf"], here.number, side) for side in ("left", "right")])
    bounds, lim = here.bounds(q["low"]), q["lim"].copy()
    nearest = bounds.argmin(axis=1)
    for turn in (0, 1):
        for leaf, (lo, hi) in enumerate(ends):
            at = np.flatnonzero((bounds[:, leaf] <= lim) & ((nearest == leaf) == (turn == 0)))
            if not len(at) or lo == hi:
                continue
            some = {c: v[at] for c, v in q.items()} | {"lim": lim[at]}
            i, j, d2, done = best_of(some, {c: v[lo:hi] for c, v in t.items()}, k, exclude_self)
            out.append((at[i], j + lo, d2))
            last = np.cumsum(n := np.bincount(i, minlength=len(at))) - 1
            lim[at[n == k]] = d2[last[n == k]]
            met[at] += hi - lo
            full += done
    i, j, d2 = (np.concatenate(x) for x in zip(*out, strict=True))
    fit = d2 <= lim[i]
    i, j, d2 = i[fit], j[fit], d2[fit]
    order = np.lexsort((t["key"][j], d2, i))
    i, j, d2 = i[order], j[order], d2[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], d2[keep], met, full


_LISTS = "tkeys array<long>, d2s array<double>, labels array<double>, met long, full long"


def _meet(rows: DataFrame, asked: DataFrame, counts: DataFrame, space: LowSpace, leaves: Leaves, width: int, k: int, exclude_self: bool, first: bool) -> DataFrame:
    """Queries with the k nearest rows of the block they ask, as lists. ``first`` keeps
    the query's own columns and sets its limit."""
    n_low = leaves.lo.shape[1]
    tasks = counts.groupBy("block").agg(F.ceil(F.sum("n") / F.lit(TASK_QUERIES)).cast("long").alias("tasks"))
    cols = ["key", "vec", "low", "fold"]
    left = rows.join(tasks, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("side"), "leaf", *cols, F.col("label").alias("more")
    )
    asked = asked.join(tasks.select(F.col("block").alias("b"), "tasks"), F.col("block") == F.col("b"))
    right = asked.select("block", F.pmod(F.xxhash64("key"), F.col("tasks")).alias("task"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("leaf"), *cols, F.col("lim").alias("more"))

    def read(b: pa.RecordBatch | pa.Table) -> dict:
        leaf, key, vec, low, fold = (flat(b.column(c)) for c in (3, 4, 5, 6, 7))
        vec, low = matrix(vec, width), matrix(low, n_low)
        return {"leaf": leaf.to_numpy(), "key": key.to_numpy(), "vec": vec, "at": vec - space.centre, "low": low, "fold": fold.to_numpy()}

    def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, _), slices in groups(batches, 2):
            held, t = [], None
            for piece in slices:
                cut = int(np.searchsorted(piece.column(2).to_numpy(), 1))
                if cut:
                    held.append(piece.slice(0, cut))
                if cut == piece.num_rows:
                    continue
                if t is None:
                    table = pa.Table.from_batches(held or [piece.slice(0, 0)]).combine_chunks()
                    held.clear()
                    t, labels = read(table), table.column(8).to_numpy()
                    here = leaves.inside(int(block))
                for s in range(cut, piece.num_rows, 2048):
                    yield answer(piece.slice(s, 2048), t, labels, here, block)

    def answer(b: pa.RecordBatch, t: dict, labels: np.ndarray, here: Leaves, block: int) -> pa.RecordBatch:
        q = {**read(b), "lim": b.column(8).to_numpy()}
        i, j, d2, met, full = best_of_leaves(q, t, here, k, exclude_self)
        n = np.bincount(i, minlength=b.num_rows)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(t["key"][j]), pa.array(d2), pa.array(labels[j], from_pandas=True))]
        done = np.zeros(b.num_rows, np.int64)
        done[0] = full
        names = ["key", "tkeys", "d2s", "labels", "met", "full"]
        cols = [b.column(4), *lists, pa.array(met), pa.array(done)]
        if first:
            lim = np.full(b.num_rows, np.inf)
            whole = n == k
            lim[whole] = d2[ends[1:][whole] - 1]
            cols += [b.column(5), b.column(7), b.column(6), pa.array(lim), pa.array(np.full(b.num_rows, block))]
            names += ["vec", "fold", "low", "lim", "block"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    schema = "key long, " + _LISTS + (_QUERY.removeprefix("key long") if first else "")
    return grouped_stream(left.unionByName(right), ["block", "task"], ["side", "leaf"]).mapInArrow(run, schema)


def nearest_rows(train: DataFrame, query: DataFrame, k: int, exclude_self: bool = False, block_rows: int = 2048) -> Found | None:
    """The k nearest train rows of each query by (distance, train key), exactly.

    train: key long (unique), vec array<double>, label double, fold long; query: key
    long (unique), vec, fold. Pairs of one fold are left out, and of one key if
    ``exclude_self``. Rows whose key or vector is null, or whose vector has a null or
    non-finite component, take no part; vectors of another length raise. None if no
    train row is left.
    """
    first = train.where("key IS NOT NULL AND vec IS NOT NULL").first()
    if first is None:
        return None
    width = len(first["vec"])
    train = _checked(train.select("key", "vec", "label", "fold"), width)
    if train.isEmpty():
        return None
    rows, space, leaves = _indexed(train, width, block_rows)
    n_low = leaves.lo.shape[1]
    start = written(_first_blocks(_checked(query.select("key", "vec", "fold"), width), width, space, leaves), "nearest-queries")
    counts = start.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    begun = written(_meet(rows, start, counts, space, leaves, width, k, exclude_self, first=True), "nearest-first")
    counts = written(_asked(begun, n_low, leaves, counted=True).groupBy("block").agg(F.sum("n").alias("n")), "nearest-asked")
    rest = written(_meet(rows, _asked(begun, n_low, leaves, counted=False), counts, space, leaves, width, k, exclude_self, first=False), "nearest-rest")
    names = ["key", "tkeys", "d2s", "labels", "met", "full"]
    both = begun.select(*names).unionByName(rest.select(*names))
    # at most k of each block that a query opened and that holds something within its limit
    each = both.select(F.col("key").alias("qkey"), F.explode(F.arrays_zip("d2s", "tkeys", "labels")).alias("x"))
    each = each.select("qkey", F.col("x.tkeys").alias("tkey"), F.col("x.d2s").alias("d2"), F.col("x.labels").alias("tlabel"))
    place = F.row_number().over(Window.partitionBy("qkey").orderBy("d2", "tkey"))
    out = written(each.withColumn("rank", place - 1).where(F.col("rank") < k), "nearest-found")
    sums = both.agg(F.sum("met"), F.sum("full")).first()
    work = Work(rows.count() * start.count(), sums[0] or 0, sums[1] or 0)
    drop_written(rows, start, begun, counts, rest)
    return Found(out, work)
