"""Custom distance operators against brute-force numpy versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablight.operators.cluster import silhouette
from tablight.operators.dbscan import dbscan
from tablight.operators.knn import knn_neighbors, vote


def brute_dbscan(X, keys, eps, m):
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    A = d2 <= eps * eps
    core = A.sum(1) >= m
    lab = np.where(core, keys, np.iinfo(np.int64).max)
    while True:
        Acc = A & core[:, None] & core[None, :]
        new = np.where(core, np.minimum(lab, np.where(Acc, lab[None, :], np.iinfo(np.int64).max).min(1)), lab)
        if np.array_equal(new, lab):
            break
        lab = new
    comp = {}
    for i in range(len(X)):
        if core[i]:
            comp[keys[i]] = lab[i]
        else:
            c = [lab[j] for j in np.flatnonzero(A[i] & core)]
            if c:
                comp[keys[i]] = min(c)
    order = {c: r for r, c in enumerate(sorted(set(comp.values())))}
    return {k: order[comp[k]] if k in comp else -1 for k in keys}, dict(zip(keys, core))


def _points(n=220, d=3, seed=7):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 4, size=(4, d))
    X = np.concatenate([c + rng.normal(0, 0.6, size=(n // 4, d)) for c in centers])
    X = np.concatenate([X, rng.uniform(-10, 10, size=(20, d))])
    keys = rng.permutation(len(X)).astype(np.int64) * 3 + 5
    return X, keys


@pytest.mark.parametrize("d,eps,m", [(2, 0.5, 4), (3, 0.8, 5), (5, 1.5, 4)])
def test_dbscan_matches_brute_force(spark, d, eps, m):
    X, keys = _points(d=d)
    pdf = pd.DataFrame({"row_id": keys, "features": [list(map(float, r)) for r in X]})
    df = spark.createDataFrame(pdf, "row_id long, features array<double>")
    got = {r["row_id"]: (r["cluster"], r["is_core"]) for r in dbscan(df, eps, m, "features", "row_id", block_rows=40).collect()}
    exp, core = brute_dbscan(X, keys, eps, m)
    assert len(got) == len(keys)
    for k in keys:
        assert got[k][0] == exp[k], (k, got[k], exp[k])
        assert got[k][1] == core[k]


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(150, 6))
    y = rng.integers(0, 3, size=150)
    keys = np.arange(150, dtype=np.int64) * 7
    pdf = pd.DataFrame({"id": keys, "v": [list(r) for r in X], "label": y.astype(float)})
    df = spark.createDataFrame(pdf, "id long, v array<double>, label double")
    train, test = df.where(F.col("id") % 5 != 0), df.where(F.col("id") % 5 == 0)
    nb = knn_neighbors(train, test, 4, "v", "id", "id", "label", block_rows=16)
    got = {}
    for r in nb.collect():
        got.setdefault(r["qkey"], []).append((r["rank"], r["tkey"]))
    tr = keys % 5 != 0
    for i in np.flatnonzero(~tr):
        d = ((X[tr] - X[i]) ** 2).sum(1)
        order = np.lexsort((keys[tr], d))[:4]
        assert [t for _, t in sorted(got[keys[i]])] == list(keys[tr][order])
    pred = {r["qkey"]: r["prediction"] for r in vote(nb, [3]).collect()}
    for i in np.flatnonzero(~tr):
        d = ((X[tr] - X[i]) ** 2).sum(1)
        lab = y[tr][np.lexsort((keys[tr], d))[:3]]
        vals, cnt = np.unique(lab, return_counts=True)
        assert pred[keys[i]] == vals[np.argmax(cnt)]


def brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(120, 4))
    lab = rng.integers(-1, 3, size=120)
    pdf = pd.DataFrame({"id": np.arange(120), "v": [list(r) for r in X], "c": lab})
    df = spark.createDataFrame(pdf, "id long, v array<double>, c long")
    got = silhouette(df, "v", "c", "id", block_rows=25)
    assert abs(got - brute_silhouette(X, lab)) < 1e-9
    got2 = silhouette(df, "v", "c", "id", drop_noise=True, block_rows=25)
    keep = lab != -1
    assert abs(got2 - brute_silhouette(X[keep], lab[keep])) < 1e-9


def test_dbscan_search_picks_valid_setting(spark):
    X, keys = _points(n=120, d=2, seed=9)
    pdf = pd.DataFrame({"row_id": keys, "features": [list(map(float, r)) for r in X]})
    df = spark.createDataFrame(pdf, "row_id long, features array<double>")
    from tablight.operators.dbscan import dbscan_search, eps_grid

    eps = eps_grid(0.3, 1.1, 0.2)
    assert eps == [0.3, 0.5, 0.7, 0.9]
    best = dbscan_search(df, eps, [3, 5], "features", "row_id", min_clusters=2, drop_noise=True, block_rows=50)
    tried = best["tried"].collect()
    assert len(tried) == 8
    valid = [t for t in tried if t["silhouette"] is not None]
    assert valid and all(t["has_outliers"] and t["n_clusters"] >= 2 for t in valid)
    top = max(t["silhouette"] for t in valid)
    assert best["silhouette"] == top
    first = next(t for t in tried if t["silhouette"] == top)
    assert (best["eps"], best["min_samples"]) == (first["eps"], first["min_samples"])


def test_knn_ties_break_on_train_key(spark):
    rng = np.random.default_rng(8)
    X = rng.integers(0, 3, size=(120, 2)).astype(float)  # many exact duplicates
    keys = rng.permutation(120).astype(np.int64) + 100
    pdf = pd.DataFrame({"id": keys, "v": [list(r) for r in X], "label": (keys % 3).astype(float)})
    df = spark.createDataFrame(pdf, "id long, v array<double>, label double")
    train, test = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)
    nb = knn_neighbors(train, test, 6, "v", "id", "id", "label", block_rows=20)
    got = {}
    for r in nb.collect():
        got.setdefault(r["qkey"], []).append((r["rank"], r["tkey"]))
    tr = keys % 4 != 0
    for i in np.flatnonzero(~tr):
        d = ((X[tr] - X[i]) ** 2).sum(1)
        exp = list(keys[tr][np.lexsort((keys[tr], d))[:6]])
        assert [t for _, t in sorted(got[keys[i]])] == exp


@pytest.mark.parametrize("slice_edges", [500_000, 40])  # one run holds all edges; rounds after many runs
def test_connected_components_long_chain(spark, slice_edges):
    from tablight.functions.components import connected_components

    rng = np.random.default_rng(4)
    chain = rng.permutation(np.arange(1000, 1300))  # one path of 300 nodes in random key order
    edges = [(int(a), int(b)) for a, b in zip(chain[:-1], chain[1:])]
    edges += [(5000, 5001), (5002, 5001), (7000, 7000)]  # a small star and a self loop
    nodes = sorted(set(chain.tolist()) | {5000, 5001, 5002, 7000, 9000})
    comps = connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node long"),
        spark.createDataFrame(edges, "a long, b long"),
        slice_edges=slice_edges,
    )
    got = {r["node"]: r["comp"] for r in comps.collect()}
    assert all(got[n] == 1000 for n in chain)
    assert got[5000] == got[5001] == got[5002] == 5000
    assert got[7000] == 7000 and got[9000] == 9000


def test_iterated_tables_keep_small_size_estimates(spark):
    """A join per round on a table that is written each round: the planner's
    estimate stays that of the files, whatever the number of rounds."""
    from tablight.functions.rounds import drop_written, size_estimate, written

    e = written(spark.range(200).selectExpr("id AS src", "id + 1 AS dst"), "test-rounds")
    for _ in range(6):
        m = e.groupBy("src").agg({"dst": "min"}).withColumnRenamed("min(dst)", "m")
        new = written(e.join(m, "src").selectExpr("m AS src", "dst + 1 AS dst"), "test-rounds")
        drop_written(e)
        e = new
    assert size_estimate(e) < 2**50
    assert e.count() == 200


def _survey_like(n, seed=11):
    """Dense and sparse parts, copies, and a few far rows in 3 dimensions."""
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 0.25, (n // 3, 3))
    b = rng.normal(3, 0.5, (n // 3, 3))
    c = rng.uniform(-4, 6, (n - 2 * (n // 3) - 20, 3))
    X = np.vstack([a, b, c, np.repeat(a[:1], 20, axis=0)])
    keys = rng.permutation(np.arange(1000, 1000 + len(X)))
    return X, keys


@pytest.mark.parametrize("block_rows", [40, 1024])
def test_dbscan_levels_match_brute_force_for_every_setting(spark, block_rows):
    from tablight.operators.dbscan import _labelled, dbscan_levels, setting_summary

    X, keys = _survey_like(500)
    df = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(keys, X)], "row_id long, features array<double>")
    eps, mins = [0.3, 0.45, 0.6, 0.9], [3, 5, 9]
    found = dbscan_levels(df, eps, mins, "features", "row_id", block_rows)
    summary = setting_summary(found)
    for i, e in enumerate(eps):
        for j, m in enumerate(mins):
            want, core = brute_dbscan(X, keys, e, m)
            got = {r["row_id"]: (r["cluster"], r["is_core"]) for r in _labelled(found, found.setting(i, j), "row_id").collect()}
            assert got == {int(k): (want[k], core[k]) for k in keys}
            labels = [got[int(k)][0] for k in keys]
            assert summary[found.setting(i, j)] == (len(set(labels) - {-1}), labels.count(-1))


def test_dense_cell_is_not_paired_with_itself(spark):
    """3000 rows in one fine cell: no chunk pair, whole counts, one cluster."""
    from tablight.functions.tiles import make_tiles
    from tablight.operators.dbscan import dbscan, neighbour_counts

    rng = np.random.default_rng(2)
    X = np.vstack([rng.uniform(0.4, 0.45, (3000, 2)), rng.uniform(5, 9, (30, 2))])
    rows = [(str(i), x.tolist()) for i, x in enumerate(X)]  # text keys
    df = spark.createDataFrame(rows, "row_id string, features array<double>")
    tiles = make_tiles(df.selectExpr("cast(row_id as long) AS idx", "features AS vec"), 0.5, 0.5, 4, 256)
    dense = tiles.rows.where("own > 0")
    assert dense.count() == 3000 and dense.select("chunk").distinct().count() == 12
    near = tiles.candidates.join(dense.select("chunk").distinct(), "chunk").count()
    assert near == 0
    n = {r["key"]: r["n"] for r in neighbour_counts(df, "features", "row_id", [0.5], 256).collect()}
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    assert n == {str(i): int(c) for i, c in enumerate((d2 <= 0.25).sum(axis=1))}
    got = dbscan(df, 0.5, 4, "features", "row_id", 256)
    assert got.where("cluster = 0 AND is_core").count() == 3000


def test_many_silhouettes_equal_one_by_one(spark):
    from tablight.operators.cluster import silhouette_many

    rng = np.random.default_rng(8)
    X = np.vstack([rng.normal(c, 0.4, (60, 2)) for c in (0, 2, 5)])
    labelings = {0: rng.integers(-1, 4, 180), 1: np.repeat([0, 1, 2], 60), 3: np.where(rng.random(180) < 0.9, -1, 0), 4: np.arange(180)}
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "idx long, vec array<double>")
    labels = spark.createDataFrame(
        [(s, i, int(c)) for s, ls in labelings.items() for i, c in enumerate(ls) if c >= 0], "setting int, idx long, cluster int"
    )
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
    for drop in (False, True):
        got = silhouette_many(rows, labels, {s: int(ls.max()) + 1 for s, ls in labelings.items()}, drop, block_rows=50)
        for s, ls in labelings.items():
            use = np.flatnonzero(ls >= 0) if drop else np.arange(180)
            lab, dd = ls[use], d[np.ix_(use, use)]
            kinds = np.unique(lab)
            if not 2 <= len(kinds) <= len(lab) - 1:
                assert got[s] is None
                continue
            vals = []
            for i in range(len(lab)):
                same = lab == lab[i]
                if same.sum() == 1:
                    vals.append(0.0)
                    continue
                a = dd[i, same].sum() / (same.sum() - 1)
                b = min(dd[i, lab == k].mean() for k in kinds if k != lab[i])
                vals.append((b - a) / max(a, b))
            assert got[s] == pytest.approx(np.mean(vals), abs=1e-9)


def test_level_forest_keeps_components_of_every_level():
    from tablight.functions.forest import level_forest, min_labels

    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 300, (2, 2000))
    level = rng.integers(0, 9, 2000).astype(np.int32)
    fa, fb, fl = level_forest(a, b, level)
    assert len(fa) < 300
    for e in range(9):
        want = min_labels(a[level <= e], b[level <= e], 300)
        assert np.array_equal(min_labels(fa[fl <= e], fb[fl <= e], 300), want)


def _brute_neighbours(X, keys, queries, k, fold=None):
    out = {}
    for i in queries:
        d2 = ((X - X[i]) ** 2).sum(1)
        ok = np.ones(len(keys), bool) if fold is None else fold != fold[i]
        order = np.lexsort((keys[ok], d2[ok]))[:k]
        out[keys[i]] = list(keys[ok][order])
    return out


def _neighbours(nb):
    got = {}
    for r in nb.collect():
        got.setdefault(r["qkey"], []).append((r["rank"], r["tkey"]))
    return {q: [t for _, t in sorted(v)] for q, v in got.items()}


@pytest.mark.parametrize("d", [1, 5, 24])  # all axes are low; more axes than low ones
def test_knn_pruned_equals_brute_force(spark, d):
    """Clusters, exact copies, integer ties and a far row, with folds; most pairs are dropped."""
    from tablight.operators.knn import knn_work

    rng = np.random.default_rng(d)
    centres = rng.normal(size=(12, d)) * 50
    X = np.vstack([centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, d)), np.round(rng.normal(size=(200, d))), np.repeat(centres[:1], 99, axis=0), np.full((1, d), 1e6)])
    keys = rng.permutation(len(X)).astype(np.int64) * 3 - 500
    fold = rng.integers(0, 4, len(X))
    rows = [(int(a), [float(x) for x in v], 1.0, int(f)) for a, v, f in zip(keys, X, fold)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label double, fold int")
    got = _neighbours(knn_neighbors(df, df, 7, "v", "id", "id", "label", fold="fold", block_rows=50))
    assert got == _brute_neighbours(X, keys, range(len(X)), 7, fold)
    if d > 1:
        work = knn_work(df, df, 7, "v", "id", "id", "label", fold="fold", block_rows=50).first()
        assert work["all_pairs"] == len(X) ** 2 and work["met"] < 0.5 * len(X) ** 2 and work["full"] < 0.2 * len(X) ** 2


def test_knn_edges(spark):
    """Text keys, own row left out, few rows, bad vectors, null labels and folds, empty tables."""
    schema = "id string, v array<double>, label double, fold string"
    rows = [("b", [0.0, 0.0], 1.0, "x"), ("a", [0.0, 0.0], None, None), ("c", [3.0, 4.0], 0.0, "x"), ("d", None, 0.0, "y"),
            ("e", [float("nan"), 0.0], 0.0, "y"), ("f", [None, 0.0], 0.0, "y"), (None, [0.0, 0.0], 0.0, "y")]
    df = spark.createDataFrame(rows, schema)
    out = knn_neighbors(df, df, 5, "v", "id", "id", exclude_self=True)
    assert _neighbours(out) == {"a": ["b", "c"], "b": ["a", "c"], "c": ["a", "b"]}
    assert {r["distance"] for r in out.where("qkey = 'c'").collect()} == {5.0}
    assert {r["tlabel"] for r in out.where("tkey = 'a'").collect()} == {None}
    assert _neighbours(knn_neighbors(df, df, 5, "v", "id", "id", fold="fold")) == {"a": ["a", "b", "c"], "b": ["a"], "c": ["a"]}
    none = df.where("id = 'd'")
    assert knn_neighbors(none, df, 5, "v", "id", "id").collect() == [] == knn_neighbors(df, none, 5, "v", "id", "id").collect()
    short = spark.createDataFrame([("z", [1.0], 0.0, "x")], schema)
    with pytest.raises(Exception, match="2 components"):
        knn_neighbors(df, short, 5, "v", "id", "id")


def test_chunks_of_many_categories_meet_few_rows(spark):
    """Categories as dummies on more axes than three: a chunk meets rows of its own
    category, not most of the table."""
    from tablight.functions.tiles import make_tiles, near_pairs

    rng = np.random.default_rng(12)
    X = np.hstack([np.eye(12)[rng.integers(0, 12, 4000)] * 4, rng.normal(size=(4000, 3))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "idx long, vec array<double>")
    tiles = make_tiles(df, 0.3, 0.3, 4, 64)
    n = tiles.rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    assert n.agg(F.max("n")).first()[0] <= 64
    homes = tiles.homes.join(n, "chunk").select("tile", F.col("n").alias("h"))
    met = tiles.candidates.join(n, "chunk").join(homes, "tile").agg(F.sum(F.col("n") * F.col("h"))).first()[0]
    assert met < 0.14 * len(X) ** 2
    d2 = ((X[:300, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    i, j, got = near_pairs(X[:300], X, 0.09)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(d2 <= 0.09))))
    assert np.allclose(got, d2[i, j])


def test_dbscan_plans_broadcast_no_rows(spark):
    """Labels take few bytes a row; they must not go through the driver for that."""
    from tablight.operators.dbscan import dbscan

    df = spark.range(3000).selectExpr("id AS row_id", "array(cast(id % 50 AS double), cast(id % 7 AS double)) AS features")
    plan = dbscan(df, 0.5, 4, "features", "row_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_silhouette_copies_the_table_once_a_block(spark):
    """Many rows, a single row and equal rows against brute force; a block sees all rows in
    one stream, so blocks are not paired with blocks."""
    from tablight.operators.cluster import silhouette_per_row

    rng = np.random.default_rng(15)
    X = np.vstack([rng.normal(size=(2040, 3)), np.zeros((8, 3))])
    lab = np.where(np.arange(2048) == 7, 99, rng.integers(0, 4, 2048))
    rows = [(i, x.tolist(), int(c)) for i, (x, c) in enumerate(zip(X, lab))]
    per = silhouette_per_row(spark.createDataFrame(rows, "id long, v array<double>, c long"), "v", "c", "id")
    got = per.collect()
    assert len(got) == 2048 and [r["silhouette"] for r in got if r["key"] == 7] == [0.0]
    assert abs(np.mean([r["silhouette"] for r in got]) - brute_silhouette(X, lab)) < 1e-9
    plan = per._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" not in plan and "MapInArrow" in plan


def test_knn_copies_a_row_to_few_blocks(spark):
    """Where nothing is pruned, a query goes to a bounded number of blocks, not to every leaf."""
    from tablight.functions import nearest

    rng = np.random.default_rng(9)
    X = rng.normal(size=(1600, 24))
    keys = np.arange(1600, dtype=np.int64) - 40
    schema = "key long, vec array<double>, label double, fold long"
    df = spark.createDataFrame([(int(a), v.tolist(), 1.0, int(a) % 4) for a, v in zip(keys, X)], schema)
    rows, _, leaves = nearest._indexed(df, 24, 16)
    assert len(leaves.number) > 64 and rows.select("block").distinct().count() <= 40
    got = _neighbours(knn_neighbors(df, df, 7, "vec", "key", "key", "label", fold="fold", block_rows=16))
    assert got == _brute_neighbours(X, keys, range(1600), 7, keys % 4)


def test_leaves_are_dealt_to_blocks():
    from tablight.functions.nearest import _dealt

    first, parts = _dealt([3, 4, 4, 25, 2, 8, 1], 10)
    assert first.tolist() == [0, 0, 1, 2, 5, 5, 6] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1]


def test_dbscan_copies_a_row_to_few_loads(spark):
    """All rows are near all chunks: a row is shuffled to about 16 loads, not to a tile of
    each chunk, and all settings still equal brute force."""
    from tablight.functions.tiles import make_tiles, tile_stream
    from tablight.operators.dbscan import _labelled, dbscan_levels, neighbour_counts

    rng = np.random.default_rng(4)
    X = rng.normal(size=(1600, 6))
    X /= np.sqrt((X**2).sum(axis=1, keepdims=True))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "idx long, vec array<double>")
    tiles = make_tiles(df, 0.9, 0.9, 4, 16)
    assert tiles.rows.select("chunk").distinct().count() > 96
    assert tile_stream(tiles).count() < 24 * len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    eps = [0.25, 0.9]
    n = {(r["key"], r["eps_idx"]): r["n"] for r in neighbour_counts(df, "vec", "idx", eps, 16).collect()}
    assert n == {(i, e): int((d2[i] <= eps[e] ** 2).sum()) for i in range(len(X)) for e in (0, 1)}
    found = dbscan_levels(df, eps, [4], "vec", "idx", 16)
    for e in (0, 1):
        want, core = brute_dbscan(X, np.arange(len(X)), eps[e], 4)
        got = {r["idx"]: (r["cluster"], r["is_core"]) for r in _labelled(found, found.setting(e, 0), "idx").collect()}
        assert got == {i: (want[i], core[i]) for i in range(len(X))}


def test_distance_tiles_are_small_and_exact():
    """Every pair once, in tiles of bounded size; equal and nearly equal rows far from the
    origin get their distance from differences."""
    from tablight.functions.tiles import distance_tiles

    rng = np.random.default_rng(21)
    H, C = rng.normal(size=(300, 5)) + 1e3, rng.normal(size=(2500, 5)) + 1e3
    C[:200], C[200] = H[:200], H[0] + 1e-9
    got = np.full((300, 2500), np.nan)
    for r, s, d in distance_tiles(H, C):
        assert d.size <= 128 * 1024 and np.isnan(got[r : r + len(d), s : s + d.shape[1]]).all()
        got[r : r + len(d), s : s + d.shape[1]] = d
    want = np.sqrt(((H[:, None, :] - C[None, :, :]) ** 2).sum(axis=2))
    assert np.abs(got - want).max() < 1e-7 and (got[np.arange(200), np.arange(200)] == 0).all()
    assert got[0, 200] == pytest.approx(want[0, 200], rel=1e-12)


def test_orders_of_dbscan_share_one_pass_over_the_pairs(spark, monkeypatch):
    """Labels of every order are those of a run of its own on rows with that order as key;
    the pairs are met once for all seeds."""
    from tablight.operators import cluster
    from tablight.operators import dbscan as module

    passes, own = [], module.make_tiles
    monkeypatch.setattr(module, "make_tiles", lambda *a: passes.append(1) or own(*a))
    X, keys = _points(d=2, seed=23)
    df = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(keys, X)], "row_id long, features array<double>")
    orders = [F.xxhash64(F.lit(s), F.col("row_id")) for s in (0, 1)]
    for order, found in zip(orders, module.dbscan_orders(df, 0.5, 4, orders, block_rows=40)):
        got = {r["row_id"]: (r["cluster"], r["is_core"]) for r in module._labelled(found, 0, "row_id").collect()}
        alone = dbscan(df.withColumn("_order", order), 0.5, 4, "features", "_order", block_rows=40)
        want = {r["_order"]: (r["cluster"], r["is_core"]) for r in alone.collect()}
        place = {r["row_id"]: r["o"] for r in df.select("row_id", order.alias("o")).collect()}
        assert len(got) == len(keys) and all(got[k] == want[place[k]] for k in got)
    passes.clear()
    assert cluster.dbscan_stability(df, 0.5, 4, [0, 1, 2]) == 0.0
    assert len(passes) == 1
