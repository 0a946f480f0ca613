"""Property tests: splits, folds, scaling, ranks, ROC/AUC, exact quantiles."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablight.functions.quantiles import column_modes, exact_quantiles
from tablight.functions.ranking import global_rank, running_sums
from tablight.operators.evaluate import auc_from_points, classification_report, confusion_matrix, roc_auc, roc_curve
from tablight.operators.features import standardize
from tablight.operators.split import stratified_folds, train_test_split


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame(
        {
            "k": np.arange(n, dtype=np.int64) * 13 + 1,
            "y": (rng.random(n) < 0.3).astype(int),
            "x": np.round(rng.normal(10, 3, n), 1),
            "g": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_exact_split_size_and_disjoint(frame):
    pdf, df = frame
    s = train_test_split(df, "k", 0.2, 42, exact=True).toPandas()
    assert (s.split == "test").sum() == math.ceil(0.2 * len(pdf))
    assert set(s.k) == set(pdf.k)
    s2 = train_test_split(df.repartition(3), "k", 0.2, 42, exact=True).toPandas()
    assert set(s[s.split == "test"].k) == set(s2[s2.split == "test"].k)


def test_hash_split_is_partition_independent(frame):
    pdf, df = frame
    a = train_test_split(df, "k").where("split = 'test'").select("k").toPandas()
    b = train_test_split(df.coalesce(1), "k").where("split = 'test'").select("k").toPandas()
    assert set(a.k) == set(b.k) and 0.15 < len(a) / len(pdf) < 0.25


def test_stratified_folds_balanced(frame):
    pdf, df = frame
    f = stratified_folds(df, "k", "y", 5).toPandas()
    counts = f.groupby(["y", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 1


def test_global_rank_and_running_sums(frame):
    pdf, df = frame
    r = global_rank(df, [F.col("x"), F.col("k")], partition_cols=["g"], rank_col="r").toPandas()
    exp = pdf.sort_values(["g", "x", "k"]).groupby("g").cumcount()
    exp.index = pdf.sort_values(["g", "x", "k"]).k.values
    assert all(r.set_index("k").r.sort_index() == exp.sort_index())
    cs = running_sums(df.select("k", "x"), [F.col("k")], ["x"]).toPandas().sort_values("k")
    assert np.allclose(cs.cum_x.values, pdf.sort_values("k").x.cumsum().values)


def test_scaler_population_moments(frame):
    _, df = frame
    out, model = standardize(df, ["x"])
    st = out.agg(F.avg("x"), F.stddev_pop("x")).collect()[0]
    assert abs(st[0]) < 1e-9 and abs(st[1] - 1) < 1e-9


def test_auc_equals_pair_probability(frame):
    pdf, df = frame
    auc = roc_auc(df, "y", "x", 1)
    pos, neg = pdf.x[pdf.y == 1].values, pdf.x[pdf.y == 0].values
    pairs = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert abs(auc - pairs) < 1e-12
    pts = roc_curve(df, "y", "x", 1).toPandas()
    assert pts.fpr.max() == 1.0 and pts.tpr.max() == 1.0 and len(pts) == pdf.x.nunique() + 1


def test_confusion_and_report(frame):
    pdf, df = frame
    p = df.withColumn("p", (F.col("x") > 10).cast("int"))
    cm = {(r["label"], r["prediction"]): r["n"] for r in confusion_matrix(p, "y", "p").collect()}
    assert sum(cm.values()) == len(pdf) and len(cm) == 4
    rep = {r["class"]: r for r in classification_report(p, "y", "p").collect()}
    tp = cm[("1", "1")]
    assert abs(rep["1"]["precision"] - tp / (tp + cm[("0", "1")])) < 1e-12
    assert rep["accuracy"]["precision"] is None and rep["accuracy"]["support"] == len(pdf)


def test_reports_of_many_classes_and_odd_ones(spark):
    n = 5000  # class i is predicted right when i is even, else as class i - 1
    many = spark.range(2 * n).select((F.col("id") % n).alias("y"), (F.col("id") % n - F.col("id") % 2).cast("double").alias("p"))
    rep = {r["class"]: r for r in classification_report(many, "y", "p").collect()}
    assert len(rep) == n + 3 and rep["accuracy"]["f1"] == 0.5 and rep["accuracy"]["support"] == 2 * n
    assert (rep["10"]["precision"], rep["10"]["recall"], rep["11"]["f1"]) == (0.5, 1.0, 0.0)
    assert confusion_matrix(many, "y", "p", dense=False).count() == n
    odd = spark.createDataFrame([("a", "a"), (None, "a"), (None, None), ("b", None)], "label string, prediction string")
    cm = [tuple(r) for r in confusion_matrix(odd).collect()]
    assert cm == [(y, p, int((y, p) in {("a", "a"), (None, "a"), (None, None), ("b", None)})) for y in ("a", "b", None) for p in ("a", "b", None)]
    assert [r["class"] for r in classification_report(odd).collect()] == ["a", "b", None, "accuracy", "macro avg", "weighted avg"]
    empty = classification_report(odd.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("accuracy", None, None, 0.0, 0), ("macro avg", 0.0, 0.0, 0.0, 0), ("weighted avg", 0.0, 0.0, 0.0, 0)]
    assert confusion_matrix(odd.limit(0)).collect() == []


def test_auc_from_points_equals_auc(frame):
    _, df = frame
    assert auc_from_points(roc_curve(df, "y", "x", 1)) == pytest.approx(roc_auc(df, "y", "x", 1), abs=1e-12)


def test_exact_quantiles_vs_numpy(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.lognormal(3, 2, 5000), np.full(2500, 7.25), rng.integers(0, 50, 500)])
    g = np.where(np.arange(len(v)) % 3 == 0, "a", "b")
    df = spark.createDataFrame(pd.DataFrame({"v": v, "g": g}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    # small bracket_limit and buckets force several refinement rounds
    res = exact_quantiles(df, "v", probs, by=["g"], bracket_limit=50, buckets=16)
    for r in res:
        sub = v[g == r["group"][0]]
        assert r["value"] == pytest.approx(np.quantile(sub, r["prob"]), rel=1e-12, abs=1e-12)
    glob = exact_quantiles(df, "v", probs, bracket_limit=100, buckets=32)
    for r in glob:
        assert r["value"] == pytest.approx(np.quantile(v, r["prob"]), rel=1e-12, abs=1e-12)


def test_modes_tie_lowest(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": ["x", "y", "y", "x", None], "b": [2.0, 1.0, 1.0, 2.0, 3.0]}))
    m = column_modes(df, ["a", "b"])
    assert m == {"a": "x", "b": 1.0}
