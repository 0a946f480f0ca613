"""Composed workflows: prepare data for supervised / unsupervised learning,
profile and association reports, the six-model benchmark, the clustering
benchmark and the final fit of a chosen setting.

Each step is a DataFrame transformation or a Spark ML fit; the driver only
holds small results (statistics, metrics, leaderboards). Prepared features are
persisted once because every model reads them several times.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablight.operators import association, classifiers, cluster, dbscan, evaluate, features, knn, leaderboard, profile, split, stages, svm


@dataclass
class Prepared:
    train: DataFrame | None
    test: DataFrame | None
    all_rows: DataFrame | None
    feature_names: list[str]
    scaler: features.ScalerModel
    encoder: features.OneHotModel
    extra: dict = field(default_factory=dict)


def prepare_supervised(
    clean: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42, exact_split: bool = False,
    persist: bool = True,
) -> Prepared:
    """One-hot (label and key kept aside), split, scale with statistics of the
    training rows only, assemble ``features``. Rows: key, label, split, features."""
    enc = features.fit_one_hot(clean, exclude=[label, key])
    wide = enc.transform(clean, keep=[key, label])
    names = enc.feature_names
    with_split = split.train_test_split(wide, key, test, seed, exact=exact_split)
    scaler = features.fit_standard_scaler(with_split.where(F.col("split") == "train"), names)
    scaled = scaler.transform(with_split, names)
    out = features.assemble(scaled, names, "features", keep=[key, label, "split"]).withColumn(
        label, F.col(label).cast("double")
    )
    if persist:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(
        out.where(F.col("split") == "train"), out.where(F.col("split") == "test"), out, names, scaler, enc
    )


def prepare_unsupervised(clean: DataFrame, label: str, key: str, persist: bool = True) -> Prepared:
    """One-hot without the label, scaled over all rows, assembled."""
    enc = features.fit_one_hot(clean, exclude=[label, key])
    names = enc.feature_names
    wide = enc.transform(clean, keep=[key])
    scaler = features.fit_standard_scaler(wide, names)
    out = features.assemble(scaler.transform(wide, names), names, "features", keep=[key])
    if persist:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(None, None, out, names, scaler, enc)


def profile_report(clean: DataFrame, label: str, numeric: Sequence[str]) -> dict:
    """Summary statistics, class share, imbalance and histograms."""
    return {
        "info": profile.table_info(clean),
        "describe": profile.describe_numeric(clean, numeric),
        "shares": profile.value_counts(clean, label, normalize=True),
        "imbalance": profile.class_imbalance(clean, label, 1.0, 0.0),
        "histograms": {c: profile.histogram(clean, c, "auto") for c in numeric},
    }


def association_report(clean: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
                       grouped: str | None = None) -> dict:
    """Box statistics by label, grouped counts, chi-square tests, correlations."""
    return {
        "box": {c: profile.box_stats(clean, c, by=label) for c in numeric},
        "grouped": profile.grouped_counts(clean, grouped, label) if grouped else None,
        "chi_square": association.chi_square(clean, categorical, label),
        "correlation": association.correlation_matrix(clean, [*numeric, label]),
    }


MODEL_NAMES = ("Logistic Regression", "Random Forest", "Decision Tree", "KNN", "SVM", "Gradient Boosting")
# the reference's name for its boosting model; ours is Spark's first-order GBT
MODEL_ALIASES = {"XGBoost": "Gradient Boosting"}


def fit_predict(name: str, prep: Prepared, key: str, label: str = "label", seed: int = 42) -> DataFrame:
    """Fixed-parameter fit of one of the six models; test predictions
    (key, label, prediction, score)."""
    train, test = prep.train, prep.test
    name = MODEL_ALIASES.get(name, name)
    if name == "KNN":
        nb = knn.knn_neighbors(train, test, 5, "features", key, key, label)
        pv = knn.vote(nb, [5]).select(F.col("qkey").alias(key), "prediction")
        # probability of class 1 = share of positive neighbours
        share = nb.groupBy(F.col("qkey").alias(key)).agg(F.avg((F.col("tlabel") == 1.0).cast("double")).alias("score"))
        return (
            test.select(key, F.col(label).alias("label"))
            .join(pv, key).join(share, key)
            .select(key, "label", "prediction", "score")
        )
    if name == "SVM":
        return svm.svm_rbf(train, C=1.0, gamma="scale", seed=seed, label=label).predict(test, keep=[key], label=label)
    est = _estimator(name, train.count(), label, seed)
    return classifiers.predict(est.fit(_rows_for(name, train, key)), test, keep=[key])


def _rows_for(name: str, train: DataFrame, key: str) -> DataFrame:
    return classifiers.dealt(train, key) if name == "Gradient Boosting" else train


def _estimator(name: str, n: int, label: str, seed: int):
    return {
        "Logistic Regression": lambda: classifiers.logistic_regression(n, C=1.0, max_iter=1000, label=label),
        "Random Forest": lambda: classifiers.random_forest(100, None, seed, label=label),
        "Decision Tree": lambda: classifiers.decision_tree(None, seed, label=label),
        "Gradient Boosting": lambda: classifiers.gradient_boosting(100, 6, 0.3, seed, label=label),
    }[name]()


def fit_bundle(name: str, prep: Prepared, key: str, label: str = "label", seed: int = 42, fills: dict | None = None) -> PipelineModel:
    """One of the six models with its preparation as one pipeline, to be saved whole
    (``stages.save_bundle``). It takes rows of the clean table (with ``fills``: of the
    mapped one) and adds ``prediction`` and ``probability``."""
    name = MODEL_ALIASES.get(name, name)
    if name == "KNN":
        est = stages.KnnClassifier(k=5, keyCol=key, labelCol=label)
    elif name == "SVM":
        est = stages.RbfSvm(C=1.0, gamma="scale", seed=seed, labelCol=label)
    else:
        est = _estimator(name, prep.train.count(), label, seed)
    return stages.bundle(fills, prep.encoder, prep.scaler, [key, label], est.fit(_rows_for(name, prep.train, key)))


def supervised_benchmark(prep: Prepared, key: str, label: str = "label", models: Sequence[str] = MODEL_NAMES) -> dict:
    """Fit every model, score on the test rows; leaderboard of accuracy and AUC."""
    metrics, preds = {}, {}
    for name in models:
        p = fit_predict(name, prep, key, label).persist(StorageLevel.MEMORY_AND_DISK)
        preds[name] = p
        metrics[name] = {"accuracy": evaluate.accuracy(p), "auc": evaluate.roc_auc(p, "label", "score", 1.0)}
    spark = prep.all_rows.sparkSession
    return {"leaderboard": leaderboard.model_leaderboard(spark, metrics), "predictions": preds, "metrics": metrics}


def clustering_benchmark(
    prep: Prepared, key: str, k_kmeans: int = 2, k_pp: int = 2, eps_list: Sequence[float] | None = None,
    min_samples: Sequence[int] = (5,), min_clusters: int = 2, seed: int = 42, stability_seeds: Sequence[int] = (),
    drop_noise: bool = True,
) -> dict:
    """k-means, k-means|| and a DBSCAN search, each with silhouette; one table.

    Defaults follow the straight-line benchmark (noise dropped from the
    silhouette, at least two clusters); the interactive variant counts noise
    as a cluster and accepts one cluster (``drop_noise=False, min_clusters=1``)."""
    df = prep.all_rows
    rows = []
    for method, k, pp in (("KMeans", k_kmeans, False), ("KMeans++", k_pp, True)):
        model = (cluster.kmeans_pp if pp else cluster.kmeans)(df, k, seed)
        pred = model.transform(df)
        summ = cluster.cluster_summary(pred).collect()[0]
        stab = cluster.kmeans_stability(df, k, stability_seeds, plus_plus=pp) if stability_seeds else None
        rows.append(
            {
                "method": method, "k_or_eps": k, "n_clusters": summ["n_clusters"], "has_outliers": False,
                "silhouette": cluster.silhouette(pred, "features", "cluster", key), "stability": stab,
            }
        )
    eps_list = list(eps_list) if eps_list is not None else dbscan.eps_grid(0.5, 2.0, 0.1)
    best = dbscan.dbscan_search(df, eps_list, list(min_samples), "features", key, min_clusters=min_clusters, drop_noise=drop_noise)
    rows.append(
        {
            "method": "DBSCAN", "k_or_eps": best["eps"] if best["eps"] is not None else "N/A",
            "n_clusters": best["n_clusters"] if best["eps"] is not None else "N/A",
            "has_outliers": True if best["eps"] is not None else "N/A",
            "silhouette": best["silhouette"] if best["eps"] is not None else "N/A",
            "stability": cluster.dbscan_stability(df, best["eps"], best["min_samples"], stability_seeds, "features", key)
            if stability_seeds and best["eps"] is not None else None,
        }
    )
    return {"leaderboard": leaderboard.clustering_leaderboard(df.sparkSession, rows), "dbscan": best}


def final_fit(train: DataFrame, test: DataFrame, n_features: int, n_classes: int, hidden: Sequence[int] = (512, 256, 128),
              max_iter: int = 100, seed: int = 42, label: str = "label", class_names: Sequence[str] | None = None) -> dict:
    """Refit the chosen perceptron setting for longer and report on test rows."""
    model = classifiers.mlp(n_features, n_classes, hidden, max_iter, seed, label=label).fit(train)
    pred = model.transform(test).select(F.col(label).alias("label"), "prediction", "probability")
    return {
        "model": model,
        "accuracy": evaluate.accuracy(pred),
        "confusion": evaluate.confusion_matrix(pred),
        "report": evaluate.classification_report(pred),
        "predictions": pred,
    }


def predict_with_proba(model, df: DataFrame, n: int = 25, keep: Sequence[str] = (), class_names: Sequence[str] | None = None) -> DataFrame:
    """n rows with the predicted class, its name and all class probabilities."""
    from pyspark.ml.functions import vector_to_array

    from tablight.functions.columns import lookup

    out = model.transform(df.limit(n)).select(
        *[F.col(c) for c in keep], "prediction", vector_to_array("probability").alias("probabilities")
    )
    if class_names:
        out = out.withColumn("class_name", lookup(F.col("prediction").cast("int"), dict(enumerate(class_names))))
    return out
