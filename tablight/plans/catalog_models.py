"""Driver-table queries for learning operators: prepared features, the six
classifiers, tuning, nearest neighbours, k-means, silhouette, DBSCAN,
leaderboards and the perceptron on embeddings.

Queries whose result is a fitted model's output (predictions, clusters) have
no oracle SQL; they are checked by row count here and by seeded threshold or
brute-force tests in ``tests/``.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablight.operators import classifiers, cluster, dbscan, evaluate, knn, leaderboard, split, stages, svm, tune
from tablight.plans import workflows
from tablight.plans.catalog import r6
from tablight.plans.survey import clean_survey
from tablight.session import ensure_checkpoint_dir
from tablight.sources.tables import table

KNN_EPS = 1.15
KNN_MIN_SAMPLES = 5


def _prep_sup(spark, sf):
    return workflows.prepare_supervised(clean_survey(spark, sf).df, "fraud", "row_id")


def _prep_unsup(spark, sf):
    return workflows.prepare_unsupervised(clean_survey(spark, sf).df, "fraud", "row_id")


def q_prepare_supervised_survey(spark, sf):
    p = _prep_sup(spark, sf)
    arr = vector_to_array(F.col("features"))
    return r6(
        p.all_rows.select(
            "row_id", "split", F.col("fraud").alias("label"), *[arr[i].alias(n) for i, n in enumerate(p.feature_names)]
        )
    )


def _model_query(name):
    def q(spark, sf):
        p = _prep_sup(spark, sf)
        return r6(workflows.fit_predict(name, p, "row_id", "fraud"))

    q.__name__ = "q_" + name.lower().replace(" ", "_")
    return q


def q_supervised_leaderboard_survey(spark, sf):
    p = _prep_sup(spark, sf)
    return r6(workflows.supervised_benchmark(p, "row_id", "fraud")["leaderboard"])


def q_saved_bundles_survey(spark, sf):
    """Preparation and model of all six models saved, loaded and applied to the test
    rows: how many rows get the same prediction and probability as before."""
    clean = clean_survey(spark, sf).df
    p = workflows.prepare_supervised(clean, "fraud", "row_id")
    test = clean.join(p.test.select("row_id"), "row_id", "left_semi")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundles-{uuid.uuid4().hex}"
    out = None
    for i, name in enumerate(workflows.MODEL_NAMES):
        whole = workflows.fit_bundle(name, p, "row_id", "fraud")
        stages.save_bundle(whole, f"{folder}/{i}")
        old, new = (m.transform(test).select("row_id", "prediction", vector_to_array("probability").alias("p")) for m in (whole, stages.load_bundle(f"{folder}/{i}")))
        new = new.toDF("row_id", "new_prediction", "new_p")
        # the margin is for sums whose order differs between two runs of a plan
        near = F.forall(F.zip_with("p", "new_p", lambda a, b: F.abs(a - b) < 1e-9), lambda x: x)
        same = (F.col("prediction") == F.col("new_prediction")) & near
        row = old.join(new, "row_id").agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_equal"))
        out = row if out is None else out.unionByName(row)
    return out


def q_feature_importance_survey(spark, sf):
    p = _prep_sup(spark, sf)
    model = classifiers.random_forest(100, None, 42, label="fraud").fit(p.train)
    return r6(classifiers.feature_importance(model, p.feature_names, 10, spark))


def q_cross_val_logreg_survey(spark, sf):
    p = _prep_sup(spark, sf)
    folds = split.stratified_folds(p.train, "row_id", "fraud", 5, 42).persist()
    n = folds.count()
    fit = tune.spark_ml_fit(classifiers.logistic_regression(int(n * 0.8), C=1.0, label="fraud"))
    res = tune.cross_val_score(fit, tune.spark_ml_predict("fraud"), folds, 5, parallelism=5)
    rows = [(i, s) for i, s in enumerate(res["scores"])]
    return r6(spark.createDataFrame(rows, "fold int, accuracy double"))


def q_grid_search_svm_survey(spark, sf):
    """The SVM grid: C in {0.1, 1, 10} x gamma in {scale, auto}, 5 folds; the winner is
    fitted on all training rows and scored on the test rows."""
    p = _prep_sup(spark, sf)
    folds = split.stratified_folds(p.train, "row_id", "fraud", 5, 42).persist()

    def fit(train, C, gamma):
        return svm.svm_rbf(train, C=C, gamma=gamma, label="fraud")

    def predict(model, df):
        return model.predict(df, label="fraud")

    def fit_folds(df, jobs):
        return svm.svm_rbf_folds(df, jobs, label="fraud")

    grid = {"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto"]}
    res = tune.grid_search(fit, predict, folds, grid, 5, parallelism=6, fit_folds=fit_folds)
    scored = evaluate.accuracy(predict(res["model"], p.test))
    rows = [(s, m, best, scored if best else None) for s, m in res["table"] for best in [s == str(res["best_params"])]]
    return r6(spark.createDataFrame(rows, "setting string, cv_accuracy double, best boolean, test_accuracy double"))


def q_knn_search_survey(spark, sf):
    p = _prep_sup(spark, sf)
    folds = split.stratified_folds(p.train, "row_id", "fraud", 5, 42)
    res = knn.knn_search(folds, list(range(1, 20)), "features", "row_id", "fraud", "fold")
    rows = [(k, res["scores"][k], k == res["best_k"]) for k in sorted(res["scores"])]
    return r6(spark.createDataFrame(rows, "k int, cv_accuracy double, best boolean"))


def _emb_split(spark, sf):
    return split.train_test_split(table(spark, sf, "embeddings"), "vec_id", 0.2, 42)


def q_knn_neighbors_embeddings(spark, sf):
    e = _emb_split(spark, sf)
    nb = knn.knn_neighbors(e.where("split = 'train'"), e.where("split = 'test'"), 5, "embedding", "vec_id", "vec_id", "label")
    return nb.select(F.col("qkey").alias("vec_id"), F.col("rank").cast("int").alias("rank"), F.col("tkey").alias("neighbor_id"))


def q_knn_embeddings(spark, sf):
    e = _emb_split(spark, sf)
    test = e.where("split = 'test'").select("vec_id", "embedding", "label")
    pred = knn.knn_predict(e.where("split = 'train'"), test, 5, "embedding", "vec_id", "label")
    return pred.select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


def q_knn_search_embeddings(spark, sf):
    """Cross-validated accuracy for k = 1..19 over the training rows."""
    e = _emb_split(spark, sf).where("split = 'train'").select("vec_id", "embedding", "label")
    folds = split.stratified_folds(e, "vec_id", "label", 5, 42)
    res = knn.knn_search(folds, list(range(1, 20)), "embedding", "vec_id", "label", "fold")
    return r6(spark.createDataFrame([(k, res["scores"][k]) for k in sorted(res["scores"])], "k int, cv_accuracy double"))


def q_silhouette_embeddings_labels(spark, sf):
    e = table(spark, sf, "embeddings")
    s = cluster.silhouette(e, "embedding", "label", "vec_id")
    return r6(spark.createDataFrame([(s,)], "silhouette double"))


def q_dbscan_neighbors_embeddings(spark, sf):
    e = table(spark, sf, "embeddings")
    n = dbscan.neighbour_counts(e, "embedding", "vec_id", [KNN_EPS])
    return n.select(
        F.col("key").alias("vec_id"), F.col("n").alias("n_neighbors"), (F.col("n") >= KNN_MIN_SAMPLES).alias("is_core")
    )


def q_dbscan_embeddings(spark, sf):
    e = table(spark, sf, "embeddings")
    return dbscan.dbscan(e, KNN_EPS, KNN_MIN_SAMPLES, "embedding", "vec_id")


SEARCH_EPS, SEARCH_MIN = dbscan.eps_grid(0.3, 1.1, 0.1), list(range(3, 10))
BENCH_EPS, BENCH_MIN = dbscan.eps_grid(0.5, 2.0, 0.1), [5]


def q_dbscan_core_counts_embeddings(spark, sf):
    """Core rows of every setting of both search grids, from one pass."""
    e = table(spark, sf, "embeddings")
    wide = sorted({*SEARCH_EPS, *BENCH_EPS})
    return dbscan.core_counts(e, wide, SEARCH_MIN, "embedding", "vec_id")


def q_dbscan_search_survey(spark, sf):
    """All 8 x 7 settings (eps 0.3 to 1.0, min_samples 3 to 9) with their silhouettes."""
    p = _prep_unsup(spark, sf)
    best = dbscan.dbscan_search(p.all_rows, SEARCH_EPS, SEARCH_MIN, "features", "row_id")
    chosen = (F.col("eps") == F.lit(best["eps"])) & (F.col("min_samples") == F.lit(best["min_samples"]))
    return r6(best["tried"].withColumn("best", F.coalesce(chosen, F.lit(False))))


def q_cluster_summary_dbscan_embeddings(spark, sf):
    return cluster.cluster_summary(q_dbscan_embeddings(spark, sf), "cluster")


def q_dbscan_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    return dbscan.dbscan(p.all_rows, 0.7, 4, "features", "row_id")


def q_kmeans_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    return cluster.kmeans(p.all_rows, 3, 42).transform(p.all_rows).select("row_id", "cluster")


def q_kmeans_pp_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    return cluster.kmeans_pp(p.all_rows, 6, 42).transform(p.all_rows).select("row_id", "cluster")


def q_elbow_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    return r6(cluster.elbow(p.all_rows, range(2, 11), 42))


def q_silhouette_kmeans_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    pred = cluster.kmeans(p.all_rows, 3, 42).transform(p.all_rows)
    s = cluster.silhouette(pred, "features", "cluster", "row_id")
    return r6(spark.createDataFrame([(3, s)], "k int, silhouette double"))


def q_cluster_summary_dbscan_survey(spark, sf):
    return cluster.cluster_summary(q_dbscan_survey(spark, sf), "cluster")


def q_cluster_stability_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    seeds = [0, 1, 2, 3, 4]
    rows = [
        ("KMeans", float(cluster.kmeans_stability(p.all_rows, 3, seeds))),
        ("KMeans++", float(cluster.kmeans_stability(p.all_rows, 6, seeds, plus_plus=True))),
        ("DBSCAN", float(cluster.dbscan_stability(p.all_rows, 0.7, 4, seeds))),
    ]
    return r6(spark.createDataFrame(rows, "method string, stability double"))


def q_cluster_projection_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    pred = cluster.kmeans(p.all_rows, 3, 42).transform(p.all_rows)
    return r6(cluster.cluster_projection(pred, "features", "cluster", keep=["row_id"]))


def q_clustering_leaderboard_survey(spark, sf):
    p = _prep_unsup(spark, sf)
    res = workflows.clustering_benchmark(
        p, "row_id", 3, 6, eps_list=SEARCH_EPS, min_samples=SEARCH_MIN, min_clusters=1, drop_noise=False,
        stability_seeds=[0, 1, 2, 3, 4],
    )
    return r6(res["leaderboard"])


def q_clustering_benchmark_survey(spark, sf):
    """The straight-line benchmark: 15 eps from 0.5 to 1.9, noise left out of the silhouette."""
    p = _prep_unsup(spark, sf)
    return r6(workflows.clustering_benchmark(p, "row_id", eps_list=BENCH_EPS, min_samples=BENCH_MIN)["leaderboard"])


def _emb_vectors(spark, sf):
    from pyspark.ml.functions import array_to_vector

    e = _emb_split(spark, sf)
    return e.select("vec_id", "split", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def q_mlp_embeddings(spark, sf):
    e = _emb_vectors(spark, sf)
    res = workflows.final_fit(e.where("split = 'train'"), e.where("split = 'test'"), 64, 10, (512, 256, 128), 50)
    return r6(res["report"])


def q_confusion_mlp_embeddings(spark, sf):
    e = _emb_vectors(spark, sf)
    res = workflows.final_fit(e.where("split = 'train'"), e.where("split = 'test'"), 64, 10, (512, 256, 128), 50)
    return res["confusion"]


def q_experiment_grid_embeddings(spark, sf):
    """One row per (batch size, learning rate) setting of the perceptron."""
    from tablight.operators.features import config_label

    e = _emb_vectors(spark, sf)
    # every fit makes 30 passes over the training rows, which a small table keeps in one partition
    train, test = (classifiers.dealt(e.where(F.col("split") == s), "vec_id").persist() for s in ("train", "test"))

    def run(cfg):
        m = classifiers.mlp(64, 10, (512, 256, 128), 30, 42, block_size=cfg["batch_size"], learning_rate=cfg["learning_rate"]).fit(train)
        return evaluate.accuracy(m.transform(train)), evaluate.accuracy(m.transform(test))

    configs = [{"batch_size": b, "learning_rate": lr} for b in (16, 32, 64, 128) for lr in (0.01, 0.005, 0.001, 0.0005, 0.0001)]
    table_df, _best = tune.experiment_grid(
        spark, configs, run, label=lambda c: config_label("MLP", c["batch_size"], c["learning_rate"])
    )
    return leaderboard.sort_results(table_df.select("setting", "accuracy", "validation_accuracy"), "validation_accuracy")


def q_predict_with_proba_embeddings(spark, sf):
    e = _emb_vectors(spark, sf)
    m = classifiers.mlp(64, 10, (512, 256, 128), 50, 42).fit(e.where("split = 'train'"))
    out = workflows.predict_with_proba(m, e.where("split = 'test'").orderBy("vec_id"), 25, keep=["vec_id", "label"])
    return out.select("vec_id", "label", "prediction", F.array_max("probabilities").alias("max_probability"))


QUERIES = {
    "prepare_supervised_survey": q_prepare_supervised_survey,
    "logistic_regression_survey": _model_query("Logistic Regression"),
    "random_forest_survey": _model_query("Random Forest"),
    "decision_tree_survey": _model_query("Decision Tree"),
    "knn_survey": _model_query("KNN"),
    "svm_rbf_survey": _model_query("SVM"),
    "gradient_boosting_survey": _model_query("Gradient Boosting"),
    "supervised_leaderboard_survey": q_supervised_leaderboard_survey,
    "saved_bundles_survey": q_saved_bundles_survey,
    "feature_importance_survey": q_feature_importance_survey,
    "cross_val_logreg_survey": q_cross_val_logreg_survey,
    "grid_search_svm_survey": q_grid_search_svm_survey,
    "knn_search_survey": q_knn_search_survey,
    "knn_neighbors_embeddings": q_knn_neighbors_embeddings,
    "knn_embeddings": q_knn_embeddings,
    "knn_search_embeddings": q_knn_search_embeddings,
    "silhouette_embeddings_labels": q_silhouette_embeddings_labels,
    "dbscan_neighbors_embeddings": q_dbscan_neighbors_embeddings,
    "dbscan_embeddings": q_dbscan_embeddings,
    "cluster_summary_dbscan_embeddings": q_cluster_summary_dbscan_embeddings,
    "dbscan_core_counts_embeddings": q_dbscan_core_counts_embeddings,
    "dbscan_search_survey": q_dbscan_search_survey,
    "clustering_benchmark_survey": q_clustering_benchmark_survey,
    "dbscan_survey": q_dbscan_survey,
    "kmeans_survey": q_kmeans_survey,
    "kmeans_pp_survey": q_kmeans_pp_survey,
    "elbow_survey": q_elbow_survey,
    "silhouette_kmeans_survey": q_silhouette_kmeans_survey,
    "cluster_summary_dbscan_survey": q_cluster_summary_dbscan_survey,
    "cluster_stability_survey": q_cluster_stability_survey,
    "cluster_projection_survey": q_cluster_projection_survey,
    "clustering_leaderboard_survey": q_clustering_leaderboard_survey,
    "mlp_embeddings": q_mlp_embeddings,
    "confusion_mlp_embeddings": q_confusion_mlp_embeddings,
    "experiment_grid_embeddings": q_experiment_grid_embeddings,
    "predict_with_proba_embeddings": q_predict_with_proba_embeddings,
}
