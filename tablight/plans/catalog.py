"""Driver-table queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver's parquet tables (or the survey view derived from
them) in full, runs the library operator, and rounds floating columns to 6
places so results compare exactly with the oracle SQL in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.operators import association, evaluate, features, leaderboard, profile, split
from tablight.plans.survey import clean_survey, dirty_survey
from tablight.sources.tables import TABLES, shape, split_counts, table

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SURVEY_NUMERIC = ["income", "balance", "age"]
CHI_FEATURES = ["education", "gender", "area", "home_owner", "employed"]


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (the comparison precision)."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), 6).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _clean(spark, sf):
    return clean_survey(spark, sf).df


def q_clean_survey(spark, sf):
    return r6(_clean(spark, sf))


def q_table_shapes(spark, sf):
    rows = [(n, *shape(table(spark, sf, n))) for n in TABLES]
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_cols long")


def q_distinct_area_raw(spark, sf):
    return profile.distinct_values(dirty_survey(spark, sf), "area")


def q_value_counts_events(spark, sf):
    return r6(profile.value_counts(table(spark, sf, "events"), "event_type", normalize=True))


def q_value_counts_education(spark, sf):
    return r6(profile.value_counts(_clean(spark, sf), "education", normalize=True))


def q_class_imbalance_survey(spark, sf):
    return r6(profile.class_imbalance(_clean(spark, sf), "fraud", 1.0, 0.0))


def q_describe_lineitem(spark, sf):
    return r6(profile.describe_numeric(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


def q_table_info_survey(spark, sf):
    return profile.table_info(_clean(spark, sf))


def q_before_after_age(spark, sf):
    return profile.before_after_counts(dirty_survey(spark, sf), _clean(spark, sf), "age")


def q_grouped_counts_education(spark, sf):
    return profile.grouped_counts(_clean(spark, sf), "education", "fraud")


def q_crosstab_lineitem(spark, sf):
    return profile.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


def q_chi_square_survey(spark, sf):
    return r6(association.chi_square(_clean(spark, sf), CHI_FEATURES, "fraud").drop("p_value"))


def q_correlation_lineitem(spark, sf):
    return r6(association.correlation_matrix(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


def q_box_stats_lineitem(spark, sf):
    return r6(profile.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", by="l_returnflag"))


def q_histogram_lineitem(spark, sf):
    out, _ = profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", bins=30)
    return r6(out)


def q_histogram_info_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = []
    for c in LINEITEM_NUMERIC:
        _, info = profile.histogram(li, c, bins=30)
        rows.append((c, info["n"], info["min"], info["max"], info["log_scale_ok"]))
    return r6(spark.createDataFrame(rows, "col_name string, n long, min double, max double, log_scale_ok boolean"))


def q_select_numeric_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return r6(li.select(*profile.numeric_columns(li)))


def q_one_hot_survey(spark, sf):
    clean = _clean(spark, sf).drop("fraud")
    out, _ = features.one_hot(clean, keep=["row_id"])
    return r6(out)


def q_standardize_survey(spark, sf):
    clean = _clean(spark, sf).select("row_id", *SURVEY_NUMERIC)
    out, _ = features.standardize(clean, SURVEY_NUMERIC)
    return r6(out)


def q_train_test_split_orders(spark, sf):
    return split.train_test_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42)


def q_train_test_split_exact(spark, sf):
    return split.train_test_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42, exact=True)


def q_split_counts_orders(spark, sf):
    s = split.train_test_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42)
    return split_counts(s)


def q_stratified_folds_survey(spark, sf):
    return split.stratified_folds(_clean(spark, sf).select("row_id", "fraud"), "row_id", "fraud", 5, 42)


def q_stratified_folds_dirty(spark, sf):
    d = dirty_survey(spark, sf).select("row_id", F.when(F.col("row_id") % 7 != 0, F.col("fraud")).alias("label"))
    return split.stratified_folds(d, "row_id", "label", 5, 42)


def q_box_stats_dirty(spark, sf):
    n = F.col("l_linenumber")
    li = table(spark, sf, "lineitem").select(
        F.when(n != 5, F.col("l_returnflag")).alias("grp"),
        F.when(n == 3, F.lit(float("nan"))).when(n != 4, F.col("l_extendedprice")).alias("price"),
    )
    return r6(profile.box_stats(li, "price", by="grp"))


def doc_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a deterministic score (length) and prediction
    (longer than the mean length)."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = d.join(lab, "doc_id").select("doc_id", "label", F.col("n_chars").cast("double").alias("score"))
    mean = docs.agg(F.avg("score")).collect()[0][0]
    return docs.withColumn("prediction", F.when(F.col("score") > F.lit(mean), 1).otherwise(0))


def q_confusion_matrix_docs(spark, sf):
    return evaluate.confusion_matrix(doc_predictions(spark, sf), "label", "prediction")


def q_classification_report_docs(spark, sf):
    return r6(evaluate.classification_report(doc_predictions(spark, sf), "label", "prediction"))


def q_accuracy_docs(spark, sf):
    return r6(evaluate.accuracy_frame(doc_predictions(spark, sf), "label", "prediction"))


def q_roc_curve_docs(spark, sf):
    return r6(evaluate.roc_curve(doc_predictions(spark, sf), "label", "score", positive=1))


def q_roc_auc_docs(spark, sf):
    auc = evaluate.roc_auc(doc_predictions(spark, sf), "label", "score", positive=1)
    return r6(spark.createDataFrame([(auc,)], "auc double"))


def q_top_k_users(spark, sf):
    ev = table(spark, sf, "events")
    per_user = ev.groupBy("user_id").agg(F.sum("value").alias("total_value"), F.count(F.lit(1)).alias("n_events"))
    return r6(leaderboard.top_k(per_user, "total_value", 10, tie=["user_id"]))


def q_best_row_part(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return r6(leaderboard.best_row(p, "p_retailprice", ordinal="p_partkey"))


def q_sort_results_supplier(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return r6(leaderboard.sort_results(s, "s_acctbal", descending=True))


def q_append_rows_parties(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
    )
    return r6(leaderboard.append_rows(c, s))


def q_relabel_survey(spark, sf):
    from tablight.plans.survey import LABEL_NAMES

    lab = features.relabel(_clean(spark, sf), "fraud", LABEL_NAMES, out="fraud_status")
    return lab.groupBy("fraud_status").agg(F.count(F.lit(1)).alias("n"))


def q_filter_rows_orders(spark, sf):
    o = table(spark, sf, "orders")
    kept = o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000.0))
    return r6(kept.select("o_orderkey", "o_custkey", "o_totalprice"))


def q_before_after_area(spark, sf):
    return profile.before_after_counts(dirty_survey(spark, sf), _clean(spark, sf), "area", numeric=False)


def q_describe_survey(spark, sf):
    return r6(profile.describe_numeric(_clean(spark, sf), SURVEY_NUMERIC))


def q_box_stats_survey(spark, sf):
    return r6(profile.box_stats(_clean(spark, sf), "income", by="fraud"))


def q_histogram_auto_lineitem(spark, sf):
    out, info = profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", bins="auto")
    return r6(out)


def q_value_counts_raw_area(spark, sf):
    return profile.value_counts(dirty_survey(spark, sf), "area", null_as="nan")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_survey": q_clean_survey,
    "table_shapes": q_table_shapes,
    "distinct_area_raw": q_distinct_area_raw,
    "value_counts_events": q_value_counts_events,
    "value_counts_education": q_value_counts_education,
    "class_imbalance_survey": q_class_imbalance_survey,
    "describe_lineitem": q_describe_lineitem,
    "table_info_survey": q_table_info_survey,
    "before_after_age": q_before_after_age,
    "grouped_counts_education": q_grouped_counts_education,
    "crosstab_lineitem": q_crosstab_lineitem,
    "chi_square_survey": q_chi_square_survey,
    "correlation_lineitem": q_correlation_lineitem,
    "box_stats_lineitem": q_box_stats_lineitem,
    "histogram_lineitem": q_histogram_lineitem,
    "histogram_info_lineitem": q_histogram_info_lineitem,
    "select_numeric_lineitem": q_select_numeric_lineitem,
    "one_hot_survey": q_one_hot_survey,
    "standardize_survey": q_standardize_survey,
    "train_test_split_orders": q_train_test_split_orders,
    "train_test_split_exact": q_train_test_split_exact,
    "split_counts_orders": q_split_counts_orders,
    "stratified_folds_survey": q_stratified_folds_survey,
    "stratified_folds_dirty": q_stratified_folds_dirty,
    "box_stats_dirty": q_box_stats_dirty,
    "confusion_matrix_docs": q_confusion_matrix_docs,
    "classification_report_docs": q_classification_report_docs,
    "accuracy_docs": q_accuracy_docs,
    "roc_curve_docs": q_roc_curve_docs,
    "roc_auc_docs": q_roc_auc_docs,
    "top_k_users": q_top_k_users,
    "best_row_part": q_best_row_part,
    "sort_results_supplier": q_sort_results_supplier,
    "append_rows_parties": q_append_rows_parties,
    "relabel_survey": q_relabel_survey,
    "filter_rows_orders": q_filter_rows_orders,
    "before_after_area": q_before_after_area,
    "describe_survey": q_describe_survey,
    "box_stats_survey": q_box_stats_survey,
    "histogram_auto_lineitem": q_histogram_auto_lineitem,
    "value_counts_raw_area": q_value_counts_raw_area,
}
