"""Composed workflows on the golden survey and group-wise validation splits."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import FIXTURES
from tablight.operators.clean import clean
from tablight.operators.split import train_val_split_by_group
from tablight.plans import workflows
from tablight.plans.survey import CATEGORICAL_TESTED, survey_spec
from tablight.sources.csv import read_table_csv


def _cleaned(spark):
    raw = read_table_csv(spark, os.path.join(FIXTURES, "survey_raw.csv"))
    df = clean(raw, survey_spec()).df
    return df.withColumn("row_id", F.monotonically_increasing_id()).checkpoint()


def test_profile_and_association_reports(spark):
    df = _cleaned(spark)
    prof = workflows.profile_report(df, "Fraud", ["Income", "Balance", "Age"])
    assert prof["describe"].count() == 3 and prof["imbalance"].collect()[0]["positives"] == 58
    for h, info in prof["histograms"].values():
        assert sum(r["n"] for r in h.collect()) == 122
    assoc = workflows.association_report(df, "Fraud", ["Income", "Balance", "Age"], list(CATEGORICAL_TESTED), "Education")
    assert assoc["chi_square"].count() == 5 and assoc["correlation"].count() == 16
    assert assoc["grouped"].agg(F.sum("n")).collect()[0][0] == 122


def test_prepare_supervised_scaler_uses_train_rows(spark):
    df = _cleaned(spark)
    p = workflows.prepare_supervised(df, "Fraud", "row_id")
    assert len(p.feature_names) == 25
    from pyspark.ml.functions import vector_to_array

    tr = p.train.select(vector_to_array("features")[0].alias("x")).agg(F.avg("x"), F.stddev_pop("x")).collect()[0]
    assert abs(tr[0]) < 1e-9 and abs(tr[1] - 1) < 1e-9
    assert p.train.count() + p.test.count() == 122


def test_train_val_split_by_group(spark):
    pdf = pd.DataFrame({"cls": np.repeat(["a", "b"], [10, 5]), "f": [f"{i:03d}" for i in range(15)]})
    out = train_val_split_by_group(spark.createDataFrame(pdf), "cls", ["f"], 0.2).toPandas()
    val = out[out.split == "validation"].sort_values("f")
    assert list(val.f) == ["000", "001", "010"]
