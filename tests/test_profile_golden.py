"""Profiling and association on the golden cleaned survey (FIXTURES.md §2)."""

import math
import os

import pytest

from conftest import FIXTURES
from tablight.operators.association import chi_square, correlation_matrix
from tablight.operators.clean import clean
from tablight.operators.features import fit_one_hot
from tablight.operators.profile import box_stats, class_imbalance, describe_numeric, histogram, value_counts
from tablight.plans.survey import CATEGORICAL_TESTED, survey_spec
from tablight.sources.csv import read_table_csv


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = read_table_csv(spark, os.path.join(FIXTURES, "survey_raw.csv"))
    return clean(raw, survey_spec()).df.cache()


def close(a, b, tol=1e-5):
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def test_describe(cleaned):
    d = {r["col_name"]: r for r in describe_numeric(cleaned, ["Income", "Balance", "Age"]).collect()}
    assert d["Income"]["count"] == 122
    assert close(d["Income"]["mean"], 32942.868852) and close(d["Income"]["std"], 32513.921722)
    assert (d["Income"]["min"], d["Income"]["q25"], d["Income"]["median"], d["Income"]["q75"], d["Income"]["max"]) == (
        0, 6381.25, 19575, 51762.5, 156000)
    assert (d["Balance"]["q25"], d["Balance"]["median"], d["Balance"]["q75"]) == (345, 2350, 12311.25)
    assert (d["Age"]["min"], d["Age"]["q25"], d["Age"]["median"], d["Age"]["q75"], d["Age"]["max"]) == (17, 24, 27.5, 35.75, 64)


def test_class_share_and_imbalance(cleaned):
    vc = {r["Fraud"]: r for r in value_counts(cleaned, "Fraud", normalize=True).collect()}
    assert vc[1.0]["n"] == 58 and close(vc[1.0]["share_pct"], 47.540984)
    r = class_imbalance(cleaned, "Fraud", 1.0, 0.0).collect()[0]
    assert (r["positives"], r["negatives"]) == (58, 64) and close(r["ratio"], 0.90625)


def test_quartiles_by_label(cleaned):
    b = {r["grp"]: r for r in box_stats(cleaned, "Income", by="Fraud").collect()}
    assert (b["0.0"]["q1"], b["0.0"]["median"], b["0.0"]["q3"]) == (38675, 48990, 65277.25)
    assert (b["1.0"]["q1"], b["1.0"]["median"], b["1.0"]["q3"]) == (4653.25, 7037.5, 12287.5)
    a = {r["grp"]: r for r in box_stats(cleaned, "Age", by="Fraud").collect()}
    assert (a["0.0"]["q1"], a["0.0"]["median"], a["0.0"]["q3"]) == (32, 34, 45)
    assert (a["1.0"]["q1"], a["1.0"]["median"], a["1.0"]["q3"]) == (22, 24.5, 26)
    for r in b.values():
        assert r["whisker_lo"] >= r["q1"] - 1.5 * r["iqr"] and r["whisker_hi"] <= r["q3"] + 1.5 * r["iqr"]


def test_correlations(cleaned):
    c = {(r["a"], r["b"]): r["r"] for r in correlation_matrix(cleaned, ["Income", "Balance", "Age", "Fraud"]).collect()}
    assert close(c[("Income", "Balance")], 0.506265) and close(c[("Income", "Fraud")], -0.709679)
    assert close(c[("Balance", "Age")], 0.235228) and close(c[("Age", "Fraud")], -0.637575)
    assert close(c[("Age", "Age")], 1.0)


def test_chi_square_yates(cleaned):
    res = {r["feature"]: r for r in chi_square(cleaned, list(CATEGORICAL_TESTED), "Fraud").collect()}
    assert close(res["Education"]["chi2"], 76.319859) and res["Education"]["dof"] == 2
    assert close(res["Gender"]["chi2"], 0.456004) and close(res["Gender"]["p_value"], 0.796123)
    assert close(res["Area"]["chi2"], 99.172120) and res["Area"]["dof"] == 1
    assert close(res["Home Owner"]["chi2"], 82.119772) and close(res["Employed"]["chi2"], 72.640801)
    assert math.isclose(res["Area"]["p_value"], 2.315e-23, rel_tol=1e-3)
    assert math.isclose(res["Education"]["p_value"], 2.675e-17, rel_tol=1e-3)
    unc = {r["feature"]: r for r in chi_square(cleaned, ["Area"], "Fraud", correction=False).collect()}
    assert close(unc["Area"]["chi2"], 102.817742)


def test_one_hot_width(cleaned):
    enc = fit_one_hot(cleaned, exclude=["Fraud"])
    assert len(enc.feature_names) == 25
    assert enc.feature_names[:3] == ["Income", "Balance", "Age"]
    assert "Colour_White " in enc.feature_names


def test_histogram_fixed_and_auto(cleaned):
    h, info = histogram(cleaned, "Balance", 30)
    rows = h.collect()
    assert len(rows) == 30 and sum(r["n"] for r in rows) == 122
    assert info["log_scale_ok"] is False  # a zero balance
    h2, info2 = histogram(cleaned, "Age", "auto")
    assert sum(r["n"] for r in h2.collect()) == 122 and info2["bins"] >= 1
