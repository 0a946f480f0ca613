"""Golden pair: the raw survey CSV cleans to the shipped cleaned CSV, cell by cell."""

import math
import os

import pandas as pd

from conftest import FIXTURES
from tablight.operators.clean import clean
from tablight.plans.survey import SURVEY_COLUMNS, survey_spec
from tablight.sources.csv import read_table_csv


def _expected():
    return pd.read_csv(os.path.join(FIXTURES, "survey_clean.csv"))


def test_raw_scan_shape(spark):
    raw = read_table_csv(spark, os.path.join(FIXTURES, "survey_raw.csv"))
    assert raw.columns == list(SURVEY_COLUMNS)
    assert raw.count() == 122


def test_golden_pair(spark):
    raw = read_table_csv(spark, os.path.join(FIXTURES, "survey_raw.csv"))
    res = clean(raw, survey_spec())
    got = res.df.toPandas()
    exp = _expected()
    assert list(got.columns) == list(exp.columns)
    assert len(got) == len(exp) == 122
    for c in exp.columns:
        for i, (a, b) in enumerate(zip(got[c], exp[c])):
            if isinstance(b, float):
                assert math.isclose(float(a), b, rel_tol=0, abs_tol=1e-9), (c, i, a, b)
            else:
                assert a == b, (c, i, a, b)


def test_learned_statistics(spark):
    raw = read_table_csv(spark, os.path.join(FIXTURES, "survey_raw.csv"))
    fills = clean(raw, survey_spec()).fills
    assert fills["Education"] == "University"
    assert fills["Area"] == "Urban"
    assert fills["Home Owner"] == "Yes"
    assert fills["Employed"] == "Yes"
    assert fills["Colour"] == "Black"
    assert fills["Fraud"] == 0.0
    assert fills["Income"] == 19575.0
    assert fills["Balance"] == 2350.0
    assert math.isclose(fills["Age"], 31.66386554621849, rel_tol=1e-12)
