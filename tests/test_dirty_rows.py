"""Null groups, NaN, empty inputs and quoted CSV fields lose and change nothing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablight.functions.components import connected_components
from tablight.operators.classifiers import _depth
from tablight.operators.profile import box_stats, describe_numeric
from tablight.operators.split import stratified_folds, train_val_split_by_group
from tablight.sources.csv import read_table_csv, write_table_csv


def _fifty(spark):
    return spark.range(50).select("id", F.when(F.col("id") % 5 != 0, F.col("id") % 3).alias("g"))


def test_null_label_keeps_its_rows(spark):
    out = stratified_folds(_fifty(spark), "id", "g", 5).collect()
    assert len(out) == 50
    assert {sum(r.g is None and r.fold == f for r in out) for f in range(5)} == {2}


def test_null_group_is_split_too(spark):
    out = train_val_split_by_group(_fifty(spark), "g", ["id"], 0.2)
    assert out.columns == ["id", "g", "split"]
    rows = out.collect()
    assert len(rows) == 50 and sum(r.g is None and r.split == "validation" for r in rows) == 2


def test_box_stats_null_group_and_empty(spark):
    df = _fifty(spark).withColumn("v", F.col("id").cast("double"))
    assert sorted(r.grp for r in box_stats(df, "v", by="g").collect()) == ["0", "1", "2"]
    assert box_stats(df.where("id < 0"), "v", by="g").collect() == []
    assert box_stats(df.where("id < 0"), "v").collect() == []


def test_describe_skips_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,), (None,)], "v double")
    r = describe_numeric(df).collect()[0]
    assert (r["mean"], r["max"], r["q75"]) == (2.0, 3.0, 2.5)


def test_csv_quotes_and_line_breaks(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="csvq-"), "t.csv")
    with open(p, "w") as f:
        f.write('a,b\n"x ""q"" y",1\n"two\nlines",2\n')
    rows = [tuple(r) for r in read_table_csv(spark, p, multi_line=True).collect()]
    assert rows == [('x "q" y', "1"), ("two\nlines", "2")]
    out = tempfile.mkdtemp(prefix="csvw-") + "/o"
    write_table_csv(spark.createDataFrame(rows, "a string, b string"), out, single_file=True)
    assert sorted(map(tuple, read_table_csv(spark, out, multi_line=True).collect())) == sorted(rows)


def test_deep_tree_raises():
    assert _depth(None) == 30 and _depth(7) == 7
    with pytest.raises(ValueError):
        _depth(31)


def test_star_component_is_salted(spark):
    n = 50_000
    edges = spark.range(1, n).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    out = connected_components(spark.range(n + 1).withColumnRenamed("id", "node"), edges)
    got = {r["comp"]: r["count"] for r in out.groupBy("comp").count().collect()}
    assert got == {0: n, n: 1}


def test_no_edges(spark):
    out = connected_components(spark.range(3).withColumnRenamed("id", "node"), spark.createDataFrame([], "a long, b long"))
    assert sorted(map(tuple, out.collect())) == [(0, 0), (1, 1), (2, 2)]


def test_box_stats_sorts_no_group_in_one_task(spark):
    """Rows of a large group stay where they are when they meet the fences."""
    from tablight.operators.profile import _with_fences

    rows = spark.range(100).selectExpr("id % 3 AS _k", "id AS v")
    fences = spark.createDataFrame([(k, 0.0, 1.0) for k in range(3)], "_k long, _lo double, _hi double")
    plan = _with_fences(rows, fences)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
