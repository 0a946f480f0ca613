"""Profiling: distinct values, value counts, class balance, numeric summaries,
column info, before/after alignment, grouped counts, contingency tables, box
statistics and equal-width histograms.

Every statistic is a distributed aggregate with map-side combine. Results are
small (one row per column, class, bin or category) and are returned as
DataFrames; where a result is assembled from a few driver-side scalars, the
scalars come from a single aggregate job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.functions.columns import fmt1, quoted, to_double
from tablight.functions.quantiles import column_quantiles, numeric_guard, quantile_table


def _c(name: str) -> Column:
    return F.col(quoted(name))


def distinct_values(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """Distinct values of a column (null included); sorted with null last."""
    out = df.select(_c(col).alias(col)).distinct()
    return out.orderBy(F.asc_nulls_last(col)) if sort else out


def value_counts(df: DataFrame, col: str, normalize: bool = False, null_as: str | None = None) -> DataFrame:
    """Rows per value: ``value, n`` plus ``share_pct`` (0-100) when normalize.

    ``null_as`` counts nulls under a text key (the 'nan' bar of a count plot);
    by default nulls are dropped as pandas ``value_counts`` does.
    """
    key = _c(col)
    if null_as is not None:
        key = F.coalesce(key.cast("string"), F.lit(null_as))
    base = df.select(key.alias(col))
    if null_as is None:
        base = base.where(F.col(quoted(col)).isNotNull())
    counts = base.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("n")).collect()[0][0] or 0
    return counts.withColumn("share_pct", F.try_divide(F.col("n") * 100.0, F.lit(float(total))))


def class_imbalance(df: DataFrame, label: str, positive=1, negative=0) -> DataFrame:
    """positives, negatives and positives / negatives (null when no negatives)."""
    return df.agg(
        F.count_if(_c(label) == F.lit(positive)).alias("positives"),
        F.count_if(_c(label) == F.lit(negative)).alias("negatives"),
    ).withColumn("ratio", F.try_divide(F.col("positives").cast("double"), F.col("negatives").cast("double")))


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("col_name", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("q25", T.DoubleType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("q75", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles (linear), max per column;
    NaN counts as missing everywhere.

    One aggregate for the moments, one exact-quantile pass for all columns.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        v = numeric_guard(_c(c))
        aggs += [F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)]
    row = df.agg(*aggs).collect()[0]
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for i, c in enumerate(cols):
        cnt, mean, std, mn, mx = row[5 * i : 5 * i + 5]
        qq = q.get(c, {})
        rows.append((c, cnt, mean, std, mn, qq.get(0.25), qq.get(0.5), qq.get(0.75), mx))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def table_info(df: DataFrame) -> DataFrame:
    """column, position, data type and non-null count for every column."""
    row = df.agg(*[F.count(_c(c)).alias(f"_{i}") for i, c in enumerate(df.columns)]).collect()[0]
    rows = [
        (f.name, i, f.dataType.simpleString(), row[i]) for i, f in enumerate(df.schema.fields)
    ]
    schema = "col_name string, position int, dtype string, non_null long"
    return df.sparkSession.createDataFrame(rows, schema)


def before_after_counts(
    before: DataFrame, after: DataFrame, before_col: str, after_col: str | None = None, numeric: bool = True
) -> DataFrame:
    """For every value seen in the raw column, its count before and after
    cleaning (0 when gone). Cleaned values never seen raw are dropped.

    Numeric columns are keyed by their '%.1f' text (null -> 'nan').
    """
    after_col = after_col or before_col
    if numeric:
        bkey = fmt1(to_double(_c(before_col)))
        akey = fmt1(_c(after_col))
    else:
        bkey = F.coalesce(_c(before_col).cast("string"), F.lit("nan"))
        akey = F.coalesce(_c(after_col).cast("string"), F.lit("nan"))
    b = before.select(bkey.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n_before"))
    a = after.select(akey.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n_after"))
    return b.join(a, on="value", how="left").select(
        "value", "n_before", F.coalesce(F.col("n_after"), F.lit(0)).alias("n_after")
    )


def grouped_counts(df: DataFrame, col: str, by: str) -> DataFrame:
    """Rows per (value, group)."""
    return df.groupBy(_c(col).alias(col), _c(by).alias(by)).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, long: bool = True, max_columns: int = 1000) -> DataFrame:
    """Dense contingency table of two columns (nulls dropped, as pandas).

    Wide form: one row per value of ``a``, one count column per value of ``b``
    (a pivot, so no join). Long form: the wide table unpivoted, zero cells kept.
    """
    base = df.where(_c(a).isNotNull() & _c(b).isNotNull())
    levels = [r[0] for r in base.select(_c(b)).distinct().orderBy(_c(b)).limit(max_columns + 1).collect()]
    if len(levels) > max_columns:
        raise ValueError(f"{b} has more than {max_columns} values")
    wide = base.groupBy(_c(a).alias(a)).pivot(b, levels).agg(F.count(F.lit(1)))
    if not long:
        return wide.fillna(0, subset=[c for c in wide.columns[1:] if "." not in c])
    names = [f"_l{i}" for i in range(len(levels))]
    wide = wide.toDF(a, *names).fillna(0, subset=names)
    pairs = ", ".join(f"{_sql_lit(v)}, {n}" for v, n in zip(levels, names))
    return wide.selectExpr(quoted(a), f"stack({len(levels)}, {pairs}) AS ({quoted(b)}, n)")


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    return repr(v)


BOX_SCHEMA = (
    "grp string, n long, q1 double, median double, q3 double, iqr double, "
    "whisker_lo double, whisker_hi double, n_outliers long"
)


def _with_fences(rows: DataFrame, fences: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(fences), "_k")


def box_stats(df: DataFrame, value: str, by: str | None = None, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values inside whis x IQR) and outlier
    counts per group. Quartiles are exact; the second pass is one aggregate
    over the rows joined with the broadcast table of fences (one row per group, as
    many as ``exact_quantiles`` allows), so no group is sorted in one task. Rows with
    a null group or a missing value are left out; no row left: an empty result."""
    by_cols = [by] if by else []
    if by:
        df = df.where(_c(by).isNotNull())
    v = numeric_guard(_c(value))
    df = df.where(v.isNotNull())
    qt = quantile_table(df, value, [0.25, 0.5, 0.75], by=by_cols)
    if not qt:
        return df.sparkSession.createDataFrame([], BOX_SCHEMA)
    if by:
        kind = df.schema[by].dataType.simpleString()
        edges = [(g[0], q[0.25] - whis * (q[0.75] - q[0.25]), q[0.75] + whis * (q[0.75] - q[0.25])) for g, q in qt.items()]
        fences = df.sparkSession.createDataFrame(edges, f"_k {kind}, _lo double, _hi double")
        lo_f, hi_f = F.col("_lo"), F.col("_hi")
        grouped = _with_fences(df.select(_c(by).alias("_k"), _c(value)), fences).groupBy("_k")
    else:
        (q,) = qt.values()
        lo_f = F.lit(q[0.25] - whis * (q[0.75] - q[0.25]))
        hi_f = F.lit(q[0.75] + whis * (q[0.75] - q[0.25]))
        grouped = df.groupBy(F.lit(None).cast("string").alias("_k"))
    agg = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        F.count_if((v < lo_f) | (v > hi_f)).alias("n_outliers"),
    ).collect()
    rows = []
    for r in agg:
        g = (r["_k"],) if by else ()
        q = qt[g]
        rows.append(
            (
                None if r["_k"] is None else str(r["_k"]), r["n"], q[0.25], q[0.5], q[0.75],
                q[0.75] - q[0.25], r["whisker_lo"], r["whisker_hi"], r["n_outliers"],
            )
        )
    return df.sparkSession.createDataFrame(rows, BOX_SCHEMA)


HIST_SCHEMA = "bin int, lo double, hi double, n long"


def histogram_bins_auto(n: int, mn: float, mx: float, iqr: float) -> int:
    """numpy's 'auto' rule: the narrower of Sturges and Freedman-Diaconis widths."""
    span = mx - mn
    if n == 0 or span <= 0:
        return 1
    sturges = span / (math.log2(n) + 1.0)
    fd = 2.0 * iqr * n ** (-1.0 / 3.0)
    width = min(sturges, fd) if fd > 0 else sturges
    return max(1, int(math.ceil(span / width)))


def histogram(df: DataFrame, col: str, bins: int | str = 30) -> tuple[DataFrame, dict]:
    """Equal-width histogram over [min, max]; the last bin is closed on the
    right. Returns (bins DataFrame with empty bins as 0, info) where info holds
    min, max, width and ``log_scale_ok`` (min > 0)."""
    v = _c(col).cast("double")
    data = df.select(v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    st = data.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v")).collect()[0]
    n, mn, mx = st[0], st[1], st[2]
    if bins == "auto":
        q = column_quantiles(data, ["_v"], [0.25, 0.75])["_v"] if n else {0.25: 0.0, 0.75: 0.0}
        bins = histogram_bins_auto(n, mn or 0.0, mx or 0.0, (q[0.75] - q[0.25]))
    bins = int(bins)
    spark = df.sparkSession
    info = {"n": n, "min": mn, "max": mx, "bins": bins, "log_scale_ok": bool(n and mn > 0)}
    if not n:
        return spark.createDataFrame([], HIST_SCHEMA), info
    width = (mx - mn) / bins if mx > mn else 1.0
    info["width"] = width
    b = F.least(F.floor((F.col("_v") - F.lit(mn)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = data.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # bin ids are a fixed-size frame of `bins` rows: broadcasting them is bounded
    ids = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = F.broadcast(ids).join(counts, on="bin", how="left").select(
        "bin",
        (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )
    return out, info


def log_scale_ok(df: DataFrame, col: str) -> bool:
    """True when every non-null value is > 0 (a log axis would show them all)."""
    mn = df.agg(F.min(_c(col))).collect()[0][0]
    return mn is not None and mn > 0


def shares(df: DataFrame, col: str) -> DataFrame:
    """Class share in percent, the distribution line of a summary report."""
    return value_counts(df, col, normalize=True)
