"""Association between columns: chi-square tests of independence against a
label (with Yates' continuity correction when dof = 1) and Pearson
correlation matrices.

Chi-square: all tested columns are stacked into (feature, value) rows and
counted per label in one distributed aggregate, pivoted on the (few) label
values so zero cells exist. Everything after that works on the small count
table. Correlation: one aggregate with the covariances and deviations of all
pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablight.functions.columns import quoted
from tablight.functions.stats import chi2_sf


def contingency_counts(df: DataFrame, cols: Sequence[str], label: str, max_labels: int = 1000) -> tuple[DataFrame, list]:
    """(feature, value, one count column per label value) for every column."""
    stacked = df.select(
        F.col(quoted(label)).alias("_y"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("f"), F.col(quoted(c)).cast("string").alias("v")) for c in cols])
        ).alias("_s"),
    ).select(F.col("_s.f").alias("feature"), F.col("_s.v").alias("value"), "_y")
    stacked = stacked.where(F.col("value").isNotNull() & F.col("_y").isNotNull())
    levels = [r[0] for r in df.select(quoted(label)).where(F.col(quoted(label)).isNotNull()).distinct().limit(max_labels + 1).collect()]
    if len(levels) > max_labels:
        raise ValueError("too many label values for a contingency table")
    levels = sorted(levels)
    wide = stacked.groupBy("feature", "value").pivot("_y", levels).agg(F.count(F.lit(1)))
    # pivot names are the label values (e.g. '1.0'); rename to plain identifiers
    names = [f"y{i}" for i in range(len(wide.columns) - 2)]
    wide = wide.toDF("feature", "value", *names).fillna(0, subset=names)
    return wide, names


def chi_square(df: DataFrame, cols: Sequence[str], label: str, correction: bool = True) -> DataFrame:
    """feature, chi2, dof, p_value for each column against the label."""
    wide, names = contingency_counts(df, cols, label)
    obs = [F.col(quoted(n)).cast("double") for n in names]
    row_total = sum(obs[1:], obs[0])
    t = wide.select("feature", "value", *[o.alias(f"o{i}") for i, o in enumerate(obs)], row_total.alias("rt"))
    col_tot = t.groupBy("feature").agg(
        *[F.sum(f"o{i}").alias(f"ct{i}") for i in range(len(names))],
        F.sum("rt").alias("n"),
        F.count(F.lit(1)).alias("r"),
    )
    j = t.join(col_tot, on="feature")
    # labels actually present for this feature
    c_present = sum([F.when(F.col(f"ct{i}") > 0, 1).otherwise(0) for i in range(len(names))], F.lit(0))
    dof = ((F.col("r") - 1) * (c_present - 1)).cast("int")
    terms = []
    for i in range(len(names)):
        e = F.col("rt") * F.col(f"ct{i}") / F.col("n")
        d = F.abs(F.col(f"o{i}") - e)
        if correction:
            d = F.when(dof == 1, d - F.least(F.lit(0.5), d)).otherwise(d)
        terms.append(F.when(F.col(f"ct{i}") > 0, F.try_divide(d * d, e)).otherwise(F.lit(0.0)))
    cell = sum(terms[1:], terms[0])
    res = j.select("feature", dof.alias("dof"), cell.alias("cell")).groupBy("feature").agg(
        F.sum("cell").alias("chi2"), F.first("dof").alias("dof")
    )
    rows = res.collect()
    order = {c: i for i, c in enumerate(cols)}
    out = sorted(
        [(r["feature"], r["chi2"], r["dof"], chi2_sf(r["chi2"], r["dof"])) for r in rows],
        key=lambda x: order.get(x[0], 0),
    )
    return df.sparkSession.createDataFrame(out, "feature string, chi2 double, dof int, p_value double")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair (a, b), diagonal included, long form.

    r = covar_samp / (stddev_samp * stddev_samp); a constant column gives null
    (as pandas gives NaN) instead of a divide-by-zero error.
    """
    cols = list(cols)
    aggs = []
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    for a, b in pairs:
        x, y = F.col(quoted(a)).cast("double"), F.col(quoted(b)).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        aggs += [F.covar_samp(xs, ys), F.stddev_samp(xs), F.stddev_samp(ys)]
    row = df.agg(*aggs).collect()[0]
    vals = {}
    for k, (a, b) in enumerate(pairs):
        cov, sa, sb = row[3 * k : 3 * k + 3]
        r = None
        if cov is not None and sa and sb:
            r = cov / (sa * sb)
        vals[(a, b)] = vals[(b, a)] = r
    out = [(a, b, vals[(a, b)]) for a in cols for b in cols]
    return df.sparkSession.createDataFrame(out, "a string, b string, r double")
