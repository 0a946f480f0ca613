"""Feature engineering: full one-hot dummies, population standard scaling,
and assembling feature vectors.

One-hot learns the category list with one distributed distinct aggregate over
all encoded columns (checked against ``max_categories``), then every dummy is
a ``CASE`` expression in a single projection. The scaler learns mean and
population deviation of every column in one aggregate; applying it is one
projection with the statistics as literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.functions.columns import quoted


@dataclass
class OneHotModel:
    """Learned categories: {column: sorted values}; numeric columns pass through."""

    passthrough: list[str]
    categories: dict[str, list]

    @property
    def feature_names(self) -> list[str]:
        return self.passthrough + [f"{c}_{v}" for c, vals in self.categories.items() for v in vals]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        dummies = [
            F.when(F.col(quoted(c)) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_{v}")
            for c, vals in self.categories.items()
            for v in vals
        ]
        return df.select(*[F.col(quoted(k)) for k in keep], *[F.col(quoted(c)) for c in self.passthrough], *dummies)


def fit_one_hot(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (), max_categories: int = 10_000) -> OneHotModel:
    """Numeric columns first (schema order), then every string column's values
    sorted, no category dropped (pandas ``get_dummies`` layout)."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    if cols is None:
        cols = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    passthrough = [f.name for f in fields if f.name not in cols and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    cats: dict[str, list] = {c: [] for c in cols}
    if cols:
        stacked = df.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("c"), F.col(quoted(c)).cast("string").alias("v")) for c in cols])
            ).alias("_s")
        ).select("_s.c", "_s.v")
        levels = stacked.where(F.col("v").isNotNull()).distinct().limit(max_categories + 1).collect()
        if len(levels) > max_categories:
            raise ValueError(f"more than {max_categories} categories to encode")
        for r in levels:
            cats[r["c"]].append(r["v"])
        for c in cats:
            cats[c].sort()
    return OneHotModel(passthrough, cats)


def one_hot(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> tuple[DataFrame, OneHotModel]:
    """Fit and apply; ``keep`` columns (keys, label) are carried in front."""
    model = fit_one_hot(df, cols, exclude=list(exclude) + list(keep))
    return model.transform(df, keep), model


@dataclass
class ScalerModel:
    """Per-column mean and population standard deviation."""

    mean: dict[str, float]
    std: dict[str, float]

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        cols = list(cols) if cols is not None else list(self.mean)
        out = []
        for c in df.columns:
            if c in cols:
                s = self.std.get(c) or 0.0
                m = self.mean.get(c) or 0.0
                x = F.col(quoted(c)).cast("double")
                # a constant column scales to 0, as scikit-learn does (scale 1)
                out.append(((x - F.lit(m)) / F.lit(s if s > 0 else 1.0)).alias(c))
            else:
                out.append(F.col(quoted(c)))
        return df.select(*out)


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> ScalerModel:
    """Mean and population deviation of every column in one aggregate."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(quoted(c)).cast("double")
        aggs += [F.avg(x), F.stddev_pop(x)]
    row = df.agg(*aggs).collect()[0] if cols else []
    return ScalerModel(
        {c: row[2 * i] for i, c in enumerate(cols)}, {c: row[2 * i + 1] for i, c in enumerate(cols)}
    )


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> tuple[DataFrame, ScalerModel]:
    """z-scores with the population deviation; statistics from ``fit_on``
    (the training rows) when given, else from ``df``."""
    model = fit_standard_scaler(fit_on if fit_on is not None else df, cols)
    return model.transform(df, cols), model


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns -> one ``VectorUDT`` column (Spark ML input)."""
    # plain inner names: the assembler reads a dot in a name as a field
    inner = [f"_x{i}" for i in range(len(cols))]
    src = df.select(*[F.col(quoted(k)) for k in keep], *[F.col(quoted(c)).cast("double").alias(x) for c, x in zip(cols, inner, strict=True)])
    va = VectorAssembler(inputCols=inner, outputCol=out, handleInvalid="error")
    return va.transform(src).select(*[F.col(quoted(k)) for k in keep], out)


def select_features(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    return df.drop(*drop)


def relabel(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """0/1 -> display text through a literal map."""
    from tablight.functions.columns import lookup

    return df.withColumn(out or col, lookup(F.col(quoted(col)), mapping))


def config_label(model: str, batch_size, learning_rate) -> str:
    """'<model> (batch=<b>, lr=<r>)', the row label of an experiment."""
    return f"{model} (batch={batch_size}, lr={learning_rate})"


def config_label_col(model_col: str, batch_col: str, rate_col: str):
    return F.format_string("%s (batch=%s, lr=%s)", F.col(model_col), F.col(batch_col), F.col(rate_col))
