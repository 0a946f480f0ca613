"""Cleaning: value maps, normalising replacements, label mapping, numeric
parsing and imputation, driven by a declarative per-column spec.

``clean`` is one projection (all maps and casts), one round of distributed
statistics (modes, exact medians, means) and one final projection that fills
nulls with those statistics. The statistics are a handful of scalars, so they
enter the final projection as literals: no join, no broadcast of data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablight.functions.columns import col_of, lookup, quoted, to_double
from tablight.functions.quantiles import column_modes, column_quantiles, column_stats_aggs, numeric_guard
from tablight.sources.csv import drop_unnamed


@dataclass(frozen=True)
class Rule:
    """How one column is cleaned.

    kind     keep | map | replace | label | numeric
    mapping  text -> text lookup (map, replace, and the first step of label)
    lower    lower-case before the lookup (replace)
    allowed  values kept by ``replace``; anything else becomes ``default``
    default  fallback of ``replace``; for ``label`` the fill when every value is null
    then     second lookup of ``label`` (e.g. Yes/No -> 1.0/0.0)
    impute   None | mode | median | mean | const
    fill     the constant for ``impute="const"``
    """

    kind: str = "keep"
    mapping: Mapping[str, Any] | None = None
    lower: bool = False
    allowed: Sequence[str] | None = None
    default: Any = None
    then: Mapping[str, Any] | None = None
    impute: str | None = None
    fill: Any = None


@dataclass
class CleanResult:
    """The cleaned DataFrame plus the learned fill values (one per column)."""

    df: DataFrame
    fills: dict = field(default_factory=dict)


# --- single-column building blocks -------------------------------------------------


def map_values_expr(c: str | Column, mapping: Mapping) -> Column:
    """Exact, case-sensitive, untrimmed lookup; unmapped and null -> null."""
    return lookup(col_of(c), mapping)


def replace_values_expr(
    c: str | Column, mapping: Mapping, lower: bool = True, allowed: Sequence[str] | None = None, default: Any = None
) -> Column:
    """Lower-case (optional), replace when present, else keep; then anything
    outside ``allowed`` (and null) becomes ``default``."""
    c = col_of(c).cast("string")
    key = F.lower(c) if lower else c
    replaced = F.coalesce(lookup(key, mapping), key)
    if allowed is not None:
        replaced = F.when(replaced.isin(list(allowed)), replaced)
    return F.coalesce(replaced, F.lit(default)) if default is not None else replaced


def map_label_expr(c: str | Column, first: Mapping, then: Mapping) -> Column:
    """Text -> first map -> second map, as double (unmapped -> null)."""
    return lookup(lookup(col_of(c).cast("string"), first), then).cast("double")


def rule_expr(name: str, rule: Rule) -> Column:
    c = F.col(quoted(name))
    if rule.kind == "keep":
        out = c
    elif rule.kind == "map":
        out = map_values_expr(c, rule.mapping or {})
    elif rule.kind == "replace":
        out = replace_values_expr(c, rule.mapping or {}, rule.lower, rule.allowed, rule.default)
    elif rule.kind == "label":
        out = map_label_expr(c, rule.mapping or {}, rule.then or {})
    elif rule.kind == "numeric":
        out = to_double(c)
    else:
        raise ValueError(f"unknown rule kind {rule.kind!r} for {name}")
    return out.alias(name)


# --- DataFrame operators -----------------------------------------------------------


def map_values(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(col, map_values_expr(quoted(col), mapping))


def replace_values(df: DataFrame, col: str, mapping: Mapping, lower: bool = True, allowed=None, default=None) -> DataFrame:
    return df.withColumn(col, replace_values_expr(quoted(col), mapping, lower, allowed, default))


def map_label(df: DataFrame, col: str, first: Mapping, then: Mapping, all_null_default: float = 0.0) -> DataFrame:
    """Map a text label to 1.0/0.0 and fill nulls with the label's mode
    (``all_null_default`` when nothing mapped)."""
    mapped = df.withColumn(col, map_label_expr(quoted(col), first, then))
    mode = column_modes(mapped, [col])[col]
    fill = all_null_default if mode is None else mode
    return mapped.withColumn(col, F.coalesce(F.col(quoted(col)), F.lit(fill)))


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bad text -> null, like ``errors='coerce'``."""
    return df.select(*[to_double(quoted(c)).alias(c) if c in cols else F.col(quoted(c)) for c in df.columns])


def learn_fills(df: DataFrame, strategies: Mapping[str, tuple[str, Any]]) -> dict:
    """Statistics for imputation: {col: value}. strategies: col -> (how, const)."""
    modes = [c for c, (how, _) in strategies.items() if how == "mode"]
    medians = [c for c, (how, _) in strategies.items() if how == "median"]
    means = [c for c, (how, _) in strategies.items() if how == "mean"]
    fills: dict = {}
    if modes:
        fills.update(column_modes(df, modes))
    if medians or means:
        # one aggregate: the means, and count/min/max that start the exact medians
        row = df.agg(
            F.lit(0).alias("_one"),
            *[F.avg(numeric_guard(F.col(quoted(c)))).alias(f"_avg__{c}") for c in means],
            *column_stats_aggs(medians),
        ).collect()[0]
        fills.update({c: row[f"_avg__{c}"] for c in means})
        if medians:
            q = column_quantiles(df, medians, [0.5], stats_row=row)
            fills.update({c: q[c].get(0.5) for c in medians})
    for c, (how, const) in strategies.items():
        if how == "const":
            fills[c] = const
    return fills


def apply_fills(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    return df.select(
        *[
            F.coalesce(F.col(quoted(c)), F.lit(fills[c])).alias(c)
            if c in fills and fills[c] is not None
            else F.col(quoted(c))
            for c in df.columns
        ]
    )


def impute(df: DataFrame, strategies: Mapping[str, tuple[str, Any]]) -> CleanResult:
    """mode / median / mean / constant fill; statistics over the given column."""
    fills = learn_fills(df, strategies)
    return CleanResult(apply_fills(df, fills), fills)


def clean(df: DataFrame, spec: Mapping[str, Rule], keep_other: bool = True, persist: bool = False) -> CleanResult:
    """Apply a cleaning spec: drop header-artefact columns, map every column,
    learn fill statistics in one round of aggregates, fill.

    Columns not in the spec are kept unchanged (``keep_other``) in their
    original position; the output keeps the input column order.

    Statistics take a few column-pruned passes (modes; exact medians; means).
    Over a plain table scan that is cheapest; when ``df`` is expensive to
    recompute (a join, a wide derived view) ``persist=True`` keeps the mapped
    columns (MEMORY_AND_DISK) for the duration of learning.
    """
    from pyspark import StorageLevel

    df = drop_unnamed(df)
    cols = [c for c in df.columns if c in spec or keep_other]
    mapped = df.select(*[rule_expr(c, spec[c]) if c in spec else F.col(quoted(c)) for c in cols])
    strategies = {c: (r.impute, r.fill) for c, r in spec.items() if r.impute and c in cols}
    learn_on = mapped.select(*[quoted(c) for c in strategies]).persist(StorageLevel.MEMORY_AND_DISK) if persist else mapped
    fills = learn_fills(learn_on, strategies)
    if persist:
        learn_on.unpersist()
    for c, r in spec.items():
        if r.kind == "label" and c in fills and fills[c] is None:
            fills[c] = r.default if r.default is not None else 0.0
    return CleanResult(apply_fills(mapped, fills), fills)
