"""Exact quantiles and modes that never gather a column into one task.

Spark's exact ``percentile`` keeps a value -> count map per group and merges it
in a single task; for a global median over a high-cardinality column that map
is the whole column. ``exact_quantiles`` instead narrows a bracket around each
wanted order statistic with equal-width histograms (one distributed,
map-side-combined aggregate per round), and finishes with a window whose
partitions are bounded by ``bracket_limit`` rows.

Targets (groups x ranks) stay small and live on the driver; the number of
groups is checked against ``max_targets`` before anything is broadcast.
Interpolation is linear between the two neighbouring order statistics,
``lo + (hi - lo) * frac`` at position ``p * (n - 1)``, as numpy / pandas /
DuckDB's ``quantile_cont`` do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.functions.columns import quoted


class TooManyGroups(ValueError):
    pass


def _prepare(df: DataFrame, value: str | Column, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    v = F.col(quoted(value)) if isinstance(value, str) else value
    gcols = [f"_g{i}" for i in range(len(by))]
    data = df.select(
        *[F.col(quoted(b)).alias(g) for b, g in zip(by, gcols)], v.cast("double").alias("_v")
    ).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return data, gcols


def _assign(data: DataFrame, gcols: list[str], targets: dict, gschema: T.StructType | None) -> DataFrame:
    """Rows (_t, _v, _lo, _hi) for every target whose bracket holds the value."""
    spark = data.sparkSession
    if not gcols:
        structs = [
            F.when(
                F.col("_v").between(F.lit(t["lo"]), F.lit(t["hi"])),
                F.struct(F.lit(tid).alias("t"), F.lit(t["lo"]).alias("lo"), F.lit(t["hi"]).alias("hi")),
            )
            for tid, t in targets.items()
        ]
        return (
            data.select(F.col("_v"), F.explode(F.array(*structs)).alias("_s"))
            .where(F.col("_s").isNotNull())
            .select(F.col("_s.t").alias("_t"), "_v", F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
        )
    rows = [(tid, t["lo"], t["hi"], *t["g"]) for tid, t in targets.items()]
    schema = T.StructType(
        [
            T.StructField("_t", T.IntegerType()),
            T.StructField("_lo", T.DoubleType()),
            T.StructField("_hi", T.DoubleType()),
            *[T.StructField(f"_k{i}", f.dataType) for i, f in enumerate(gschema.fields)],
        ]
    )
    tdf = spark.createDataFrame(rows, schema)
    cond = None
    for i, g in enumerate(gcols):
        c = data[g].eqNullSafe(tdf[f"_k{i}"])
        cond = c if cond is None else cond & c
    # the target table is bounded by max_targets rows, so broadcasting it is safe
    joined = data.join(F.broadcast(tdf), cond, "inner")
    return joined.where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).select("_t", "_v", "_lo", "_hi")


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    bracket_limit: int = 50_000,
    buckets: int = 4096,
    max_targets: int = 20_000,
    max_rounds: int = 64,
    stats: Sequence[dict] | None = None,
) -> list[dict]:
    """Exact linear-interpolated quantiles of ``value`` per group.

    Returns one dict per (group, prob): ``{"group": tuple, "prob": p,
    "value": q, "n": count}``; nulls and NaNs are skipped as pandas does.
    ``stats`` may supply each group's ``_n``, ``_mn``, ``_mx`` (and the group
    columns ``_g0``...) from an aggregate the caller already runs.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    data, gcols = _prepare(df, value, by)
    gschema = T.StructType([data.schema[g] for g in gcols]) if gcols else None
    if stats is None:
        stats = data.groupBy(*gcols).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")
        ).collect()
    stats = [r for r in stats if r["_n"]]
    if len(stats) * len(probs) * 2 > max_targets:
        raise TooManyGroups(
            f"{len(stats)} groups x {len(probs)} quantiles exceed max_targets={max_targets}; "
            "use percentile_approx for high-cardinality grouping"
        )
    targets: dict[int, dict] = {}
    index: dict[tuple, int] = {}
    want: list[tuple] = []
    for r in stats:
        g = tuple(r[c] for c in gcols)
        n = r["_n"]
        for p in probs:
            pos = p * (n - 1)
            ks = (math.floor(pos), math.ceil(pos))
            for k in ks:
                if (g, k) not in index:
                    tid = len(targets)
                    index[(g, k)] = tid
                    targets[tid] = {"g": g, "k": k, "lo": r["_mn"], "hi": r["_mx"], "below": 0, "cnt": n}
            want.append((g, p, pos, ks, n))

    resolved: dict[int, float] = {}

    def shared(tids):
        """Targets with the same (group, bracket) share one histogram / window."""
        groups: dict[tuple, list[int]] = {}
        for tid in tids:
            t = targets[tid]
            groups.setdefault((t["g"], t["lo"], t["hi"]), []).append(tid)
        brackets = {bid: {"g": key[0], "lo": key[1], "hi": key[2]} for bid, key in enumerate(groups)}
        members = {bid: groups[key] for bid, key in enumerate(groups)}
        return brackets, members

    for _ in range(max_rounds):
        for tid, t in targets.items():
            if tid not in resolved and t["lo"] == t["hi"]:
                resolved[tid] = t["lo"]
        active = [tid for tid, t in targets.items() if tid not in resolved and t["cnt"] > bracket_limit]
        if not active:
            break
        brackets, members = shared(active)
        # the per-round histogram comes to the driver: keep it under ~400k rows
        nb = max(16, min(buckets, 400_000 // len(brackets)))
        rows = _assign(data, gcols, brackets, gschema)
        half_span = F.col("_hi") / 2 - F.col("_lo") / 2
        b = F.least(
            F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / half_span * nb).cast("int"), F.lit(nb - 1)
        )
        hist = (
            rows.withColumn("_b", b)
            .groupBy("_t", "_b")
            .agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("mn"), F.max("_v").alias("mx"))
            .collect()
        )
        per: dict[int, list] = {}
        for h in hist:
            per.setdefault(h["_t"], []).append(h)
        for bid, tids in members.items():
            hs = sorted(per.get(bid, []), key=lambda x: x["_b"])
            for tid in tids:
                t = targets[tid]
                acc = t["below"]
                for h in hs:
                    if acc + h["c"] > t["k"]:
                        t.update(lo=h["mn"], hi=h["mx"], below=acc, cnt=h["c"])
                        break
                    acc += h["c"]
    pending = [tid for tid in targets if tid not in resolved]
    if pending:
        brackets, members = shared(pending)
        rows = _assign(data, gcols, brackets, gschema)
        wanted = F.create_map(
            *[
                x
                for bid, tids in members.items()
                for x in (F.lit(bid), F.array(*[F.lit(targets[t]["k"] - targets[t]["below"]) for t in tids]))
            ]
        )
        w = Window.partitionBy("_t").orderBy("_v")
        picked = (
            rows.select("_t", "_v")
            .withColumn("_rn", F.row_number().over(w) - 1)
            .where(F.array_contains(F.element_at(wanted, F.col("_t")), F.col("_rn")))
            .select("_t", "_rn", "_v")
            .collect()
        )
        got = {(r["_t"], r["_rn"]): r["_v"] for r in picked}
        for bid, tids in members.items():
            for tid in tids:
                resolved[tid] = got[(bid, targets[tid]["k"] - targets[tid]["below"])]
    out = []
    for g, p, pos, (klo, khi), n in want:
        lo = resolved[index[(g, klo)]]
        hi = resolved[index[(g, khi)]]
        q = lo if klo == khi else lo + (hi - lo) * (pos - klo)
        out.append({"group": g, "prob": p, "value": q, "n": n})
    return out


def quantile_table(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), **kw
) -> dict:
    """{group tuple: {prob: value}} convenience view of ``exact_quantiles``."""
    res: dict = {}
    for r in exact_quantiles(df, value, probs, by, **kw):
        res.setdefault(r["group"], {})[r["prob"]] = r["value"]
    return res


def numeric_guard(c: Column) -> Column:
    """The value as double, NaN treated as missing (pandas skips both)."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def column_stats_aggs(cols: Sequence[str]) -> list[Column]:
    """count / min / max per column, to be run inside a caller's aggregate and
    handed to ``column_quantiles(stats=...)``."""
    out = []
    for c in cols:
        v = numeric_guard(F.col(quoted(c)))
        out += [F.count(v).alias(f"_n__{c}"), F.min(v).alias(f"_mn__{c}"), F.max(v).alias(f"_mx__{c}")]
    return out


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], stats_row=None, **kw) -> dict:
    """{column: {prob: value}} for several numeric columns in one pass per round.

    The columns are stacked into (name, value) rows so one set of distributed
    aggregates serves all of them. ``stats_row`` is a collected row holding the
    ``column_stats_aggs`` results, which saves the counting pass.
    """
    cols = list(cols)
    if not cols:
        return {}
    if stats_row is not None:
        kw["stats"] = [
            {"_g0": c, "_n": stats_row[f"_n__{c}"], "_mn": stats_row[f"_mn__{c}"], "_mx": stats_row[f"_mx__{c}"]}
            for c in cols
        ]
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("c"), F.col(quoted(c)).cast("double").alias("v")) for c in cols])
        ).alias("_s")
    ).select(F.col("_s.c").alias("_col"), F.col("_s.v").alias("_val"))
    res = {c: {} for c in cols}
    for r in exact_quantiles(stacked, "_val", probs, by=["_col"], **kw):
        res[r["group"][0]][r["prob"]] = r["value"]
    return res


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """{column: most frequent non-null value}, ties -> the lowest value.

    One distributed job for all columns: every row is stacked into
    (column, value) entries whose value sits in a field of its own type
    (integral, fractional or text), value counts are a partial/final
    aggregate, and the winner per column is ``min_by(value, (-count, value))``
    -- an ordinary aggregate, compared in the column's own type.
    """
    out: dict = {c: None for c in cols}
    if not cols:
        return out
    kinds = {}
    for c in cols:
        t = df.schema[c].dataType
        kinds[c] = "l" if isinstance(t, T.IntegralType) else "d" if isinstance(t, T.FractionalType) else "s"
    entries = []
    for c in cols:
        v = F.col(quoted(c))
        entries.append(
            F.struct(
                F.lit(c).alias("c"),
                (v.cast("long") if kinds[c] == "l" else F.lit(None).cast("long")).alias("l"),
                (v.cast("double") if kinds[c] == "d" else F.lit(None).cast("double")).alias("d"),
                (v.cast("string") if kinds[c] == "s" else F.lit(None).cast("string")).alias("s"),
                v.isNull().alias("null"),
            )
        )
    stacked = df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").where(~F.col("null"))
    counts = stacked.groupBy("c", "l", "d", "s").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(
        F.min_by(F.struct("l", "d", "s"), F.struct((-F.col("n")).alias("nn"), "l", "d", "s")).alias("m")
    )
    for r in best.collect():
        m = r["m"]
        out[r["c"]] = m[{"l": 0, "d": 1, "s": 2}[kinds[r["c"]]]]
    return out
