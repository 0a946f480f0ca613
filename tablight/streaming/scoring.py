"""Cleaning and scoring as Structured Streaming queries.

The reference processes one file at a time; the streaming form fits the
cleaning statistics (modes, medians, means) and a model on a batch of
history, then applies both to newly arriving files. Applying a fitted spec is
a stateless projection (maps + ``coalesce`` with literal fills), and applying
a fitted Spark ML model is a ``transform``, so the stream needs no state
store; each micro-batch scales with its own size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.operators.clean import Rule, apply_fills, rule_expr
from tablight.sources.csv import drop_unnamed


def apply_spec(df: DataFrame, spec: Mapping[str, Rule], fills: Mapping) -> DataFrame:
    """Maps and casts of ``spec`` then the learned fills (no aggregation)."""
    df = drop_unnamed(df)
    mapped = df.select(*[rule_expr(c, spec[c]) if c in spec else F.col(f"`{c}`") for c in df.columns])
    return apply_fills(mapped, fills)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def clean_stream(stream: DataFrame, spec: Mapping[str, Rule], fills: Mapping) -> DataFrame:
    """A streaming DataFrame cleaned with statistics learned on history."""
    return apply_spec(stream, spec, fills)


def score_stream(stream: DataFrame, model, keep=()) -> DataFrame:
    """Apply a fitted Spark ML model (e.g. a PipelineModel) to a stream."""
    out = model.transform(stream)
    return out.select(*[F.col(c) for c in keep], "prediction")


def run_to_memory(stream: DataFrame, name: str, checkpoint: str, output_mode: str = "append"):
    """Start the query into a memory table, drain what is available, stop.
    (For tests and small runs; production sinks are files or tables.)"""
    q = (
        stream.writeStream.format("memory").queryName(name).outputMode(output_mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return stream.sparkSession.table(name)
