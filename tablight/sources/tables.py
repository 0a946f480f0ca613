"""Parquet table scans for the driver's table set and table shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet``; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view of the same name (for SQL users)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns), as a pandas shape."""
    return df.count(), len(df.columns)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split value."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
