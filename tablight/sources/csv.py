"""CSV scan and sink with pandas-compatible missing-value handling.

The scan reads every column as text (no schema inference pass over the data),
maps the missing-value tokens to null in one projection, and leaves typing to
the cleaning spec. Parquet stays the default format for large tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablight.functions.columns import DEFAULT_NULL_TOKENS, null_if_token

_UNNAMED = re.compile(r"^_c\d+$")


def read_table_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
    drop_unnamed_columns: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV -> DataFrame of nullable strings (or the given schema).

    With no schema, the header is taken from the file and every column is text;
    a trailing comma in the header yields an empty-named column that Spark
    calls ``_cN`` and that is dropped (``drop_unnamed``). Quotes inside quoted
    fields are doubled. ``multi_line`` also reads line breaks inside quotes; a
    file is then one task, since it cannot be split.
    """
    reader = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("escape", '"')
        # keep blanks as they are; token mapping below decides what is missing
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("nullValue", None)
        .option("emptyValue", "")
    )
    if schema is not None:
        df = reader.schema(schema).csv(path)
    else:
        df = reader.option("inferSchema", False).csv(path)
    if drop_unnamed_columns:
        df = drop_unnamed(df)
    tokens = list(null_tokens)
    return df.select(
        *[
            null_if_token(F.col(f"`{f.name}`"), tokens).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns that exist only because the header ended with a comma."""
    extra = [c for c in df.columns if _UNNAMED.match(c) or c.startswith("Unnamed:")]
    return df.drop(*extra) if extra else df


def write_table_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """Header CSV sink. ``single_file`` is for small report tables only."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode(mode)
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        # the writer trims blanks by default; values like 'White ' must survive
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> str:
    """Parquet sink, the default for large tables."""
    w = df.write.mode(mode)
    cols = list(partition_by)
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path
