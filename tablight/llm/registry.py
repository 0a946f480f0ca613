"""Queries of this subpackage and of the corpus pipeline, for the entry point."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .queries import QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = dict(oracle.SQL)
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
