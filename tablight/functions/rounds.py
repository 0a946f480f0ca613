"""Tables of an iterative job, written to the shared checkpoint folder.

``checkpoint()`` cuts lineage but keeps the plan's size estimate, and every
join multiplies the estimates of its sides: after a few rounds of an iteration
the planner works on numbers of millions of digits. A Parquet table read back
has the size of its files, so plans stay small and small sides can be
broadcast by their real size. The folder is the one the cluster names in
``spark.checkpoint.dir``, so a lost executor re-reads the last round.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from tablight.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        for folder in {os.path.dirname(f) for f in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def size_estimate(df: DataFrame) -> int:
    """The planner's estimate of the bytes of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
