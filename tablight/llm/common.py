"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablight.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (what ``--py-files`` does)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    base = tempfile.mkdtemp(prefix="tablight-llm-")
    spark.sparkContext.addPyFile(
        shutil.make_archive(os.path.join(base, "tablight_llm"), "zip", root_dir=_ROOT, base_dir="tablight")
    )
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    A Parquet table there cuts the lineage and survives lost executors. It
    stays until the folder is cleaned or ``release`` is called: results are
    lazy and may still read it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables written by ``materialise`` that no later result reads."""
    for t in tables:
        spark = t.sparkSession
        for f in {os.path.dirname(p) for p in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(col: str) -> Column:
    """crc32 of an id as text (a null id counts as the empty string)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def chunks(batches: Iterator[pa.RecordBatch], text_col: str, max_bytes: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of about ``max_bytes`` of text, never inside a
    text; yields each run with its texts as UTF-8 bytes (null: empty). Memory
    per step is bounded by ``max_bytes`` or the one text that exceeds it."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start), [x or b"" for x in col.slice(start, i - start).to_pylist()]
                start, held = i, 0
            held += int(size) + 1
        if start < len(sizes):
            yield batch.slice(start), [x or b"" for x in col.slice(start).to_pylist()]
