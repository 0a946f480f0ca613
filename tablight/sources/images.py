"""Folder-per-class image scan: ``<root>/<split>/<class>/<file>``.

Spark's ``image`` source decodes the files (no Python image library needed)
into ``struct<origin, height, width, nChannels, mode, data>`` with pixel bytes
in BGR order. Split and class come from the path; the integer label is the
class's position in the sorted class list (folder-name order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablight.functions.columns import lookup

# The class folders of the scene-image set.
SCENE_CLASSES = ("buildings", "forest", "glacier", "mountain", "sea", "street")


def read_image_folder(
    spark: SparkSession, root: str, class_names: Sequence[str] | None = None, splits: Sequence[str] | None = None
) -> DataFrame:
    """origin, split, class_name, label, image for every decodable file."""
    df = spark.read.format("image").option("dropInvalid", True).load(f"{root.rstrip('/')}/*/*/*")
    origin = F.col("image.origin")
    out = df.select(
        origin.alias("origin"),
        F.regexp_extract(origin, r"/([^/]+)/[^/]+/[^/]+$", 1).alias("split"),
        F.regexp_extract(origin, r"/([^/]+)/[^/]+$", 1).alias("class_name"),
        F.col("image"),
    )
    if splits:
        out = out.where(F.col("split").isin(list(splits)))
    names = sorted(class_names) if class_names else sorted(SCENE_CLASSES)
    return out.withColumn("label", lookup(F.col("class_name"), {n: i for i, n in enumerate(names)}).cast("int"))


def image_counts(df: DataFrame) -> DataFrame:
    """Images found per split and class."""
    return df.groupBy("split", "class_name").agg(F.count(F.lit(1)).alias("n_images"))
