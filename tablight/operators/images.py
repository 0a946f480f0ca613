"""Image rows -> model-ready vectors, and seeded offline augmentation.

Both run vectorised per Arrow batch in ``mapInPandas``: decoding the image
struct, nearest-neighbour resizing, BGR -> RGB, scaling by 1/255. Augmentation
writes ``copies`` transformed rows per training image; each copy's affine map
(rotation, shift, shear, zoom, horizontal flip) is seeded from
``xxhash64(origin, copy)``, so re-running a lost task gives the same pixels.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _decode(img) -> np.ndarray:
    h, w, c = int(img["height"]), int(img["width"]), int(img["nChannels"])
    a = np.frombuffer(img["data"], dtype=np.uint8).reshape(h, w, c)
    if c >= 3:
        a = a[:, :, [2, 1, 0]]  # BGR -> RGB
    else:
        a = np.repeat(a[:, :, :1], 3, axis=2)
    return a


def _resize(a: np.ndarray, h: int, w: int) -> np.ndarray:
    ys = np.minimum((np.arange(h) + 0.5) * a.shape[0] / h, a.shape[0] - 1).astype(int)
    xs = np.minimum((np.arange(w) + 0.5) * a.shape[1] / w, a.shape[1] - 1).astype(int)
    return a[ys][:, xs]


def image_to_vector(df: DataFrame, height: int = 150, width: int = 150, image_col: str = "image", out: str = "features") -> DataFrame:
    """Add ``out`` (vector of height*width*3 floats in [0, 1], RGB, row-major)."""
    keep = [f for f in df.schema.fields if f.name != image_col]
    schema = T.StructType(keep + [T.StructField("_px", T.ArrayType(T.FloatType()))])
    names = [f.name for f in keep]

    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            px = [(_resize(_decode(img), height, width).astype(np.float32) / 255.0).ravel() for img in pdf[image_col]]
            o = pdf[names].copy()
            o["_px"] = px
            yield o

    return df.mapInPandas(fn, schema).withColumn(out, array_to_vector("_px")).drop("_px")


def _affine(rng: np.random.Generator, h: int, w: int, rotation=20.0, shift=0.2, shear=0.2, zoom=0.2, flip=True):
    """Inverse affine map (output pixel -> source pixel) about the image centre."""
    th = math.radians(rng.uniform(-rotation, rotation))
    tx, ty = rng.uniform(-shift, shift) * w, rng.uniform(-shift, shift) * h
    sh = rng.uniform(-shear, shear)
    zx, zy = rng.uniform(1 - zoom, 1 + zoom, size=2)
    fl = flip and rng.random() < 0.5
    R = np.array([[math.cos(th), -math.sin(th)], [math.sin(th), math.cos(th)]])
    S = np.array([[1.0, -math.sin(sh)], [0.0, math.cos(sh)]])
    Z = np.diag([zx, zy])
    M = R @ S @ Z
    F_ = np.diag([-1.0, 1.0]) if fl else np.eye(2)
    return M @ F_, np.array([tx, ty])


def augment_images(df: DataFrame, copies: int = 1, height: int = 150, width: int = 150, seed: int = 42,
                   image_col: str = "image", origin_col: str = "origin", out: str = "features") -> DataFrame:
    """``copies`` augmented vectors per input row (column ``copy`` = 1..copies);
    pixels outside the source take the nearest edge value."""
    base = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    base = base.withColumn("_seed", F.xxhash64(F.col(origin_col), F.col("_copy"), F.lit(seed)))
    keep = [f for f in base.schema.fields if f.name not in (image_col, "_seed")]
    schema = T.StructType(keep + [T.StructField("_px", T.ArrayType(T.FloatType()))])
    names = [f.name for f in keep]
    yy, xx = np.mgrid[0:height, 0:width]
    cy, cx = (height - 1) / 2.0, (width - 1) / 2.0
    coords = np.stack([xx.ravel() - cx, yy.ravel() - cy])

    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            px = []
            for img, s in zip(pdf[image_col], pdf["_seed"]):
                a = _resize(_decode(img), height, width)
                rng = np.random.default_rng(np.uint64(np.int64(s)))
                M, t = _affine(rng, height, width)
                src = M @ coords
                sx = np.clip(np.rint(src[0] + cx - t[0]), 0, width - 1).astype(int)
                sy = np.clip(np.rint(src[1] + cy - t[1]), 0, height - 1).astype(int)
                px.append((a[sy, sx].astype(np.float32) / 255.0).ravel())
            o = pdf[names].copy()
            o["_px"] = px
            yield o

    return (
        base.mapInPandas(fn, schema)
        .withColumn(out, array_to_vector("_px"))
        .drop("_px")
        .withColumnRenamed("_copy", "copy")
    )


def image_matrix(pdf: pd.DataFrame, col: str = "features", height: int = 150, width: int = 150) -> np.ndarray:
    """Small helper for tests: vectors of a collected frame -> N x H x W x 3."""
    return np.stack([np.asarray(v.toArray() if hasattr(v, "toArray") else v).reshape(height, width, 3) for v in pdf[col]])
