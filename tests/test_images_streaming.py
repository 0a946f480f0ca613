"""Image folder scan / vectors / augmentation on tiny PNGs, and the cleaning
spec applied to a Structured Streaming source."""

import os
import struct
import tempfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from tablight.operators.clean import clean
from tablight.operators.images import augment_images, image_to_vector
from tablight.plans.survey import clean_survey, dirty_survey, snake_spec
from tablight.sources.images import image_counts, read_image_folder
from tablight.streaming.scoring import apply_spec, read_stream, run_to_memory


def _png(path, rgb):
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(t, d):
        c = struct.pack(">I", len(d)) + t + d
        return c + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
    data += chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(data)


def _folder():
    root = tempfile.mkdtemp(prefix="imgs-")
    rng = np.random.default_rng(0)
    for split, n in (("seg_train", 3), ("seg_test", 1)):
        for ci, cls in enumerate(("forest", "sea")):
            d = os.path.join(root, split, cls)
            os.makedirs(d)
            for i in range(n):
                img = np.zeros((6, 8, 3), dtype=np.uint8)
                img[..., ci] = 200
                img[0, 0] = rng.integers(0, 255, 3)
                _png(os.path.join(d, f"{i}.png"), img)
    return root


def test_read_image_folder_and_vectors(spark):
    root = _folder()
    df = read_image_folder(spark, root, class_names=["forest", "sea"])
    counts = {(r["split"], r["class_name"]): r["n_images"] for r in image_counts(df).collect()}
    assert counts == {("seg_train", "forest"): 3, ("seg_train", "sea"): 3, ("seg_test", "forest"): 1, ("seg_test", "sea"): 1}
    labels = {r["class_name"]: r["label"] for r in df.select("class_name", "label").distinct().collect()}
    assert labels == {"forest": 0, "sea": 1}
    vec = image_to_vector(df, 12, 16).where("class_name = 'sea'").select("features").first()["features"].toArray()
    px = vec.reshape(12, 16, 3)
    # sea images are pure green (channel 1) away from the noisy corner pixel, in RGB order after decoding
    assert abs(px[6, 8, 1] - 200 / 255) < 1e-6 and px[6, 8, 0] == 0 and px[6, 8, 2] == 0
    assert vec.min() >= 0 and vec.max() <= 1


def test_augment_is_seeded_and_sized(spark):
    root = _folder()
    df = read_image_folder(spark, root, class_names=["forest", "sea"], splits=["seg_train"])
    a = augment_images(df, copies=2, height=10, width=10, seed=3)
    rows = a.select("origin", "copy", "features").collect()
    assert len(rows) == 12
    b = {(r["origin"], r["copy"]): r["features"].toArray() for r in augment_images(df, 2, 10, 10, seed=3).collect()}
    for r in rows:
        assert np.array_equal(r["features"].toArray(), b[(r["origin"], r["copy"])])
        assert r["features"].size == 300


def test_clean_stream_matches_batch(spark, sf_dir):
    batch = clean_survey(spark, sf_dir)
    src = tempfile.mkdtemp(prefix="stream-src-")
    dirty_survey(spark, sf_dir).repartition(3).write.mode("overwrite").parquet(src + "/in")
    schema = spark.read.parquet(src + "/in").schema
    stream = read_stream(spark, src + "/in", schema, max_files_per_trigger=1)
    out = run_to_memory(apply_spec(stream, snake_spec(), batch.fills), "clean_stream_t", tempfile.mkdtemp(prefix="ck-"))
    a = out.orderBy("row_id").collect()
    b = batch.df.orderBy("row_id").collect()
    assert len(a) == len(b) and a == b


def test_score_stream_matches_batch(spark):
    import pandas as pd
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from tablight.streaming.scoring import score_stream

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": np.arange(300), "a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["label"] = (pdf.a + pdf.b > 0).astype(float)
    batch = spark.createDataFrame(pdf)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             LogisticRegression(maxIter=50)]).fit(batch)
    src = tempfile.mkdtemp(prefix="score-src-") + "/in"
    batch.repartition(3).write.parquet(src)
    stream = read_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    out = run_to_memory(score_stream(stream, model, keep=["id"]), "score_stream_t", tempfile.mkdtemp(prefix="ck-"))
    got = {r["id"]: r["prediction"] for r in out.collect()}
    exp = {r["id"]: r["prediction"] for r in model.transform(batch).select("id", "prediction").collect()}
    assert got == exp and len(got) == 300
