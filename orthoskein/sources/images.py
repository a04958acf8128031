"""Images as rows: decoded by Spark's image source, in the order of a list of paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "image_id long, rows int, cols int, rgb binary"


def _rgb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Red first, three channels; grey images get three equal ones."""
    for batch in batches:
        for i in range(batch.num_rows):
            key, h, w, n, data = (batch.column(c)[i].as_py() for c in ("image_id", "height", "width", "channels", "data"))
            pixels = np.frombuffer(data, np.uint8).reshape(h, w, n)
            pixels = np.repeat(pixels, 3, axis=2) if n == 1 else pixels[:, :, 2::-1]
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([h], pa.int32()), pa.array([w], pa.int32()), pa.array([np.ascontiguousarray(pixels).tobytes()], pa.binary())], names=["image_id", "rows", "cols", "rgb"])


def load_images(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(image_id, rows, cols, rgb) of the files; image_id is the place in ``paths``. Files that do not decode raise."""
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = [(i, path(p).toUri().getPath()) for i, p in enumerate(paths)]
    order = spark.createDataFrame(named, "image_id long, file string")
    read = spark.read.format("image").load(paths)
    # Origins are addresses with a scheme; their path is what the list names.
    found = read.select("image.*").withColumn("file", F.expr("url_decode(regexp_replace(origin, '^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?', ''))"))
    checked = found.join(order, "file").withColumn("height", F.when(F.col("height") > 0, F.col("height")).otherwise(F.raise_error(F.concat(F.lit("not an image: "), "origin")).cast("int")))
    return checked.select("image_id", "height", "width", F.col("nChannels").alias("channels"), "data").mapInArrow(_rgb, SCHEMA)


def load_image(spark: SparkSession, path: str) -> DataFrame:
    """The row of one file, with image_id 0."""
    return load_images(spark, [path])
