"""IDX tensor files (images and labels, gzipped or not) to rows."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import read_binary_files

# Third byte 8 = unsigned bytes, fourth byte = number of dimensions.
_GZIP_MAGIC = b"\x1f\x8b"
_ROWS_PER_BATCH = 1024


def _tensor(content: bytes, dimensions: int) -> np.ndarray:
    data = gzip.decompress(content) if content[:2] == _GZIP_MAGIC else content
    if data[2] != 8 or data[3] != dimensions:
        raise ValueError(f"not an IDX file of {dimensions}-dimensional bytes")
    shape = np.frombuffer(data, dtype=">u4", count=dimensions, offset=4)
    return np.frombuffer(data, dtype=np.uint8, offset=4 + 4 * dimensions).reshape(shape.astype(int))


def _decode(files: DataFrame, dimensions: int, schema: str, to_arrow) -> DataFrame:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = _tensor(row["content"], dimensions)
                for first in range(0, len(values), _ROWS_PER_BATCH):
                    part = values[first : first + _ROWS_PER_BATCH]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["path"]] * len(part)),
                            pa.array(np.arange(first, first + len(part), dtype=np.int64)),
                            to_arrow(part),
                        ],
                        names=["path", "idx", "value"],
                    )

    return files.select("path", "content").mapInArrow(decode, schema)


def _image_column(part: np.ndarray) -> pa.Array:
    n, rows, cols = part.shape
    flat = pa.array(part.reshape(-1).astype(np.int16))
    lines = pa.ListArray.from_arrays(pa.array(np.arange(0, n * rows * cols + 1, cols, dtype=np.int32)), flat)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * rows + 1, rows, dtype=np.int32)), lines)


def _label_column(part: np.ndarray) -> pa.Array:
    return pa.array(part.astype(np.int16))


def decode_images(files: DataFrame) -> DataFrame:
    """(path, content) to (path, idx, image): one row per image, read file by file."""
    return _decode(
        files, 3, "path string, idx bigint, value array<array<smallint>>", _image_column
    ).withColumnRenamed("value", "image")


def decode_labels(files: DataFrame) -> DataFrame:
    """(path, content) to (path, idx, label)."""
    return _decode(files, 1, "path string, idx bigint, value smallint", _label_column).withColumnRenamed(
        "value", "label"
    )


#: Label files are broadcast up to so many bytes, which the listing of the files tells.
BROADCAST_BYTES = 64 << 20


def _shard() -> Column:
    """The name of a file before `-images` or `-labels`."""
    name = F.element_at(F.split("path", "/"), -1)
    return F.regexp_replace(name, r"[-.](images|labels)[-.].*\z", "")


def pair_files(images: DataFrame, labels: DataFrame) -> DataFrame:
    """(shard, idx, image, label) from image files and label files (path, length, content).

    Files pair by the name before `-images` or `-labels`, as rows that hold a whole file, and one task
    decodes both: pixels are never shuffled. Label files are small, so they go to the image files as
    long as their bytes allow; beyond, file rows meet by shard. Items beyond the shorter file of a
    pair are left out.
    """
    small = labels.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] <= BROADCAST_BYTES
    left = images.select(_shard().alias("shard"), F.col("content").alias("images"))
    right = labels.select(_shard().alias("shard"), F.col("content").alias("labels"))
    pairs = left.join(F.broadcast(right) if small else right, "shard")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, pixels, marks = (batch.column(c)[row].as_py() for c in ("shard", "images", "labels"))
                image, label = _tensor(pixels, 3), _tensor(marks, 1)
                count = min(len(image), len(label))
                for first in range(0, count, _ROWS_PER_BATCH):
                    end = min(first + _ROWS_PER_BATCH, count)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * (end - first)),
                            pa.array(np.arange(first, end, dtype=np.int64)),
                            _image_column(image[first:end]),
                            _label_column(label[first:end]),
                        ],
                        names=["shard", "idx", "image", "label"],
                    )

    schema = "shard string, idx bigint, image array<array<smallint>>, label smallint"
    return pairs.select("shard", "images", "labels").mapInArrow(decode, schema)


def read_idx(spark: SparkSession, images_path: str, labels_path: str) -> DataFrame:
    return pair_files(read_binary_files(spark, images_path), read_binary_files(spark, labels_path))
