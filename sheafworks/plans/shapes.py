"""The dataset shapes the operators work on, derived from the plain tables.

Each function gives one DataFrame over a whole table: markdown documents with file paths,
captions and images, tagged sources, two versions of a table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.readers import read_parquet, spread

PROMPT_NAME = "image-caption"

# Twelve classes of which 10 and 11 never occur.
CLASS_NAMES = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
)

_MARKDOWN = r"""
array_join(transform(split(text, '\n'), (l, i) ->
  case when i % 12 = 0  then concat('# ',   substr(l, 1, 40), ' <a id=x>', '\n', l)
       when i % 12 = 3  then concat('## ',  substr(l, 1, 40), '\n', l)
       when i % 12 = 5  then concat('### ', substr(l, 1, 40), '\n', l)
       when i % 12 in (7, 9) then '```'
       when i % 12 = 10 then '│ ─ │ ─ │'
       when i % 12 = 11 then concat('[docs](http://x.example/a) ', l)
       else l end), '\n')
"""


_ROUGH_MARKDOWN = r"""
array_join(transform(split(text, '\n'), (l, i) ->
  case (i + doc_id) % 16
       when 0  then concat('# ', substr(l, 1, 30))
       when 1  then concat('## ', substr(l, 1, 20))
       when 3  then '#'
       when 4  then '~~~ text'
       when 5  then '# in code'
       when 6  then '```'
       when 7  then '  ~~~'
       when 8  then ''
       when 9  then concat('### ', substr(l, 1, 10))
       when 10 then '````'
       when 11 then ''
       when 12 then '## in code'
       when 13 then '```'
       when 14 then '``` in line ```'
       when 15 then '#### deep'
       else l end), '\n')
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, over enough tasks for work on the text."""
    return spread(table(spark, sf, "documents"), "doc_id")


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "lineitem"), "l_orderkey")


def landed_at() -> Column:
    """One file per minute."""
    return F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id as int))")


def file_path() -> Column:
    return F.concat(F.lit("raw/"), T.readme_file_name(F.col("source"), landed_at()))


def as_markdown(docs: DataFrame) -> DataFrame:
    """(doc_id, path, text) with headers, fences, boxes and links in the text."""
    return docs.select("doc_id", file_path().alias("path"), F.expr(_MARKDOWN).alias("text"))


def markdown(spark: SparkSession, sf: str) -> DataFrame:
    return as_markdown(documents(spark, sf))


def rough_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text) with fences of both kinds inside each other, bare headers and empty parents."""
    return documents(spark, sf).select("doc_id", F.expr(_ROUGH_MARKDOWN).alias("text"))


def image_name(key: str = "doc_id") -> Column:
    return F.format_string("image_%06d.jpg", F.col(key))


def captions(spark: SparkSession, sf: str) -> DataFrame:
    """(position key, image, caption); the caption is the whole text."""
    docs = documents(spark, sf)
    return docs.select("doc_id", image_name().alias("image"), F.col("text").alias("caption"))


def images(spark: SparkSession, sf: str) -> DataFrame:
    """The images that exist, with sizes and bytes."""
    return table(spark, sf, "labels").select(
        image_name().alias("image"),
        (F.lit(256) + F.col("doc_id") % 512).alias("width"),
        (F.lit(256) + (F.col("doc_id") * 7) % 512).alias("height"),
        F.concat_ws("|", "doc_id", "quality", "toxic").cast("binary").alias("content"),
    )


def supplier_files(spark: SparkSession, sf: str, version: int = 1) -> DataFrame:
    """(name, text): a small file for each supplier; version 2 lacks some, has changed and new ones.

    Nine in ten are markdown files, some lie in a folder, and some hold the same text.
    """
    key = F.col("s_suppkey")
    kept = key % 10 != 0 if version == 2 else key % 10 != 1
    suffix = F.when(key % 10 == 3, ".txt").otherwise(".md")
    folder = F.when(key % 4 == 0, F.concat(F.lit("n"), F.col("s_nationkey"), F.lit("/"))).otherwise("")
    changed = F.when((key % 10 == 2) & F.lit(version == 2), " (changed)").otherwise("")
    text = F.when(key % 10 == 5, "the same\n").otherwise(F.concat("s_name", changed, F.lit("\né of nation "), "s_nationkey"))
    rows = table(spark, sf, "supplier").where(kept)
    return rows.select(F.concat(folder, F.lit("s"), key, suffix).alias("name"), text.alias("text"))


def png_files(spark: SparkSession, sf: str) -> DataFrame:
    """(image, content): a PNG file of its own size for each supplier but every fifth; each ninth is broken."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(kind: bytes, body: bytes) -> bytes:
            return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

        def png(key: int) -> bytes:
            if key % 9 == 0:
                return b"no image"
            width, height = 16 + key % 112, 16 + key * 7 % 112
            header = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))
            rows = b"".join(b"\0" + bytes([key % 256]) * width for _ in range(height))
            return b"\x89PNG\r\n\x1a\n" + header + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

        for batch in batches:
            keys = batch.column("key").to_pylist()
            names = [f"image_{k:06d}.png" for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([png(k) for k in keys])], ["image", "content"])

    keys = table(spark, sf, "supplier").where("s_suppkey % 5 != 0").select(F.col("s_suppkey").alias("key"))
    return keys.mapInArrow(draw, "image string, content binary")


def prompts(spark: SparkSession) -> DataFrame:
    """The prompt registry: three versions of one template."""
    rows = [
        (PROMPT_NAME, 1, "Describe the image."),
        (PROMPT_NAME, 2, "Describe the image in one sentence."),
        (PROMPT_NAME, 3, "Describe the image.\nName what stands out."),
    ]
    return spark.createDataFrame(rows, "prompt_name string, prompt_version int, template string")


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(CLASS_NAMES)), "class_id int, class_name string")


def order_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders: (logical_path, md5, price_cents)."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey") % 10
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    raised = cents + F.when(key == 2, 100).otherwise(0)

    def shaped(df: DataFrame, price: Column) -> DataFrame:
        content = F.md5(F.concat_ws("|", F.col("o_custkey"), F.col("o_orderstatus"), price))
        return df.select(
            F.col("o_orderkey").alias("logical_path"), content.alias("md5"), price.alias("price_cents")
        )

    return shaped(orders.where(key != 0), cents), shaped(orders.where(key != 1), raised)


def vector_checksum(vector: Column) -> Column:
    """The elements that are not zero as `index:millionths`, in order."""
    shown = F.transform(
        vector,
        lambda x, i: F.when(
            x != 0,
            F.concat_ws(":", i.cast("string"), F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string")),
        ),
    )
    return F.array_join(shown, ",")
