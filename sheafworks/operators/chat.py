"""Chat-format training rows with a recorded prompt, and statistics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .lookup import single_row

IMAGE_MARK = "<image>\n"


def select_prompt(prompts: DataFrame, name: str, version: int) -> DataFrame:
    """The one row of a registered prompt with the URI and text that go on record."""
    row = prompts.where((F.col("prompt_name") == name) & (F.col("prompt_version") == version))
    return row.select(
        "prompt_name",
        "prompt_version",
        F.concat(F.lit("prompts:/"), "prompt_name", F.lit("/"), F.col("prompt_version").cast("string")).alias(
            "prompt_uri"
        ),
        F.col("template").alias("prompt_text"),
    )


def chat_turns(instruction: Column, answer: Column) -> Column:
    """[{human, image mark + instruction}, {gpt, answer}]."""

    def turn(speaker: str, value: Column) -> Column:
        return F.struct(F.lit(speaker).alias("from"), value.alias("value"))

    return F.array(
        turn("human", F.concat(F.lit(IMAGE_MARK), instruction)),
        turn("gpt", answer),
    )


def chat_format(df: DataFrame, prompt: DataFrame, caption: str = "caption") -> DataFrame:
    """Adds `conversations` and the prompt's lineage; a missing prompt is an error."""
    used = single_row(prompt, "the prompt is not registered")
    return df.withColumn("conversations", chat_turns(used["prompt_text"], F.col(caption))).withColumns(
        {f: used[f] for f in ("prompt_name", "prompt_version", "prompt_uri")}
    )


def answer_of(conversations: Column) -> Column:
    return F.get(conversations, F.lit(1))["value"]


def split_image_name(split: Column, position: Column, topic: str) -> Column:
    """{split}_{topic}_000001.jpg"""
    return F.format_string(f"%s_{topic}_%06d.jpg", split, position)


def join_images(captions: DataFrame, images: DataFrame, key: str = "image") -> DataFrame:
    return captions.join(images, key, "inner")


def missing_images(captions: DataFrame, images: DataFrame, key: str = "image") -> DataFrame:
    """Captions whose image does not exist."""
    return captions.join(images.select(key), key, "left_anti")


def with_existing_image(annotations: DataFrame, images: DataFrame, key: str = "image") -> DataFrame:
    return annotations.join(images.select(key), key, "left_semi")


def caption_stats(df: DataFrame, conversations: str = "conversations", split: str = "split") -> DataFrame:
    """Words per answer and split: count, mean (2 decimals), min, max."""
    words = T.word_count(answer_of(F.col(conversations)))
    return (
        df.select(split, words.alias("words"))
        .groupBy(split)
        .agg(
            F.count(F.lit(1)).alias("num_samples"),
            F.round(F.avg("words"), 2).alias("caption_length_mean"),
            F.min("words").alias("caption_length_min"),
            F.max("words").alias("caption_length_max"),
        )
    )


def first_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group; tasks keep n per group before anything is shuffled."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def image_size_means(
    annotations: DataFrame,
    sizes: DataFrame,
    split: str = "split",
    order: str = "position",
    key: str = "image",
    n: int = 100,
) -> DataFrame:
    """Mean width and height of the first n annotations of each split whose image exists.

    A split without any image shows zeros.
    """
    first = first_per_group(annotations.select(split, order, key), split, order, n)
    joined = first.join(sizes.select(key, "width", "height"), key, "left")
    return joined.groupBy(split).agg(
        F.count("width").alias("num_images"),
        F.coalesce(F.round(F.avg("width"), 2), F.lit(0.0)).alias("image_width_mean"),
        F.coalesce(F.round(F.avg("height"), 2), F.lit(0.0)).alias("image_height_mean"),
    )


def split_summary(df: DataFrame, fraction: float, split: str = "split") -> DataFrame:
    """Rows per split and the ratio they were cut with, as one row."""
    return df.agg(
        F.count_if(F.col(split) == "train").alias("train_samples"),
        F.count_if(F.col(split) == "test").alias("test_samples"),
    ).withColumn("train_split", F.lit(float(fraction)))
