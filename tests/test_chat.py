import json

import pytest
from pyspark.sql import functions as F

from sheafworks.operators import chat
from sheafworks.plans import datasets, shapes


@pytest.fixture(scope="module")
def data(spark):
    captions = spark.createDataFrame(
        [(i, f"image_{i:06d}.jpg", "word " * (i + 1)) for i in range(10)], "pos int, image string, caption string"
    )
    images = spark.createDataFrame(
        [(f"image_{i:06d}.jpg", 100 + i, 200 + i, bytearray([i])) for i in range(10) if i != 3],
        "image string, width int, height int, content binary",
    )
    prompt = chat.select_prompt(shapes.prompts(spark), shapes.PROMPT_NAME, 2)
    return captions, images, prompt


def test_caption_chat_flow(data):
    captions, images, prompt = data
    rows = datasets.caption_chat(captions, images, prompt, "pos", "scan")
    got = {r["position"]: r for r in rows.collect()}
    assert sorted(got) == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    assert got[0]["image"] == "train_scan_000000.jpg" and got[9]["image"] == "test_scan_000009.jpg"
    turns = got[4]["conversations"]
    assert [t["from"] for t in turns] == ["human", "gpt"]
    assert turns[0]["value"] == "<image>\nDescribe the image in one sentence."
    assert turns[1]["value"] == "word " * 5
    assert got[4]["prompt_uri"] == f"prompts:/{shapes.PROMPT_NAME}/2"
    missing = chat.missing_images(captions, images).collect()
    assert [r["image"] for r in missing] == ["image_000003.jpg"]


def test_caption_metadata(data):
    captions, images, prompt = data
    rows = datasets.caption_chat(captions, images, prompt, "pos", "scan")
    sizes = rows.select("image", "width", "height")
    doc = json.loads(datasets.caption_metadata(rows.drop("width", "height"), sizes, prompt, "n", "s").first()[0])
    assert doc["prompt"]["prompt_version"] == 2
    assert doc["splits"]["train"]["num_samples"] == 7
    assert doc["metrics"]["test"]["caption_length_mean"] == 9.5
    assert doc["metrics"]["test"]["image_width_mean"] == 108.5
    stats = datasets.process_stats(rows, prompt, 0.8).first()
    assert (stats["train_samples"], stats["test_samples"], stats["train_split"]) == (7, 2, 0.8)
    assert stats["prompt"]["prompt_text"] == "Describe the image in one sentence."


def test_missing_prompt_is_an_error(spark, data):
    captions, _, _ = data
    none = chat.select_prompt(shapes.prompts(spark), "unknown", 1)
    with pytest.raises(Exception, match="not registered"):
        chat.chat_format(captions, none).collect()


def test_image_means_take_first_rows_then_look_for_images(spark):
    notes = spark.createDataFrame(
        [("a", i, f"i{i}") for i in range(6)] + [("b", 0, "none")], "split string, position int, image string"
    )
    sizes = spark.createDataFrame([(f"i{i}", i, 2 * i) for i in (1, 2, 5)], "image string, width int, height int")
    got = {r["split"]: tuple(r)[1:] for r in chat.image_size_means(notes, sizes, n=3).collect()}
    assert got == {"a": (2, 1.5, 3.0), "b": (0, 0.0, 0.0)}


def test_first_per_group_limits_before_the_shuffle(spark):
    from conftest import plan_of

    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    out = chat.first_per_group(df, "g", "id", 3)
    plan = plan_of(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2, 3, 4, 5]
