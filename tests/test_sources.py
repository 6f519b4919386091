import gzip
import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafworks.sources import idx, readers, writers


def test_csv_keeps_quotes_breaks_and_separators(spark, tmp_path):
    rows = [(1, 'he said "hi"; ok'), (2, "two\nlines"), (3, "a,b"), (4, " spaced "), (5, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    for sep in (";", ","):
        path = str(tmp_path / f"csv{ord(sep)}")
        writers.write_csv(df, path, sep=sep)
        back = readers.read_csv(spark, path, df.schema, sep=sep, multi_line=True)
        assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_plain_csv_is_split_among_tasks(spark, tmp_path):
    writers.write_csv(spark.range(200_000).coalesce(1), str(tmp_path / "c"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        df = readers.read_csv(spark, str(tmp_path / "c"), "id bigint")
        assert df.rdd.getNumPartitions() > 3 and df.agg(F.sum("id")).first()[0] == 199_999 * 100_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_array_and_splits(spark, tmp_path):
    path = tmp_path / "captions.json"
    path.write_text(json.dumps([{"image": "a.jpg", "caption": "x"}, {"image": "b.jpg", "caption": "y\nz"}], indent=2))
    got = readers.read_json_array(spark, str(path), readers.CAPTION_SCHEMA).collect()
    assert [tuple(r) for r in got] == [("a.jpg", "x"), ("b.jpg", "y\nz")]
    writers.write_json_splits(spark.createDataFrame([("train", "a"), ("test", "b")], "split string, image string"), str(tmp_path / "out"))
    train = readers.read_json_lines(spark, str(tmp_path / "out" / "split=train"), "image string").collect()
    assert [r["image"] for r in train] == ["a"]


def test_broken_json_is_counted_not_fatal(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"id": 1}\n{"id": 2\n{"id": 3}\n')
    df = readers.read_json_tolerant(spark, str(path), "id int")
    got = df.select("id", readers.rejects(df).alias("bad")).collect()
    assert sorted((r["id"] or 0, r["bad"]) for r in got if not r["bad"]) == [(1, False), (3, False)]
    assert sum(r["bad"] for r in got) == 1


def test_text_files_are_whole_and_filtered(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "one_README_20250101_000000.md").write_text("a\n\nb\n")
    (tmp_path / "deep" / "two.md").write_text("c")
    (tmp_path / "skip.txt").write_text("d")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in readers.read_text_files(spark, str(tmp_path)).collect()}
    assert got == {"one_README_20250101_000000.md": "a\n\nb\n", "two.md": "c"}
    with pytest.raises(Exception):
        readers.read_text_files(spark, str(tmp_path / "nowhere")).collect()


def test_idx_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, size=(1500, 4, 3), dtype=np.uint8)
    labels = rng.integers(0, 10, size=1500, dtype=np.uint8)
    image_bytes = struct.pack(">IIII", 0x803, 1500, 4, 3) + pixels.tobytes()
    label_bytes = struct.pack(">II", 0x801, 1500) + labels.tobytes()
    (tmp_path / "train-images-idx3-ubyte.gz").write_bytes(gzip.compress(image_bytes))
    (tmp_path / "train-labels-idx1-ubyte.gz").write_bytes(gzip.compress(label_bytes))
    df = idx.read_idx(spark, str(tmp_path / "train-images*"), str(tmp_path / "train-labels*"))
    got = {r["idx"]: r for r in df.collect()}
    assert len(got) == 1500 and got[0]["shard"] == "train"
    for i in (0, 1023, 1024, 1499):
        assert got[i]["image"] == pixels[i].tolist() and got[i]["label"] == labels[i]
    with pytest.raises(Exception, match="IDX"):
        idx.decode_labels(readers.read_binary_files(spark, str(tmp_path), "*images*")).collect()


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))
    body = chunk(b"IDAT", zlib.compress(b"".join(b"\0" + b"\x80" * width for _ in range(height))))
    return b"\x89PNG\r\n\x1a\n" + header + body + chunk(b"IEND", b"")


def test_image_sizes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(7, 5))
    (tmp_path / "b.png").write_bytes(png(3, 9))
    (tmp_path / "broken.png").write_bytes(b"no image")
    got = {r["image"]: (r["width"], r["height"]) for r in readers.read_image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (7, 5), "b.png": (3, 9)}


def test_entities_and_metadata_sinks(spark, tmp_path):
    df = spark.createDataFrame([("r1", "r1_README_x.md", "t")], "repo string, file_name string, text string")
    writers.write_entities(df, str(tmp_path / "e"))
    assert readers.read_parquet(spark, str(tmp_path / "e")).where("repo = 'r1'").count() == 1
    writers.write_metadata(spark.createDataFrame([('{"a": 1}',)], "metadata string"), str(tmp_path / "m"))
    files = list((tmp_path / "m").glob("part-*"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == {"a": 1}


def test_spread_only_helps_narrow_inputs(spark):
    assert readers.spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 16)
    assert readers.spread(wide, "id") is wide


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from conftest import plan_of

    spark.range(10).select("id", F.lit("train").alias("split"), F.lit("x").alias("text")).write.partitionBy("split").parquet(str(tmp_path / "p"))
    plan = plan_of(readers.read_parquet(spark, str(tmp_path / "p")).where("split = 'train' and id > 3").select("id"))
    assert "PartitionFilters: [isnotnull(split" in plan and "GreaterThan(id,3)" in plan
    assert "text" not in plan.split("ReadSchema")[1]


def test_files_that_gave_no_row_are_listed(spark, tmp_path):
    from sheafworks.sources import readers

    (tmp_path / "sub").mkdir()
    (tmp_path / "a.png").write_bytes(b"no image")
    (tmp_path / "sub" / "b.png").write_bytes(b"none")
    (tmp_path / "c.txt").write_text("other")
    sizes = readers.read_image_sizes(spark, str(tmp_path), "*.png")
    lost = readers.unread_files(spark, str(tmp_path), sizes, "*.png").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in lost) == ["a.png", "b.png"]
    texts = readers.read_text_files(spark, str(tmp_path), ".txt", tolerant=True)
    assert readers.unread_files(spark, str(tmp_path), texts, "*.txt").count() == 0
