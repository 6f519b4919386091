"""The sink of one file per row, image headers and tensor files."""

import os
import struct

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sheafworks.sources import files, idx, images


def tree(path):
    return {
        os.path.relpath(os.path.join(folder, name), path): open(os.path.join(folder, name), "rb").read()
        for folder, _, names in os.walk(path)
        for name in names
        if not name.endswith(".crc")
    }


def frame(spark, rows):
    return spark.createDataFrame(rows, "name string, content binary").repartition(4)


def write(df, path):
    files.write_files(df, str(path), F.col("name"), F.col("content"))


def test_rows_become_files(spark, tmp_path):
    rows = [(f"d{i % 3}/f{i}.bin", bytes([i % 256]) * i) for i in range(300)] + [("empty", None), ("é x", b"1")]
    write(frame(spark, rows), tmp_path / "out")
    assert tree(tmp_path / "out") == {name: content or b"" for name, content in rows}
    write(frame(spark, [("d0/f0.bin", b"new"), ("other", b"o")]), tmp_path / "out")
    found = tree(tmp_path / "out")
    assert found["d0/f0.bin"] == b"new" and found["other"] == b"o" and len(found) == 303
    write(frame(spark, []), tmp_path / "none")
    assert tree(tmp_path / "none") == {}


def test_a_uri_is_a_place_too(spark, tmp_path):
    write(frame(spark, [("a", b"1")]), f"file:{tmp_path}/u")
    write(frame(spark, [("b", b"2")]), f"file://{tmp_path}/u")
    assert tree(tmp_path / "u") == {"a": b"1", "b": b"2"}


@pytest.mark.parametrize("bad", [None, "", "../x", "a/../../x", "/x", "_staging-1/x", "a//b"])
def test_a_failed_task_leaves_no_file(spark, tmp_path, bad):
    rows = [(f"f{i}", b"x") for i in range(50)] + [(bad, b"y")]
    with pytest.raises(Exception, match="not a file name"):
        write(frame(spark, rows), tmp_path / "out")
    # A task that still ran may leave its staging folder, which readers pass over; nothing is in place.
    assert [name for name in tree(tmp_path / "out") if not name.startswith("_staging-")] == []
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).count() == 0


def test_what_is_moved_once_may_be_moved_again(spark, tmp_path):
    staging = tmp_path / "out" / "_staging-1"
    (staging / "000000-a" / "d").mkdir(parents=True)
    (staging / "000000-a" / "d" / "x").write_bytes(b"x")
    (staging / "000000-b" / "d").mkdir(parents=True)
    (staging / "000000-b" / "d" / "x").write_bytes(b"of a lost attempt")
    tasks = spark.createDataFrame([("000000-a",)], "folder string")
    for count in (1, 0):
        moved = tasks.mapInArrow(files._moved(str(tmp_path / "out"), str(staging)), "files long")
        assert moved.first()["files"] == count
        assert (tmp_path / "out" / "d" / "x").read_bytes() == b"x"


def test_copies_into_split_folders(spark, tmp_path):
    annotations = spark.createDataFrame([("train", "a"), ("train", "a"), ("test", "a"), ("test", "b"), ("test", "c")], "split string, image string")
    held = spark.createDataFrame([("a", b"A"), ("b", b"B"), ("d", b"D")], "image string, content binary")
    files.copy_files(annotations, held, str(tmp_path / "s"))
    assert tree(tmp_path / "s") == {"train/a": b"A", "test/a": b"A", "test/b": b"B"}


def jpeg(width, height, before=b"", marker=0xC0):
    frame = struct.pack(">BBHBHHB", 0xFF, marker, 11, 8, height, width, 1) + b"\x01\x11\x00"
    return b"\xff\xd8" + before + frame + b"\xff\xda\x00\x02data\xff\xd9"


def segment(marker, body):
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def test_sizes_from_headers():
    thumbnail = jpeg(1, 1)
    long = segment(0xE1, b"Exif\0\0" + thumbnail) + segment(0xE2, b"x" * 65_000) * 40 + segment(0xC4, b"tables")
    cases = {
        jpeg(640, 480): (640, 480),
        jpeg(33, 44, long, 0xC2): (33, 44),
        jpeg(5, 6, b"\xff\xff\xff\x01" + segment(0xFE, b"note")): (5, 6),
        b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 7, 9): (7, 9),
        b"GIF89a" + struct.pack("<HH", 3, 4): (3, 4),
        b"BM" + b"\0" * 16 + struct.pack("<ii", 10, -20): (10, 20),
        b"": None,
        b"no image": None,
        b"\x89PNG\r\n\x1a\n": None,
        jpeg(0, 5): None,
        jpeg(1, 2)[:9]: None,
        b"\xff\xd8\xff\xd9": None,
        b"\xff\xd8" + segment(0xE1, b"cut")[:6]: None,
        b"\xff\xd8junk": None,
    }
    for data, size in cases.items():
        assert images.image_size(data) == size, data[:40]


def test_sizes_of_files(spark):
    rows = [("a", jpeg(3, 4)), ("b", None), ("c", b"x"), ("d", jpeg(70, 80, segment(0xE0, b"y" * 9000)))]
    df = spark.createDataFrame(rows, "path string, content binary")
    assert sorted(map(tuple, images.image_sizes(df).collect())) == [("a", 3, 4), ("d", 70, 80)]


def tensor(kind, items):
    data = np.array(items, np.uint8)
    return struct.pack(f">I{data.ndim}I", 0x800 | kind, *data.shape) + data.tobytes()


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_files_pair_without_moving_pixels(spark, monkeypatch, limit):
    monkeypatch.setattr(idx, "BROADCAST_BYTES", limit)
    pictures = [(f"s3://b/{s}-images-idx3-ubyte", tensor(3, [[[s, i % 250], [i % 250, s]] for i in range(n)])) for s, n in ((1, 5), (2, 1500), (3, 2))]
    marks = [(f"s3://b/{s}-labels-idx1-ubyte", tensor(1, [i % 10 for i in range(n)])) for s, n in ((1, 5), (2, 1400), (4, 2))]
    held = [
        spark.createDataFrame([(p, len(c), c) for p, c in rows], "path string, length long, content binary")
        for rows in (pictures, marks)
    ]
    paired = idx.pair_files(*held)
    got = {(r["shard"], r["idx"]): (r["image"], r["label"]) for r in paired.collect()}
    assert set(got) == {("1", i) for i in range(5)} | {("2", i) for i in range(1400)}
    assert got[("2", 7)] == ([[2, 7], [7, 2]], 7)
    plan = plan_of(paired)
    assert plan.index("MapInArrow") < plan.index("Join")
    if limit:
        assert "Exchange hash" not in plan
