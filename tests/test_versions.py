from pyspark.sql import functions as F

from sheafworks.operators import versions as V


def frame(spark, rows):
    return spark.createDataFrame(rows, "logical_path string, md5 string")


def test_diff_and_changed(spark):
    old = frame(spark, [("a", "1"), ("b", "2"), ("c", "3")])
    new = frame(spark, [("b", "2"), ("c", "4"), ("d", "5")])
    got = {r["logical_path"]: r["status"] for r in V.snapshot_diff(old, new).collect()}
    assert got == {"a": "removed", "b": "same", "c": "changed", "d": "added"}
    assert V.has_changed(V.snapshot_diff(old, new)).first()["is_changed"]
    assert not V.has_changed(V.snapshot_diff(old, old)).first()["is_changed"]


def test_fingerprint_ignores_order_and_sees_copies(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("x"))
    first = V.dataset_fingerprint(df, V.row_hash("x")).first()
    assert first == V.dataset_fingerprint(df.repartition(7).orderBy(F.desc("x")), V.row_hash("x")).first()
    assert first != V.dataset_fingerprint(df.union(df.limit(1)), V.row_hash("x")).first()
    empty = V.dataset_fingerprint(df.limit(0), V.row_hash("x")).first()
    assert (empty["num_rows"], empty["hash_sum"]) == (0, "0")


def test_file_manifest_and_read_at_version(spark, tmp_path):
    for version, files in {"v1": {"a.md": "one", "sub/b.md": "two"}, "v2": {"a.md": "changed"}}.items():
        for name, text in files.items():
            path = tmp_path / version / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
    (tmp_path / "v1" / "skip.txt").write_text("x")
    parts = [V.file_manifest(spark, str(tmp_path / v), "docs", v, "*.md") for v in ("v1", "v2")]
    manifest = parts[0].unionByName(parts[1])
    rows = {(r["version"], r["logical_path"]): (r["length"], r["md5"]) for r in manifest.collect()}
    import hashlib

    assert rows[("v1", "sub/b.md")] == (3, hashlib.md5(b"two").hexdigest())
    assert len(rows) == 3
    store = str(tmp_path / "store")
    for v in ("v1", "v2", "v1"):
        V.store_files(spark, str(tmp_path / v), store, "*.md")
    assert spark.read.parquet(store).count() == 3
    read = {r["logical_path"]: bytes(r["content"]) for r in V.read_files_at(spark, manifest, "docs", "v1", store).collect()}
    assert read == {"a.md": b"one", "sub/b.md": b"two"}
    read = {r["logical_path"]: bytes(r["content"]) for r in V.read_files_at(spark, manifest, "docs", "v2", store).collect()}
    assert read == {"a.md": b"changed"}
    diff = V.snapshot_diff(V.at_version(manifest, "docs", "v1"), V.at_version(manifest, "docs", "v2"))
    assert {r["logical_path"]: r["status"] for r in diff.collect()} == {"a.md": "changed", "sub/b.md": "removed"}


def test_row_read_at_version(spark):
    manifest = V.table_manifest(frame(spark, [("k1", "h1"), ("k2", "h1")]), "t", "v1", "logical_path", F.col("md5"))
    store = spark.createDataFrame([("h1", 5)], "md5 string, price int")
    got = V.read_version(manifest, "t", "v1", store).collect()
    assert sorted((r["logical_path"], r["price"]) for r in got) == [("k1", 5), ("k2", 5)]


def test_manifest_keeps_nested_folder_of_the_same_name(spark, tmp_path):
    from sheafworks.operators.versions import file_manifest

    for name in ("raw/a.md", "raw/raw/a.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    for root in (f"{tmp_path}/raw", f"file://{tmp_path}/raw/"):
        rows = file_manifest(spark, root, "d", "v1").collect()
        assert sorted(r.logical_path for r in rows) == ["a.md", "raw/a.md"]


def test_diff_takes_null_content_as_a_value(spark):
    from sheafworks.operators.versions import snapshot_diff

    old = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)], "logical_path string, md5 string")
    new = spark.createDataFrame([("a", None), ("b", None), ("d", None)], "logical_path string, md5 string")
    got = dict(tuple(r) for r in snapshot_diff(old, new).collect())
    assert got == {"a": "same", "b": "changed", "c": "removed", "d": "added"}


def test_two_loaders_of_one_name_are_two_models(spark):
    import numpy as np

    from sheafworks.operators.embedding import embed

    df = spark.createDataFrame([("x",)], "text string").coalesce(1)
    for value in (1.0, 2.0):
        got = embed(df, load=lambda value=value: lambda texts: np.full((len(texts), 2), value)).collect()
        assert list(got[0].embeddings) == [value, value]


def test_missing_content_is_an_error_and_listed(spark):
    import pytest

    manifest = V.table_manifest(frame(spark, [("k1", "h1"), ("k2", "h2")]), "t", "v1", "logical_path", F.col("md5"))
    store = spark.createDataFrame([("h1", 5)], "md5 string, price int")
    assert [r["logical_path"] for r in V.missing_content(manifest, "t", "v1", store).collect()] == ["k2"]
    with pytest.raises(Exception, match="no content for k2"):
        V.read_version(manifest, "t", "v1", store).select("price").collect()


def test_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", "a")], "x string, y string")
    assert df.select(V.row_hash("x", "y").alias("h")).distinct().count() == 4
    one = spark.createDataFrame([("a", 1)], "x string, y int").select(V.row_hash("x", "y").alias("h")).first()
    import hashlib

    assert one["h"] == hashlib.md5(b"a|1").hexdigest()


def test_reads_only_the_named_files_of_many_folders(spark, tmp_path):
    import pytest

    for i in range(1_050):
        folder = tmp_path / f"d{i} [{i % 2}]"
        folder.mkdir()
        (folder / "a.md").write_text(str(i))
    (tmp_path / "d0 [0]" / "other.md").write_text("not in the version")
    manifest = V.file_manifest(spark, str(tmp_path), "docs", "v1", "a.md").persist()
    store = str(tmp_path / "store")
    V.store_files(spark, str(tmp_path), store, "*.md")
    got = V.read_files_at(spark, manifest, "docs", "v1", store)
    assert {r["logical_path"]: bytes(r["content"]) for r in got.collect()} == {
        f"d{i} [{i % 2}]/a.md": str(i).encode() for i in range(1_050)
    }
    assert spark.read.parquet(store).count() == 1_051
    manifest.unpersist()
    with pytest.raises(ValueError, match="no version"):
        V.read_files_at(spark, manifest, "docs", "v2", store)


def test_upstream_over_levels_and_circles(spark):
    from sheafworks.operators.versions import upstream

    rows = [("a", "1", "b", "1"), ("a", "1", "c", "1"), ("b", "1", "c", "1"), ("c", "1", "d", "2"), ("d", "2", "b", "1")]
    rows += [("x", "9", "a", "1"), ("x", "9", "a", "1"), ("y", None, "x", "8")]
    edges = spark.createDataFrame(rows, "dataset string, version string, source_dataset string, source_data_version string")
    got = {(r["dataset"], r["source_dataset"]): r["depth"] for r in upstream(edges).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "x"} == {"a": 1, "b": 2, "c": 2, "d": 3}
    assert {k[1]: v for k, v in got.items() if k[0] == "b"} == {"c": 1, "d": 2, "b": 3}
    assert {k[1]: v for k, v in got.items() if k[0] == "y"} == {"x": 1}
    assert upstream(edges.where("false")).collect() == []
