import json
import os

import pytest
from pyspark.sql import functions as F

from sheafworks.operators import vector_table as V
from sheafworks.plans import datasets

DOC = "# Title\n" + "A sentence that says enough to be kept as a chunk of text. " * 3


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame(
        [(i, f"raw/repo{i}_README_20250101_000000.md", DOC + str(i)) for i in range(250)], "k int, path string, text string"
    ).repartition(2)
    return datasets.vector_rows(docs, "k", V.Lineage("v1", "hashing", workflow_uid="run"), dim=8).cache()


def test_stored_schema(rows):
    assert rows.columns == ["id", "content", "embedding", "metadata", "created_at"]
    row = rows.first()
    assert len(row["embedding"]) == 8 and row["metadata"]["dvc_data_version"] == "v1"
    assert row["metadata"]["docker_image"] is None and row["metadata"]["section_h1"] == "Title"
    as_json = json.loads(V.metadata_json(rows).first()["metadata"])
    assert as_json["docker_image"] is None and len(as_json) == 11


def test_wrong_length_fails(spark, rows):
    bad = spark.createDataFrame([([1.0, 2.0],)], "v array<float>").select(V.checked_vector(F.col("v"), 3))
    with pytest.raises(Exception, match="3 elements"):
        bad.collect()


def test_create_or_replace_and_lineage_filter(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    V.write_vector_table(rows, path)
    V.write_vector_table(rows.limit(40), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 40
    assert V.filter_lineage(stored, dvc_data_version="v1", argo_workflow_uid="run").count() == 40
    assert V.filter_lineage(stored, dvc_data_version="v2").count() == 0


def test_batched_writer_commits_per_batch_and_closes(rows, tmp_path):
    folder = str(tmp_path)

    def connect():
        import os
        import uuid

        class Files:
            def __init__(self):
                self.name = uuid.uuid4().hex
                self.batches = 0
                self.pending = []

            def write(self, batch):
                self.pending += [r["id"] for r in batch]

            def commit(self):
                with open(os.path.join(folder, f"{self.name}-{self.batches}"), "w") as out:
                    out.write("\n".join(self.pending))
                self.batches += 1
                self.pending = []

            def close(self):
                open(os.path.join(folder, f"{self.name}-closed"), "w").close()

        return Files()

    V.write_batches(rows, connect, batch_size=100)
    names = [p for p in tmp_path.iterdir()]
    batches = [p.read_text().split("\n") for p in names if not p.name.endswith("closed")]
    assert max(map(len, batches)) <= 100
    assert sorted(x for b in batches for x in b) == sorted(r["id"] for r in rows.select("id").collect())
    assert sum(p.name.endswith("closed") for p in names) == rows.rdd.getNumPartitions()


def test_jdbc_rows_have_plain_types(rows):
    out = V.jdbc_rows(rows)
    assert dict(out.dtypes)["embedding"] == "string" and dict(out.dtypes)["metadata"] == "string"
    assert len(json.loads(out.first()["embedding"])) == 8


def test_batches_reach_a_store_once(spark, tmp_path):
    rows = spark.range(1000).select(F.format_string("k%04d", "id").alias("id"), (F.col("id") % 7).alias("x"))
    folder = str(tmp_path / "sent")
    for sent in (rows, rows.repartition(5), rows.union(rows.limit(0)).coalesce(1)):
        V.write_batches_once(sent, lambda: V.FolderLedger(folder), "id", batch_size=30, partitions=6)
    held = spark.read.json(folder)
    assert held.count() == held.select("id").distinct().count() == 1000
    files = [p for p in (tmp_path / "sent").iterdir() if p.suffix == ".json"]
    assert all(len(p.read_text().splitlines()) <= 30 for p in files)


def test_a_task_that_fails_between_batches_sends_none_twice(spark, tmp_path):
    folder, broken = str(tmp_path / "sent"), str(tmp_path / "broken")
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"))

    class Breaks(V.FolderLedger):
        def commit(self, batch, rows):
            super().commit(batch, rows)
            if not os.path.exists(broken):
                open(broken, "w").close()
                raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        V.write_batches_once(rows, lambda: Breaks(folder), "id", 10, 2)
    V.write_batches_once(rows, lambda: Breaks(folder), "id", 10, 2)
    held = [r["id"] for r in spark.read.json(folder).collect()]
    assert sorted(held, key=int) == [str(i) for i in range(200)]
