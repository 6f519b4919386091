import shutil

from pyspark.sql import functions as F

from sheafworks.streaming import ingest as I


def land(spark, folder, tmp_path, name, rows):
    spark.createDataFrame(rows, "id int, source string, ts timestamp_ntz, text string").coalesce(1).write.parquet(str(tmp_path / name))
    part = next((tmp_path / name).glob("part-*.parquet"))
    shutil.copy(part, folder / f"{name}.parquet")


def test_ingest_runs_again_without_copies(spark, tmp_path):
    from datetime import datetime

    folder = tmp_path / "landing"
    folder.mkdir()
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    day = datetime(2025, 1, 1)
    land(spark, folder, tmp_path, "one", [(1, "a", day, "x"), (2, "b", day, "y")])
    schema = spark.read.parquet(str(folder)).schema

    def process(batch):
        return batch.select("id", F.upper("text").alias("text"))

    def run():
        I.ingest(I.stream_parquet(spark, str(folder), schema), process, table, checkpoint)
        out = process(spark.createDataFrame([], schema)).schema
        return sorted((r["id"], r["text"]) for r in I.read_ingested(spark, table, out).collect())

    assert run() == [(1, "X"), (2, "Y")]
    assert run() == [(1, "X"), (2, "Y")]  # nothing new landed
    land(spark, folder, tmp_path, "two", [(2, "b", day, "newer"), (3, "c", day, "z")])
    assert run() == [(1, "X"), (2, "NEWER"), (3, "Z")]


def test_latest_per_source_batch_and_stream_agree(spark, tmp_path):
    from datetime import datetime

    folder = tmp_path / "landing"
    folder.mkdir()
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    rows = [(i, f"s{i % 3}" if i % 7 else None, datetime(2025, 1, 1 + i % 5), f"t{i}") for i in range(40)]
    wanted = {}
    names = {"source": "source", "ts": "ts", "key": "id"}
    for n, part in enumerate((rows[10:20], rows[20:30], rows[:10], rows[30:])):
        land(spark, folder, tmp_path, f"p{n}", part)
        schema = spark.read.parquet(str(folder)).schema
        landed = I.stream_parquet(spark, str(folder), schema, files_per_batch=1)
        I.track_latest(landed, **names, table=table, checkpoint=checkpoint, merge_every=2)
        batch = I.latest_per_source(spark.read.parquet(str(folder)), "source", "ts", "id")
        for row in part:
            wanted[row[1]] = max(wanted.get(row[1], (row[2], row[0])), (row[2], row[0]))
        assert {r["source"]: (r["ts"], r["id"]) for r in batch.collect()} == wanted
        tracked = I.read_tracked(spark, table, **names)
        assert {r["source"]: (r["ts"], r["id"]) for r in tracked.collect()} == wanted
    assert len(list((tmp_path / "table" / "changed").glob("batch_id=*"))) == 4
    assert sorted(p.name for p in (tmp_path / "table" / "merged").glob("upto=*")) == ["upto=1", "upto=3"]


def test_a_batch_writes_only_the_sources_it_touched(spark, tmp_path):
    from datetime import datetime

    folder = tmp_path / "landing"
    folder.mkdir()
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    day = datetime(2025, 1, 1)
    for n, part in enumerate(([(i, f"s{i}", day, "x") for i in range(20)], [(30, "s3", day, "y")])):
        land(spark, folder, tmp_path, f"q{n}", part)
        schema = spark.read.parquet(str(folder)).schema
        I.track_latest(I.stream_parquet(spark, str(folder), schema), "source", "ts", "id", table, checkpoint)
    changed = spark.read.parquet(f"{table}/changed").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in changed} == {0: 20, 1: 1}


def test_newer_text_replaces_all_rows_of_a_document(spark, tmp_path):
    from datetime import datetime

    folder = tmp_path / "landing"
    folder.mkdir()
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    day = datetime(2025, 1, 1)
    rows = [(1, "a", day, "x y z"), (2, "b", day, "p q"), (3, "c", day, "r"), (None, "d", day, "n")]
    land(spark, folder, tmp_path, "one", rows)
    schema = spark.read.parquet(str(folder)).schema

    def process(batch):
        return batch.select("id", F.explode(F.split("text", " ")).alias("word"))

    def run():
        I.ingest(I.stream_parquet(spark, str(folder), schema), process, table, checkpoint)
        out = process(spark.createDataFrame([], schema)).schema
        return sorted((r["id"] or 0, r["word"]) for r in I.read_ingested(spark, table, out, "id").collect())

    assert run() == [(0, "n"), (1, "x"), (1, "y"), (1, "z"), (2, "p"), (2, "q"), (3, "r")]
    land(spark, folder, tmp_path, "two", [(1, "a", day, "y"), (3, "c", day, None), (None, "d", day, "m")])
    assert run() == [(0, "m"), (1, "y"), (2, "p"), (2, "q")]


def test_no_task_lands_a_whole_lot(spark, tmp_path, monkeypatch):
    from sheafworks.plans import catalog

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setitem(catalog.__dict__, "scratch_path", lambda _, label: str(tmp_path / label))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        rows = catalog.latest_per_source(spark, str(tmp_path))
        got = {r["source"]: r["doc_id"] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {r["source"]: r["n"] for r in source.groupBy("source").agg(F.max("doc_id").alias("n")).collect()}
    assert len(list((tmp_path / "landed").glob("part-*.parquet"))) == 18
    # A batch for each lot; the second one merges.
    assert len(list((tmp_path / "latest" / "changed").glob("batch_id=*"))) == 3
    assert [p.name for p in (tmp_path / "latest" / "merged").glob("upto=*")] == ["upto=1"]
