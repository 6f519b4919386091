"""Line dedup against levelled sorted runs of line hashes, with DataFrame functions only.

A run is a table (h1, h2, n_docs, last) sorted by hash: in how many documents of its batches a
line key was seen, and the largest id among them. Each new batch is merge-anti-joined with the
runs: keys that have enough documents there already, and a larger id, are left out; the rest is
written as a run of level 0. When a level has `fanout` runs they are merged into one of the next
level, so a key meets a logarithmic number of runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import SPACES, shielded, text_of, write_once

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of one key are spread over so many groups before they meet their verdict.
SALTS = 32


def line_key(line: Column) -> Column:
    """The line without white space at both ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def line_keys(documents: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, kt, pos, h1, h2): every line whose key has at least `min_chars` code points.

    kt is a hash of the text (it tells rows of one id apart), pos the 0-based line, h1 and h2
    together a 96-bit hash of the key.
    """
    texts = documents.select("doc_id", text_of().alias("text"))
    lines = texts.select(
        "doc_id", _text_key(F.col("text")).alias("kt"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    )
    keys = lines.select("doc_id", "kt", "pos", line_key(F.col("line")).alias("key"))
    keys = keys.where(F.length("key") >= min_chars)
    return keys.select("doc_id", "kt", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))


class LineRuns:
    """The runs below one folder. A document must come in one batch only."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 3, fanout: int = 4):
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0
        self.schema = None

    def _write(self, level: int, run: DataFrame) -> None:
        where = f"{self.path}/level-{level}/run-{self.written}"
        self.written += 1
        run.repartition("h1", "h2").sortWithinPartitions("h1", "h2").write.mode("overwrite").parquet(where)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(where)

    def _read(self, paths: list[str]) -> DataFrame:
        return reduce(DataFrame.union, (self.spark.read.schema(self.schema).parquet(p) for p in paths))

    @staticmethod
    def _merge(runs: DataFrame) -> DataFrame:
        return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))

    def add(self, keys: DataFrame) -> None:
        """Adds a batch of (doc_id, h1, h2); the same document may hold a key many times."""
        # Ids first: a key in very many documents is dealt out by them, then counted by partial sums.
        once = keys.select("h1", "h2", "doc_id").distinct()
        batch = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
        self.schema = self.schema or batch.schema
        if self.written:
            known = self.merged().where(F.col("n_docs") >= self.min_docs).select("h1", "h2", F.col("last").alias("known"))
            settled = (batch.h1 == known.h1) & (batch.h2 == known.h2) & (
                (known.known >= batch["last"]) | batch["last"].isNull()
            )
            batch = batch.join(known, settled, "left_anti")
        self._write(0, batch)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._write(level + 1, self._merge(self._read(self.levels[level])))
            self.levels[level] = []
            level += 1

    def merged(self) -> DataFrame:
        """(h1, h2, n_docs, last) over all runs. n_docs may be short for keys that were settled before."""
        return self._merge(self._read([p for level in self.levels for p in level]))

    def repeated(self) -> DataFrame:
        return self.merged().where(F.col("n_docs") >= self.min_docs).select("h1", "h2", "last")


def dropped_lines(
    documents: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 4
) -> DataFrame:
    """(doc_id, kt, dropped): the 0-based lines that each text loses; texts that lose none give no row."""
    spark = documents.sparkSession
    base = scratch_path(spark, "line-runs")
    keys = line_keys(documents, min_chars).withColumn("batch", F.expr(f"pmod(xxhash64(doc_id), {batches})").cast("int"))
    keys.write.mode("overwrite").partitionBy("batch").parquet(f"{base}/keys")
    keys = spark.read.schema(keys.schema).parquet(f"{base}/keys")
    runs = LineRuns(spark, f"{base}/runs", min_docs, fanout)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch))
    repeated = write_once(runs.repeated(), f"{base}/repeated")
    spread = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = keys.drop("batch").withColumn("salt", F.expr(f"pmod(kt + pos, {SALTS})").cast("int"))
    gone = salted.join(spread, ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    return gone.groupBy("doc_id", "kt").agg(F.collect_set("pos").alias("dropped"))


def drop_repeated_lines(
    documents: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 4
) -> DataFrame:
    """Adds n_lines, n_dropped and `kept`, the lines left joined by \\n.

    A text is cut at \\n; a null or empty one is one empty line. Keys (see `line_key`) of at least
    `min_chars` code points in at least `min_docs` documents lose all their lines except in the
    largest doc_id that has them. Documents are told apart by doc_id: rows that share an id are
    one document, null ids together are one and smaller than all others. All other columns pass
    through; columns with the added names are replaced.
    """
    added = ("n_lines", "n_dropped", "kept")
    found = dropped_lines(documents, min_chars, min_docs, batches, fanout)
    found = found.select(F.col("doc_id").alias("_id"), F.col("kt").alias("_kt"), F.col("dropped").alias("_dropped"))
    others = [c for c in documents.columns if c not in added]
    left = documents.select(*others, text_of().alias("_text")).withColumn("_key", _text_key(F.col("_text")))
    both = left.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_kt")), "left")
    lines = F.split("_text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_dropped")
    # Texts that lose nothing are not cut up.
    both = both.withColumn("_lines", F.when(F.col("_dropped").isNotNull(), lines))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    breaks = F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("\n"), F.lit("")))
    return both.select(
        *others,
        (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("_dropped").isNotNull(), F.size("_dropped")), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(kept).alias("kept"),
    )


def stage(documents: DataFrame) -> DataFrame:
    """The documents with their repeated lines gone.

    Columns of any other names stay as they are; n_chars follows the text.
    """
    return shielded(documents, lambda docs: drop_repeated_lines(docs).withColumn("text", F.col("kept")))
