"""The stored form of embedded chunks and its sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5
from itertools import islice
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..sources.files import file_place


@dataclass(frozen=True)
class Lineage:
    """What every stored row says about where it comes from."""

    data_version: str
    embedding_model: str
    docker_image: str | None = None
    workflow_uid: str | None = None


def lineage_struct(lineage: Lineage) -> Column:
    """The metadata of a chunk: source, position, sections and lineage (fixed key names)."""

    def fixed(value: str | None) -> Column:
        return F.lit(value).cast("string")

    return F.struct(
        F.col("source_repo"),
        F.col("source_file"),
        F.col("chunk_index"),
        F.col("doc_id"),
        fixed(lineage.data_version).alias("dvc_data_version"),
        fixed(lineage.embedding_model).alias("embedding_model"),
        fixed(lineage.docker_image).alias("docker_image"),
        fixed(lineage.workflow_uid).alias("argo_workflow_uid"),
        F.col("section_h1"),
        F.col("section_h2"),
        F.col("section_h3"),
    )


def checked_vector(vector: Column, dim: int) -> Column:
    """The vector itself; one of another length, or none, fails the write."""
    return F.when(F.size(vector) == dim, vector).otherwise(
        F.raise_error(F.lit(f"an embedding must have {dim} elements"))
    )


def stored_rows(embedded: DataFrame, lineage: Lineage, dim: int = P.EMBEDDING_DIM) -> DataFrame:
    """(id, content, embedding, metadata, created_at)."""
    return embedded.select(
        F.col("chunk_id").alias("id"),
        F.col("text").alias("content"),
        checked_vector(F.col("embeddings"), dim).alias("embedding"),
        lineage_struct(lineage).alias("metadata"),
        F.current_timestamp().alias("created_at"),
    )


def write_vector_table(rows: DataFrame, path: str) -> None:
    """Create or replace. Metadata stays a struct, so filters on it reach the scan."""
    rows.write.mode("overwrite").parquet(path)


def metadata_json(rows: DataFrame) -> DataFrame:
    """Metadata as JSON text, for stores that keep it so. Absent values stay as null keys."""
    return rows.withColumn("metadata", F.to_json("metadata", {"ignoreNullFields": "false"}))


def filter_lineage(rows: DataFrame, **wanted: str) -> DataFrame:
    """Rows whose metadata has the given values."""
    for key, value in wanted.items():
        rows = rows.where(F.col(f"metadata.{key}") == value)
    return rows


class Writer(Protocol):
    def write(self, rows: list[Row]) -> None: ...
    def commit(self) -> None: ...
    def close(self) -> None: ...


def write_batches(rows: DataFrame, connect: Callable[[], Writer], batch_size: int = P.WRITE_BATCH) -> None:
    """Sends the rows to an outside store, one commit per batch.

    The connection is opened inside the task. A retried task sends its rows again under
    the same ids, so the store must upsert by id.
    """

    def send(part: Iterator[Row]) -> None:
        writer = connect()
        try:
            while batch := list(islice(part, batch_size)):
                writer.write(batch)
                writer.commit()
        finally:
            writer.close()

    rows.foreachPartition(send)


class Ledger(Protocol):
    """A store that knows which batches it holds. `commit` adds rows and the batch's key as one step."""

    def holds(self, batch: str) -> bool: ...
    def commit(self, batch: str, rows: list[Row]) -> None: ...
    def close(self) -> None: ...


class FolderLedger:
    """A folder of JSON lines, one file for each batch, named by its key.

    A file is written beside its place and moved there, so it is whole or not there, and a batch that
    is committed twice, even at the same time, is one file.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def _file(self, name: str):
        system, root = file_place(self.folder)
        return system, root, f"{root}/{name}"

    def holds(self, batch: str) -> bool:
        system, _, path = self._file(f"{batch}.json")
        return system.get_file_info(path).is_file

    def commit(self, batch: str, rows: list[Row]) -> None:
        system, root, path = self._file(f"{batch}.json")
        beside = f"{root}/_{batch}-{uuid.uuid4().hex}"
        system.create_dir(root, recursive=True)
        with system.open_output_stream(beside) as out:
            out.write("".join(json.dumps(row.asDict(True), default=str) + "\n" for row in rows).encode())
        system.move(beside, path)

    def close(self) -> None:
        pass


def write_batches_once(
    rows: DataFrame,
    connect: Callable[[], Ledger],
    key: str = "id",
    batch_size: int = P.WRITE_BATCH,
    partitions: int | None = None,
) -> None:
    """Sends the rows to an outside store in batches, each of which it takes once.

    Rows are dealt out by a hash of their unique key to a fixed number of partitions and sorted there,
    so a batch has the same rows whenever it is made: by a task that runs a second time, at the same
    time elsewhere, or in another run over the same rows. Its key is a digest of the rows' keys; a
    batch that the store holds is passed over. Of rows with one key and other content the first sent
    stays.
    """
    count = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(part: Iterator[Row]) -> None:
        store = connect()
        try:
            while batch := list(islice(part, batch_size)):
                name = md5("\0".join(str(row[key]) for row in batch).encode()).hexdigest()
                if not store.holds(name):
                    store.commit(name, batch)
        finally:
            store.close()

    # The optimizer may not change this number, or batches would differ from run to run.
    rows.repartition(count, key).sortWithinPartitions(key).foreachPartition(send)


def jdbc_rows(rows: DataFrame) -> DataFrame:
    """The same rows in types every JDBC driver takes: vector and metadata as text."""
    vector = F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), ","), F.lit("]"))
    return metadata_json(rows).withColumn("embedding", vector)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, Any] | None = None) -> None:
    """Create or replace through JDBC, `batchsize` rows per round trip."""
    options = {"batchsize": str(P.WRITE_BATCH), "truncate": "false", **(properties or {})}
    jdbc_rows(rows).write.mode("overwrite").jdbc(url, table, properties=options)
