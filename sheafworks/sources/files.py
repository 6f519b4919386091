"""A sink that writes each row as a file of its own, with a commit for tasks and for the job.

Tasks write into a folder of their attempt below a staging folder. A task that fails, or runs a second
time, leaves only such a folder; the driver hears from each task that ended well the name of its folder
and nothing else. When all have ended, these folders' files are moved to their places, again by tasks;
moving a second time changes nothing. Then the staging folder goes. A job that fails leaves no file in
place; a task of it that still ran may leave a staging folder, which readers pass over for its name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "one_file_per_row"
_STAGING = "_staging"
_TASKS = "tasks"


def file_place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder (local, s3, gs, hdfs) and the folder in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    system, folder = fs.FileSystem.from_uri(path)
    return system, folder.rstrip("/")


@dataclass
class _TaskDone(WriterCommitMessage):
    folder: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, staging: str):
        self.staging = staging

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _TaskDone:
        system, root = file_place(self.staging)
        folder = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        made: set[str] = set()
        for batch in iterator:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                path = f"{root}/{folder}/{_checked(name.as_py())}"
                parent = path.rsplit("/", 1)[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(path) as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
        return _TaskDone(folder if made else None)

    def commit(self, messages: list[_TaskDone | None]) -> None:
        """Writes the list of the folders that count: one short name for each task."""
        system, root = file_place(self.staging)
        system.create_dir(root, recursive=True)
        folders = [m.folder for m in messages if m and m.folder]
        with system.open_output_stream(f"{root}/{_TASKS}") as out:
            out.write(json.dumps(folders).encode())

    def abort(self, messages: list[_TaskDone | None]) -> None:
        system, root = file_place(self.staging)
        if system.get_file_info(root).type != fs.FileType.NotFound:
            system.delete_dir(root)


class OneFilePerRow(DataSource):
    """Rows (name string, content binary) as files below the folder `path`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def _checked(name: str | None) -> str:
    """A name that stays below its folder."""
    if not name or name.startswith(("/", "_", ".")) or any(part in ("", ".", "..") for part in name.split("/")):
        raise ValueError(f"not a file name: {name!r}")
    return name


def _moved(target: str, staging: str):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_place(staging)
        _, place = file_place(target)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                base, count, made = f"{root}/{folder}", 0, set()
                found = system.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True))
                for file in (f for f in found if f.type == fs.FileType.File):
                    goal = place + file.path[len(base) :]
                    parent = goal.rsplit("/", 1)[0]
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    system.move(file.path, goal)
                    count += 1
                yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    return move


def write_files(df: DataFrame, path: str, name: Column, content: Column) -> None:
    """Each row as the file `name` (folders in it are made) below `path`, holding `content` in bytes.

    Names must be unique: of rows with one name any may stay. Existing files of other names stay, of
    the same name are replaced. A null content is an empty file; a null name, or one that leads out of
    the folder, is an error, and then no file is written. The folder must be one that every executor
    reaches by this path.
    """
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(OneFilePerRow)
    staging = f"{path.rstrip('/')}/{_STAGING}-{uuid.uuid4().hex}"
    rows = df.select(name.cast("string").alias("name"), content.cast("binary").alias("content"))
    rows.write.format(FORMAT).mode("append").option("path", staging).save()
    system, root = file_place(staging)
    with system.open_input_stream(f"{root}/{_TASKS}") as held:
        folders = json.loads(held.read())
    if folders:
        tasks = spark.createDataFrame([(f,) for f in folders], "folder string")
        dealt = tasks.repartition(min(len(folders), 8 * spark.sparkContext.defaultParallelism), "folder")
        dealt.mapInArrow(_moved(path, staging), "files long").agg(F.sum("files")).collect()
    system.delete_dir(root)


def copy_files(annotations: DataFrame, files: DataFrame, path: str, split: str = "split", key: str = "image") -> None:
    """The files (key, content) of the annotations into one folder per split, each once."""
    wanted = annotations.select(split, key).distinct()
    write_files(wanted.join(files.select(key, "content"), key), path, F.concat_ws("/", split, key), F.col("content"))
