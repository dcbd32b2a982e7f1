"""Document collections with commit: a data source whose failed export leaves the collection as it was.

Every export writes a version of its own, task by task, and names its files in a manifest when all tasks have ended.
Readers follow the newest whole manifest, so they see the old documents or the new ones. An export
that fails deletes its version. The version before the current one stays, for those who still read it.

Tasks write through ``pyarrow.fs``, which knows local and mounted paths, S3, GCS and HDFS.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "coleccion"
MANIFESTS, VERSION = "_confirmadas", "version-"
# Manifests, and their versions, that stay: the current one and the one before.
KEPT = 2


class NoCollection(ValueError):
    """Nothing has been committed to the folder."""


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _manifests(files: fs.FileSystem, root: str) -> list[str]:
    """The paths of all manifests, newest first."""
    found = files.get_file_info(fs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True))
    return sorted((f.path for f in found if f.type == fs.FileType.File), reverse=True)


def _content(files: fs.FileSystem, path: str) -> dict | None:
    """A manifest, or None if its writer died before it was whole."""
    with files.open_input_stream(path) as stream:
        try:
            return json.loads(stream.read())
        except ValueError:
            return None


class CollectionWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder, self.version = folder.rstrip("/"), f"{VERSION}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Write the lines of one task attempt to a file of its own, which only a commit makes part of the collection."""
        files, root = _opened(self.folder)
        context = TaskContext.get()
        name, lines = f"{self.version}/part-{context.partitionId():06d}-{context.taskAttemptId()}.json", 0
        files.create_dir(f"{root}/{self.version}", recursive=True)
        with files.open_output_stream(f"{root}/{name}") as out:
            for batch in iterator:
                values = batch.column(0).to_pylist()
                lines += len(values)
                out.write("".join(f"{v}\n" for v in values).encode())
        message = WriterCommitMessage()
        message.file, message.lines = name, lines
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _opened(self.folder)
        before = _manifests(files, root)
        number = int(before[0].rsplit("/", 1)[1].split("-")[0]) + 1 if before else 1
        done = [m for m in messages if m is not None and m.lines]
        manifest = {"version": self.version, "lines": sum(m.lines for m in done), "files": sorted(m.file for m in done)}
        files.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        # Of two exports that take the same number, every reader prefers the same one.
        with files.open_output_stream(f"{root}/{MANIFESTS}/{number:012d}-{self.version}") as out:
            out.write(json.dumps(manifest).encode())
        for path in _manifests(files, root)[KEPT:]:
            self._delete(files, f"{root}/{path.rsplit('/', 1)[1].split('-', 1)[1]}")
            files.delete_file(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _opened(self.folder)
        self._delete(files, f"{root}/{self.version}")

    @staticmethod
    def _delete(files: fs.FileSystem, path: str) -> None:
        if files.get_file_info(path).type == fs.FileType.Directory:
            files.delete_dir(path)


class CollectionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> CollectionWriter:
        if not overwrite:
            raise ValueError("a collection is replaced as a whole")
        return CollectionWriter(self.options["path"])


def replace_collection(df: DataFrame, folder: str) -> None:
    """Replace the documents of the collection ``folder``, or leave it as it is if a task fails.

    Documents become JSON inside the JVM; fields that are null stay present, as null.
    """
    # Workers get this module along with the classes, whether or not the package is installed there.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    df.sparkSession.dataSource.register(CollectionSource)
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.format(FORMAT).mode("overwrite").save(folder)


def read_collection(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The documents of the newest committed version."""
    files, root = _opened(folder.rstrip("/"))
    for path in _manifests(files, root):
        manifest = _content(files, path)
        if manifest is None:
            continue
        if not manifest["files"]:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json([f"{folder.rstrip('/')}/{name}" for name in manifest["files"]])
    raise NoCollection(folder)
