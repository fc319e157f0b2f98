"""A sink for rows that are files: one file per row, named by the row, its
bytes as they are (IO-11).

Written with Spark's Python data source API in two phases. Tasks stage their
files in a folder of their attempt; the driver publishes the attempts that
Spark committed, file by file, by a rename; what failed or was repeated is
dropped. Any file system that pyarrow knows will do, and no links are made.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "named_files"


@dataclass
class Staged(WriterCommitMessage):
    """The folder of a task's attempt; its names are listed where they are published."""

    folder: str


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.replace = options["path"].rstrip("/"), options.get("existing", "keep") == "replace"
        self.job = f"{self.path}/.staged-{uuid.uuid4().hex}"
        if schema.names != ["name", "body"]:
            raise ValueError("rows must be (name string, body binary)")

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        files, job = fs.FileSystem.from_uri(self.job) if "://" in self.job else (fs.LocalFileSystem(), self.job)
        folder = f"{job}/{uuid.uuid4().hex}"
        files.create_dir(folder, recursive=True)
        for name, body in iterator:
            if not name or "/" in name or name.startswith("."):
                raise ValueError(f"not a file name: {name!r}")
            with files.open_output_stream(f"{folder}/{name}") as out:
                out.write(bytes(body or b""))
        return Staged(folder)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, path = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        for message in messages:
            if message is None:
                continue
            for staged in files.get_file_info(fs.FileSelector(message.folder)):
                final = f"{path}/{staged.base_name}"
                if self.replace or files.get_file_info(final).type == fs.FileType.NotFound:
                    files.move(staged.path, final)
        self._drop(files, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, path = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        self._drop(files, path)

    def _drop(self, files: fs.FileSystem, path: str) -> None:
        job = f"{path}/{self.job.rsplit('/', 1)[1]}"
        if files.get_file_info(job).type == fs.FileType.Directory:
            files.delete_dir(job)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, body binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return NamedFilesWriter(self.options, schema)


def write_named(files: DataFrame, path: str, *, name: str = "name", body: str = "body", existing: str = "keep") -> None:
    """One file per row below ``path``. A name that is there already is kept
    as it is, or replaced with ``existing='replace'``. A job that fails leaves
    nothing; one that is repeated leaves each file once. Names must not repeat."""
    spark = files.sparkSession
    spark.dataSource.register(NamedFiles)
    (files.select(F.col(name).alias("name"), F.col(body).cast("binary").alias("body"))
     .write.format(FORMAT).option("path", path).option("existing", existing).mode("append").save())


def read_named(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, body) of the files of one folder, empty ones left out."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return rows.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("name"), F.col("content").alias("body"))
