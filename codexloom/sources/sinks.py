"""Sinks: packs and reports, one folder per document or, for a workspace, one file."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def write_packs(lines: DataFrame, path: str) -> None:
    """lines (doc, line_no, line): one folder doc=… per pack, its lines in order in one file. Folders of other documents
    stay."""
    rows = lines.repartition("doc").sortWithinPartitions("doc", "line_no").select("doc", "line")
    rows.write.option("partitionOverwriteMode", "dynamic").partitionBy("doc").mode("overwrite").text(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))


def make_folders(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, at = _fs(spark, path)
        fs.mkdirs(at(path))


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at(path)))


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Renames files; folders are made as needed."""
    for source, target in moves:
        fs, at = _fs(spark, target)
        fs.mkdirs(at(target).getParent())
        if not fs.rename(at(source), at(target)):
            raise OSError(f"could not move {source} to {target}")


class Files(DataSource):
    """A sink of text files: rows (file, line), those of a file together and in order, become files of a folder."""

    @classmethod
    def name(cls) -> str:
        return "codexloom-files"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FilesWriter(self.options["path"])


@dataclass
class Written(WriterCommitMessage):
    files: int


class FilesWriter(DataSourceWriter):
    """Each task writes under names of its own and gives files their names when all of them are complete, one rename each,
    on the executor. Tasks that are tried again write the same files once more; a task that fails leaves no part of a file
    under its name. Files go through pyarrow's file systems: local and mounted folders, HDFS, object stores."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows: Iterator[Row]) -> Written:
        fs, root = FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (LocalFileSystem(), self.folder)
        fs.create_dir(root, recursive=True)
        mine, done, out, name = f".{uuid.uuid4().hex}", [], None, None
        try:
            for file, line in rows:
                if file != name:
                    if out is not None:
                        out.close()
                    name = file
                    done.append(file)
                    out = fs.open_output_stream(f"{root}/{mine}.{len(done)}")
                out.write(line.encode("utf-8", "surrogatepass") + b"\n")
            if out is not None:
                out.close()
        except BaseException:
            for i in range(1, len(done) + 1):
                with contextlib.suppress(OSError):
                    fs.delete_file(f"{root}/{mine}.{i}")
            raise
        for i, file in enumerate(done, 1):
            fs.move(f"{root}/{mine}.{i}", f"{root}/{file}")
        return Written(len(done))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing is left to do: files have their names."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of tasks that were complete stay; each is whole."""


def write_files(lines: DataFrame, names: DataFrame, folder: str) -> None:
    """lines (doc, line_no, line) as one file per document in folder, by names (doc, file); other files there stay, and
    one of the same name is replaced. Of documents with the same name the last one's stays."""
    spark = lines.sparkSession
    spark.dataSource.register(Files)
    # Every file belongs to one document, so that no two tasks write it.
    of = names.groupBy("file").agg(F.max("doc").alias("doc"))
    rows = lines.join(of, "doc").repartition("file").sortWithinPartitions("file", "line_no").select("file", "line")
    rows.write.format(Files.name()).option("path", folder).mode("append").save()


def write_reports(reports: DataFrame, names: DataFrame, folder: str) -> None:
    """reports (doc, json, html) beside the packs, by names (doc, file): the file's name with .inspect.json and .inspect.html."""
    for column in ("json", "html"):
        lines = reports.select("doc", F.lit(1).alias("line_no"), F.col(column).alias("line"))
        write_files(lines, names.select("doc", F.concat(F.regexp_replace("file", r"\.jsonl$", ""), F.lit(f".inspect.{column}")).alias("file")), folder)
