"""A sink of files with names of their own: one for each document, as lines or as a whole.

Rows are dealt by file and sorted, so that a file is written by one task from beginning to end, line by line. Tasks write under names
that nobody looks for; when all have ended the files get theirs, replacing what was there, and a job that fails leaves none. A task
that runs again writes other such names: what the failed one left goes with the folder.

Python writes the files, so the folder has to be one that it reaches as Spark does (``pyarrow.fs``)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

TEMPORARY = "_temporary"
#: Renames at a time when a job is committed.
RENAMES = 16


def python_uri(spark: SparkSession, path: str) -> str:
    """The path as Spark understands it, for ``pyarrow.fs``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def file_name(name: Column) -> Column:
    """A string as the name of one file: slashes, percent signs and leading dots and underscores are percent-encoded."""
    out = name.cast("string")
    for c in "%/\x00":
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    for c in "._":
        out = F.when(out.startswith(c), F.concat(F.lit(f"%{ord(c):02X}"), F.substr(out, F.lit(2)))).otherwise(out)
    return out


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: temporary and own name."""

    files: list[tuple[str, str]] = field(default_factory=list)


class _Writer(DataSourceWriter):
    def __init__(self, uri: str):
        self.uri, self.run = uri, uuid.uuid4().hex

    def _fs(self):
        from pyarrow import fs

        found, root = fs.FileSystem.from_uri(self.uri)
        return found, root.rstrip("/")

    def write(self, iterator: Iterator) -> Written:
        fs, root = self._fs()
        out = Written()
        fs.create_dir(f"{root}/{TEMPORARY}/{self.run}", recursive=True)
        for name, rows in groupby(iterator, lambda r: r.file):
            beside = f"{root}/{TEMPORARY}/{self.run}/{uuid.uuid4().hex}"
            with fs.open_output_stream(beside) as stream:
                for r in rows:
                    stream.write((r.value or "").encode())
            out.files.append((beside, f"{root}/{name}"))
        return out

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = self._fs()
        files = [f for m in messages if m is not None for f in m.files]
        for folder in sorted({own.rsplit("/", 1)[0] for _, own in files}):
            fs.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(lambda f: fs.move(*f), files))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs as kinds

        fs, root = self._fs()
        if fs.get_file_info(f"{root}/{TEMPORARY}/{self.run}").type != kinds.FileType.NotFound:
            fs.delete_dir(f"{root}/{TEMPORARY}/{self.run}")
        if fs.get_file_info(f"{root}/{TEMPORARY}").type != kinds.FileType.NotFound and not fs.get_file_info(kinds.FileSelector(f"{root}/{TEMPORARY}")):
            fs.delete_dir(f"{root}/{TEMPORARY}")


class NamedFiles(DataSource):
    """Rows of file (below the path) and value, in the order of the file."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def write_files(rows: DataFrame, path: str, file: Column, value: Column, order: list[Column] | None = None) -> None:
    """Each ``file`` below ``path`` with the ``value`` of its rows, one behind the other."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    places = [f"_{i}" for i in range(len(order or []))]
    dealt = rows.select(file.alias("file"), value.alias("value"), *(c.alias(p) for c, p in zip(order or [], places, strict=True)))
    dealt = dealt.where("file IS NOT NULL").repartition("file").sortWithinPartitions("file", *places).select("file", "value")
    dealt.write.format("named_files").mode("append").option("path", python_uri(spark, path)).save()
