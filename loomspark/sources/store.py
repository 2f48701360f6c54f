"""The store of ingested documents: chunks, graph tables, vectors and the status of documents, in committed batches.

Each batch writes its tables to folders of its own. It counts once a manifest names it: a file per version that lists all batches,
put in place by one rename that fails where the version is there already. Readers take the newest manifest and only the folders of
its batches, so that what a failed run has left, or a running one is writing, is never read, and a table read stays as it was while
others write. Of two writers at once the second finds its version taken: if the first one's documents are others it commits after
it, else it leaves its batch and adds what is still new. Folders that no manifest names are deleted by ``vacuum``.

The folder needs renames that don't replace what is there (HDFS and its like, or one machine's file system)."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import graph, ingest

MANIFESTS = "_manifests"
#: Writers that take a version one after the other before one gives up.
TRIES = 100


@dataclass(frozen=True)
class View:
    """What is committed: a version and its batches, with the tables that each has."""

    version: int = 0
    batches: dict[str, list[str]] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _said(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str) -> bool:
    """Writes ``text`` at ``path`` as a whole, or nothing and False where something is."""
    fs, at = _fs(spark, path)
    beside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    _, temporary = _fs(spark, beside)
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":  # this file system's renames replace
            local = lambda p: fs.makeQualified(p).toUri().getPath()
            os.link(local(temporary), local(at))
            return True
        jvm = spark._jvm
        none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(temporary, at, none)
        return True
    except FileExistsError:
        return False
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        return False
    finally:
        fs.delete(temporary, False)


def view(spark: SparkSession, store: str) -> View:
    """The newest version."""
    names = [n for n in _names(spark, f"{store}/{MANIFESTS}") if n.startswith("v")]
    if not names:
        return View()
    newest = max(names)
    return View(int(newest[1:].split(".")[0]), json.loads(_said(spark, f"{store}/{MANIFESTS}/{newest}"))["batches"])


def publish(spark: SparkSession, store: str, now: View) -> bool:
    """Makes ``now`` the newest version, or returns False if another writer has made that version."""
    fs, at = _fs(spark, f"{store}/{MANIFESTS}")
    fs.mkdirs(at)
    return _put(spark, f"{store}/{MANIFESTS}/v{now.version:012d}.json", json.dumps({"batches": now.batches}))


def stored(spark: SparkSession, store: str, table: str, at: View | None = None) -> DataFrame | None:
    """A table of the store as the newest version (or ``at``) has it, or none where no batch has it."""
    batches = (at or view(spark, store)).batches
    paths = [f"{store}/{table}/batch={b}" for b, tables in batches.items() if table in tables]
    return spark.read.parquet(*paths) if paths else None


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


class Batch:
    """Tables of a batch that isn't committed yet, which is read as it was written."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store, self.id, self.tables = spark, store, uuid.uuid4().hex, []

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        at = f"{self.store}/{table}/batch={self.id}"
        _write(rows, at)
        self.tables.append(table)
        return self.spark.read.schema(rows.schema).parquet(at)

    def leave(self) -> None:
        """Deletes what was written."""
        for table in self.tables:
            fs, at = _fs(self.spark, f"{self.store}/{table}/batch={self.id}")
            fs.delete(at, True)


def graph_tables(chunks: DataFrame, batch: Batch) -> None:
    """Entities by their patterns and relations of those that follow each other."""
    short = batch.write("entities", graph.extracted(chunks))
    found, relations = graph.mentions(short), graph.extracted_relations(short)
    for table, rows in (("nodes", graph.node_table(found)), ("edges", graph.edge_table(relations)), ("node_chunk", found)):
        batch.write(table, rows)


def add(docs: DataFrame, store: str, chunker: Callable[[DataFrame], DataFrame], with_graph: bool = True, graph_of: Callable[[DataFrame, Batch], None] = graph_tables) -> int:
    """Adds the documents (doc_id, text) that the store doesn't have, as one batch; returns how many. ``graph_of`` writes the
    graph tables of the chunks. Nothing of a batch is read before all of it is written."""
    spark = docs.sparkSession
    docs = docs.dropDuplicates(["doc_id"])
    for _ in range(TRIES):
        before = view(spark, store)
        done = stored(spark, store, "doc_status", before)
        new = (docs if done is None else ingest.not_yet_ingested(docs, done)).persist()
        batch = Batch(spark, store)
        try:
            n = new.count()
            if not n:
                return 0
            chunks = batch.write("chunks", chunker(new))
            if with_graph:
                graph_of(chunks, batch)
            status = batch.write("doc_status", ingest.doc_status(new, chunks))
            if _committed(spark, store, batch, before, status):
                return n
            batch.leave()
        finally:
            new.unpersist()
    raise RuntimeError(f"{TRIES} other writers added the same documents")


def _committed(spark: SparkSession, store: str, batch: Batch, before: View, status: DataFrame) -> bool:
    """Commits a batch after those of other writers; False if one of these has a document of it."""
    for _ in range(TRIES):
        if commit(spark, store, batch, before):
            return True
        now = view(spark, store)
        others = View(now.version, {b: t for b, t in now.batches.items() if b not in before.batches})
        theirs = stored(spark, store, "doc_status", others)
        if theirs is not None and not status.select("doc_id").join(theirs.select("doc_id"), "doc_id", "left_semi").isEmpty():
            return False
        before = now
    raise RuntimeError(f"{TRIES} other writers took the versions after {before.version}")


def commit(spark: SparkSession, store: str, batch: Batch, before: View) -> bool:
    """Commits a batch as the version after ``before``, or returns False where that is taken."""
    return publish(spark, store, View(before.version + 1, before.batches | {batch.id: batch.tables}))


def compact(spark: SparkSession, store: str) -> View:
    """Writes the tables of all batches as one batch, which takes their place in the next version; batches that others commit
    meanwhile stay beside it."""
    before = view(spark, store)
    batch = Batch(spark, store)
    for table in sorted({t for tables in before.batches.values() for t in tables}):
        batch.write(table, stored(spark, store, table, before))
    now = before
    for _ in range(TRIES):
        rest = {b: t for b, t in now.batches.items() if b not in before.batches}
        gone = [b for b in before.batches if b not in now.batches]
        if gone:  # another one has put batches together
            batch.leave()
            return now
        new = View(now.version + 1, {batch.id: batch.tables} | rest)
        if publish(spark, store, new):
            return new
        now = view(spark, store)
    raise RuntimeError(f"{TRIES} other writers took the versions after {before.version}")


def vacuum(spark: SparkSession, store: str, older_s: float = 7 * 86400, versions: int = 10) -> int:
    """Deletes folders of batches that the last ``versions`` manifests don't name and that weren't written to for ``older_s``
    seconds (longer than any run takes, as a running batch isn't named yet), and older manifests; returns how many folders."""
    names = sorted(n for n in _names(spark, f"{store}/{MANIFESTS}") if n.startswith("v"))
    named = {b for n in names[-versions:] for b in json.loads(_said(spark, f"{store}/{MANIFESTS}/{n}"))["batches"]}
    for n in names[:-versions]:
        fs, at = _fs(spark, f"{store}/{MANIFESTS}/{n}")
        fs.delete(at, False)
    deleted = 0
    for table in _names(spark, store):
        for name in _names(spark, f"{store}/{table}") if not table.startswith("_") else ():
            fs, at = _fs(spark, f"{store}/{table}/{name}")
            old = time.time() - fs.getFileStatus(at).getModificationTime() / 1000 >= older_s
            if name.startswith("batch=") and name.removeprefix("batch=") not in named and old:
                fs.delete(at, True)
                deleted += 1
    return deleted
