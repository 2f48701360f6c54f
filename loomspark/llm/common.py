"""What the operators share: settled tables, bounded Arrow batches, membership gates and components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text that a Python worker handles at a time, and the characters after which a slice ends early.
SLICE_ROWS, SLICE_CHARS = 256, 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only in a local session that names none (tests) is one made."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    there = spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomspark-"))
        there = spark.sparkContext.getCheckpointDir()
    return there.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it again: its lineage ends there, and a lost
    executor costs a read, not the work before it. Column pruning still reaches the files."""
    at = f"{shared_dir(df.sparkSession)}/loomspark/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def discard(df: DataFrame) -> None:
    """Deletes the files of a settled table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that they need no path of the driver's."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).parents[1]
        at = Path(tempfile.mkdtemp(prefix="loomspark-")) / f"{package.name}.zip"
        with zipfile.ZipFile(at, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(at))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds the Arrow batches that go to Python by rows and bytes, as texts may be very long."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def give_back() -> None:
    """Returns free memory to the system: Python workers live on after a task, beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not every C library has it


def slices(batch: pa.RecordBatch, text: str, rows: int = SLICE_ROWS, chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their texts (null: empty), each of bounded rows and characters."""
    texts = ["" if x is None else x for x in batch.column(text).to_pylist()]
    start = total = 0
    for i, x in enumerate(texts):
        total += len(x)
        if i + 1 - start >= rows or total >= chars or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, total = i + 1, 0


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _gate(df: DataFrame, keys: DataFrame, on: list[str], bits: int) -> Column:
    """Whether the bit of ``on`` is set in a bit map of 2**bits bits (1 MB at 23, whatever the size of ``keys``), which
    reaches the scan as a scalar subquery."""
    words = (1 << bits) // 64
    spot = F.pmod(F.xxhash64(*on), F.lit(1 << bits))
    word, bit = F.shiftright(spot, 6).cast("int"), F.pmod(spot, F.lit(64)).cast("int")
    ones = keys.select(word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    dense = (
        df.sparkSession.range(0, words, 1, 1)
        .join(ones, F.col("id") == F.col("w"), "left")
        .agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("all"))
        .select(F.transform("all", lambda x: x["b"]).alias("gate"))
    )
    return F.getbit(F.element_at(dense.scalar(), word + 1), bit) == 1


def member_gate(df: DataFrame, keys: DataFrame, on: list[str], bits: int = 23) -> DataFrame:
    """``df`` less most rows whose ``on`` is not in ``keys``; false members may stay, true ones always do.

    Wide rows are dropped before they are shuffled. A full map only stops saving work: an exact join has to follow.
    """
    return df.where(_gate(df, keys, on, bits))


def without(df: DataFrame, keys: DataFrame, on: list[str], made: dict[str, Column] | None = None, bits: int = 24) -> DataFrame:
    """``df`` less the rows whose ``on`` is in ``keys`` (nulls are equal to each other). Only rows whose bit is set in a
    map of ``keys`` take part in the join, so that texts of the others are not exchanged. Columns of ``on`` that ``df`` doesn't
    have are ``made`` for these rows only."""
    made = made or {}
    passes = _gate(df, keys, [c for c in on if c not in made], bits)
    listed = keys.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(on)))
    some = df.where(passes).withColumns(made) if made else df.where(passes)
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & some[c].eqNullSafe(listed[f"_{i}"])
    return df.where(~passes).unionByName(some.join(listed, same, "left_anti").select(*df.columns))


def stars(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 40) -> DataFrame:
    """Connected components: (node, root) for every node of ``edges``, root the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) over settled edge tables until nothing
    changes. A hot node is met by aggregation with partial sums and by joins that adaptive execution can split;
    no group of neighbours is ever gathered in one task.
    """
    e = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(most_rounds):
        for large in (True, False):
            near = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
            low = near.groupBy("u").agg(F.min("v").alias("m")).select(F.expr("u + 0L").alias("u"), F.least("u", "m").alias("m"))
            new = near.join(low, "u").where("v > u" if large else "true").select(F.col("v").alias("x"), "m")
            if not large:
                new = new.union(low.select(F.col("u").alias("x"), "m"))
            e = new.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        e = settle(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


#: Links up to which components are found in one task; 16 bytes each.
SMALL_GRAPH = 1 << 19


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) as ``stars`` gives them. A graph of at most ``SMALL_GRAPH`` links, counted first, fits one task; any
    larger one goes through the distributed rounds."""
    if links.count() > SMALL_GRAPH:
        return stars(links, a, b)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = top(x), top(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        if up:
            yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([top(x) for x in list(up)], pa.int64())], names=["node", "root"])

    ship(links.sparkSession)
    return links.select(a, b).coalesce(1).mapInArrow(rows, "node long, root long")


def is_held_out(key: str, parts: int, part: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts)) == part


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and label (0 or 1) of at most ``most`` labelled rows of ``docs`` for which ``learn`` holds.

    The bound makes the chosen ids small enough to broadcast. Which rows they are depends on the ids' hashes alone.
    Of labels that contradict each other the smaller one counts; ids and labels that are null don't count.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & learn).groupBy(id_col).agg(F.min(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(most).select(F.col(id_col).alias("_id"), "y")
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "text", "y")
