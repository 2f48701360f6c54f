"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local session that names none (tests) gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    there = named or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomspark-"))
        there = spark.sparkContext.getCheckpointDir()
    return there.rstrip("/")


#: Whether Spark deletes the files of a query's exchanges as it ends; else they stay until the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """Writes ``df`` and reads it again: what it took to make is done once, however often the result is used, and a lost
    executor costs a read. Column pruning still reaches the files. The exchanges it took are deleted, as nothing reads them again."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/loomspark-tables/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(at)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(at)


def discard(df: DataFrame) -> None:
    """Deletes the files of a settled table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds the Arrow batches that go to Python by rows and bytes, as texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


#: Bytes of files from which a task has its rows: what it sorts and counts then doesn't grow with the input.
DEALT = 4 << 20


def shares(df: DataFrame) -> int:
    """How many partitions ``df`` is worth, by the bytes of the files that it is read from; no fewer than shuffles have."""
    spark, size = df.sparkSession, 0
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // DEALT))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, which is evaluated once a row, however often later expressions use it: a projection would
    be merged into theirs, a generator of one row isn't."""
    return df.select("*", F.explode(F.array(value)).alias(name))


#: Bits of a map of members, as a power of two: least and most (16 MB).
LEAST_BITS, MOST_BITS = 16, 27


def _marked(df: DataFrame, keys: DataFrame, on: list[str]) -> Column:
    """Whether the bit of a row's ``on`` is set in the bit map of the settled table ``keys``."""
    n = keys.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (8 * n).bit_length()))
    spot = F.pmod(F.xxhash64(*on), F.lit(1 << bits))
    word, bit = F.shiftright(spot, 6).cast("int"), F.pmod(spot, F.lit(64)).cast("int")
    ones = keys.select(word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    all_words = df.sparkSession.range(0, (1 << bits) // 64, 1, 1).join(ones, F.col("id") == F.col("w"), "left")
    whole = all_words.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("all")).select(F.transform("all", lambda x: x["b"]).alias("map"))
    return F.getbit(F.element_at(whole.scalar(), word + 1), bit) == 1


def members(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``df`` less most rows whose ``on`` is not in the settled table ``keys``: a join with it has to follow, but exchanges few
    rows. A bit map of eight bits a key reaches the scan as one value; beyond 16 MB of it fewer rows are left out, none wrongly."""
    return df.where(_marked(df, keys, on))


def without(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The settled table ``df`` less the rows whose ``on`` is in the settled table ``keys``: only rows whose bit is set are
    exchanged, the others are read and passed on."""
    marked = _marked(df, keys, on)
    return df.where(~marked).unionByName(df.where(marked).join(keys, on, "left_anti"))


#: Bytes of a core's share of a table below which its rows are dealt anew.
SHARE = 4 << 20


def read_table(spark: SparkSession, at: str, name: str) -> DataFrame:
    """The table ``name`` of the directory ``at``. A table that is small for the cores there are, as one of a single row group,
    is dealt over them, so that not one of them does all the work; larger ones are read as they are."""
    path = f"{at}/{name}.parquet"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = there.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(there).getLength()
    table, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    return table.repartition(cores) if size < cores * SHARE else table
