"""Session helpers: shared folder, driver-side checks, size-checked joins."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A registry above this size is joined by a salted shuffle instead of a broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="waybill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def shared_file(spark: SparkSession, folder: str, text: str, suffix: str) -> str:
    """Write a small text under a name made from its hash; return the full path.

    The name changes with the text, so executors never see a stale copy.
    """
    name = hashlib.sha256(text.encode("utf-8")).hexdigest()[:32]
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{folder}/{name}{suffix}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        part = jvm.org.apache.hadoop.fs.Path(f"{target.toString()}.{jvm.java.util.UUID.randomUUID()}")
        out = fs.create(part, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if not fs.rename(part, target):
            fs.delete(part, False)
            if not fs.exists(target):
                raise OSError(f"cannot write {target.toString()}")
    return target.toString()


def measured_bytes(df: DataFrame) -> int:
    """Size of a small table, measured by one aggregate over its text form."""
    size = sum((F.octet_length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in df.columns), F.lit(0))
    row = df.agg(F.sum(size.cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(row["b"] or 0) + 16 * int(row["n"])


def one_per_key(right: DataFrame, key: str) -> DataFrame:
    """One row per key: equal rows collapse, and of different ones the greatest stays."""
    rest = [c for c in right.columns if c != key]
    return right.groupBy(key).agg(F.max(F.struct(*rest)).alias("__kept")).select(key, *[f"__kept.{c}" for c in rest])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it back, so that what follows starts there."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Parts that a share of a heavy key is cut into, so that they even out over the tasks; in all at most so many a task.
PARTS = 16


def heavy_keys(df: DataFrame, key: str) -> dict[str | None, int]:
    """How many salts each key gets, for keys with more rows than one task's share: ``PARTS`` per share.

    One pass over the key column alone, by a heavy-hitter summary of fixed size: a key
    that has more than a share can't be missed, and there are no more of those than
    tasks. A stream can't be measured beforehand and has none.
    """
    if df.isStreaming:
        return {}
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(1_000_000, max(1_000, 16 * tasks))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {min(tasks + 1, most)}, {most})").alias("top")).first()
    share = max(1, -(-row["n"] // tasks))
    return {k: -(-PARTS * n // share) for k, n in row["top"] if n > share}


def salted_join(left: DataFrame, right: DataFrame, key: str, salt_by: Column) -> DataFrame:
    """Left join by a shuffle on ``key`` (a text), where each heavy key spreads over as many tasks as its rows ask for.

    ``right`` holds a key once and is repeated once per salt of a heavy key only;
    rows without a key, which find nothing, spread alike.
    """
    heavy = heavy_keys(left, key)
    if not heavy:
        return left.join(right, key, "left")
    spark = left.sparkSession
    # At most a row per task.
    known = spark.createDataFrame([(k, n) for k, n in heavy.items() if k is not None], f"`{key}` string, __salts int")
    missing = F.when(F.col(key).isNull(), F.lit(heavy.get(None, 1))).otherwise(F.lit(1))
    salts = F.coalesce(F.col("__salts"), missing)
    spread = left.join(F.broadcast(known), key, "left").withColumn("__salt", F.pmod(F.xxhash64(salt_by), salts).cast("int")).drop("__salts")
    copies = right.join(F.broadcast(known), key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    return spread.join(copies, [key, "__salt"], "left").drop("__salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    size: int | None = None,
    limit: int = BROADCAST_BYTES,
    salt_by: Column | None = None,
) -> DataFrame:
    """Left join of a big table to a registry; of several rows of a ``key`` one counts (``one_per_key``).

    ``right`` is broadcast when its measured size is within ``limit``. Beyond
    that both sides shuffle, and keys that are heavy on the left are salted by
    their measured counts (``salted_join``).
    """
    size = measured_bytes(right) if size is None else size
    right = one_per_key(right, key)
    if size <= limit:
        return left.join(F.broadcast(right), key, "left")
    return salted_join(left, right, key, F.struct(*left.columns) if salt_by is None else salt_by)


# Spark packs files below this size into shared splits.
SPLIT_BYTES = 4 * 1024 * 1024
# Rows of files that a task gets, about; splits of up to twice as many stay as they are.
TASK_ROWS = 50_000


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Deal out the rows of an input whose splits are too few or too uneven.

    A file may hold a million rows in one block that does not split, and the estimated size of a
    join says nothing. So the rows of each split are counted, by a pass that reads no columns of a
    table, and those of files get tasks of ``TASK_ROWS`` rows, one per core at least.
    Rows that come from no files are dealt out if they are estimated below one small split per core.
    Files whose splits hold ``least`` rows at most stay as they are.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not len(df._jdf.inputFiles()):
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        return df.repartition(cores) if size <= cores * SPLIT_BYTES else df
    held = df.groupBy(F.spark_partition_id().alias("split")).count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    rows, most = held["n"] or 0, held["most"] or 0
    tasks = max(cores, -(-rows // TASK_ROWS))
    return df.repartition(tasks) if most > max(least, 2 * -(-rows // tasks)) else df
