"""Helpers shared by the corpus operators: words, shared tables, gapless numbers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the characters that separate words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it back: later steps, and tasks that run again, start there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys that are broadcast at most, where they have been counted.
SMALL_ROWS = 500_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of keys that was counted and is small; a larger one is joined by a shuffle."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't use."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body).getItem(0)


def scan(values: Column, zero: Column, kind: str, step, block: int = 64) -> Column:
    """The state after each element of an array: ``step(state before, element)``, of type ``kind``.

    States are gathered block by block, so an array of n elements costs about
    n * block + (n / block) ** 2 copies, not n ** 2.
    """
    none, nested = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")
    state = lambda last, out: F.struct(last.cast(kind).alias("last"), out.alias("out"))

    def inside(acc: Column, x: Column) -> Column:
        return let(step(acc["last"], x).cast(kind), lambda s: state(s, F.concat(acc["out"], F.array(s))))

    def outside(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, state(acc["last"], none), inside)
        return let(done, lambda d: state(d["last"], F.concat(acc["out"], F.array(d["out"]))))

    def whole(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda b: F.slice(v, b * block + 1, F.lit(block)))
        return F.when(F.size(v) > 0, F.flatten(F.aggregate(parts, state(zero, nested), outside, lambda acc: acc["out"]))).otherwise(none)

    return let(values, whole)


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(df: DataFrame, group: str, order: list[str], out: str, rows_per_task: int = 100_000) -> DataFrame:
    """Number the rows of each group from 0 without a gap, however large a group is.

    A group is cut into buckets by a hash of ``order``. Buckets are numbered by
    themselves, each behind the rows of those before it, so no task sorts more
    than about ``rows_per_task`` rows, unless more than that are equal in ``order``.
    """
    total = df.count()
    buckets = max(1, -(-total // rows_per_task))
    mark = F.xxhash64(*[F.col(c) for c in order])
    cut = df.withColumn("__bucket", F.pmod(mark, F.lit(buckets)).cast("int"))
    sizes = cut.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    ranked = cut.withColumn("__rank", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, [group, "__bucket"])
        .withColumn(out, (F.col("__start") + F.col("__rank")).cast("long"))
        .drop("__bucket", "__rank", "__start")
    )
