"""Shards by a k-d tree: split at weighted medians along the widest metadata dimension."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import few, numbered, written

BINS = 256


class Search(NamedTuple):
    """The search for one node's median: first along the dimension, then along the tie mark."""

    dim: int
    leaves: int
    wanted: float
    below: float = 0.0
    value: float | None = None  # found along the dimension
    lo: float = 0.0
    hi: float = 0.0
    mark: float | None = None  # found along the tie mark
    left: bool = True  # whether rows on the mark go left


#: Numbers beyond count as this, infinite ones too, so that differences stay finite.
FAR = 1e300
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def number(value: Column) -> Column:
    """A number as a coordinate; null and what is no number are -1."""
    plain = F.coalesce(F.nanvl(value.cast("double"), F.lit(-1.0)), F.lit(-1.0))
    return F.greatest(F.lit(-FAR), F.least(F.lit(FAR), plain))


def text_ranks(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Distinct values of a column, as text, with their rank in byte order, and how many there are.

    Values are sorted range by range and each range numbered behind those before
    it; the driver gets a count per range.
    """
    values = df.select(F.col(name).cast("string").alias(name)).where(F.col(name).isNotNull()).distinct()
    parts = written(values.repartitionByRange(name).withColumn("part", F.spark_partition_id()), "values")
    starts, total = [], 0
    for r in sorted(parts.groupBy("part").count().collect()):
        starts.append((r["part"], total))
        total += r["count"]
    before = df.sparkSession.createDataFrame(starts, "part int, start long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(name))
    ranked = parts.withColumn("inside", inside).join(F.broadcast(before), "part")
    return ranked.select(name, (F.col("start") + F.col("inside") - 1).cast("double").alias("rank")), total


def kd_shards(
    docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None, text: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row, in ``shards`` leaves or as many as ``target_bytes`` asks for.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1, checksum 0). Each
    level of the tree finds, for all its nodes at once, the dimension that is
    widest against its width in the whole table, and the weighted median in it:
    sizes are summed in bins, the bin of the median is binned anew, until one
    value is left. Rows that share this value, such as a hot source, are split by
    a hash of id and text in the same way; only rows equal in both stay
    together. Texts count by the rank of their distinct values, so no two are
    taken for one; infinite numbers count as very large ones, null and NaN as -1.
    The driver keeps a few numbers per shard. Only ids,
    dimensions and sizes are shuffled, never texts. ``slot`` numbers a shard's
    rows from 0. Null ids are allowed; an empty table gives no rows.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    mark = (F.pmod(F.xxhash64("doc_id", F.col(f"`{text}`")), F.lit(1 << 52)) / F.lit(float(1 << 52))).alias("m")
    kinds = dict(docs.dtypes)
    texts = [f"x{i}" for i, d in enumerate(dims) if kinds[d] not in _NUMBERS]
    rows = written(
        docs.select(
            "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"), mark, F.lit(0).alias("node"),
            *[(F.col(f"`{d}`").cast("string") if kinds[d] not in _NUMBERS else number(F.col(f"`{d}`"))).alias(f"x{i}") for i, d in enumerate(dims)],
        ), "rows")
    for x in texts:
        ranks, count = text_ranks(rows, x)
        rows = rows.join(few(ranks, count), x, "left").withColumn(x, F.coalesce("rank", F.lit(-1.0))).drop("rank")
    if texts:
        rows = written(rows, "rows")
    spark, n = docs.sparkSession, range(len(dims))
    spans = [f for i in n for f in (F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}"))]
    root = rows.agg(F.sum("size").alias("size"), *spans).first()
    if root["size"] is None:
        shards = 1
    elif shards is None:
        shards = max(1, -(-int(root["size"]) // int(target_bytes)))
    leaves = {0: shards}
    while any(k > 1 for k in leaves.values()):
        found = {}
        for r in rows.groupBy("node").agg(F.sum("size").alias("size"), *spans).collect():
            if (k := leaves[r["node"]]) > 1:
                wide = [(r[f"hi{i}"] - r[f"lo{i}"]) / ((root[f"hi{i}"] - root[f"lo{i}"]) or 1.0) for i in n]
                d = wide.index(max(wide))
                found[r["node"]] = Search(d, k, r["size"] * (k // 2) / k, lo=r[f"lo{d}"], hi=r[f"hi{d}"])
        found = _medians(rows, found)
        table = spark.createDataFrame(
            [(node, s.dim, s.value, s.mark, s.left) for node, s in found.items()],
            "node int, dim int, value double, mark double, on_left boolean")
        x = _chosen(n)
        left = (x < F.col("value")) | ((x == F.col("value")) & (
            (F.col("m") < F.col("mark")) | ((F.col("m") == F.col("mark")) & F.col("on_left"))))
        moved = rows.join(F.broadcast(table), "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node") * 2).otherwise(F.col("node") * 2 + (~left).cast("int")))
        rows = written(moved.drop("dim", "value", "mark", "on_left"), "rows")
        leaves = {
            child: k for node, total in leaves.items()
            for child, k in ([(2 * node, total // 2), (2 * node + 1, total - total // 2)] if total > 1 else [(2 * node, total)])
        }
    names = spark.createDataFrame([(node, i) for i, node in enumerate(sorted(leaves))], "node int, shard int")
    placed = rows.join(F.broadcast(names), "node").select("doc_id", "size", "text_crc32", "m", "shard")
    return numbered(placed, "shard", ["m", "doc_id", "text_crc32", "size"], "slot").drop("m")


def _chosen(n: range) -> Column:
    """The coordinate along the dimension that ``dim`` names."""
    return F.coalesce(*[F.when(F.col("dim") == i, F.col(f"x{i}")) for i in n])


def _medians(rows: DataFrame, found: dict[int, Search]) -> dict[int, Search]:
    """Narrow every node's search until value and mark are known."""
    n = range(sum(c[0] == "x" for c in rows.columns))
    while open_ := {k: s for k, s in found.items() if s.mark is None}:
        table = rows.sparkSession.createDataFrame(
            [(k, s.dim, s.value, s.lo, s.hi) for k, s in open_.items()], "node int, dim int, value double, lo double, hi double")
        x = _chosen(n)
        key = F.when(F.col("value").isNull(), x).when(x == F.col("value"), F.col("m"))
        share = F.when(F.col("hi") > F.col("lo"), (F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
        bins = (
            rows.join(F.broadcast(table), "node").withColumn("key", key).where("key between lo and hi")
            .groupBy("node", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"))
            .agg(F.sum("size").alias("size"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        )
        for node, s in open_.items():
            below = s.below
            mine = sorted((b["bin"], b["size"], b["lo"], b["hi"]) for b in bins if b["node"] == node)
            for _, size, lo, hi in mine:
                if below + size >= s.wanted or (lo, hi) == mine[-1][2:]:
                    break
                below += size
            if lo < hi:
                found[node] = s._replace(below=below, lo=lo, hi=hi)
            elif s.value is None:
                found[node] = s._replace(below=below, value=lo, lo=0.0, hi=1.0)
            else:
                found[node] = s._replace(below=below, mark=lo, left=below + size / 2 <= s.wanted)
    return found
