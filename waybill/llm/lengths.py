"""Token counts: the exact histogram of encoded lengths, and what suffix sums tell from it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import written
from waybill.llm.tokens import VOCABULARY, encoder

BLOCK = 4096


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, added: bool = False) -> DataFrame:
    """``length`` of every document's ``text`` in ids; 0 for a null or empty one."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(vocabulary, added)
        for batch in batches:
            yield pd.DataFrame({"length": [len(ids_of(t)) if t else 0 for t in batch["text"]]}, dtype="int64")

    return docs.select("text").mapInPandas(count, "length long")


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY, added: bool = False) -> DataFrame:
    """A row per encoded length, over all rows of ``docs``, with sums over the longer ones.

    ``docs`` and ``tokens`` of that length; ``docs_longer`` and ``tokens_longer``
    beyond it; and for a context limit of that length ``tokens_kept``, the total
    after truncation, and ``tokens_cut``. Repeated rows count each; an empty
    table gives no rows. Sums run inside blocks of lengths and then over the
    blocks' totals, so no task needs all lengths.
    """
    counted = token_lengths(docs, vocabulary, added).groupBy("length").agg(F.count(F.lit(1)).alias("docs"))
    counted = counted.withColumns({"tokens": F.col("length") * F.col("docs"), "block": F.floor(F.col("length") / BLOCK)})
    counted = written(counted, "lengths")  # used twice below; texts are encoded once
    after = lambda by, order: Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    later = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    blocks = counted.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    whole = after([], "block")
    blocks = blocks.select(
        "block", later("d", whole).alias("far_docs"), later("t", whole).alias("far_tokens"),
        F.sum("t").over(Window.partitionBy()).alias("all_tokens"))
    near = after(["block"], "length")
    out = counted.withColumns({"near_docs": later("docs", near), "near_tokens": later("tokens", near)}).join(blocks, "block")
    longer, beyond = F.col("near_docs") + F.col("far_docs"), F.col("near_tokens") + F.col("far_tokens")
    return out.select(
        "length", "docs", "tokens", longer.alias("docs_longer"), beyond.alias("tokens_longer"),
        (beyond - longer * F.col("length")).alias("tokens_cut"),
        (F.col("all_tokens") - beyond + longer * F.col("length")).alias("tokens_kept"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents cut by it, tokens kept and tokens cut. Limits are a short list."""
    size = lambda n: F.sum(F.least(F.col("length"), F.lit(n)) * F.col("docs"))
    over = lambda n: F.sum(F.when(F.col("length") > n, F.col("docs")).otherwise(0))
    rows = F.array(*[
        F.struct(F.lit(n).cast("long").alias("context"), over(n).alias("docs_cut"), size(n).alias("tokens_kept"),
                 (F.sum("tokens") - size(n)).alias("tokens_cut"))
        for n in limits
    ])
    return histogram.agg(rows.alias("r")).select(F.inline("r"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """Per share, the least length that at least that share of the documents doesn't exceed."""
    total = histogram.agg(F.sum("docs")).first()[0] or 0
    within = F.lit(total) - F.col("docs_longer")
    rows = F.array(*[
        F.struct(F.lit(float(q)).alias("share"), F.min(F.when(within >= q * total, F.col("length"))).alias("length"))
        for q in shares
    ])
    return histogram.agg(rows.alias("r")).select(F.inline("r"))
