"""Packing token pieces into sequences by minimum bin slack over the histogram of their lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import numbered, written
from waybill.llm.tokens import END, VOCABULARY, encoder

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, capacity: int = 2048, with_ids: bool = False, vocabulary: str = VOCABULARY, added: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids per document (``doc_id``, ``text``): full ones from the start, then the rest.

    A document's ids end with ``END``; a null text counts as empty, so each document has a piece.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, end = encoder(vocabulary, added), np.array([END], dtype="<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.concatenate([ids_of(text), end]) if text else end
                for start in range(0, len(ids), capacity):
                    raw = ids[start:start + capacity].tobytes()
                    rows.append((doc_id, start, len(raw) // 4, zlib.crc32(raw), len(ids)) + ((raw,) if with_ids else ()))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(cut, PIECE + ", ids binary" * with_ids)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum comes closest to ``room`` from below.

    Reachable sums are the bits of an integer. Lengths enter from the longest
    on, until the room is filled; the counts are then read back step by step.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        before = reach
        for _ in range(min(counts[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            reach = wider
        steps.append((length, before))
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            used[length] = used.get(length, 0) + 1
            total -= length
    return used


def fill_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Fills for the whole histogram: rows (length, first rank, end rank, per sequence, first sequence, offset), and the sequences' number.

    Each fill takes the longest length left and the multiset that leaves the
    least slack beside it, as often as the counts allow. So each fill uses up a
    length, and there are at most as many fills as lengths, whatever the counts.
    """
    left = {length: n for length, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    rows, sequences = [], 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = best_fill(rest, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[length] // k for length, k in used.items())
        offset = 0
        for length, k in sorted(used.items(), reverse=True):
            rows.append((length, rank[length], rank[length] + k * times, k, sequences, offset))
            offset += k * length
            rank[length] += k * times
            left[length] -= k * times
            if not left[length]:
                del left[length]
        sequences += times
    return rows, sequences


def packed(docs: DataFrame, capacity: int = 2048, with_ids: bool = False, vocabulary: str = VOCABULARY, added: bool = False) -> DataFrame:
    """All documents (``doc_id``, ``text``) packed: a row per piece with ``sequence_id`` (from 0) and ``offset`` in it.

    The driver gets the histogram of piece lengths, at most ``capacity`` rows,
    and plans by minimum bin slack. Pieces of one length are alike, so a piece's
    number among those of its length tells its place. The plan has at most
    ``capacity`` fills of under sqrt(2 * capacity) lengths each and is broadcast.
    Repeated rows are packed each for itself; null ids stay null; extra columns
    are left out; an empty table gives no rows.
    """
    pieces = written(cut_pieces(docs, capacity, with_ids, vocabulary, added), "pieces")
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    rows, _ = fill_plan(counts, capacity)
    plan = docs.sparkSession.createDataFrame(
        rows, "length long, first long, past long, per long, sequence long, place long")
    ranked = numbered(pieces, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"], "rank").alias("p")
    at = F.col("rank") - F.col("first")
    return ranked.join(
        F.broadcast(plan.alias("f")), F.expr("p.length = f.length and p.rank >= f.first and p.rank < f.past")
    ).select(
        "p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens",
        (F.col("sequence") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(at, F.col("per")) * F.col("p.length")).cast("long").alias("offset"),
        *(["p.ids"] if with_ids else []),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """Token sequences as binary little-endian ids, from ``packed(..., with_ids=True)``; at most one capacity of ids a row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"),
        F.sum("length").alias("tokens"))
