"""Fill-in-middle: a text cut at two units and written as prefix, suffix and middle."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.batches import cut, raw_texts, text_array

BLOCK = 4096
#: Blocks that are looked at together while counting.
TOGETHER = 256
MARKS = ("<P>", "<S>", "<M>")

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _ends(raw: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Where units end in a stretch of UTF-8: at a word's last byte, and at the text's last byte."""
    blank = _BLANK[raw[start: stop + 1]]
    found = np.empty(stop - start, dtype=bool)
    found[: len(blank) - 1] = blank[1:] & ~blank[:-1]
    if stop == len(raw):
        found[-1] = True
    return found


def _points(raw: np.ndarray) -> np.ndarray:
    """Where code points start."""
    return (raw & 0xC0) != 0x80


class BlockTree:
    """Fenwick tree over the fixed blocks of a text, with its counts of units and of code points."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.raw, self.block = np.frombuffer(text, dtype=np.uint8), block
        n = -(-len(text) // block)
        self.units, self.points = [0] * (n + 1), [0] * (n + 1)
        for first in range(0, n, TOGETHER):
            start, stop = first * block, min(len(text), (first + TOGETHER) * block)
            at = np.arange(0, stop - start, block)
            for sums, marks in ((self.units, _ends(self.raw, start, stop)), (self.points, _points(self.raw[start:stop]))):
                sums[first + 1: first + 1 + len(at)] = np.add.reduceat(marks, at, dtype=np.int64).tolist()
        self.total = sum(self.units)
        for i in range(1, n + 1):
            above = i + (i & -i)
            if above <= n:
                self.units[above] += self.units[i]
                self.points[above] += self.points[i]

    def after(self, count: int) -> tuple[int, int]:
        """Byte and code point right after the first ``count`` units (0 to ``total``)."""
        if not count:
            return 0, 0
        n, at, points = len(self.units) - 1, 0, 0
        step = 1 << n.bit_length()
        while step := step >> 1:
            if at + step <= n and self.units[at + step] < count:
                at += step
                count -= self.units[at]
                points += self.points[at]
        start = at * self.block
        stop = min(len(self.raw), start + self.block)
        inside = int(np.flatnonzero(_ends(self.raw, start, stop))[count - 1]) + 1
        return start + inside, points + int(_points(self.raw[start: start + inside]).sum())


def draws(seed: int, key: str | None) -> tuple[int, ...]:
    """Four numbers below 2**32 from the SHA-256 of ``seed:key``."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{key or ''}".encode()).digest()[:16])


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80,
    marks: tuple[str, str, str] = MARKS, block: int = BLOCK,
) -> DataFrame:
    """Cut each document (``doc_id``, ``text``) into prefix, middle and suffix of whole units and write it in one form.

    A unit is a word with the blanks before it, or the blanks that end the text.
    Of each hundred documents ``percent`` are cut, ``spm_percent`` of these with the
    suffix first (``spm``), the others with the prefix first (``psm``); the choice
    and the cuts depend on ``seed`` and ``doc_id`` alone. Gives ``doc_id``, ``n``
    units, ``form``, ``prefix_chars`` and ``middle_chars`` in code points and
    ``output``; ``restored`` takes it back.

    A null text is empty; empty texts and texts that hold a mark stay ``plain``,
    with null lengths. A null id draws as an empty one. Equal ids draw alike, so
    repeated rows give repeated rows. Extra columns are left out; an empty table
    gives no rows. A row needs its own text and a few numbers per block, however
    long the text is.
    """
    first, second, third = (m.encode() for m in marks)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def one(text: bytes, key: str | None) -> tuple:
        tree = BlockTree(text, block)
        h = draws(seed, key)
        if not text or h[2] % 100 >= percent or any(m in text for m in (first, second, third)):
            return tree.total, "plain", None, None, text
        (a, before), (b, upto) = (tree.after(k) for k in sorted((h[0] % (tree.total + 1), h[1] % (tree.total + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < spm_percent:
            return tree.total, "spm", before, upto - before, b"".join((second, suffix, first, prefix, third, middle))
        return tree.total, "psm", before, upto - before, b"".join((first, prefix, second, suffix, third, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            keys = batch.column("key").to_pylist()
            n, form, before, inside, output = zip(*map(one, raw_texts(batch, "text"), keys))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                 pa.array(inside, pa.int64()), text_array(output)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), "text").mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text as it was: a text with a mark is never cut, so the marks in an output are the written ones."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    prefix, suffix = (F.when(form == "psm", parts[a]).otherwise(parts[b]) for a, b in ((1, 2), (2, 1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
