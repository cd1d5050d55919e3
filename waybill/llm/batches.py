"""Arrow batches inside tasks: texts as UTF-8 bytes, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that a task holds at once, unless one text alone is longer.
BYTES = 8 << 20


def cut(batches: Iterator[pa.RecordBatch], column: str, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of a text column; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def raw_texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The texts as UTF-8; a null is an empty one."""
    for text in batch.column(column).cast(pa.binary()):
        yield text.as_py() or b""


def text_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary()).cast(pa.string())
