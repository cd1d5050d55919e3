"""Substring deduplication: Rabin-Karp hashes of every word window, counted over the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.hashing import Rolling, mixed, word_marks

WIDTH = 20
BATCH_BYTES = 8 << 20
BUCKET_WINDOWS = 2 << 20
# Two bases for windows: a mark has 64 bits from the first and 32 from the second.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
LAST_ID = np.iinfo(np.int64).max

SENT = "bucket int, batch long, blob binary"
SPANS = "array<struct<start:int,end:int>>"
RESULT = f"doc_id long, n_words long, n_removed long, removed {SPANS}, kept_text string"


class Windows:
    """All windows of a batch of documents: two hashes, and the place (id, start) of each."""

    def __init__(self, docs: pd.DataFrame, width: int):
        roll, check = (Rolling(b, width) for b in BASES)
        ids = np.array([LAST_ID if pd.isna(i) else int(i) for i in docs["doc_id"]], dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        self.docs, ids = docs.iloc[order], ids[order]
        self.ordered = len(np.unique(ids)) == len(ids)  # then windows in order of rows are in order of places
        self.words, first, second, starts, sizes = [], [], [], [], []
        for text in self.docs["text"]:
            found, marks = word_marks(text)
            self.words.append(found)
            first.append(roll(marks))
            second.append((check(marks) >> np.uint64(32)).astype(np.uint32))
            starts.append(np.arange(len(first[-1]), dtype=np.uint32))
            sizes.append(len(first[-1]))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        self.hash = mixed(join(first, np.uint64))
        self.check, self.start = join(second, np.uint32), join(starts, np.uint32)
        self.doc = np.repeat(ids, sizes)
        self.sizes = sizes

    def short(self, bits: int) -> np.ndarray:
        """The top ``bits + 32`` bits of the hash: a bucket and 32 bits in it."""
        return self.hash >> np.uint64(32 - bits)


def _parts(values: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Bucket numbers and their slices of sorted short hashes."""
    buckets = (values >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(buckets)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(values)], strict=True):
        if hi > lo:
            yield int(buckets[lo]), slice(lo, hi)


def _frame(rows: list, columns: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in columns.split(", ")])


def _pack(*planes: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte in planes, compressed."""
    raw = b"".join(p.view(np.uint8).reshape(len(p), -1).T.tobytes() for p in planes)
    return zstandard.compress(raw, 1)


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(widths), 0, []
    for kind, w in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at:at + n * w].reshape(w, n).T).view(kind).ravel())
        at += n * w
    return out


PLACED = [np.uint64, np.uint32, np.int64, np.uint32]
MARKED = [np.uint64, np.uint32]


def _spread_hashes(width: int, bits: int):
    """Per batch and bucket: the 32-bit hashes of the windows in it, each once, sorted."""

    def run(docs: pd.DataFrame) -> pd.DataFrame:
        seen = np.unique(Windows(docs, width).short(bits))
        batch = int(docs["batch"].iloc[0]) if len(docs) else 0
        low = (seen & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return _frame([(b, batch, low[s].tobytes()) for b, s in _parts(seen, bits)], SENT)

    return run


def _shared_hashes(sent: pd.DataFrame) -> pd.DataFrame:
    """Per batch, a bit for each of its hashes in this bucket: whether another batch has it too."""
    parts = [np.frombuffer(b, dtype=np.uint32) for b in sent["blob"]]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    same = np.diff(values[order]) == 0
    twice = np.zeros(len(values), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    ends = np.cumsum([len(p) for p in parts])
    rows = [
        (int(bucket), int(batch), np.packbits(bits).tobytes())
        for bucket, batch, bits in zip(sent["bucket"], sent["batch"], np.split(twice, ends[:-1]), strict=True) if bits.any()
    ]
    return _frame(rows, SENT)


def _first_places(w: Windows, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows ``some``, ordered by hash: their order, where runs of one mark begin, and each run's first place."""
    order = some[np.argsort(w.hash[some], kind="stable")]
    h, c = w.hash[order], w.check[order]
    begins = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])) if len(order) else order[:0]
    if w.ordered or not len(order):
        return order, begins, order[begins]
    run = np.repeat(np.arange(len(begins)), np.diff([*begins, len(order)]))
    return order, begins, order[np.lexsort((w.start[order], w.doc[order], run))[begins]]


def _spread_places(width: int, bits: int):
    """Per batch and bucket: full mark and first place of the windows whose short hash other batches have."""

    def run(docs: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        if not len(docs) or not len(flags):
            return _frame([], SENT)
        w, batch = Windows(docs, width), int(docs["batch"].iloc[0])
        seen, where = np.unique(w.short(bits), return_inverse=True)
        shared, told = np.zeros(len(seen), dtype=bool), dict(zip(flags["bucket"], flags["blob"], strict=True))
        for bucket, s in _parts(seen, bits):
            if bucket in told:
                shared[s] = np.unpackbits(np.frombuffer(told[bucket], dtype=np.uint8), count=s.stop - s.start).astype(bool)
        _, _, firsts = _first_places(w, np.flatnonzero(shared[where]))
        rows = [
            (b, batch, _pack(w.hash[i], w.check[i], w.doc[i], w.start[i]))
            for b, s in _parts(w.short(bits)[firsts], bits) for i in [firsts[s]]
        ]
        return _frame(rows, SENT)

    return run


def _later_places(sent: pd.DataFrame) -> pd.DataFrame:
    """Per batch, the marks in this bucket of which another batch has an earlier place."""
    parts = [_unpack(b, PLACED) for b in sent["blob"]]
    h, c, doc, start = (np.concatenate(p) for p in zip(*parts, strict=True))
    of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.lexsort((start, doc, c, h))
    h, c, doc, start, of = h[order], c[order], doc[order], start[order], of[order]
    begins = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
    first = np.repeat(begins, np.diff([*begins, len(h)]))
    late = (doc != doc[first]) | (start != start[first])
    bucket, batches, rows = int(sent["bucket"].iloc[0]), sent["batch"].to_numpy(), []
    for k in range(len(parts)):
        mine = late & (of == k)
        if mine.any():
            rows.append((bucket, int(batches[k]), _pack(h[mine], c[mine])))
    return _frame(rows, SENT)


def _removed(width: int):
    """Per document: the words covered by windows that also start earlier, and what is left."""

    def run(docs: pd.DataFrame, late: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return _frame([], "doc_id, n_words, n_removed, removed, kept_text")
        w = Windows(docs, width)
        order, begins, firsts = _first_places(w, np.arange(len(w.hash)))
        sizes = np.diff([*begins, len(order)])
        first = np.repeat(firsts, sizes)
        gone = np.zeros(len(order), dtype=bool)
        gone[order] = (w.doc[order] != w.doc[first]) | (w.start[order] != w.start[first])
        if len(late):
            h, c = (np.concatenate(p) for p in zip(*[_unpack(b, MARKED) for b in late["blob"]], strict=True))
            run_h, run_c = w.hash[firsts], w.check[firsts]
            by = np.argsort(h, kind="stable")
            h, c = h[by], c[by]
            at = np.searchsorted(h, run_h)
            inside = at < len(h)
            told = np.zeros(len(firsts), dtype=bool)
            told[inside] = (h[at[inside]] == run_h[inside]) & (c[at[inside]] == run_c[inside])
            gone[order] |= np.repeat(told, sizes)
        rows, at = [], 0
        for doc_id, found, n in zip(w.docs["doc_id"], w.words, w.sizes, strict=True):
            hit = np.flatnonzero(gone[at:at + n])
            at += n
            edge = np.zeros(len(found) + 1, dtype=np.int32)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + width, -1)
            out = np.cumsum(edge[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)]
            kept = [word for word, x in zip(found, out, strict=True) if not x] if spans else found
            rows.append((doc_id, len(found), int(out.sum()), spans, b" ".join(kept).decode()))
        return _frame(rows, "doc_id, n_words, n_removed, removed, kept_text").astype({"doc_id": "Int64"})

    return run


def repeats_removed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document (``doc_id``, ``text``): words, words removed, the maximal removed intervals, and the kept text.

    A word goes if a window of ``width`` words over it also starts earlier: in a
    document of smaller id, or earlier in the same one. Rows that share an id are
    one document in this order, so equal rows keep the same; null ids come last,
    as one id. Texts without words, null ones too, have nothing to remove. Extra
    columns are left out; an empty table gives no rows.

    Documents lie in batches of about ``BATCH_BYTES``. First every window's hash
    goes to its hash bucket, 32 bits and the bucket's own, once per batch, and
    comes back as a bit: does another batch have it? Those that others have go
    again, with 96 bits and their first place, and come back if another batch has
    an earlier one. Repeats inside a batch are seen there. A hot passage counts
    once per batch; batches and buckets grow in number, not in size.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    bits = max(4, int(size // 6 // BUCKET_WINDOWS).bit_length())
    by = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    held = docs.select("doc_id", "text", F.pmod(by, F.lit(batches)).alias("batch"))
    grouped = lambda: held.groupBy("batch")
    hashes = grouped().applyInPandas(_spread_hashes(width, bits), SENT)
    shared = hashes.groupBy("bucket").applyInPandas(_shared_hashes, SENT)
    places = grouped().cogroup(shared.groupBy("batch")).applyInPandas(_spread_places(width, bits), SENT)
    late = places.groupBy("bucket").applyInPandas(_later_places, SENT)
    return grouped().cogroup(late.groupBy("batch")).applyInPandas(_removed(width), RESULT)
