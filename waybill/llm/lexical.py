"""Ranked lexical search: integer impacts of documents times weights of query terms, as dense tiles."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.batches import cut, raw_texts
from waybill.llm.common import written

#: Item text per block; a block's items and terms are broadcast, and each block is one pass over the documents.
BLOCK_BYTES = 4 << 20
#: Sides of the tiles: items, vocabulary terms, documents.
ITEMS, TERMS, DOCS = 512, 2048, 1024
#: Above every impact, for ``1e9 * tf div (1000 * tf + 8 * m)`` with ``m`` of 25 at least.
IMPACT = 1_000_000
#: Doubles hold every integer up to here.
EXACT = 1 << 53
#: Text that is split into terms at once.
STRETCH = 4 << 20

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Terms of a UTF-8 text with their counts: runs of ASCII letters, digits and all else beyond ASCII; A to Z lowered."""
    counts: Counter = Counter()
    plain = text.translate(_TERM)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + STRETCH) if len(plain) - at > STRETCH else -1
        end = len(plain) if end < 0 else end
        counts.update(plain[at:end].split())
        at = end
    return counts


@dataclass
class Block:
    """Items of one block as (item, term, repeats) triples over a vocabulary of its own."""

    ids: list
    vocabulary: dict[bytes, int]
    item: np.ndarray
    term: np.ndarray
    repeats: np.ndarray


def _block(rows: list) -> Block:
    vocabulary: dict[bytes, int] = {}
    triples = [
        (i, vocabulary.setdefault(word, len(vocabulary)), n)
        for i, row in enumerate(rows) for word, n in term_counts((row["text"] or "").encode()).items()
    ]
    item, term, repeats = (np.array(c, dtype=np.int64) for c in (zip(*triples) if triples else ([], [], [])))
    return Block([row["item_id"] for row in rows], vocabulary, item, term, repeats)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    """``floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))`` per term."""
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


@dataclass
class Tile:
    """Weights of some items for some terms; every sum of products with impacts stays below 2**53."""

    terms: np.ndarray
    item: np.ndarray
    column: np.ndarray
    weight: np.ndarray

    def dense(self, items: int) -> np.ndarray:
        out = np.zeros((items, len(self.terms)))
        out[self.item, self.column] = self.weight
        return out


def weight_tiles(item: np.ndarray, term: np.ndarray, weight: np.ndarray, most: int = TERMS, exact: int = EXACT) -> list[Tile]:
    """Cut one tile of items by terms, and single terms by weight, until no item's sum can reach ``exact``."""
    used = weight > 0
    item, term, weight = item[used], term[used], weight[used]
    if not len(item):
        return []
    terms, column = np.unique(term, return_inverse=True)
    heaviest = np.zeros(int(item.max()) + 1, dtype=np.int64)
    np.add.at(heaviest, item, weight)
    if len(terms) <= most and int(heaviest.max()) * IMPACT < exact:
        return [Tile(terms, item, column, weight)]
    if len(terms) > 1:
        low = column < len(terms) // 2
        halves = [(item[side], term[side], weight[side]) for side in (low, ~low)]
    else:
        halves = [(item, term, weight // 2), (item, term, weight - weight // 2)]
    return [tile for half in halves for tile in weight_tiles(*half, most, exact)]


class Best:
    """The ``top`` best documents of each item so far: by score, then by ascending id, nulls last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, dtype=np.int64)
        self.item = self.score = self.doc = np.empty(0, dtype=np.int64)
        self.gone = np.empty(0, dtype=bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, gone: np.ndarray) -> None:
        """Scores of all items for a tile of documents; ties with the last place stay in until ids decide."""
        able = scores >= self.least[:, None]
        if scores.shape[1] > self.top and able.sum() > 4 * self.top * len(scores):
            kth = np.partition(scores, scores.shape[1] - self.top, axis=1)[:, -self.top]
            able &= scores >= kth[:, None]
        item, column = np.nonzero(able)
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, column]])
        doc, none = np.concatenate([self.doc, docs[column]]), np.concatenate([self.gone, gone[column]])
        order = np.lexsort((doc, none, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.top]
        self.item, self.score, self.doc, self.gone = item[order], score[order], doc[order], none[order]
        full = place[place < self.top] == self.top - 1
        self.least[self.item[full]] = self.score[full]


class Scorer:
    """Scores tiles of documents against all items of a block."""

    def __init__(self, block: Block, weight: np.ndarray, docs: int, length: int, top: int):
        self.docs, self.length, self.terms = docs, length, len(block.vocabulary)
        coefficient = weight[block.term] * block.repeats
        self.groups = []
        for first in range(0, len(block.ids), ITEMS):
            mine = (block.item >= first) & (block.item < first + ITEMS)
            tiles = weight_tiles(block.item[mine] - first, block.term[mine], coefficient[mine])
            items = min(ITEMS, len(block.ids) - first)
            self.groups.append((first, items, tiles, Best(items, top)))
        # One tile, the usual case, stays dense; more are made dense when they are used.
        only = [g for g in self.groups if g[2]]
        self.kept = only[0][2][0].dense(only[0][1]) if len(only) == 1 and len(only[0][2]) == 1 else None

    def add(self, doc: np.ndarray, gone: np.ndarray, n: np.ndarray, of: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A tile of documents: ids, lengths, and (document, term, occurrences) triples."""
        # Python's integers, for 75 * n * N can pass 64 bits.
        m = np.array([25 + 75 * int(x) * self.docs // self.length for x in n], dtype=np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[of])
        place = np.full(self.terms, -1, dtype=np.int64)
        for _, items, tiles, best in self.groups:
            scores = np.zeros((items, len(doc)), dtype=np.int64)
            for tile in tiles:
                place[tile.terms] = np.arange(len(tile.terms))
                row = place[term]
                place[tile.terms] = -1
                held = row >= 0
                impacts = np.zeros((len(tile.terms), len(doc)))
                impacts[row[held], of[held]] = impact[held]
                scores += ((tile.dense(items) if self.kept is None else self.kept) @ impacts).astype(np.int64)
            best.add(scores, doc, gone)

    def rows(self) -> pa.RecordBatch:
        found = [(b.item + first, b.doc, b.gone, b.score) for first, _, _, b in self.groups]
        item, doc, gone, score = (np.concatenate(c) for c in zip(*found))
        return pa.record_batch([pa.array(item), pa.array(doc, mask=gone), pa.array(score)], names=["item", "doc_id", "score"])


def _counted(docs: DataFrame, vocabulary) -> DataFrame:
    """Per document its number of terms, and which vocabulary terms it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in cut(batches, "text"):
            n, terms, tfs = [], [], []
            for text in raw_texts(batch, "text"):
                counts = term_counts(text)
                n.append(counts.total())
                held = [(known[w], c) for w, c in counts.items() if w in known]
                terms.append([t for t, _ in held])
                tfs.append([c for _, c in held])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>").where("n > 0")


def _scored(counted: DataFrame, scorer) -> DataFrame:
    """The best documents of each item within each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*scorer.value)
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS):
                batch = whole.slice(at, DOCS)
                ids = batch.column("doc_id")
                terms, tfs = batch.column("terms"), batch.column("tfs")
                sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
                own.add(
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("n").to_numpy(),
                    np.repeat(np.arange(len(sizes)), sizes), terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy())
        yield own.rows()

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents (``doc_id``, ``text``) for each item (``item_id``, ``text``), by score and then by ascending id.

    Gives ``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` above 0. A term's
    weight times the impact of its occurrences is summed by matrix products of
    dense tiles: items by vocabulary, vocabulary by documents. Tiles are cut so
    that every partial sum is an integer below 2**53, which doubles hold, so
    scores are exact. Each task keeps ``top`` rows per item, ties decided by id,
    and a window over those rows gives the result.

    Items come in blocks of about ``block_bytes`` of text, each one pass over
    the documents; a block is broadcast. A null text holds no term. Documents
    without terms count nowhere and are never found; items without known terms
    give no rows. Equal items (id and text) are one; different texts of one id are
    ranked apart. Repeated documents count and rank each for itself; null ids
    rank last among equals. Extra columns are left out. An empty table on either
    side gives no rows.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", "text").where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    kind = items.schema["item_id"].dataType.simpleString()
    parts, totals = [], None
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        block = _block(sorted(rows, key=lambda r: (str(r["item_id"]), r["text"])))
        counted = written(_counted(docs, spark.sparkContext.broadcast(block.vocabulary)), "impacts")
        totals = totals or counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not totals[0]:
            break
        df = np.zeros(len(block.vocabulary), dtype=np.int64)
        for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = n
        given = spark.sparkContext.broadcast((block, weights(df, totals[0]), totals[0], totals[1], top))
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = _scored(counted, given).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
        parts.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
