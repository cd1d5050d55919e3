"""Benchmark decontamination by latent semantic retrieval and longest common subsequences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import few, free_name, written
from waybill.llm.hashing import plain_marks

LEAK = "doc_id long, text_mark long, item_id long, start int, end int, cosine float, lcs_share float, answer_share float"


class Search(NamedTuple):
    """``features`` hashed words, ``rank`` latent dimensions; windows of ``width`` words.

    Documents have a window at every half width, items at every ``item_stride``-th word.
    Items of fewer than ``brief`` words are leaks only word by word.
    """

    features: int = 1024
    rank: int = 96
    passage: int = 128
    width: int = 16
    item_stride: int = 4
    brief: int = 8
    copied: float = 0.8
    paraphrased: float = 0.55
    answered: float = 0.8
    alike: float = 0.8
    item_block: int = 5_000
    seed: int = 7


def coded(docs: DataFrame) -> DataFrame:
    """Id, text mark and 32-bit word codes of every document, written once for the passes over them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text_mark": batch["text_mark"],
                "codes": [codes(t).tobytes() for t in batch["text"]]})

    marked = docs.select("doc_id", F.xxhash64("text").alias("text_mark"), "text")
    return written(marked.mapInPandas(run, "doc_id long, text_mark long, codes binary"), "codes")


def codes(text: str | None) -> np.ndarray:
    return (plain_marks(text) >> np.uint64(32)).astype(np.uint32)


def _features(code: np.ndarray, n: int) -> np.ndarray:
    return (code % np.uint32(n)).astype(np.int64)


BLOCK = 1024
PART = 131_072
#: Words of stretches that are compared with an item at once.
CELLS = 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def _passages(batches: Iterator[pd.DataFrame], s: Search) -> Iterator[np.ndarray]:
    """Term counts of all passages, in blocks of ``BLOCK``; a text's passages don't overlap, and its last may be short."""
    flat, row = [], 0
    for batch in batches:
        for raw in batch["codes"]:
            f = _features(np.frombuffer(raw, dtype=np.uint32), s.features)
            for i in range(0, len(f), s.passage):
                flat.append(f[i:i + s.passage] + row * s.features)
                row += 1
                if row == BLOCK:
                    yield np.bincount(np.concatenate(flat), minlength=BLOCK * s.features).reshape(BLOCK, -1).astype(np.float32)
                    flat, row = [], 0
    if row:
        yield np.bincount(np.concatenate(flat), minlength=row * s.features).reshape(row, -1).astype(np.float32)


def _weights(held: DataFrame, s: Search) -> np.ndarray:
    """Inverse passage frequency of every feature, over all passages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = np.zeros(s.features, dtype=np.int64), 0
        for block in _passages(batches, s):
            seen += (block > 0).sum(axis=0)
            total += len(block)
        yield pd.DataFrame({"feature": np.arange(-1, s.features), "n": np.concatenate([[total], seen])})

    rows = held.select("codes").mapInPandas(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(s.features + 1)
    for r in rows:
        n[r["feature"] + 1] = r["n"]
    return (np.log((n[0] + 1) / (n[1:] + 1)) + 0.01).astype(np.float32)


def latent_words(held: DataFrame, s: Search = Search()) -> np.ndarray:
    """Feature vectors in the space of the leading singular directions of the TF-IDF passages: randomised SVD in one pass.

    Every task multiplies its passages with one random matrix, and the products
    back with the passages; Spark sums these by feature. The driver
    orthogonalises ``features`` x ``rank`` numbers, whatever the corpus.
    """
    idf = _weights(held, s)
    random = np.random.default_rng(s.seed).standard_normal((s.features, s.rank)).astype(np.float32)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((s.features, s.rank))
        for block in _passages(batches, s):
            block *= idf
            block /= np.linalg.norm(block, axis=1, keepdims=True) + 1e-9
            total += block.T @ (block @ random)
        yield pd.DataFrame({"feature": np.arange(s.features), "row": [r.tobytes() for r in total]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(r) for r in rows["row"]], axis=0)
        return pd.DataFrame({"feature": rows["feature"].iloc[:1], "row": [total.tobytes()]})

    sums = held.select("codes").mapInPandas(multiply, "feature int, row binary").groupBy("feature").applyInPandas(
        add, "feature int, row binary").collect()
    product = np.zeros((s.features, s.rank))
    for r in sums:
        product[r["feature"]] = np.frombuffer(r["row"])
    basis, _ = np.linalg.qr(product)
    # The core of A'A in this basis, from the one product; its eigenvectors order the directions.
    core = (basis.T @ product) @ np.linalg.pinv(basis.T @ random)
    _, turn = np.linalg.eigh((core + core.T) / 2)
    return ((basis @ turn[:, ::-1]) * idf[:, None]).astype(np.float32)


def _units(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


def _item_windows(f: np.ndarray, space: np.ndarray, width: int, stride: int) -> np.ndarray:
    """Unit vectors of an item's windows, the last one at its end; a shorter item is one window."""
    last = max(0, len(f) - width)
    starts = np.unique(np.append(np.arange(0, last + 1, stride), last))
    return _units(np.stack([space[f[a:a + width]].sum(axis=0) for a in starts]))


def _windows(f: np.ndarray, space: np.ndarray, width: int) -> np.ndarray:
    """Unit vectors of a document's windows, one at every half width; the last may be short."""
    half = width // 2
    blocks = np.add.reduceat(space[f], np.arange(0, len(f), half), axis=0)
    return _units(blocks[:-1] + blocks[1:] if len(blocks) > 1 else blocks)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if hit := v & places.get(x, 0):
            v = (v + hit | v - hit) & full
    return len(a) - v.bit_count()


def answer_of(text: str) -> str:
    """The last sentence of an item."""
    body = text.rstrip().rstrip(".?!")
    at = max(body.rfind(c) for c in ".?!\n")
    return body[at + 1:]


def leaks(docs: DataFrame, benchmark: DataFrame, s: Search = Search()) -> DataFrame:
    """A row per document and benchmark item that the document holds, copied or paraphrased.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``.
    Every stretch of a document, an item's length before and after each window, is
    looked at if it has as many of the item's words as ``paraphrased`` takes, in any
    order, so nothing that the rule accepts is passed over. The longest common
    subsequence of item and stretch decides: from ``copied`` of the item's words on
    it is a leak; from ``paraphrased`` on, if as much as ``answered`` of the item's
    answer, its last sentence, is there too. Below that the latent space decides: a stretch with
    ``copied`` of the item's words in another order, and with the answer, is a leak if the item's
    windows have their like in it, by a mean cosine of ``alike``. The rule holds for each stretch by
    itself; the best one that passes is reported, with its greatest ``cosine`` in the latent
    space. An item of fewer than ``brief`` words is a leak where it stands word by word.

    The items are a query set, taken in blocks of ``item_block``; each block's
    vectors go to all tasks and the documents' word codes are read once for it,
    without a shuffle. Null and empty texts and items without words match nothing. Null
    ids stay null; repeated rows give a row each; ``start`` and ``end`` are word
    positions around the match. No corpus, or no items: no rows.
    """
    asked = benchmark.where("text is not null").select("item_id", "text")
    blocks = -(-asked.count() // s.item_block)
    if not blocks or docs.isEmpty():
        return docs.sparkSession.createDataFrame([], LEAK)
    held = coded(docs)
    space, out = latent_words(held, s), None
    for k in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        found = held.mapInPandas(_search([(r["item_id"], r["text"]) for r in part], space, s), LEAK)
        out = found if out is None else out.unionByName(found)
    return out


def _least(size: int, share: float) -> int:
    """The fewest of ``size`` words that make the share."""
    return next(k for k in range(1, size + 2) if k / size >= share)


def _gate(words: list[np.ndarray], often: np.ndarray, s: Search) -> tuple[np.ndarray, np.ndarray]:
    """Which words count for each item, and how many of them every stretch that reaches ``paraphrased`` holds.

    Such a stretch lacks at most ``size - least`` of the item's words, so of any
    ``r`` of them it has ``r - (size - least)`` or more. ``r`` of the rarest are
    taken, as many as make chance hits least likely; ``often``, the words'
    frequencies, only steers that choice, and no choice loses a match.
    """
    counts, floor = np.zeros((len(often), len(words)), dtype=np.uint8), np.zeros(len(words), dtype=np.int32)
    for j, mine in enumerate(words):
        size = len(mine)
        rare = mine[np.argsort(often[mine], kind="stable")]
        first = np.zeros(size, dtype=bool)
        first[np.unique(rare, return_index=True)[1]] = True
        chance = (2 * size + s.width) * np.cumsum(often[rare] * first)
        need = _least(size, s.paraphrased) - size + np.arange(1, size + 1)
        sure = np.maximum(need, 1)
        gain = np.where((need >= 1) & (need > chance), sure * np.log(sure / chance) - sure + chance, -1.0)
        r = int(np.argmax(gain)) if gain.max() > 0 else size - 1
        counts[rare[:r + 1], j], floor[j] = 1, need[r]
    return counts, floor


def _common(a: list, b: list) -> int:
    """How many words two texts share, in any order."""
    return (Counter(a) & Counter(b)).total()


def _shares(words: np.ndarray, tail: int, least: float, around: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of an item in many stretches (rows of word numbers below ``n``), by their common subsequences.

    And how much of its words may be there in any order: 0 where less than ``least`` of its last ``tail`` words is.
    """
    size = len(words)
    if size > 64:
        mine, rows = words.tolist(), around.tolist()
        return np.array([lcs(mine, row) for row in rows]) / size, np.array([_common(mine, row) for row in rows]) / size
    masks = np.zeros(n, dtype=np.uint64)
    for i, w in enumerate(words.tolist()):
        masks[w] |= np.uint64(1 << i)
    v = np.full(len(around), (1 << 64) - 1, dtype=np.uint64)
    seen = np.zeros(len(around), dtype=np.uint64)
    for column in around.T:
        mask = masks[column]
        seen |= mask
        hit = v & mask
        v = (v + hit) | (v - hit)
    left = np.bitwise_count(v & np.uint64((1 << size) - 1)).astype(np.int64)
    whole = np.bitwise_count(seen >> np.uint64(size - tail)) >= least * tail if tail else True
    return (size - left) / size, np.where(whole, np.bitwise_count(seen) / size, 0.0)


def _sums(each: np.ndarray, wides: list[int], n: int) -> Iterator[np.ndarray]:
    """Sums of so many (even) consecutive rows around each of ``n`` places, put together from sums of 1, 2, 4, ... rows."""
    most = max(wides) // 2
    powers = [np.pad(each, ((most, most + 1), (0, 0)))]
    while 2 ** len(powers) <= max(wides):
        done = 2 ** (len(powers) - 1)
        powers.append(powers[-1][:-done] + powers[-1][done:])
    for wide in wides:
        at, total = most - (wide // 2 - 1), None
        for k, power in enumerate(powers):
            if wide >> k & 1:
                part = power[at:at + n]
                total = part if total is None else total + part
                at += 1 << k
        yield total


def _search(items: list[tuple[int, str]], space: np.ndarray, s: Search):
    items = sorted(((i, t, c) for i, t, c in ((i, t, codes(t)) for i, t in items) if len(c)), key=lambda x: len(x[2]))
    half = s.width // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not items:
            return
        vocabulary = np.unique(np.concatenate([c for _, _, c in items]))
        none = len(vocabulary)  # the number of a word that no item has
        words = [np.searchsorted(vocabulary, c) for _, _, c in items]
        sizes = np.array([len(w) for w in words])
        answers = [codes(answer_of(t)) for _, t, _ in items]
        tails = [len(a) if np.array_equal(c[len(c) - len(a):], a) else 0 for a, (_, _, c) in zip(answers, items, strict=True)]
        brief = int(np.searchsorted(sizes, s.brief))
        overlap = -(-(2 * int(sizes[-1]) + s.width) // half) * half
        columns = [c.split()[0] for c in LEAK.split(", ")]
        gate: list = []
        vectors: dict = {}

        known = np.zeros(1 << 16, dtype=bool)
        known[vocabulary >> np.uint32(16)] = True

        def numbers(code: np.ndarray) -> np.ndarray:
            number = np.full(len(code) + -len(code) % half, none)
            place = np.flatnonzero(known[code >> np.uint32(16)])
            mine = code[place]
            at = np.minimum(np.searchsorted(vocabulary, mine), none - 1)
            number[place] = np.where(vocabulary[at] == mine, at, none)
            return number

        def matches(held: list) -> list:
            """Of documents (id, mark, codes) taken together."""
            spots: dict = {}
            parts: list = []
            count = 0
            for d, h in enumerate(held):
                # Parts of a long document overlap, so each stretch is whole in one of them.
                for o in range(0, len(h[2]), PART):
                    parts.append((d, o, h[2][o:o + PART + overlap]))
                    count += len(parts[-1][2])
                    if count >= PART:
                        gather(parts, spots)
                        parts, count = [], 0
            if parts:
                gather(parts, spots)
            return [r for (d, j), found in sorted(spots.items()) for r in decided(held[d], j, found)]

        def gather(parts: list, spots: dict) -> None:
            """Adds (start, end, share) of every stretch with enough of an item, in whatever order, by document and item."""
            flat = [numbers(p[2]) for p in parts]
            ends = np.cumsum([len(f) for f in flat])
            flat, begins = np.concatenate(flat), ends - [len(f) for f in flat]
            ends = begins + [len(p[2]) for p in parts]
            found = [(j, at) for j, at in runs(flat)]
            if brief < len(items):
                found += stretches(flat)
            for j, at in found:
                size = int(sizes[j])
                of = np.searchsorted(begins, at, side="right") - 1
                lo, hi = (at, at + size) if j < brief else (np.maximum(at - size, begins[of]), np.minimum(at + s.width + size, ends[of]))
                step = max(1, min(8192, CELLS // (2 * size + s.width)))
                for k in range(0, len(at), step):
                    part = slice(k, k + step)
                    if j < brief:
                        share = some = np.where(hi[part] <= ends[of[part]], 1.0, 0.0)
                    else:
                        place = lo[part, None] + np.arange(2 * size + s.width)
                        inside = place < hi[part, None]
                        share, some = _shares(words[j], tails[j], s.answered, np.where(inside, flat[np.minimum(place, len(flat) - 1)], none), none + 1)
                    for x in np.flatnonzero((share >= s.paraphrased) | (some >= s.copied)):
                        d, o, _ = parts[of[k + x]]
                        start = o - begins[of[k + x]]
                        spots.setdefault((d, j), set()).add((int(start + lo[k + x]), int(start + hi[k + x]), float(share[x])))

        def runs(flat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            """Where the items of fewer than ``brief`` words stand word by word."""
            for size in np.unique(sizes[:brief]).tolist():
                key = np.zeros(max(len(flat) - size + 1, 0), dtype=np.uint64)
                mine = [j for j in range(brief) if sizes[j] == size]
                keys = np.zeros(len(mine), dtype=np.uint64)
                for i in range(size):
                    key = key * MIX + flat[i:i + len(key)].astype(np.uint64)
                    keys = keys * MIX + np.array([words[j][i] for j in mine], dtype=np.uint64)
                at = np.flatnonzero(np.isin(key, keys))
                for j, k in zip(mine, keys, strict=True):
                    here = at[key[at] == k]
                    here = here[(flat[here[:, None] + np.arange(size)] == words[j]).all(axis=1)]
                    if len(here):
                        yield j, here

        def stretches(flat: np.ndarray) -> list[tuple[int, np.ndarray]]:
            """Where so many words of a longer item are near that a stretch may hold its share: starts, by item."""
            if not gate:
                often = (np.bincount(flat, minlength=none + 1) + 0.1) / (len(flat) + 1)
                gate.extend(_gate(words[brief:], often, s))
            counts, floor = gate
            n, out = len(flat) // half, []
            for c in range(0, counts.shape[1], 256):
                table = counts[:, c:c + 256]
                width = table.shape[1]
                lanes = np.zeros((len(table), -(-width // 8) * 8), dtype=np.uint8)
                lanes[:, :width] = table
                each = np.add.reduce(lanes.view(np.uint64).take(flat, axis=0).reshape(n, half, -1), axis=1)
                reach = -(-sizes[brief + c:brief + c + 256] // half)
                # Eight counts in a number, unless a long stretch may hold too many words for that.
                if (2 + 2 * int(reach.max())) * half > 255:
                    each = each.view(np.uint8).astype(np.int32)
                several = np.unique(reach)
                for r, near in zip(several, _sums(each, [2 + 2 * int(r) for r in several], n), strict=True):
                    same = slice(*np.searchsorted(reach, [r, r + 1]))
                    near = (near if near.dtype == np.int32 else near.view(np.uint8))[:, same]
                    b, j = np.nonzero(near >= floor[c:c + 256][same].astype(near.dtype))
                    order = np.argsort(j, kind="stable")
                    j, b = j[order], b[order]
                    cut = np.flatnonzero(np.diff(j)) + 1
                    out += [(brief + c + same.start + int(q[0]), p * half) for q, p in zip(np.split(j, cut), np.split(b, cut), strict=True) if len(q)]
            return out

        def decided(h: tuple, j: int, found: set) -> list:
            """The item's best stretch that is a leak, if there is one."""
            item, _, marks = items[j]
            answer = answers[j].tolist()
            for lo, hi, share in sorted(found, key=lambda x: (-x[2], x[0])):
                around = h[2][lo:hi]
                told = lcs(answer, around.tolist()) / len(answer) if answer else 0.0
                leak = share >= s.copied or share >= s.paraphrased and told >= s.answered
                moved = share < s.paraphrased and told >= s.answered and _common(marks.tolist(), around.tolist()) >= s.copied * len(marks)
                if leak or moved:
                    if j not in vectors:
                        vectors[j] = _item_windows(_features(marks, s.features), space, s.width, s.item_stride)
                    near = (_windows(_features(around, s.features), space, s.width) @ vectors[j].T).max(axis=0)
                    if leak or near.mean() >= s.alike:
                        return [(h[0], h[1], item, lo, hi, float(near.max()), share, told)]
            return []

        for batch in batches:
            held, rows, count = [], [], 0
            for doc_id, mark, raw in zip(batch["doc_id"], batch["text_mark"], batch["codes"], strict=True):
                code = np.frombuffer(raw, dtype=np.uint32)
                if len(code):
                    held.append((doc_id, mark, code))
                    count += len(code)
                if count >= PART:
                    rows += matches(held)
                    held, count = [], 0
            if held:
                rows += matches(held)
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, s: Search = Search()) -> DataFrame:
    """The documents without a leak, with their own columns. A leak is a matter of the text, so equal texts go together."""
    found = written(leaks(docs, benchmark, s).select("text_mark").distinct(), "leaks")
    mark = free_name(docs, "text_mark")
    marks = found.withColumnRenamed("text_mark", mark)
    marks = few(marks, found.count())
    return docs.withColumn(mark, F.xxhash64("text")).join(marks, mark, "left_anti").drop(mark)
