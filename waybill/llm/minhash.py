"""Near-duplicates: MinHash with banding, verified links, and components by stars."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import BLANKS, few, free_name, written
from waybill.llm.components import components
from waybill.llm.hashing import mixed, word_marks


class Near(NamedTuple):
    """Word shingles of ``width``, linked from ``percent`` Jaccard similarity; ``bands`` of ``rows`` minima each.

    A link at 85 % shares no band with probability (1 - 0.85 ** rows) ** bands, 1.7e-6 as given; at 80 %, 2e-4 as
    given and 3e-6 with 5 rows and 32 bands.
    """

    width: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 28

    @property
    def least_agreement(self) -> float:
        """Share of equal minima below which no link is possible but for a chance under 1e-9."""
        j, n = self.percent / 100, self.rows * self.bands
        return j - 6 * (j * (1 - j) / n) ** 0.5


#: Five-word shingles at 80 %, for stages without a contract.
USUAL = Near(width=5, percent=80, rows=5, bands=32)
SKETCH = "doc_id long, text_mark long, n_shingles long, node binary, bands array<long>, minima binary"


def shingles(text: str | None, width: int) -> np.ndarray:
    """Marks of the distinct shingles of a text, sorted; of fewer words, the whole sequence is one."""
    _, marks = word_marks(text, lower=True)
    if not len(marks):
        return marks
    k = min(width, len(marks))
    out = np.full(len(marks) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = mixed(out + marks[i:len(marks) - k + 1 + i])
    return np.unique(out)


def sketches(docs: DataFrame, near: Near) -> DataFrame:
    """Per row: size of its shingle set, a 128-bit mark of the set (``node``; null if empty), band hashes, and minima."""
    n = near.rows * near.bands

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(20240607)
        a = rng.integers(0, 1 << 31, n, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        b = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]
        weight = rng.integers(0, 1 << 63, near.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        number = mixed(np.arange(1, near.bands + 1, dtype=np.uint64))
        for batch in batches:
            rows = []
            for doc_id, mark, text in zip(batch["doc_id"], batch["text_mark"], batch["text"], strict=True):
                s = shingles(text, near.width)
                if not len(s):
                    rows.append((doc_id, mark, 0, None, [], None))
                    continue
                short, least = (s >> np.uint64(32)).astype(np.uint32), np.full(n, 0xFFFFFFFF, dtype=np.uint32)
                for i in range(0, len(short), 4096):
                    least = np.minimum(least, (a * short[None, i:i + 4096] + b).min(axis=1))
                bands = mixed(least.reshape(near.bands, near.rows).astype(np.uint64) @ weight + number).view(np.int64)
                node = s.sum(dtype=np.uint64).tobytes() + mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).tobytes()
                rows.append((doc_id, mark, len(s), node, bands, least.astype(np.uint16).tobytes()))
            out = pd.DataFrame(rows, columns=["doc_id", "text_mark", "n_shingles", "node", "bands", "minima"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", F.xxhash64("text").alias("text_mark"), "text").mapInPandas(run, SKETCH)


def _agreeing(near: Near):
    """Pairs whose minima agree often enough and whose sizes allow the similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(len(batch), -1) for c in ("xm", "ym"))
                small, large = np.minimum(batch["xn"], batch["yn"]), np.maximum(batch["xn"], batch["yn"])
                fit = ((x == y).mean(axis=1) >= near.least_agreement) & (100 * small >= near.percent * large)
                yield batch.loc[fit, ["a", "b"]]

    return run


def _verified(near: Near):
    """Pairs whose whole shingle sets are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, mine = None, None  # a leader's pairs come one after another
        for batch in batches:
            hit = np.zeros(len(batch), dtype=bool)
            for i, (a, xt, yt) in enumerate(zip(batch["a"], batch["xt"], batch["yt"], strict=True)):
                if a != last:
                    last, mine = a, shingles(xt, near.width)
                other = shingles(yt, near.width)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                hit[i] = 100 * both >= near.percent * (len(mine) + len(other) - both)
            yield batch.loc[hit, ["a", "b"]]

    return run


def _links(pairs: DataFrame, held: DataFrame, near: Near) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that are linked: minima first, then whole sets."""
    pairs = written(pairs.distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    used = held.join(few(nodes, 2 * pairs.count()), "node", "left_semi")
    side = lambda cols, x: used.select(*[F.col(c).alias(n) for c, n in zip(cols, x, strict=True)])
    likely = written(
        pairs.join(side(["node", "n_shingles", "minima"], ["a", "xn", "xm"]), "a")
        .join(side(["node", "n_shingles", "minima"], ["b", "yn", "ym"]), "b")
        .mapInPandas(_agreeing(near), "a binary, b binary"), "likely")
    texts = likely.join(side(["node", "text"], ["b", "yt"]), "b").join(side(["node", "text"], ["a", "xt"]), "a")
    return written(texts.select("a", "b", "xt", "yt").mapInPandas(_verified(near), "a binary, b binary"), "links")


def _with_component(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the buckets that still hold two components, with theirs; and the components."""
    known = written(components(links), "components")
    told = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = told.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    return written(told.join(open_.select("bucket"), "bucket", "left_semi"), "open"), known


def near_duplicates(docs: DataFrame, near: Near = USUAL) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id``, ``text``).

    Words are lower-cased in A to Z. Equal sets are one node from the start, so
    copies, however many, cost one sketch each and nothing more. A node meets
    those it shares a band with. In each bucket, members are first compared with
    its most central member, then with one drawn by hash; components by
    large-star and small-star contract what is linked. Members of a bucket that
    are in two components after that are compared if they share a rare shingle,
    as every linked pair does, so the stars lose no link. Every link is confirmed
    on whole sets.

    Texts without words, null ones too, have an empty set and no links.
    ``component_id`` is the smallest id of the component; rows with a null id
    link like others but name none. ``kept`` holds where the id is the
    component's (null equals null). Repeated rows have one result each; extra
    columns are left out.
    """
    rows = _rows(docs, near)
    name = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", name.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _rows(docs: DataFrame, near: Near) -> DataFrame:
    """Every row's id, text mark, set size, component and its smallest id; the last two are null without words."""
    sketched = written(sketches(docs, near), "sketches")
    found = sketched.where("node is not null")
    entries = found.select("node", F.explode("bands").alias("bucket"))
    # The first half of the mark tells sets apart well enough to find shared buckets.
    half = F.xxhash64("node")
    shared = entries.groupBy("bucket").agg(F.min(half).alias("lo"), F.max(half).alias("hi")).where("lo != hi").select("bucket")
    members = written(entries.join(shared, "bucket").distinct(), "members")
    nodes = members.select("node").distinct()
    wanted = written(found.join(nodes, "node").groupBy("node").agg(
        F.min("text_mark").alias("text_mark"), F.first("n_shingles").alias("n_shingles"), F.first("minima").alias("minima")), "wanted")
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("text_mark"), "text").join(
        few(wanted.select("text_mark"), wanted.count()), "text_mark", "left_semi")
    held = written(wanted.join(texts.groupBy("text_mark").agg(F.first("text").alias("text")), "text_mark"), "held")

    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    central = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("rank"))
    links = _links(_led(members.join(central, "node"), "rank"), held, near)
    open_, known = _with_component(members, links)
    if not open_.isEmpty():
        links = links.unionByName(_links(_led(open_, F.xxhash64("bucket", "node")), held, near))
        open_, known = _with_component(members, links)
    if not open_.isEmpty():
        rest = _links(_rare_pairs(open_.select("node", "component").distinct(), held, near), held, near)
        known = written(components(links.unionByName(rest)), "components")

    own = found.groupBy("node").agg(F.min("doc_id").alias("least")).join(known, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    names = own.groupBy("component").agg(F.min("least").alias("component_id"))
    named = own.join(names, "component").select("node", "component", "component_id")
    return sketched.select("doc_id", "text_mark", "n_shingles", "node").join(named, "node", "left").drop("node")


#: 64-bit words of a parity sketch.
PARITY = 32


def parity(shingles_: np.ndarray) -> np.ndarray:
    """A bit per hash slot: whether an odd number of the shingles fall there. Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((mixed(shingles_) >> np.uint64(53)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _rare_pairs(open_: DataFrame, held: DataFrame, near: Near) -> DataFrame:
    """Pairs of nodes in different components that may be linked: those that share a rare shingle and differ in few enough.

    With shingles ordered by how many of the nodes have them, two sets that are
    similar enough share one of the first ``n - ceil(n * similarity) + 1`` of
    either, whatever the order; and shingles that only one node has bound what it
    can have in common with any other. Of the nodes that share such a shingle the
    join passes on only pairs whose parity sketches differ in no more bits than
    linked sets may differ in shingles, which loses none. So members of a large
    group that are just short of a link to its centre, and of links to each
    other, are told apart bit by bit and give no rows.
    """

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.iloc[i:i + 64]
                sets = [shingles(t, near.width) for t in part["text"]]
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(), "shingles": [s.view(np.int64) for s in sets], "parity": [parity(s) for s in sets]})

    nodes = written(open_.withColumn("id", F.monotonically_increasing_id()), "nodes")
    texts = nodes.join(held.select("node", "text"), "node").select("id", "text")
    spelled = written(texts.mapInPandas(spell, "id long, shingles array<long>, parity array<long>"), "spelled")
    tokens = spelled.select("id", F.explode("shingles").alias("shingle"))
    often = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    common = tokens.join(often, "shingle")
    sized = nodes.join(spelled.select("id", F.size("shingles").alias("n_shingles"), "parity"), "id")
    by_rarity = Window.partitionBy("id").orderBy("often", "shingle")
    whole = F.count(F.lit(1)).over(Window.partitionBy("id"))
    ranked = common.select("id", "shingle", F.row_number().over(by_rarity).alias("at"), whole.alias("shared")).join(sized, "id")
    # Shingles that only one node has come before all others.
    first = F.expr(f"n_shingles - ceil(n_shingles * {near.percent} / 100.0) + 1")
    rare = written(ranked.where((F.col("n_shingles") - F.col("shared") + F.col("at")) <= first).select(
        "shingle", "node", "component", "n_shingles", "shared", "parity"), "rare")
    split = rare.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    rare = rare.join(split.select("shingle"), "shingle", "left_semi")
    side = lambda x: rare.selectExpr(
        "shingle", f"node as {x}", f"component as c{x}", f"n_shingles as {x}n", f"shared as {x}o", f"parity as {x}p")
    differing = " + ".join(f"bit_count(ap[{i}] ^ bp[{i}])" for i in range(PARITY))
    # No more can be common than either set shares with any other.
    fits = (
        f"a < b and ca != cb and 100 * least(ao, bo) >= {near.percent} * (an + bn - least(ao, bo))"
        f" and {100 + near.percent} * ({differing}) <= {100 - near.percent} * (an + bn)"
    )
    return side("a").join(side("b"), "shingle").where(fits).select("a", "b")


def _led(members: DataFrame, rank) -> DataFrame:
    """Pairs of each bucket's highest member with the others, leader first; those of one component are left out."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    split = "component" in members.columns
    own = F.col("component") if split else F.col("node")
    ranked = members.select("bucket", "node", own.alias("component"), rank.alias("rank"))
    top = ranked.groupBy("bucket").agg(F.max(F.struct("rank", "node", "component")).alias("top"))
    return ranked.join(top, "bucket").where("component != top.component").select(
        F.col("top.node").alias("a"), F.col("node").alias("b"))


def near_duplicates_removed(docs: DataFrame, near: Near = USUAL) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, null ids last, then the smallest text mark.

    Rows that repeat this one's id and text stay once. Texts without words, null ones too, all stay.
    """
    mark = free_name(docs, "text_mark")
    rows = written(_rows(docs, near).where("component is not null"), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_mark")).alias("first")
    kept = written(rows.groupBy("component").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_mark").alias("kept_mark")), "kept")
    ours = lambda d, m: F.col(d).eqNullSafe(F.col("kept_id")) & (F.col(m) == F.col("kept_mark"))
    marked = docs.withColumn(mark, F.xxhash64("text"))
    out = marked.join(kept, ours("doc_id", mark), "left_semi")
    if rows.join(kept, ours("doc_id", "text_mark"), "left_semi").count() > kept.count():
        out = out.dropDuplicates(["doc_id", mark])
    wordless = F.length(F.translate(F.coalesce("text", F.lit("")), BLANKS, "")) == 0
    return out.drop(mark).unionByName(docs.where(wordless))
