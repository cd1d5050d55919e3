"""Lineage: which row came from which, and from which message in the end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.render import case, lit
from waybill.operators.audit import ROW_START
from waybill.session import salted_join, written

# Bytes of edges that a task gets in a closure, about: each counts as its texts and 32 more.
TASK_BYTES = 32 * 1024 * 1024
# Groups of nodes that are counted before they are dealt out to tasks.
BUCKETS = 65_536


def lineage_rows(df: DataFrame) -> DataFrame:
    """The edges of rows that carry ``sent``, the number of their destinations.

    A message has a ``clone`` at each target (on its way back, ``resume``), each path
    ``modified`` the target's row, a row copied (``copy``), answered (``reply``) and
    sent (``destination``); what never got to a target is ``failed``. Every edge
    comes once, from the row that went straight on after it, so each row of
    ``routed()`` has one way up to its message.
    """
    leads = "p.kind = 'empty' or (p.kind = 'path' and (not first or p.path = 0))"
    kind = case([("p.kind = 'path'", "'modified'"), ("p.kind = 'reply'", "'reply'")], "'failed'")
    # ``copy`` is a text of marks (``.0``, ``.12``, ``.r3``); a row that went straight on has zeros alone.
    rows = df.selectExpr(
        "msg_id", "concat_ws('/', msg_id, p.tpos) as target", f"{ROW_START} as place", "first", "copy", "sent", "p is null as lost",
        f"coalesce({leads}, false) as leads", f"{kind} as entered", "replace(copy, '.0', '') = '' as straight",
        "length(copy) - length(replace(copy, '.', '')) as marks",
        f"case when copy <> '' then length(regexp_extract(copy, {lit('((?:[.]0)*+)$')}, 1)) div 2 end as zeros")
    # A number per edge, with its texts made after the explode: 0 and above a destination, -1 to -3 as below, -3 - j the mark j.
    none = "cast(array() as array<int>)"
    numbers = ", ".join(f"case when {on} then {found} else {none} end" for on, found in [
        ("straight and not lost and leads", "array(-1)"), ("straight and not lost", "array(-2)"), ("lost", "array(-3)"),
        ("marks > 0", "sequence(-3 - marks, -3 - cast(greatest(1, marks - zeros) as int))"), ("sent > 0", "sequence(0, sent - 1)")])
    edges = rows.selectExpr("msg_id", "target", "place", "first", "copy", "entered", f"concat({numbers}) as numbers").selectExpr(
        "msg_id", "target", "place", "first", "copy", "entered", "explode_outer(numbers) as i").where("i is not null")
    upto = lambda n: f"concat(place, substring_index(copy, '.', {n}))"
    mark = "case when startswith(substring_index(substring_index(copy, '.', -2 - i), '.', -1), 'r') then 'reply' else 'copy' end"
    return edges.selectExpr(
        f"{case([('i >= 0', 'concat(place, copy)'), ('i = -2', 'target'), ('i >= -3', 'msg_id')], upto('-3 - i'))} as parent_id",
        f"{case([('i >= 0', 'concat(place, copy, \'/\', i)'), ('i = -1', 'target'), ('i >= -3', 'place')], upto('-2 - i'))} as child_id",
        case([("i >= 0", "'destination'"), ("i = -1", "case when first then 'clone' else 'resume' end"), ("i = -2", "entered"), ("i = -3", "'failed'")], mark)
        + " as kind")


_CLIMBED = "node string, root string, depth long, done boolean"
# What stands for the depth of a node that is an error.
_TWICE, _CIRCLE = 0, -1


def _climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each child of a task's edges with the end of its way up over ``kin`` edges, all of which are in the task.

    The end is ``done`` if it is no child. If it is the child of another edge the way
    stops there, and a child of such an edge has its parent.
    """
    table = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    node, root, kin = table["child_id"].cast(pa.large_string()), table["parent_id"].cast(pa.large_string()), table["kin"]
    coded = pc.dictionary_encode(node.combine_chunks(), null_encoding="encode")
    names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    twice = np.zeros(len(names), bool)
    if len(names) < len(code):
        first = np.empty(len(names), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        parents = pc.dictionary_encode(root.combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        twice[code[parents != parents[first[code]]]] = True
        root, kin = root.take(pa.array(first)), kin.take(pa.array(first))
    at = np.arange(len(names))
    above = pc.fill_null(pc.index_in(root, value_set=names), -1).to_numpy().astype(np.int64)
    kin = kin.to_numpy()
    climbs = kin & (above >= 0)
    end, depth = np.where(climbs, above, at), climbs.astype(np.int64)
    for _ in range(len(names).bit_length() + 1):
        further = end[end]
        if (further == end).all():
            break
        depth, end = depth + depth[end], further
    done = kin[end]
    # A way that is done goes on to the parent of its end, and so does one that has not begun.
    own = done | (end == at)
    roots = pc.if_else(pa.array(own), root.combine_chunks().take(pa.array(end)), names.take(pa.array(end)))
    depth = np.where(twice, _TWICE, np.where(climbs[end], _CIRCLE, depth + own))
    out = pa.table({"node": names, "root": roots, "depth": depth, "done": done})
    for part in out.to_batches(max_chunksize=50_000):
        yield pa.RecordBatch.from_arrays([part["node"].cast(pa.string()), part["root"].cast(pa.string()), part["depth"], part["done"]], names=part.schema.names)


def lineage_closure(edges: DataFrame) -> DataFrame:
    """``node``, its ``root`` and ``depth`` below it, for every child of ``edges (parent_id, child_id)``.

    Edges of several runs may be put together: a row that was parked and came
    back is the message of the later run. Names of a message's rows begin with its
    name, so children are dealt out by what stands before their first ``/``, and
    each task climbs the edges within such a group: if all names hold to that, this is the closure.
    Groups above a task's share, and edges from one group to another, go on in rounds.
    Every round looks one pointer's
    pointer up and doubles the depth that is covered, so a chain of n edges takes
    log2(n) rounds; each round is a written table, and heavy parents are salted. A node whose
    pointer has got to a message is done and takes no part in later rounds.
    A node with two parents or a circle is an error; repeated edges count once.
    """
    named = written(edges.select("parent_id", "child_id"), "edges")
    head = lambda name: f"substring_index({name}, '/', 1)"
    bucket = F.expr(f"coalesce(cast(pmod(xxhash64({head('child_id')}), {BUCKETS}) as int), 0)")
    weight = F.sum(F.expr("32L + octet_length(child_id) + coalesce(octet_length(parent_id), 0)"))
    held = named.groupBy(bucket.alias("bucket")).agg(F.coalesce(weight, F.lit(0)).alias("bytes")).agg(
        F.sum("bytes").alias("all"), F.expr(f"collect_list(case when bytes > {4 * TASK_BYTES} then bucket end)").alias("heavy")).first()
    tasks = max(named.sparkSession.sparkContext.defaultParallelism, -(-(held["all"] or 0) // TASK_BYTES))
    light = named.where(~bucket.isin(held["heavy"])) if held["heavy"] else named
    dealt = light.select("parent_id", "child_id", F.expr(f"coalesce({head('parent_id')} = {head('child_id')}, false)").alias("kin"), bucket.alias("bucket"))
    climbed = written(dealt.repartition(tasks, "bucket").drop("bucket").mapInArrow(_climbed, _CLIMBED), "lineage")
    told = climbed.agg(F.count(F.lit(1)).alias("n"), F.min("depth").alias("least"), F.min("done").alias("done"), F.expr(f"count_if(depth = {_TWICE})").alias("twice")).first()
    size, over, left = told["n"], climbed.where("done"), climbed.where("not done")
    if told["twice"]:
        raise ValueError("a lineage node has more than one parent")
    if told["least"] == _CIRCLE:
        raise ValueError("the lineage has a circle")
    if held["heavy"]:
        first = named.where(bucket.isin(held["heavy"])).select(F.col("child_id").alias("node"), F.col("parent_id").alias("root")).distinct()
        rest = written(first.select("node", "root", F.lit(1).cast("long").alias("depth"), F.lit(False).alias("done")), "lineage")
        many = rest.count()
        # As many hashes as rows: no node comes twice. Only else are the nodes themselves compared.
        if rest.select(F.xxhash64("node")).distinct().count() < many and rest.select("node").distinct().count() < many:
            raise ValueError("a lineage node has more than one parent")
        size, left = size + many, left.unionByName(rest)
    elif told["done"] is not False:
        return over.drop("done")
    while True:
        above = over.unionByName(left).select(
            F.col("node").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"), F.col("done").alias("ended"))
        step = salted_join(left, above, "root", F.col("node"))
        now = written(step.select(
            "node", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            (F.col("further").isNull() | F.col("ended")).alias("done")), "lineage")
        most = now.agg(F.min("done").alias("done"), F.max("depth").alias("depth")).first()
        over = over.unionByName(now.where("done"))
        if most["done"] is not False:
            return over.drop("done")
        if most["depth"] > size:
            raise ValueError("the lineage has a circle")
        left = now.where("not done")
