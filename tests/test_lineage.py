"""Edges that lead every routed row up to its message, and their closure."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import message_table, one_path, registries, route, run, target
from tests.test_routing import CASES
from waybill import Settings, route_messages
from waybill.operators import lineage
from waybill.operators.lineage import lineage_closure
from waybill.session import salted_join

MORE = {
    **CASES,
    "nested": (one_path("DuplicateFlowFile://?Number=2", "SyncResponse", "DuplicateFlowFile://?Number=1", "SyncResponse", url=["u", "v"]), "<a/>"),
    "dropped": (one_path("DuplicateFlowFile://?Number=1", "RouteOnAttribute://?RoutingStrategy=r&Condition=false", "Pass"), "<a/>"),
    "no_json": (one_path("ReplaceText://?ReplacementStrategy=RegexReplace&SearchValue=</a>&ReplacementValue=<", output="JSON", url=["u", "v"]), "<a><b>1</b></a>"),
    "replies": (route(target(syncValidation="true"), target(["Pass"], ["Pass"], syncValidation="true")), "<a/>"),
}


@pytest.mark.parametrize("settings", [Settings(), Settings(steps_as_data=True, stop_target_on_suppress=True)])
def test_every_routed_row_has_one_way_up(spark, settings):
    got = run(spark, MORE, settings)
    edges = got.lineage().collect()
    children = [e["child_id"] for e in edges]
    assert len(children) == len(set(children))
    up = {e["child_id"]: e["parent_id"] for e in edges}
    rows = got.routed().select("msg_id", "lineage").collect()
    for row in rows:
        at, steps = row["lineage"], 0
        while at in up:
            at, steps = up[at], steps + 1
        assert at == row["msg_id"] and steps > 0
    told = {r["node"]: (r["root"], r["depth"]) for r in lineage_closure(got.lineage()).collect()}
    assert set(told) == set(children)
    assert all(told[r["lineage"]][0] == r["msg_id"] for r in rows)
    # What was suppressed can be traced too.
    assert {r["lineage"] for r in got.suppressed().collect()} <= set(told)


def test_closure_of_long_chains_and_wide_trees(spark):
    chain = spark.range(600).selectExpr("concat('n', id) as parent_id", "concat('n', id + 1) as child_id")
    wide = spark.range(5000).selectExpr("'n600' as parent_id", "concat('leaf', id) as child_id")
    got = lineage_closure(chain.unionByName(wide).unionByName(wide))
    assert got.count() == 5600 and got.where("root <> 'n0'").count() == 0
    assert got.agg(F.max("depth")).first()[0] == 601 and got.where("node like 'leaf%' and depth = 601").count() == 5000
    assert lineage_closure(chain.limit(0)).count() == 0


def test_nodes_that_got_to_their_message_take_no_part_in_later_rounds(spark, monkeypatch):
    left = []

    def counted(rows, *rest):
        left.append(rows.count())
        return salted_join(rows, *rest)

    monkeypatch.setattr(lineage, "salted_join", counted)
    stars = spark.range(100).selectExpr("'m' as parent_id", "concat('c', id) as child_id")
    chain = spark.range(8).selectExpr("concat('n', id) as parent_id", "concat('n', id + 1) as child_id")
    got = {r["node"]: (r["root"], r["depth"]) for r in lineage_closure(stars.unionByName(chain)).collect()}
    assert got == {f"c{i}": ("m", 1) for i in range(100)} | {f"n{i + 1}": ("n0", i + 1) for i in range(8)}
    assert left[0] == 108 and max(left[1:]) < 8


def test_closure_refuses_circles_and_second_parents(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "parent_id string, child_id string")
    with pytest.raises(ValueError, match="circle"):
        lineage_closure(pairs(("a", "b"), ("b", "c"), ("c", "a")))
    with pytest.raises(ValueError, match="parent"):
        lineage_closure(pairs(("a", "c"), ("b", "c")))


def test_lineage_of_a_second_pass_joins_on(spark):
    docs = {"p": one_path("RouteOnContent://?MatchRequirement=m&RouteCondition=c", "DuplicateFlowFile://?Number=1")}
    routes, schemas = registries(spark, docs)
    first = route_messages(message_table(spark, [("m", "<a/>", {"business.process.name": "p"})]), routes, schemas)
    back = first.routed().where("route = 'parked'").selectExpr("lineage as msg_id", "content", "attrs")
    second = route_messages(back, routes, schemas)
    ways = {r["node"]: (r["root"], r["depth"]) for r in lineage_closure(first.lineage().unionByName(second.lineage())).collect()}
    assert {r["lineage"]: ways[r["lineage"]] for r in second.routed().collect()} == {
        f"m/0/0/0/0/0/0/0.{i}/0": ("m", 7) for i in (0, 1)}


def _ways(pairs):
    """Root and depth of each child, by walking up."""
    up, found = {c: p for p, c in pairs}, {}
    for child in up:
        at, steps = child, 0
        while at in up:
            at, steps = up[at], steps + 1
        found[child] = (at, steps)
    return found


@pytest.mark.parametrize("task_bytes", [lineage.TASK_BYTES, 1000, 1])
def test_names_that_hold_to_their_message_need_no_rounds(spark, monkeypatch, task_bytes):
    monkeypatch.setattr(lineage, "TASK_BYTES", task_bytes)
    joins = []
    monkeypatch.setattr(lineage, "salted_join", lambda rows, *rest: joins.append(rows.count()) or salted_join(rows, *rest))
    pairs = [edge for m in range(50) for edge in [
        (f"m{m}", f"m{m}/0"), (f"m{m}/0", f"m{m}/0/1"), (f"m{m}/0/1", f"m{m}/0/1/0"), (f"m{m}/0/1/0", f"m{m}/0/1/0/2"), (f"m{m}", f"m{m}/1")]]
    table = lambda rows: spark.createDataFrame(rows, "parent_id string, child_id string")
    closed = lambda rows: {r["node"]: (r["root"], r["depth"]) for r in lineage_closure(table(rows)).collect()}
    assert closed(pairs + pairs[:7]) == _ways(pairs)
    # A group above a task's share goes the way of the rounds, as do edges between groups.
    assert bool(joins) == (task_bytes == 1)
    apart = [*pairs, ("x", "m3"), ("m4/0/1", "m5"), ("m5/1", "y/0"), ("y/0", "y/0/0")]
    assert closed(apart) == _ways(apart) and joins


def test_circles_and_second_parents_within_a_message_are_refused(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "parent_id string, child_id string")
    for circle in ([("a/0", "a/1"), ("a/1", "a/0")], [("a/0", "a/0")], [("a/0", "a/1"), ("a/1", "a/2"), ("a/2", "a/0"), ("a/2", "a/3")]):
        with pytest.raises(ValueError, match="circle"):
            lineage_closure(pairs(*circle))
    with pytest.raises(ValueError, match="parent"):
        lineage_closure(pairs(("a/0", "a/1"), ("a", "a/1"), ("a", "a/0")))
