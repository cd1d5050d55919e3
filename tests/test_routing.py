"""Lookup, validation, fan-out, resume, audit, lineage, sinks and streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import Routed, message_table, one_path, registries, route, run, target
from waybill import (
    Settings, messages, read_route, registry, returned_messages, route_messages, write_routes,
)
from waybill.operators.audit import audit_message
from waybill.operators.lineage import lineage_closure
from waybill.sources.commits import read_batches
from waybill.streaming.route import route_stream

AT = {"xform.stage": "0", "target.id": "t", "xform.path": "0"}
TWO = route(
    target(["UpdateAttribute://?s=1", "UpdateAttribute://?e=${s}"], ["Pass"], id="t", url='["u","v"]', input="X", sync="false"),
    target(["Pass"], id="r", syncValidation="true", output="JSON"),
)
PARK = "RouteOnContent://?MatchRequirement=m&RouteCondition=c&Result=r"

CASES = {
    "none": (None, "<a/>"),
    "blank": ("", "<a/>"),
    "bad_json": ("{nope", "<a/>"),
    "fan": (TWO, "<a><b>1</b></a>"),
    "url_list": (route(target(["Pass"], url=["u", None, "w"])), "<a/>"),
    "url_none": (route(target(["Pass"], url=None)), "<a/>"),
    "url_empty": (route(target(["Pass"], url=[])), "<a/>"),
    "no_targets": (route(), "<a/>"),
    "null_targets": ('{"validate": "any"}', "<a/>"),
    "no_paths": (route(target()), "<a/>"),
    "empty_path": (one_path(), "<a/>", {"xform.group": "g"}),
    "aliased": (json.dumps({"validate": "any", "targets": [{"id": "t", "xforms": [["A://?k=1"]], "targetPath": "u"}]}), "<a/>"),
    "no_schema": (route(target(["Pass"]), validate="gone"), "<a/>"),
    "null_schema": (route(target(["Pass"]), validate=None), "<a/>"),
    "empty_schema": (route(target(["Pass"]), validate="empty"), "<a/>"),
    "broken_schema": (route(target(["Pass"]), validate="broken"), "<a/>"),
    "wrong_root": (one_path("Pass"), "<b/>"),
    "trailing": (one_path("Pass"), "<a/>x"),
    "two_roots": (one_path("Pass"), "<a/><a/>"),
    "null_content": (one_path("Pass"), None),
    "empty_content": (one_path("Pass"), ""),
    "prefix": (one_path("Pass"), "<a><p:b/></a>"),
    "sync": (route(target(["Pass"], response="back", input="XI", sync="true"), sync="true"), "<a/>"),
    "resume": (TWO, "not xml", AT),
    "resume_done": (TWO, "x", {**AT, "xform.stage": "9"}),
    "resume_blank": (TWO, "x", {**AT, "xform.stage": ""}),
    "resume_target": (TWO, "x", {**AT, "target.id": "q"}),
    "resume_path": (TWO, "x", {**AT, "xform.path": "5"}),
    "resume_negative": (TWO, "x", {**AT, "xform.path": "-1"}),
    "resume_text": (TWO, "x", {**AT, "xform.path": "one"}),
    "resume_stage": (TWO, "x", {**AT, "xform.stage": "one"}),
    "resume_reply": (TWO, "<a><b>2</b></a>", {**AT, "target.id": "r"}),
    "resume_json": (TWO, "no xml", {**AT, "target.id": "r"}),
    "resume_part": (TWO, "<a><b>1</b></a>", {"xform.stage": "0", "target.id": "t"}),
    "xpath_back": (one_path("Pass", "EvaluateXQuery://?Destination=flowfile-attribute&q=b"), "<p:a><b>7</b></p:a>", AT),
    "restricted": (route(target(["Pass"], id="x", syncValidation="true"), target(["Pass"], ["Pass"], id="y"), target(["Pass"], id="z"), targetsRestrict="to"),
                   "<a><to>y</to><to>z</to><to>q</to></a>"),
    "restricted_all": (route(target(["Pass"], id="x"), target(["Pass"], id="y"), targetsRestrict="to"), "<a/>"),
    "restricted_none": (route(target(["Pass"], id="x"), targetsRestrict="to"), "<a><to>q</to></a>"),
    "restricted_bad": (route(target(["Pass"], id="x"), targetsRestrict="to["), "<a/>"),
    "restricted_back": (route(target(["Pass", "Pass"], id="t"), targetsRestrict="to"), "<a><to>q</to></a>", AT),
    "soap": (one_path("Pass", output="SOAP"), "<?xml version='1.0'?><a/>"),
    "root": (one_path("Pass", rootTag="all"), "<?xml version='1.0'?><a/>"),
    "root_json": (one_path("Pass", rootTag="all", output="JSON"), "<a><b>1</b></a>"),
    "root_bad": (one_path("Pass", rootTag="1 x"), "<a/>"),
    "root_parked": (one_path(PARK, rootTag="all", output="SOAP"), "<a/>"),
    "xpath_back_bad": (one_path("Pass", "EvaluateXQuery://?Destination=flowfile-attribute&q=b"), "<a><b>7</b>", AT),
}


@pytest.fixture(scope="module", params=["compiled", "data"])
def routed(spark, request):
    got = run(spark, CASES, Settings(known_systems=("r",), steps_as_data=request.param == "data"))
    assert [w.slots.data for w in got.waves] == [request.param == "data"]
    return Routed(got)


def test_route_lookup(routed):
    for name in ("none", "blank"):
        row = routed.one(name)
        text = f"Route named:{name} not found!"
        assert (row["route"], row["error"], row["attrs"]["route.error"]) == ("failed", text, text)
        assert row["attrs"]["route.status.code"] == "501" and "error.msg" not in row["attrs"]
    assert routed.of("bad_json", "error.msg") == [("-/-/0", "failed", "route document is not JSON")]


def test_fan_out(routed):
    got = routed.of("fan", "Receiver", "target.id", "xform.path", "target_url", "s", "route.input", "target.output")
    assert got == [
        ("0/0/0/0", "deliver", "t", "t", "0", "u", "1", "X", None),
        ("0/0/0/1", "deliver", "t", "t", "0", "v", "1", "X", None),
        ("0/1/0/0", "deliver", "t", "t", "1", "u", None, "X", None),
        ("0/1/0/1", "deliver", "t", "t", "1", "v", None, "X", None),
        ("1/-/0", "reply", "r", None, None, None, None, None, None),
        ("1/0/0/0", "deliver", "r", "r", "0", "u", None, None, "JSON"),
    ]
    by_key = {r["lineage"]: r for r in routed.rows}
    assert by_key["fan/1/0/0/0"]["content"] == '{"a":{"b":1}}'
    assert by_key["fan/1/-/0"]["content"] == ""
    assert by_key["fan/1/-/0"]["attrs"]["sync.response"] == "true"
    assert by_key["fan/1/-/0"]["attrs"]["xform.stage"] == "-1"
    assert by_key["fan/0/0/0/0"]["attrs"]["target_system"] == "t"
    assert "target_system" not in by_key["fan/1/0/0/0"]["attrs"]


def test_destinations(routed):
    assert [r[2] for r in routed.of("url_list", "target_url")] == ["u", "null", "w"]
    assert routed.of("url_none", "target_url") == [("0/0/0/0", "deliver", "null")]
    assert routed.of("url_empty", "error.msg") == [("0/0/0", "failed", "no destinations")]


def test_empty_routes(routed):
    assert routed.of("no_targets", "error.msg") == routed.of("null_targets", "error.msg") == [("-/-/0", "failed", "no targets")]
    assert routed.of("no_paths", "error.msg") == [("0/none/0", "failed", "no transformations")]
    assert routed.of("empty_path", "xform.stage", "xform.group") == [("0/0/0/0", "deliver", "0", None)]
    assert routed.of("aliased", "k") == [("0/0/0/0", "deliver", "1")]


def test_validation(routed):
    gone = "Failed schema extraction! java.io.IOException: Schema with name {} not found"
    for name, schema in (("no_schema", "gone"), ("null_schema", "null"), ("empty_schema", "empty")):
        assert routed.of(name, "error.msg", "xform.stage") == [("-/-/0", "failed", gone.format(schema), "-1")]
    for name in ("broken_schema", "wrong_root", "trailing", "two_roots", "null_content", "empty_content", "prefix"):
        ((_, where, text),) = routed.of(name, "error.msg")
        assert where == "failed" and text.startswith("Failed xml validation!"), name


def test_sync_route(routed):
    keys = ["business.process.name", "route.status.code", "route.input", "route.sync", "processGroupId"]
    assert routed.of("sync", *keys) == [
        ("0/0/0/0", "deliver", "back", "", "XI", "true", "")
    ]


def test_resume(routed):
    assert routed.of("resume", "s", "e", "xform.stage") == [("0/0/0/0", "deliver", None, "", "1"), ("0/0/0/1", "deliver", None, "", "1")]
    assert routed.of("resume_done", "s", "e", "xform.stage")[0] == ("0/0/0/0", "deliver", None, None, "1")
    assert routed.of("resume_blank", "s", "e")[0] == ("0/0/0/0", "deliver", "1", "1")
    problem = "java.lang.NumberFormatException: For input string: \"one\""
    assert routed.of("resume_target", "error.msg") == [("-/-/0", "failed", "java.lang.IllegalArgumentException: Target not found")]
    assert routed.of("resume_path", "error.msg") == [("-/-/0", "failed", "java.lang.Exception: Incorrect transformation path 5")]
    assert routed.of("resume_negative", "error.msg") == [("-/-/0", "failed", "java.lang.Exception: Incorrect transformation path -1")]
    assert routed.of("resume_text", "error.msg") == routed.of("resume_stage", "error.msg") == [("-/-/0", "failed", problem)]
    assert routed.one("resume_text")["error"].startswith("Exception 'java.lang.NumberFormatException")
    assert routed.one("resume_reply")["content"] == '{"a":{"b":2}}'
    assert routed.one("resume_json")["route"] == "failed"
    assert len(routed.of("resume_part")) == 6
    assert routed.of("xpath_back", "q") == [("0/0/0/0", "deliver", "7")]
    assert routed.one("xpath_back_bad")["route"] == "failed"


def test_restricted_targets(routed):
    assert routed.of("restricted") == [("1/0/0/0", "deliver"), ("1/1/0/0", "deliver"), ("2/0/0/0", "deliver")]
    assert len(routed.of("restricted_all")) == 2
    assert routed.of("restricted_none", "error.msg") == [("-/-/0", "failed", "no permitted targets")]
    ((_, kind, why),) = routed.of("restricted_bad", "error.msg")
    assert kind == "failed" and "to[" in why
    assert routed.of("restricted_back") == [("0/0/0/0", "deliver")]


def test_output_forms(routed):
    framed = '<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Body><a/></soapenv:Body></soapenv:Envelope>'
    assert routed.one("soap")["content"] == framed
    assert routed.one("root")["content"] == "<all><a/></all>"
    assert routed.one("root_json")["content"] == '{"all":{"a":{"b":1}}}'
    assert routed.of("root_bad", "error.msg") == [("0/0/0", "failed", "Incorrect root tag 1 x")]
    assert routed.one("root_parked")["content"] == "<a/>"


def test_every_message_is_accounted_for(routed):
    assert {r["msg_id"] for r in routed.rows} == set(CASES)


AUDITED = {
    "m": (one_path("UpdateAttribute://?Receiver=me", "DuplicateFlowFile://?Number=1", "Custom://?filename=g"), "<a/>",
          {"filename": "f", "path": "/p", "http.request.uri": "/sap/xi", "sap.Interface.value": "own"}),
    "drop": (one_path("Pass", "RouteOnAttribute://?RoutingStrategy=r&Condition=false", "Late"), "<a/>", {"http.query.param.senderService": "S", "http.request.uri": "fixed"}),
    "fails": (one_path("Pass", "DuplicateFlowFile://?Number=x", "Late"), "<a/>", {"http.request.uri": "none"}),
}


def test_audit_and_lineage(spark, tmp_path):
    receivers = spark.createDataFrame([("own", "attribute"), ("fixed", "F"), ("none", "")], "uri string, receiver string")
    got = run(spark, AUDITED, Settings(shared_endpoint=("/sap/xi", "sap.Interface.value")))
    audit = got.audit(receivers, host="h", specification_base="s#")
    rows = sorted((tuple(r) for r in audit.select(
        "lineage", "entry_type", "step", "path", "stage", "file_name", "sender", "receiver", "derivation", "log_start").collect()), key=str)
    assert rows == sorted([
        ("m/0/0/0.0", "processing", "UpdateAttribute", "0", "0", "f", "Не указан", "me", None, None),
        ("m/0/0/0.0", "processing", "Custom", "0", "2", "g", "Не указан", "me", None, None),
        ("m/0/0/0.1", "start", None, None, None, "f", "Не указан", "me", "m/0/0/0", 1),
        ("m/0/0/0.1", "processing", "Custom", "0", "2", "g", "Не указан", "me", None, None),
        ("drop/0/0/0", "processing", "Pass", "0", "0", None, "S", "F", None, None),
        ("drop/0/0/0", "processing", "RouteOnAttribute", "0", "1", None, "S", "F", None, None),
        ("fails/0/0/0", "processing", "Pass", "0", "0", None, "Не указан", "Не определен", None, None),
    ], key=str)
    message = json.loads(audit_message(audit.where("msg_id = 'm' and entry_type = 'start'")).first()["message"])
    assert message["derivation"] == "m/0/0/0" and message["_LogStart"] == 1 and message["specification"] == "s#m"
    assert message["short_message"] == (
        "Сообщение в [Transform] c filename [f], бизнес-процесс [m], отправитель [Не указан], получатель [me]"
    )
    edges = {tuple(r) for r in got.lineage().collect()}
    assert ("m", "m/0", "clone") in edges and ("m/0", "m/0/0/0", "modified") in edges and ("m/0/0/0", "m/0/0/0.1", "copy") in edges
    assert [r["lineage"] for r in got.suppressed().collect()] == ["drop/0/0/0"]
    again = got.materialised(str(tmp_path / "rows"))
    assert again.audit(receivers).count() == 7 and again.routed().count() == got.routed().count()


def test_sinks_and_park_then_resume(spark, tmp_path):
    straight = {"m": (one_path("UpdateAttribute://?a=1", "UpdateAttribute://?b=${a}2"), "<a/>")}
    broken = {"m": (one_path("UpdateAttribute://?a=1", PARK, "UpdateAttribute://?b=${a}2"), "<a/>")}
    base = str(tmp_path / "out")
    write_routes(run(spark, broken).routed(), base)
    parked = read_route(spark, base, "parked")
    assert read_route(spark, base, "deliver").count() == 0 and parked.count() == 1
    routes, schemas = registries(spark, {"m": broken["m"][0]})
    back = route_messages(returned_messages(parked), routes, schemas).routed().collect()
    direct = run(spark, straight).routed().collect()
    keys = ["a", "b", "target_url", "Receiver"]
    assert [[r["attrs"][k] for k in keys] for r in back] == [[r["attrs"][k] for k in keys] for r in direct]
    assert [r["route"] for r in back] == ["deliver"] and back[0]["content"] == direct[0]["content"]


def test_plain_steps_make_one_plan(spark):
    cases = {f"p{i}": (one_path(f"UpdateAttribute://?k=v{i}&k=w${{k}}{i}", "Pass"), "<a/>", {"k": "old"}) for i in range(9)}
    cases["gone"] = (None, "<a/>")
    got = run(spark, cases, Settings(max_steps=3))
    assert len(got.waves) == 1 and got.waves[0].slots.data
    rows = Routed(got)
    assert {n: rows.one(n)["attrs"].get("k") for n in cases} == {**{f"p{i}": f"wold{i}" for i in range(9)}, "gone": None}


def test_many_compiled_steps_make_several_plans(spark):
    cases = {f"p{i}": (one_path(f"UpdateAttribute://?k=sql:'v{i}'", "Pass"), "<a/>") for i in range(4)}
    cases["many"] = (one_path(*[f"UpdateAttribute://?k=sql:'m{i}'" for i in range(6)]), "<a/>")
    cases["gone"] = (None, "<a/>")
    got = run(spark, cases, Settings(max_steps=2))
    assert len(got.waves) > 2
    rows = Routed(got)
    assert {n: rows.one(n)["attrs"].get("k") for n in cases} == {**{f"p{i}": f"v{i}" for i in range(4)}, "many": "m5", "gone": None}


def test_data_and_compiled_steps_agree(spark):
    """Random templates: odd placeholders, errors, keys of the plan itself."""
    r = random.Random(8)
    cases = {}
    for i in range(14):
        pairs = [(r.choice(["a", "b", "target.id", "xform.group", "copy.index", "Receiver"]), "".join(r.choices("ab$${}}.':()=x ", k=r.randint(0, 9))))
                 for _ in range(r.randint(1, 3))] if i else [("a", "${ b }x"), ("b", "${'a'}$")]
        query = "&".join(f"{k}={v}" for k, v in pairs)
        cases[f"u{i}"] = (one_path(f"UpdateAttribute://?{query}", f"Own://?{query}", "UpdateAttribute://?last=${a}|${b}|${target.id}|${copy.index}"), "<a/>", {"a": "A", "x": "X"})
    cases["copy"] = (one_path("DuplicateFlowFile://?Number=${n}", "UpdateAttribute://?c=${copy.index}", "SyncResponse", PARK), "<a/>", {"n": "2"})
    one, two = (run(spark, cases, Settings(steps_as_data=data)) for data in (False, True))
    key = lambda r: (r["lineage"], r["route"], str(r["error"]), sorted(r["attrs"].items()))
    assert all(w.slots.data for w in two.waves) and not any(w.slots.data for w in one.waves)
    assert sorted(map(key, one.routed().collect()), key=str) == sorted(map(key, two.routed().collect()), key=str)
    receivers = spark.createDataFrame([("x", "y")], "uri string, receiver string")
    assert sorted(map(str, one.audit(receivers).collect())) == sorted(map(str, two.audit(receivers).collect()))


def test_large_registry_and_checkpoint(spark):
    cases = {f"p{i}": (one_path("A://?k=1", "B://?l=2"), "<a/>") for i in range(5)}
    got = run(spark, cases, Settings(max_registry_bytes=0, cut_every=1))
    rows = Routed(got)
    assert [rows.one(n)["attrs"]["l"] for n in cases] == ["2"] * 5
    routes, schemas = registries(spark, {n: c[0] for n, c in cases.items()})
    hot = message_table(spark, [(f"m{i}", "<a/>", {"business.process.name": "p0"}) for i in range(40)])
    plan = route_messages(hot, routes, schemas, settings=Settings(max_registry_bytes=0)).routed()
    assert "__salt" in plan._jdf.queryExecution().toString() and plan.where("route = 'deliver'").count() == 40


def test_stream_equals_batch(spark, tmp_path):
    routes, schemas = registries(spark, {"p": TWO})
    receivers = spark.createDataFrame([("x", "y")], "uri string, receiver string")
    for name, table in (("routes", routes), ("schemas", schemas), ("receivers", receivers)):
        table.write.parquet(str(tmp_path / name))
    source = str(tmp_path / "in")
    rows = [(f"m{i}", f"<a><b>{i}</b></a>", {"business.process.name": "p" if i % 3 else "q"}) for i in range(30)]
    message_table(spark, rows).repartition(3).write.parquet(source)

    def tables():
        return {k: registry(spark, k, str(tmp_path / k)) for k in ("routes", "schemas", "receivers")}

    stream = messages(spark, source, streaming=True, max_files_per_trigger=1)
    query = route_stream(stream, tables, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(300)
    out = str(tmp_path / "out")
    routed = read_batches(spark, out, "routed")
    batch = route_messages(messages(spark, source), **{k: v for k, v in tables().items() if k != "receivers"}).routed()
    columns = ["lineage", "route", "content", "error"]
    assert sorted(map(str, routed.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    assert routed.select("batch").distinct().count() == 3
    assert read_batches(spark, out, "audit").count() == 20 * 4
    assert lineage_closure(read_batches(spark, out, "lineage")).join(routed, F.expr("node = lineage")).where("root = msg_id").count() == routed.count()
    assert read_batches(spark, out, "suppressed").count() == 0 and not list((tmp_path / "out" / "rows").iterdir())


def test_plan_over_a_stream_without_batches(spark, tmp_path):
    """The plan is stateless, so it also runs as a plain streaming query."""
    routes, schemas = registries(spark, {"p": TWO})
    source = str(tmp_path / "in")
    rows = [(f"m{i}", f"<a><b>{i}</b></a>", {"business.process.name": "p"}) for i in range(5)]
    message_table(spark, rows).write.parquet(source)
    routed = route_messages(messages(spark, source, streaming=True), routes, schemas).routed()
    query = (
        routed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("route").count().orderBy("route").collect() == [("deliver", 25), ("reply", 5)]


def test_messages_without_attributes(spark):
    routes, schemas = registries(spark, {"p": TWO})
    df = message_table(spark, [("null", "<a/>", None), ("empty", None, {}), ("blank", "<a/>", {"business.process.name": ""})])
    got = {r["msg_id"]: r for r in route_messages(df, routes, schemas).routed().collect()}
    assert {k: r["error"] for k, r in got.items()} == {
        "null": "Route named:null not found!", "empty": "Route named:null not found!", "blank": "Route named: not found!"}
    assert all(r["attrs"]["route.status.code"] == "501" for r in got.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_row_counts_and_conservation(spark, seed):
    """Rows out are the sum over paths of (copies + 1) x destinations; no message is lost."""
    import random

    rng = random.Random(seed)
    cases, expected = {}, {}
    for i in range(12):
        targets, count = [], 0
        for t in range(rng.randint(1, 3)):
            paths, urls = [], [f"u{k}" for k in range(rng.randint(1, 3))]
            for _ in range(rng.randint(1, 3)):
                copies = rng.choice([None, 0, 1, 3])
                steps = ["Pass"] * rng.randint(0, 2) + ([f"DuplicateFlowFile://?Number={copies}"] if copies is not None else [])
                rng.shuffle(steps)
                paths.append(steps)
                count += ((copies or 0) + 1) * len(urls)
            targets.append(target(*paths, id=f"t{t}", url=urls))
        cases[f"p{i}"] = (route(*targets), "<a/>")
        expected[f"p{i}"] = count
    rows = Routed(run(spark, cases)).rows
    assert {n: sum(r["msg_id"] == n for r in rows) for n in cases} == expected
    assert len({r["lineage"] for r in rows}) == len(rows)
