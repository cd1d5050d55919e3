"""Every step and its quirks, in one plan over one process per case."""

import pytest

from tests.helpers import Routed, message_table, one_path, registries, route, run, target
from waybill import Settings, register_step, route_messages
from waybill.operators.steps import STEPS, reshape

X = "EvaluateXQuery://?Destination=flowfile-attribute"
R = "ReplaceText://?ReplacementStrategy=RegexReplace"
MANY = "".join(f"<b>{i}</b>" for i in range(40))
LOST = "java.lang.ArrayIndexOutOfBoundsException: Index 1 out of bounds for length 1"

CASES = {
    "update": (one_path("UpdateAttribute://?a=1&b=${a}-${x}&c=${none}&d = spaced "), "<a/>", {"x": "7"}),
    "sql": (one_path("UpdateAttribute://?a=3&b=sql:cast(${a} as int) + 1&c=sql:size(attrs)&d=sql:length(content)"), "<a/>", {"x": "7"}),
    "second_eq": (one_path("UpdateAttribute://?a=k=v://w"), "<a/>"),
    "no_params": (one_path("UpdateAttribute", "Pass", "Bare://?"), "<a/>"),
    "no_value": (one_path("UpdateAttribute://?a=1&b"), "<a/>"),
    "host_fn": (one_path("UpdateAttribute://?a=${x:toUpper()}"), "<a/>"),
    "dollar": (one_path("HandOff://?a=${spark.app.name}&b=x"), "<a/>"),
    "drop": (one_path("RouteOnAttribute://?RoutingStrategy=r&Condition=${x}", "UpdateAttribute://?a=1"), "<a/>", {"x": "false"}),
    "keep": (one_path("RouteOnAttribute://?RoutingStrategy=r&Condition=${x}", "UpdateAttribute://?a=1"), "<a/>", {"x": "False"}),
    "drop_sql": (one_path("RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${x} > 'b'", "UpdateAttribute://?a=1"), "<a/>", {"x": "a"}),
    "keep_null": (one_path("RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${x} > 'b'", "UpdateAttribute://?a=1"), "<a/>"),
    "drop_last": (one_path("UpdateAttribute://?a=1", "RouteOnAttribute://?RoutingStrategy=r&Condition=false"), "<a/>"),
    "no_condition": (one_path("RouteOnAttribute://?RoutingStrategy=r"), "<a/>"),
    "park": (one_path("UpdateAttribute://?a=1", "RouteOnContent://?MatchRequirement=m&RouteCondition=c-${a}&Result=${a}", "UpdateAttribute://?a=2"), "<a/>"),
    "park_last": (one_path("RouteOnContent://?MatchRequirement=m&RouteCondition=c"), "<a/>"),
    "park_last_json": (one_path("RouteOnContent://?MatchRequirement=m&RouteCondition=c", output="JSON"), "<a><b>1</b></a>"),
    "park_half": (one_path("RouteOnContent://?MatchRequirement=m"), "<a/>"),
    "replace": (one_path(f"{R}&SearchValue=(\\d)&ReplacementValue=<$1>"), "<a>1x2</a>"),
    "replace_none": (one_path(f"{R}&SearchValue=z+&ReplacementValue=y"), "<a>1x2</a>"),
    "replace_literal": (one_path(f"{R}&SearchValue=x&ReplacementValue=$x\\1"), "<a>1x2</a>"),
    "replace_attr": (one_path(f"{R}&SearchValue=${{p}}&ReplacementValue=$1${{q}}"), "<a>1x2</a>", {"p": "(x)", "q": "!"}),
    "replace_bad_attr": (one_path(f"{R}&SearchValue=${{p}}&ReplacementValue=y"), "<a>1x2</a>", {"p": "(x"}),
    "replace_bad": (one_path(f"{R}&SearchValue=(x&ReplacementValue=y"), "<a>1x2</a>"),
    "replace_group": (one_path(f"{R}&SearchValue=x&ReplacementValue=$3"), "<a>1x2</a>"),
    "replace_group_unused": (one_path(f"{R}&SearchValue=z&ReplacementValue=$3"), "<a>1x2</a>"),
    "replace_plain": (one_path(f"{R}&SearchValue=x&ReplacementValue=${{q}}"), "<a>1x2</a>", {"q": "Q"}),
    "replace_ref": (one_path(f"{R}&SearchValue=(x)&ReplacementValue=${{q}}"), "<a>1x2</a>", {"q": "$1$1"}),
    "replace_mode": (one_path("ReplaceText://?ReplacementStrategy=Prepend&SearchValue=x&ReplacementValue=y"), "<a/>"),
    "replace_missing": (one_path("ReplaceText://?ReplacementStrategy=RegexReplace&SearchValue=x"), "<a/>"),
    "xpath": (one_path(f"{X}&one=c&two=b&none=zz&n=count(b)&at=@k&deep=c/d"), "<a k='v'><b>1</b><b>2</b><c>x<d>y</d>z</c></a>"),
    "xpath_many": (one_path(f"{X}&i=b"), f"<?xml version='1.0'?><a>{MANY}</a>"),
    "xpath_nested": (one_path(f"{X}&i=//b"), f"<a><b>s<b>t</b><![CDATA[u]]></b>{MANY}</a>"),
    "xpath_ancestor": (one_path(f"{X}&i=//b[ancestor::a]"), f"<a>{MANY}</a>"),
    "xpath_attrs": (one_path(f"{X}&i=//@k"), "<a>" + "".join(f"<b k='{i}'/>" for i in range(12)) + "</a>"),
    "xpath_counts": (one_path(f"{X}&n=count(b)&more=count(b) > 1&half=count(b) div 2&long=count(b{' | c' * 23})&z=count(//zz)"), "<a><b>1</b><b>2</b><b/></a>"),
    "xpath_abs": (one_path(f"{X}&i=/a/b|//c"), "<a><b>1</b><c>2</c></a>"),
    "xpath_bad": (one_path(f"{X}&i=b["), "<a/>"),
    "xpath_kind": (one_path(f"{X}&i=string(b)"), "<a/>"),
    "xpath_dest": (one_path("EvaluateXQuery://?Destination=flowfile-content&i=b"), "<a/>"),
    "xpath_broken": (one_path(f"{R}&SearchValue=</a>&ReplacementValue=<", f"{X}&i=b"), "<a><b>1</b></a>"),
    "xpath_slot": (one_path("UpdateAttribute://?i.2=old", f"{X}&i=b", "UpdateAttribute://?j=${i.1}+${i.2}"), "<a><b>1</b><b>2</b></a>"),
    "xpath_extra": (one_path(f"{X}&q=b", "UpdateAttribute://?j=${q.1}+${q.2}"), "<a><b>1</b><b>2</b></a>"),
    "copies": (one_path("DuplicateFlowFile://?Number=${n}", "UpdateAttribute://?c=${copy.index}"), "<a/>", {"n": "2"}),
    "copies_last": (one_path("DuplicateFlowFile://?Number=1"), "<a/>"),
    "copies_nested": (one_path("DuplicateFlowFile://?Number=1", "DuplicateFlowFile://?Number=1"), "<a/>"),
    "copies_negative": (one_path("DuplicateFlowFile://?Number=-3"), "<a/>"),
    "copies_bad": (one_path("DuplicateFlowFile://?Number=many"), "<a/>"),
    "reply": (one_path("UpdateAttribute://?a=1", "SyncResponse", "UpdateAttribute://?a=2"), "<a>q</a>"),
    "hand_off": (one_path("Custom://?a=${x}&b=2", "UpdateAttribute://?g=${xform.group}"), "<a/>", {"x": "7"}),
    "json": (one_path(output="JSON"), "<a k='v'><b>1</b><b>x</b><c><d>2.50</d></c></a>"),
    "json_attr": (one_path("UpdateAttribute://?target.output=JSON"), "<a><b>1</b></a>"),
    "json_bad": (one_path(f"{R}&SearchValue=</a>&ReplacementValue=<", output="JSON"), "<a><b>1</b></a>"),
    "envelope": (one_path("ApplyXslt://?Name=RemoveEnvelope.xsl"), "<a><s:Body xmlns:s='u'> <b>1</b> </s:Body></a>"),
    "shape": (one_path("ApplyXslt://?Name=Swap"), "<a><b>1</b><c>x</c></a>"),
    "shape_none": (one_path("ApplyXslt://?Name=Nope"), "<a/>"),
}


@pytest.fixture(scope="module", params=["compiled", "data"])
def routed(spark, request):
    """The same cases where every step is compiled and where plain ones run as data."""
    shapes = spark.createDataFrame(
        [("Swap", "b int, c string", "named_struct('y', doc.c, 'z', doc.b + 1)", "out")],
        "name string, input_ddl string, expr string, root_tag string",
    )
    got = run(spark, CASES, Settings(steps_as_data=request.param == "data"), reshapes=shapes)
    assert [w.slots.data for w in got.waves] == [request.param == "data"]
    return Routed(got)


def test_update(routed):
    assert routed.of("update", "a", "b", "c", "d") == [("0/0/0/0", "deliver", "1", "1-7", "", "spaced")]
    assert routed.of("second_eq", "a") == [("0/0/0/0", "deliver", "k=v://w")]
    assert routed.of("no_params", "Receiver", "target.id", "xform.path", "xform.stage") == [("0/0/0/0", "deliver", "t", "t", "0", "2")]
    assert routed.of("no_value", "error.msg", "a") == [("0/0/0", "failed", LOST, None)]
    assert routed.of("host_fn")[0][1] == "failed"
    assert routed.of("dollar", "a") == [("0/0/0/0", "deliver", "${spark.app.name}")]


def test_sql_template(routed):
    ((_, route_, b, c, d),) = routed.of("sql", "b", "c", "d")
    assert (route_, b, d) == ("deliver", "4", "4")
    assert int(c) >= 4  # process, x, a, b and the position attributes


def test_filter(routed):
    assert routed.of("drop") == routed.of("drop_last") == routed.of("drop_sql") == []
    assert routed.of("keep", "a") == routed.of("keep_null", "a") == [("0/0/0/0", "deliver", "1")]
    assert routed.of("no_condition", "error.msg") == [
        ("0/0/0", "failed", "java.lang.IllegalArgumentException: RouteOnAttribute Condition")
    ]


def test_park(routed):
    keys = ["content.match.strategy", "route.on.content.condition", "route.on.content.result", "xform.group", "xform.stage", "xform.last", "a"]
    assert routed.of("park", *keys) == [("0/0/0/0", "parked", "m", "c-1", "1", "RouteOnContent", "1", None, "1")]
    assert routed.of("park_last", "xform.last", "route.on.content.result") == [("0/0/0/0", "parked", "true", None)]
    assert routed.of("park_last_json", "xform.last") == [("0/0/0/0", "parked", None)]
    assert routed.one("park_last_json")["content"] == "<a><b>1</b></a>"
    assert routed.of("park_half", "content.match.strategy")[0][1:] == ("failed", "m")


def test_replace(routed):
    assert routed.one("replace")["content"] == "<a><1>x<2></a>"
    assert routed.one("replace_none")["content"] == "<a>1x2</a>"
    assert routed.one("replace_literal")["content"] == "<a>1$x\\12</a>"
    assert routed.one("replace_attr")["content"] == "<a>1x!2</a>"
    assert routed.one("replace_plain")["content"] == "<a>1Q2</a>"
    assert routed.one("replace_ref")["content"] == "<a>1xx2</a>"
    assert routed.one("replace_group_unused")["content"] == "<a>1x2</a>"
    for bad in ("replace_bad", "replace_bad_attr", "replace_group", "replace_mode", "replace_missing"):
        assert routed.one(bad)["route"] == "failed", bad
    assert routed.of("replace_mode", "error.msg", "replace.text.mode") == [
        ("0/0/0", "failed", "java.lang.Exception: Incorrect replace strategy", "Prepend")
    ]
    assert "ReplaceText ReplacementValue" in routed.one("replace_missing")["error"]
    keys = ["replace.text.mode", "replace.text.search.value", "replace.text.replacement.value"]
    assert routed.of("replace", *keys) == [("0/0/0/0", "deliver", "RegexReplace", "(\\d)", "<$1>")]


def test_xpath(routed):
    keys = ["one", "two", "two.1", "two.2", "two.3", "none", "n", "at", "deep"]
    assert routed.of("xpath", *keys) == [("0/0/0/0", "deliver", "xyz", None, "1", "2", None, None, "2", "v", "y")]
    attrs = routed.one("xpath_many")["attrs"]
    assert [attrs.get(f"i.{k}") for k in range(1, 42)] == [*map(str, range(40)), None]
    attrs = routed.one("xpath_nested")["attrs"]
    assert [attrs.get(f"i.{k}") for k in range(1, 44)] == ["stu", "t", *map(str, range(40)), None]
    attrs = routed.one("xpath_ancestor")["attrs"]
    assert [attrs.get(f"i.{k}") for k in range(1, 42)] == [*map(str, range(40)), None]
    attrs = routed.one("xpath_attrs")["attrs"]
    assert [attrs.get(f"i.{k}") for k in range(1, 14)] == [*map(str, range(12)), None]
    assert routed.of("xpath_counts", "n", "more", "half", "long", "z") == [("0/0/0/0", "deliver", "3", "true", "1.5", "3", "0")]
    assert routed.of("xpath_abs", "i.1", "i.2") == [("0/0/0/0", "deliver", "1", "2")]
    assert routed.of("xpath_slot", "i.1", "i.2", "j") == [("0/0/0/0", "deliver", "1", "2", "1+2")]
    assert routed.of("xpath_extra", "j") == [("0/0/0/0", "deliver", "1+2")]
    for bad in ("xpath_bad", "xpath_kind", "xpath_dest", "xpath_broken"):
        assert routed.one(bad)["route"] == "failed", bad


def test_copies(routed):
    assert routed.of("copies", "copy.index", "c") == [
        ("0/0/0.0/0", "deliver", "0", "0"), ("0/0/0.1/0", "deliver", "1", "1"), ("0/0/0.2/0", "deliver", "2", "2")
    ]
    assert [r[0] for r in routed.of("copies_last")] == ["0/0/0.0/0", "0/0/0.1/0"]
    assert [r[0] for r in routed.of("copies_nested")] == ["0/0/0.0.0/0", "0/0/0.0.1/0", "0/0/0.1.0/0", "0/0/0.1.1/0"]
    assert len(routed.of("copies_negative")) == 1
    assert routed.of("copies_bad", "error.msg") == [
        ("0/0/0", "failed", 'java.lang.NumberFormatException: For input string: "many"')
    ]


def test_reply(routed):
    assert routed.of("reply", "a", "sync.response") == [
        ("0/0/0.r1", "reply", "1", "true"), ("0/0/0/0", "deliver", "2", None)
    ]
    assert [r["content"] for r in routed.rows if r["msg_id"] == "reply"] == ["", "<a>q</a>"]


def test_hand_off(routed):
    assert routed.of("hand_off", "a", "b", "g", "xform.group") == [("0/0/0/0", "deliver", "${x}", "2", "Custom", None)]


def test_json(routed):
    assert routed.one("json")["content"] == '{"a":{"b":[1,"x"],"c":{"d":2.5},"k":"v"}}'
    assert routed.one("json_attr")["content"] == '{"a":{"b":1}}'
    assert routed.of("json_bad", "error.msg") == [("0/0/0", "failed", "java.lang.Exception: Failed xml convertation!")]


def test_reshape(routed):
    assert routed.one("envelope")["content"] == CASES["envelope"][1]  # the root is no envelope
    assert "".join(routed.one("shape")["content"].split()) == "<out><y>x</y><z>2</z></out>"
    assert routed.of("shape_none", "error.msg") == [
        ("0/0/0", "failed", "java.io.IOException: XSLT with the name Nope not found")
    ]


def test_error_context(routed):
    assert routed.one("copies_bad")["error"] == (
        "Exception 'java.lang.NumberFormatException: For input string: \"many\"' occurs while processing FlowFile 'null'"
        " in 'copies_bad' scenario at 't' target at '0' path at 0 stage"
    )


def test_legacy_filters_and_ordered_json(spark):
    drop = "RouteOnAttribute://?RoutingStrategy=r&Condition=false"
    cases = {
        "last": (one_path("UpdateAttribute://?a=1", drop), "<a/>"),
        "stop": (route(target(["Pass"], [drop, "Pass"], ["Pass"]), target(["Pass"], id="t2")), "<a/>"),
        "json": (one_path(output="JSON"), "<a k='v'><b>1</b><c><d>é</d> </c><b/><b>x<i>y</i></b></a>"),
        "json_text": (one_path(output="JSON"), "<a>text</a>"),
        "json_ns": (one_path(output="JSON"), "<a><p:b xmlns:p='u'>1</p:b></a>"),
    }
    settings = Settings(legacy_last_filter=True, stop_target_on_suppress=True, ordered_json=True)
    got = Routed(run(spark, cases, settings))
    assert got.of("last", "a") == [("0/0/0/0", "deliver", "1")]
    assert [r[0] for r in got.of("stop")] == ["0/0/0/0", "1/0/0/0"]
    assert got.one("json")["content"] == '{"a":[{"b":["1"]},{"c":[{"d":["\\u00e9"]}]},{"b":[]},{"b":["x",{"i":["y"]}]}]}'
    assert got.one("json_text")["route"] == "failed"
    assert got.one("json_ns")["content"] == '{"a":[{"{u}b":["1"]}]}'


def test_own_step(spark):
    @register_step("Shout")
    def shout(ctx):
        ctx.set("loud", f"upper({ctx.render(ctx.required('Text'))})")

    try:
        got = Routed(run(spark, {"m": (one_path("Shout://?Text=${x}"), "<a/>", {"x": "hey"})}))
        assert got.of("m", "loud") == [("0/0/0/0", "deliver", "HEY")]
    finally:
        del STEPS["Shout"]


def test_reshape_leaves_literals(spark):
    """A field and a text named like the document stay, and the content is one line."""
    df = spark.createDataFrame([("<a><b>1</b></a>",)], "content string")
    out = reshape(df, "b string", "named_struct('doc', doc.b, 'kind', 'the doc')", "o").first()[0]
    assert out == "<o><doc>1</doc><kind>the doc</kind></o>"


def test_broken_steps_fail_alone(spark):
    """Templates that Spark can't read, casts that fail and huge numbers cost their own rows only."""
    docs = {
        "ok": one_path("UpdateAttribute://?a=1"), "unknown": one_path("UpdateAttribute://?a=sql:nofn(${x})"),
        "cast": one_path("UpdateAttribute://?a=sql:cast(${x} as int)"), "many": one_path("DuplicateFlowFile://?Number=00000000000000002"),
        "huge": one_path("DuplicateFlowFile://?Number=99999999999"), "quoted": one_path("UpdateAttribute://?a=sql:concat('${x}')"),
    }
    routes, schemas = registries(spark, docs)
    df = message_table(spark, [(p, "<a/>", {"business.process.name": p, "x": "q"}) for p in docs])
    rows = route_messages(df, routes, schemas).routed().collect()
    got = {}
    for r in rows:
        got.setdefault(r["msg_id"], []).append(r["route"])
    assert got == {"ok": ["deliver"], "unknown": ["failed"], "cast": ["deliver"], "many": ["deliver"] * 3, "huge": ["failed"], "quoted": ["failed"]}
