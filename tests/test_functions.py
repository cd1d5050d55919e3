"""Expression builders and lookups on small fixtures."""

import html
import json
import random
import re
import xml.etree.ElementTree as ET

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog import queries
from catalog.inputs import order_messages, run
from tests.helpers import message_table
from waybill import session
from waybill.functions import text, xmlfn
from waybill.functions.patterns import runs_deep
from waybill.functions.render import TemplateError, lit, render
from waybill.functions.text import decoded, remove_envelope, status_code, wrap_root
from waybill.functions.total import PartialExpression, total
from waybill.functions.xmlfn import _ordered, compact_json, root_name, schema_file, schema_problem, sure_form, valid_xml, well_formed
from waybill.functions.xpath import OPERATOR_LIMIT, field_values, from_root, pack_paths, xpath_fields, xpath_problem
from waybill.operators.lookup import lookup_failed, lookup_passed, multi_lookup, receiver_lookup
from waybill.operators.restrict import content_matches, fan_out_permitted, with_permitted
from waybill.session import lookup_join, spread
from waybill.sources.registry import parse_routes, steps
from waybill.sources.sinks import read_route


@pytest.mark.parametrize("path, expected", [
    ("b", "/*/b"),
    ("a|b", "/*/a | /*/b"),
    ("/a/b", "/ a / b"),
    ("//x", "// x"),
    ("@id", "/*/@ id"),
    (".", "/*/."),
    ("count(item[@k=/o/x]) + 1", "count ( /*/item [ @ k = / o / x ] ) + 1"),
    ("name()", "name ( /* )"),
    ("a[b and c]/d", "/*/a [ b and c ] / d"),
    ("2 * count(*)", "2 * count ( /*/* )"),
    ("/ | a[/b]", "/ | /*/a [ / b ]"),
    ("concat(a,'x/y',text())", "concat ( /*/a , 'x/y' , /*/text ( ) )"),
])
def test_paths_start_at_the_root(path, expected):
    assert from_root(path) == expected


@given(st.recursive(
    st.sampled_from(["x", "", "<?pi?>", "<!-- - -->", "&amp;", "<![CDATA[c]]>"]),
    lambda inner: st.lists(st.tuples(st.sampled_from("bc"), inner), max_size=4).map(lambda kids: "".join(f"<{t}>{k}</{t}>y" for t, k in kids)),
    max_leaves=12,
), st.sampled_from(["b", "//b", "b|c", "//*", "//b[ancestor::c]", "//text()"]))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_all_ways_to_read_nodes_agree(spark, body, path):
    """Packed values of many nodes against the unlimited reading with none packed."""
    content = f"<?xml version='1.0'?><a k='v'>{body}</a>"
    df = spark.createDataFrame([(content,)], "content string")
    got = []
    for nodes in (10, 0, 1):
        (at,) = pack_paths([path], nodes)
        work = df.withColumn("f", F.expr(xpath_fields("content", [at])))
        got.append((at.nodes, work.selectExpr("f[1]", f"{field_values('f', 'content', at)} as v").first()))
    (most, (count, values)), *others = got
    assert len(values) == int(count)
    assert all(row["v"] == values for _, row in others)


def test_packs_stay_under_the_operator_limit():
    places = pack_paths(["a/b/c", "d", "/x//y[@k='v']", "e" + "/f" * 40, "g"])
    assert [p.path for p in places][0] == "a/b/c" and places[3].nodes < 4
    assert len({p.pack for p in places}) > 1


def test_rendering():
    assert render("plain") == "'plain'"
    assert render("a${x}b") == "concat('a', coalesce(attrs['x'], ''), 'b')"
    assert render("") == "''"
    assert lit("it's ${x}\\") == "'it\\'s \\u0024{x}\\\\'"
    with pytest.raises(TemplateError):
        render("${x:equals('a')}")


def test_literals_survive_sql(spark):
    texts = ["it's", "a\\b", "${spark.app.name}", "\\u0041", "line\nbreak", "ключ", '"', "\\"]
    row = spark.range(1).selectExpr(*[f"{lit(t)} as c{i}" for i, t in enumerate(texts)]).first()
    assert list(row) == texts


@given(st.lists(st.sampled_from(["<a>", "</a>", "<b/>", "x", " ", "&lt;", "<!-- c -->", "<![CDATA[y]]>"]), max_size=8))
def test_ordered_json_agrees_with_a_parser(parts):
    text = "<r>" + "".join(parts) + "</r>"
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        assert _ordered(text) is None
        return
    bare = (root.text or "") + "".join(c.tail or "" for c in root)
    assert (_ordered(text) is None) == bool(bare.strip())


def test_driver_checks(spark):
    assert xpath_problem(spark, "b/c", nodes=True) is None
    assert "XPath" in xpath_problem(spark, "b[", nodes=True)
    assert xpath_problem(spark, "string(b)", nodes=True) and xpath_problem(spark, "string(b)", nodes=False) is None
    assert xpath_problem(spark, "a" + "/b" * OPERATOR_LIMIT, nodes=True)
    assert xpath_problem(spark, "$v", nodes=False)
    assert schema_problem(spark, "<nope") and schema_problem(spark, "<xs:schema xmlns:xs='http://www.w3.org/2001/XMLSchema'/>") is None


def test_well_formed(spark):
    good = ["<a/>", " <a/> ", "<?xml version='1.0' encoding='UTF-16'?><a/>", "<p:a q:z='1'/>", "<!-- c --><a/><?pi x?>", "<a><![CDATA[<]]></a>"]
    bad = ["", "a", "<a>", "<a/>x", "<a/><a/>", "</w><w>", "<a/></w><w><a/>", "<a>&nbsp;</a>", "\ufeff<a/>", "<a>\x01</a>",
           "<!DOCTYPE a><a/>", " <?xml version='1.0'?><a/>", "<?xml version='1.1'?><a/>", None]
    df = spark.createDataFrame([(c, True) for c in good] + [(c, False) for c in bad], "content string, expected boolean")
    checked = df.withColumn("ok", F.expr(well_formed(spark, "content"))).withColumn(
        "name", F.expr("case when ok then xpath_string(content, 'name(/*)') end"))
    assert checked.where("ok <> expected").collect() == []


def test_small_functions(spark):
    df = spark.createDataFrame([("XI", "200"), ("XI", "500"), ("X", "500"), (None, "7")], "p string, c string")
    assert [r[0] for r in df.selectExpr(status_code("p", "c")).collect()] == ["XI_OK", None, "500", "7"]
    row = spark.range(1).selectExpr(wrap_root("'<a/>'"), decoded("encode('é', 'UTF-16')", "UTF-16")).first()
    assert tuple(row) == ("<root><a/></root>", "é")


def test_multi_lookup(spark):
    table = spark.createDataFrame([("a", bytearray("é" * 300, "utf-8")), ("b", bytearray(b"B"))], "key string, value binary")
    cases = {"one": "a", "two": " a , b,,", "twice": "b,b", "gone": "a,z", "blank": "a, ", "none": "", "comma": ","}
    df = message_table(spark, [(k, "old", {"k": v, "v.b": "was"}) for k, v in cases.items()])
    into = {r["msg_id"]: r for r in multi_lookup(df, "${k}", table, attribute="v", max_length=256).collect()}
    assert into["one"]["attrs"]["v"] == "é" * 256 and into["one"]["content"] == "old"
    assert into["two"]["attrs"]["v.b"] == "B" and into["two"]["attrs"]["v.a"] == "é" * 256
    assert into["twice"]["attrs"]["v.b"] == "B"
    assert into["gone"]["error"] == "not every key was found" and into["gone"]["attrs"]["v.b"] == "was"
    assert into["blank"]["error"] == "no key to look up"
    assert into["none"]["error"] is None and into["comma"]["error"] is None
    body = {r["msg_id"]: r for r in multi_lookup(df, "${k}", table, limit=0).collect()}
    assert body["one"]["content"] == "é" * 300 and body["two"]["content"] == "old"
    assert "Multiple Cache Value Identifiers" in body["two"]["error"]
    whole = {r["msg_id"]: r for r in multi_lookup(df, "${k}", table.unionByName(table), attribute="v").collect()}
    assert len(whole) == len(cases) and whole["one"]["attrs"]["v"] == "é" * 300  # no cut unless asked for; keys twice count once
    many = message_table(spark, [("m", "old", {"k": ",".join(f"k{i}" for i in range(1000))})])
    values = spark.createDataFrame([(f"k{i}", f"v{i}") for i in range(1000)], "key string, value string")
    got = multi_lookup(many, "${k}", values, attribute="v").first()
    assert got["error"] is None and got["attrs"]["v.k999"] == "v999" and got["attrs"]["v.k0"] == "v0"
    for limit in (10**6, 0):
        looked = multi_lookup(df, "${k}", table, attribute="v", limit=limit)
        failed = {r["msg_id"]: r for r in lookup_failed(looked).collect()}
        assert set(failed) == {"gone", "blank"} and failed["gone"]["attrs"]["error.msg"] == failed["gone"]["error"] == "not every key was found"
        assert failed["gone"]["route"] == "failed" and failed["gone"]["content"] == "old"
        assert lookup_passed(looked).columns == df.columns and lookup_passed(looked).count() == len(cases) - 2
    assert multi_lookup(df.limit(0), "${k}", table, attribute="v").count() == 0


def test_one_value_per_key(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b")], "msg_id string, k string")
    right = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    for limit in (10**6, 0):
        rows = lookup_join(left, right, "k", limit=limit, salt_by=F.col("msg_id")).selectExpr("msg_id", "v").collect()
        assert sorted(map(tuple, rows)) == [("1", "y"), ("2", "z")]


def test_quoted_text_in_templates_stays(spark):
    df = message_table(spark, [("m", "c", {"x": "q", "n": "7"})])
    assert df.selectExpr(render("sql:concat('attrs of ', ${x}, size(attrs))")).first()[0] == "attrs of q2"
    assert df.selectExpr(render("sql:coalesce(cast(${x} as int), cast(${n} as int))")).first()[0] == "7"
    with pytest.raises(TemplateError):
        render("sql:concat('${x}', 'b')")


def test_bad_match_pattern_matches_nothing(spark):
    df = spark.createDataFrame([("abc", "b"), ("abc", "("), ("abc\n", "abc"), ("abc", "a.c"), (None, "a")], "t string, c string")
    part, whole = (df.selectExpr(content_matches("t", "c", *how)).collect() for how in ((), ("whole",)))
    assert [r[0] for r in part] == [True, False, True, True, None]
    assert [r[0] for r in whole] == [False, False, False, True, None]


def test_json_keeps_codes(spark):
    text = '<r a="007" b="7"><z>007</z><y>10</y><n/><t>see 00 and "x":null</t><z>0.5</z></r>'
    got = json.loads(spark.createDataFrame([(text,)], "c string").selectExpr(compact_json("c")).first()[0])
    assert got["r"]["z"] == ["007", 0.5] and got["r"]["a"] == "007" and got["r"]["b"] == 7 and got["r"]["y"] == 10
    assert got["r"]["n"] == "" and got["r"]["t"] == 'see 00 and "x":null'


def test_envelopes(spark):
    ns = "http://schemas.xmlsoap.org/soap/envelope/"
    s_ = f"<s:Envelope xmlns:s='{ns}'"
    cases = {
        "<mail><Body>hi</Body><x/></mail>": "<mail><Body>hi</Body><x/></mail>",
        f'<s:Envelope xmlns:s="{ns}"><s:Body/></s:Envelope>': "",
        f'<s:Envelope xmlns:s="{ns}"><s:Body> </s:Body></s:Envelope>': "",
        f"{s_} xmlns:q='u'><s:Header/><s:Body><q:b>1</q:b></s:Body></s:Envelope>": "<q:b xmlns:q='u'>1</q:b>",
        f'<Envelope xmlns="{ns}"><Body><b>1</b></Body></Envelope>': "<b>1</b>",
        # An element of the header may be named like the body, and things may stand around the root.
        f"{s_}><s:Header><Body>no</Body></s:Header><s:Body><x/></s:Body></s:Envelope>": "<x/>",
        f"<?xml version='1.0'?><!-- a > b --><?pi x?>{s_}><!-- c --><s:Body><x/></s:Body></s:Envelope><!-- d -->": "<x/>",
        f"{s_} xmlns='urn:d'><s:Body><x><y/></x></s:Body></s:Envelope>": "<x xmlns='urn:d'><y/></x>",
        f"{s_} xmlns='urn:d'><s:Body xmlns='urn:e'><x/></s:Body></s:Envelope>": "<x xmlns='urn:e'/>",
        f"{s_} xmlns='urn:d'><s:Body><x xmlns='urn:f'/></s:Body></s:Envelope>": "<x xmlns='urn:f'/>",
        f"{s_}><s:Header xmlns:q='v'/><s:Body xmlns:q='u'><q:x/></s:Body></s:Envelope>": "<q:x xmlns:q='u'/>",
        f"{s_} a='1 > 0'><s:Body b=\"x>y\"><x/>t<z k='>'/></s:Body></s:Envelope>": "<x/>t<z k='>'/>",
        f"{s_}><s:Body><w><s:Body>in</s:Body></w></s:Body></s:Envelope>": f"<w xmlns:s='{ns}'><s:Body>in</s:Body></w>",
        # What has no form to cut is told, not corrupted.
        f"{s_}><s:Header><s:Header>x</s:Header><s:Body>no</s:Body></s:Header><s:Body><x/></s:Body></s:Envelope>": None,
        f"{s_}><s:Body><x/></s:Body><s:Body><y/></s:Body></s:Envelope>": None,
        f"{s_}><s:Header/></s:Envelope>": None,
        f"{s_} xmlns:q='u'><s:Body><!-- q:y --> <q:x/></s:Body></s:Envelope>": "<!-- q:y --> <q:x xmlns:q='u'/>",
        f"{s_}><s:Body><![CDATA[</s:Body>]]></s:Body></s:Envelope>": "<![CDATA[</s:Body>]]>",
    }
    df = spark.createDataFrame([(i, text) for i, text in enumerate(cases)], "i int, c string")
    got = {r[0]: r[1] for r in df.selectExpr("i", remove_envelope(spark, "c")).collect()}
    assert {text: got[i] for i, text in enumerate(cases)} == cases


def test_receiver_lookup(spark):
    receivers = spark.createDataFrame([("/a", "A"), ("/own", "attribute"), ("/none", "")], "uri string, receiver string")
    df = spark.createDataFrame([("1", "/a", "me"), ("2", "/own", "me"), ("3", "/own", None), ("4", "/none", "me"), ("5", None, "me")],
                               "msg_id string, u string, own string")
    got = {r["msg_id"]: r["receiver"] for r in receiver_lookup(df, receivers, "u", "own").collect()}
    assert got == {"1": "A", "2": "me", "3": "Не определен", "4": "Не определен", "5": "Не определен"}


def test_salted_join_keeps_every_row(spark):
    left = spark.range(1000).selectExpr("cast(id as string) as msg_id", "case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end as k")
    right = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    plain, salted = (lookup_join(left, right, "k", limit=limit).selectExpr("msg_id", "v").collect() for limit in (10**6, 0))
    assert sorted(map(str, plain)) == sorted(map(str, salted)) and len(salted) == 1000


def test_permitted_targets(spark):
    df = spark.createDataFrame([("1", "<a><to>x</to><to>y</to></a>"), ("2", "<a/>"), ("3", "not xml"), ("4", "<a><to>q</to></a>")],
                               "msg_id string, content string")
    got = fan_out_permitted(with_permitted(df, "to"), "array('x', 'y', 'z')")
    assert sorted((r["msg_id"], r["target_id"]) for r in got.collect()) == [
        ("1", "x"), ("1", "y"), *[("2", t) for t in "xyz"], *[("3", t) for t in "xyz"]
    ]


def test_only_small_inputs_are_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).coalesce(1).write.parquet(path)
    assert spread(spark.read.parquet(path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    big = spark.range(10**9)
    assert spread(big) is big


def test_lists_of_keys_may_come_in_another_order_each_time(spark):
    keys = "abcdefgh"
    some = F.udf(lambda: ",".join(random.sample(keys, 8))).asNondeterministic()
    df = spark.range(50).select(
        F.concat(F.lit("m"), "id").alias("msg_id"), F.lit("").alias("content"), F.create_map(F.lit("keys"), some()).alias("attrs"))
    values = spark.createDataFrame([(k, k * 2) for k in keys], "key string, value string")
    rows = multi_lookup(df, "${keys}", values, attribute="found", limit=0).collect()
    assert len(rows) == 50
    for r in rows:
        assert r["error"] is None and [r["attrs"][f"found.{k}"] for k in keys] == [k * 2 for k in keys]


def test_large_blocks_and_joins_are_spread_by_their_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    path = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    dealt = spread(table)
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) < 200 and sum(sizes) == 1000
    # Even splits stay where they are.
    dealt.write.parquet(f"{path}2")
    even = spark.read.parquet(f"{path}2").repartition(10)
    assert spread(even) is even
    # The product of two sizes is no size of a join.
    wide = spark.range(10).selectExpr("id as k", "repeat(uuid(), 100000) as text").coalesce(1)
    wide.write.parquet(f"{path}3")
    joined = table.join(F.broadcast(spark.read.parquet(f"{path}3")), F.expr("id = k"), "left")
    assert spread(joined).rdd.getNumPartitions() == 10


def test_tables_are_dealt_out_before_messages_are_made(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    columns = ["id as o_orderkey", "'F' as o_orderstatus", "id / 4 as o_totalprice", "'1-URGENT' as o_orderpriority", "id % 7 as o_custkey"]
    spark.range(0, 2_000, 1, 1).selectExpr(*columns).write.parquet(f"{tmp_path}/orders.parquet")
    got = order_messages(spark, str(tmp_path))
    held = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 2_000 and max(held) <= 2 * 100
    assert got.select("msg_id").distinct().count() == 2_000
    # The messages of even tasks stay where they are.
    assert spread(got) is got


def test_duplicate_parameters_and_unknown_route(spark):
    doc = '{"targets": [{"id": "t", "transformations": [["A://?k=1&k=2&l=3"]]}]}'
    (row,) = steps(parse_routes(spark.createDataFrame([("p", doc)], "process string, doc string"))).collect()
    assert row["params"] == {"k": "2", "l": "3"} and row["name"] == "A"
    with pytest.raises(ValueError):
        read_route(spark, "x", "nowhere")


@pytest.mark.parametrize("pattern, deep", [
    ("(a|b)*c", True), ("(?:ab)+", True), ("(ab){2,}", True), ("(ab){3}", False), ("(ab){1,500}", True), ("(ab)?", False), ("[()*]+", False),
    (r"\(a\)*", False), (r"\Q(a)*\E", False), (r"\Q(a\E(b)*", True), ("[^)]*)", False), ("(?x) (a) *", True), ("a*b+", False), ("(a)(b)", False),
    ("[[a](b)*]", False), ("((a)+b)", True), ("(a)*+", True),
])
def test_patterns_that_run_deep(pattern, deep):
    assert runs_deep(pattern) is deep


@pytest.mark.parametrize("text, value", [
    ("1/0", None), ("7 / 2", 3.5), ("7 % 0", None), ("7 div 2", 3), ("7 div 0", None), ("2147483647 + 1", None), ("2 + 3 * 4 - 6 / 2", 11.0),
    ("-3 - -4", 1), ("- (2 + 1) * 2", -6), ("'a' || 1 + 1", None), ("array(1, 2)[7]", None), ("array(1, 2)[1] + 1", 3), ("map('a', 5)['z']", None),
    ("map('a', 5)['a']", 5), ("int('x')", None), ("cast('7' as int) * 2", 14), ("case when 1 + 1 = 2 then 'y' else 'n' end", "y"),
    ("aggregate(array(1, 2, 3), 0, (a, x) -> a + x)", 6), ("3 between 1 + 1 and 2 * 2", True), ("6 in (2 * 3, 1)", True),
    ("extract(year from date '2024-02-29') + 1", 2025), ("cast(date '2024-02-29' + interval 1 day as string)", "2024-03-01"),
    ("regexp_extract('a12', '[0-9]+', 0) || 'x'", "12x"), ("element_at(array(1), 3)", None), ("to_date('nope')", None),
    ("named_struct('a', 1 + 1).a * 2", 4), ("'it''s' || \"x\"", "it'sx"), ("length(r'\\d')", 2),
])
def test_total_expressions_keep_their_value_or_give_null(spark, text, value):
    assert spark.sql(f"select {total(text, spark)}").first()[0] == value


@pytest.mark.parametrize("text", ["raise_error('x')", "x rlike y", "regexp_replace(x, '(a|b)*', '')", "split(x, '(')", "x::int", "(1", "1)", "1 -- 2", "sequence(1, 9)"])
def test_what_has_no_total_form_is_refused(spark, text):
    with pytest.raises(PartialExpression):
        total(text, spark)


@given(st.recursive(st.integers(-9, 9).map(lambda n: f"({n})" if n < 0 else str(n)), lambda x: st.tuples(x, st.sampled_from("+-*"), x).map(" ".join) | x.map("({})".format), max_leaves=12))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_total_arithmetic_has_the_usual_order(spark, text):
    assert spark.sql(f"select cast({total(text, spark)} as bigint)").first()[0] == eval(text)


SCALARS = ["+491701234567", "+5", "-5", "007", "-07", "0", "0.5", "2.50", ".5", "5.", "1e5", "1E-3", "true", "false", "TRUE", "True", "", " ", " 5 ", " +5 ", "-", "+",
           "12345678901234567890123", "2024-01-01", "NaN", "null", ",null,", "[null", "5d", "a\ue000b", "\ue000n", "\ue000", "&#43;49", "a &lt; 5", "1 2", "--1", "x"]


def _scalar(text):
    plain = html.unescape(text).strip()
    if "&" not in text and re.fullmatch(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?", plain):
        return float(plain)
    return {"true": True, "false": False}.get(plain, plain)


def test_json_scalars_are_what_their_text_says(spark):
    for form in ("<r><t>{}</t></r>", "<r><t>{0}</t><t>{0}</t><z/></r>", "<r t='{}'/>", '<r t = "{}"><u>1</u></r>', "<r><t><!-- > -->{}</t></r>"):
        df = spark.createDataFrame([(i, form.format(t)) for i, t in enumerate(SCALARS)], "i int, c string")
        got = {r[0]: json.loads(r[1])["r"]["t"] for r in df.selectExpr("i", compact_json("c")).collect()}
        for i, text in enumerate(SCALARS):
            value = got[i]
            for one in value if isinstance(value, list) else [value]:
                want = _scalar(text)
                assert (one == want and isinstance(one, bool) == isinstance(want, bool)) or (type(want) is float and float(one) == want), (form, text, one)


@pytest.mark.parametrize("content, want", [
    ("<r><g/><g></g><g/></r>", {"g": ["", "", ""]}), ("<r/>", ""), ("<r><a k='1'/></r>", {"a": {"k": 1}}), ("<r><c><![CDATA[<g/>+5]]></c><g/></r>", {"c": "<g/>+5", "g": ""}),
    ("<r><![CDATA[007]]></r>", "007"), ("<r><a>x<b>1</b></a></r>", {"a": {"content": "x", "b": 1}}), ("<r><p:g xmlns:p='u'/><p:g /></r>", None),
])
def test_json_of_empty_and_mixed_elements(spark, content, want):
    got = json.loads(spark.createDataFrame([(content,)], "c string").selectExpr(compact_json("c")).first()[0])["r"]
    assert want is None or got == want


_PLAIN_XSD = (
    '<x:schema xmlns:x="http://www.w3.org/2001/XMLSchema"><x:element name="o"><x:complexType><x:sequence>'
    '<x:element name="id" type="x:long"/><x:element name="ok" type="x:boolean" minOccurs="0"/><x:element name="t.x" type="x:string"/>'
    '<x:element name="in"><x:complexType><x:sequence><x:element name="n" type="x:decimal"/></x:sequence></x:complexType></x:element>'
    '</x:sequence></x:complexType></x:element><x:element name="k" type="x:int"/></x:schema>'
)


def test_sure_form_takes_only_what_is_valid(spark):
    ids = ["1", "-1", "", "+1", " 1", "9" * 18, "9" * 19, "9" * 20, "\u0661", "1.0", "x"]
    texts = ["a", "", "a b\n", "a&amp;b", "a&b", "a<b/>", "]]>", ">", "\x01", "\x7f", "\r", "\ud7ff", "\ufffd", "\ufffe", "\U0001f600", "<!-- c -->", "\ue000", "n" * 300_000]
    form = "<o><id>{}</id>{}<t.x>{}</t.x><in><n>{}</n></in></o>"
    docs = [form.format(i, "", "a", "1.5") for i in ids] + [form.format(1, "", t, "-1.50") for t in texts] + [form.format(1, "", "a", n) for n in ids]
    docs += [form.format(1, o, "a", 1) for o in ("<ok>true</ok>", "<ok>TRUE</ok>", "<ok>1</ok>", "<ok/>", "<ok>1</ok><ok>1</ok>", "<bad>1</bad>", "x")]
    plain = form.format(1, "", "a", 1)
    docs += [before + plain + after for before in ("", " ", "\n", "\ufeff", '<?xml version="1.0"?>', '<?xml version="1.1"?>', '<?xml version="1.0"?>' * 2, "<!-- c -->") for after in ("", "\n", "x")]
    docs += [plain.replace("<o>", "<o a='1'>"), plain.replace("<o>", "<o >"), plain.replace("<t.x>", "<tyx>"), plain.replace("><", ">\n <"), "<k>1</k>", "<k>-2147483649</k>", "<k/>", "<id>1</id>", "", "x"]
    path, sure = schema_file(spark, _PLAIN_XSD), sure_form(_PLAIN_XSD)
    assert schema_problem(spark, _PLAIN_XSD) is None
    rows = spark.createDataFrame([(d,) for d in docs] + [(None,)], "c string").selectExpr(
        "c", f"{valid_xml('c', path)} as parsed", f"{valid_xml('c', path, sure)} as quick", f"c rlike {lit(sure)} as sure").collect()
    for row in rows:
        assert row["quick"] == row["parsed"], row["c"]
    # Plain documents are not parsed.
    assert {plain, plain.replace("><", ">\n <"), "<k>1</k>", '<?xml version="1.0"?>' + plain} <= {row["c"] for row in rows if row["sure"]}


@pytest.mark.parametrize("change", [
    ('type="x:long"', 'type="x:date"'), ('type="x:long"', 'type="y:long"'), ('type="x:long"', 'type="long"'), ('type="x:long"', 'type="x:long" fixed="1"'),
    ('minOccurs="0"', 'maxOccurs="2"'), ("<x:schema ", '<x:schema targetNamespace="u" '), ("<x:complexType>", '<x:complexType mixed="true">'),
    ("x:sequence>", "x:all>"), ("</x:schema>", "<x:simpleType/></x:schema>"), ("</x:schema>", ""),
])
def test_other_schemas_have_no_sure_form(change):
    assert sure_form(_PLAIN_XSD) and sure_form(_PLAIN_XSD.replace(*change)) is None


def _quick_and_parsed(monkeypatch, make):
    """The SQL text of a function, and that of its way without plain forms."""
    quick = make()
    with monkeypatch.context() as m:
        m.setattr(xmlfn, "SURELY_WELL_FORMED", "(?!)")
        m.setattr(text, "PLAIN_ENVELOPE", "(?!)()()")
        return quick, make()


_INSIDE = [
    "", "a", " a ", "\n", "<b/>", "<b>1</b>", "<b><c>1</c>x<c/></b><d/>", "<b k='1'/>", '<b\n k = "\'" >1</b >', "<a.b-c_/>", "<Body>1</Body>", "<b xmlns='u'/>", "<b xmlnsx='u'/>",
    "<x:b>1</x:b>", "<s:b/>", "s:", ":", "a>b", "]]>", "]", "&amp;", "&", "<b k='<'/>", "<b k='1' k='2'/>", "<b k='1' l='2'/>", "<b></c>", "<b>", "</b>", "<b></b", "<1/>", "<!-- c -->", "<?p?>",
    "<![CDATA[c]]>", "\r", "\x01", "\x7f", "\ud7ff", "\ue000", "\U0001f600", "\u00b7", "<\u00e9/>", f"<{'n' * 100}/>", f"<{'n' * 101}/>", "t" * 300_000, "<b/>" * 100_000,
    "<b>" * 7 + "</b>" * 7, "<b>" * 9 + "</b>" * 9,
]


def test_plain_content_is_not_parsed(spark, monkeypatch):
    plain = ["<a/>", "<a>1</a>", "\n<a k='1'><b>x</b>y<b/></a> ", '<?xml version="1.0"?><x:a xmlns:x="u"><x:b>c:d</x:b></x:a>', f"<a>{'<b>t</b>' * 100_000}</a>"]
    docs = plain + [f"<a>{i}</a>" for i in _INSIDE] + _INSIDE + ["<bad/>", "<Bad>1</Bad>", "<bad.x/>", "<a/><b/>", "x<a/>", "<a/>x", "\ufeff<a/>", '<?xml version="1.1"?><a/>', None]
    df = spark.createDataFrame([(d,) for d in docs], "c string")
    quick, parsed = _quick_and_parsed(monkeypatch, lambda: well_formed(spark, "c"))
    rows = df.selectExpr("c", f"{quick} as quick", f"{parsed} as parsed").collect()
    assert [r["c"] for r in rows if r["quick"] != r["parsed"]] == []
    # A schema that is not there ends a job that parses.
    monkeypatch.setattr(xmlfn, "schema_file", lambda *_: "/nowhere/gone.xsd")
    assert df.limit(len(plain)).where(well_formed(spark, "c")).count() == len(plain)


def test_plain_envelopes_are_not_parsed(spark, monkeypatch):
    form = "<{0}:Envelope xmlns:{0}={3}{1}{3}>{2}</{0}:Envelope>".format
    ns, other = text.SOAP_NS, text.SOAP_12_NS
    plain = [form("e", ns, f"<e:Body>{i}</e:Body>", '"') for i in ("<b>1</b>", "", " <b> 1 </b>\n<c k='1'/>", "<b/>" * 100_000)]
    # Content has to be well-formed, and XPath wants prefixes declared.
    apart = {"<x:b>1</x:b>", "]]>", "&", "<b k='<'/>", "<b k='1' k='2'/>", "<b></c>", "<b>", "</b>", "<b></b", "<1/>", "\x01"}
    inside = [i for i in _INSIDE if i not in apart]
    docs = plain + [form(p, n, f"<{p}:Body>{i}</{p}:Body>", '"') for p, n in (("s", ns), ("a.b", other), ("s", "urn:other")) for i in inside]
    docs += [form("s", ns, f"{g}<s:Body><b/></s:Body>{g}", q) + g for g in ("", "\n ", " " * 20, " " * 21) for q in "\"'"]
    docs += [form("s", ns, b, '"') for b in ("<s:Body/>", "<s:Body k='1'><b/></s:Body>", "<s:Header/><s:Body><b/></s:Body>", "<s:Body><b/></s:Body><s:Body><c/></s:Body>", "<Body><b/></Body>", "")]
    df = spark.createDataFrame([(d,) for d in docs], "c string")
    quick, parsed = _quick_and_parsed(monkeypatch, lambda: remove_envelope(spark, "c"))
    rows = df.selectExpr("c", f"{quick} as quick", f"{parsed} as parsed").collect()
    assert [r["c"] for r in rows if r["quick"] != r["parsed"]] == []
    monkeypatch.setattr(text, "well_formed", lambda *_: "raise_error('parsed')")
    got = df.limit(len(plain)).selectExpr(remove_envelope(spark, "c")).collect()
    assert [r[0] for r in got] == ["<b>1</b>", "", "<b> 1 </b>\n<c k='1'/>", "<b/>" * 100_000]


def test_customers_are_dealt_out_before_envelopes_are_made(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    made = []
    monkeypatch.setattr(queries, "run", lambda spark, df, *more, **named: made.append(df) or run(spark, df, *more, **named))
    spark.range(0, 2_000, 1, 1).selectExpr("id as c_custkey", "cast(id % 3 as int) as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name").write.parquet(f"{tmp_path}/nation.parquet")
    got = queries.QUERIES["transform_lookup"](spark, str(tmp_path))
    held = [r["count"] for r in made[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 2_000 and max(held) <= 2 * 100
    assert {r["kind"]: (r["count"], r["content"], r["problem"]) for r in got.where("msg_id like 'n1-%'").groupBy("kind", "content", "problem").count().collect()} == {
        1: (667, "<b>N1</b>", None)}


def test_root_name_of_any_start(spark):
    docs = {"<a/>": "a", "<a.b-c >1</a.b-c>": "a.b-c", "<a\nk='1'/>": "a", "<a\r\n/>": "a", "<?xml version='1.0'?><b><c/></b>": "b", "<!-- <x> --><d/>": "d", "<\u00e9t\u00e9/>": "\u00e9t\u00e9", " <e>1</e>": "e"}
    got = spark.createDataFrame([(d,) for d in docs], "c string").selectExpr("c", root_name("c")).collect()
    assert {r[0]: r[1] for r in got} == docs
