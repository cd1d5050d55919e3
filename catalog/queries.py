"""The registered queries. Each names the survey operators it shows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import (
    AT_START, SCHEMAS, cents, customer_messages, dealt, document_messages, document_xml, escaped, event_messages, order_messages,
    page_messages, part_messages, route, routes, run, schemas, table, target, values,
)
from waybill import Settings, read_route, returned_messages, route_messages, write_routes
from waybill.functions.render import lit
from waybill.functions.text import remove_envelope, soap_envelope, status_code, wrap_root
from waybill.functions.xmlfn import well_formed
from waybill.operators.audit import audit_message
from waybill.operators.lineage import lineage_closure
from waybill.operators.lookup import lookup_failed, lookup_passed, multi_lookup, receiver_lookup, request_uri, route_lookup
from waybill.operators.restrict import content_matches, fan_out_permitted, with_permitted
from waybill.operators.steps import reshape
from waybill.session import shared_dir, spread, written
from waybill.sources.commits import read_batches
from waybill.sources.messages import messages
from waybill.sources.registry import parse_routes, pipelines, registry, steps
from waybill.sources.sinks import reformat
from waybill.streaming.route import resume_stream, route_stream

Query = Callable[[SparkSession, str], DataFrame]
#: The endpoint that interfaces share in these messages, and the attribute that tells them apart.
SHARED = ("/sap/xi", "sap.Interface.value")
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def attr(name: str, alias: str | None = None) -> str:
    return f"attrs[{lit(name)}] as {alias or name.replace('.', '_')}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def events(spark: SparkSession, d: str) -> DataFrame:
    return event_messages(dealt(spark, d, "events"))


# --- lookups -----------------------------------------------------------------

FOUR = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
_KNOWN = "o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"


@query(f"""
    select 'o' || o_orderkey as msg_id, o_orderpriority as process,
           case when {_KNOWN} then null else 'Route named:' || o_orderpriority || ' not found!' end as route_error,
           case when {_KNOWN} then null else '501' end as status_code
    from orders
""")
def route_lookup_status(spark: SparkSession, d: str) -> DataFrame:
    """Route by process name; a miss is 501."""
    docs = routes(spark, {p: route(target("t", ["Pass"])) for p in FOUR})
    return route_lookup(order_messages(spark, d), docs).select("msg_id", "process", "route_error", "status_code")


@query("""
    select 'o' || o_orderkey as msg_id, c_name as content, cast(null as varchar) as error
    from orders join customer on c_custkey = o_custkey
    union all
    select 'o' || o_orderkey, '<order><id>' || o_orderkey || '</id><status>' || o_orderstatus || '</status><cents>' ||
           cast(round(o_totalprice * 100) as bigint) || '</cents></order>', 'not every key was found'
    from orders where o_custkey not in (select c_custkey from customer)
""")
def lookup_into_content(spark: SparkSession, d: str) -> DataFrame:
    """One key; the value, decoded from bytes, becomes the content."""
    names = table(spark, d, "customer").selectExpr("cast(c_custkey as string) as key", "encode(c_name, 'UTF-8') as value")
    found = multi_lookup(order_messages(spark, d), "${cust}", names)
    return found.select("msg_id", "content", "error")


@query("""
    with pairs as (
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               row_number() over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey) as copy
        from lineitem)
    select 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as msg_id,
           case when p.p_name is not null and s.s_name is not null then substr(p.p_name, 1, 6) end as part,
           case when p.p_name is not null and s.s_name is not null then substr(s.s_name, 1, 6) end as supplier,
           case when p.p_name is null or s.s_name is null then 'not every key was found' end as error
    from pairs left join part p on p.p_partkey = l_partkey and p.p_partkey % 11 <> 0
    left join supplier s on s.s_suppkey = l_suppkey
""")
def lookup_into_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Several keys; each value goes to ``name.key``, cut at six characters."""
    parts = table(spark, d, "part").where("p_partkey % 11 <> 0").selectExpr("concat('p', p_partkey) as key", "p_name as value")
    suppliers = table(spark, d, "supplier").selectExpr("concat('s', s_suppkey) as key", "s_name as value")
    lines = table(spark, d, "lineitem").selectExpr(
        "concat('l', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) as msg_id", "'' as content",
        "map('pk', concat('p', l_partkey), 'sk', concat('s', l_suppkey)) as attrs",
    )
    found = multi_lookup(lines, "${pk}, ${sk},", parts.unionByName(suppliers), attribute="found", max_length=6)
    return found.selectExpr(
        "msg_id", "attrs[concat('found.', attrs['pk'])] as part", "attrs[concat('found.', attrs['sk'])] as supplier", "error"
    )


@query("""
    with wanted as (
        select o_orderkey, case when o_orderkey % 2 = 0 then 1 else l_partkey end as k
        from orders join lineitem on l_orderkey = o_orderkey
    ), held as (
        select o_orderkey, count(distinct k) as n, count(*) as keys, bool_and(p_partkey is not null) as whole, min(p_name) as least
        from wanted left join part on p_partkey = k and p_partkey % 11 <> 0 group by o_orderkey
    )
    select 'o' || o_orderkey as msg_id, case when whole then 'deliver' else 'failed' end as route,
           case when whole then n else 0 end as found, case when whole then least end as least,
           case when not whole then 'not every key was found' end as problem
    from held
""")
def lookup_many_keys(spark: SparkSession, d: str) -> DataFrame:
    """Up to seven keys a message, half of the messages with one key alone; a missing key sends the message to failed."""
    parts = table(spark, d, "part").where("p_partkey % 11 <> 0").selectExpr("concat('p', p_partkey) as key", "p_name as value")
    own = "case when o_orderkey % 2 = 0 then 'p1' else concat('p', l_partkey) end"
    listed = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.expr("l_orderkey = o_orderkey")).groupBy("o_orderkey").agg(
        F.expr(f"concat_ws(',', collect_list({own}))").alias("keys"))
    orders = order_messages(spark, d).join(listed.selectExpr("concat('o', o_orderkey) as msg_id", "keys"), "msg_id").selectExpr(
        "msg_id", "content", "map('business.process.name', 'all', 'keys', keys) as attrs")
    # A limit of no bytes shows the way of large tables: shuffled, with heavy keys salted.
    found = written(multi_lookup(orders, "${keys}", parts, attribute="found", limit=0), "found")
    doc = route(target("t", ["Pass"]), validate="order")
    got = run(spark, lookup_passed(found), {"all": doc}).routed().unionByName(lookup_failed(found))
    hits = "map_values(map_filter(attrs, (k, v) -> k rlike '^found'))"
    return got.selectExpr("msg_id", "route", f"cast(size({hits}) as bigint) as found", f"array_min({hits}) as least", attr("error.msg", "problem"))


@query("""
    select 'e' || event_id as msg_id,
           case when event_type = 'view' then 'iface-' || user_id % 5 else '/' || event_type end as request_url,
           case when event_type = 'click' then 'Clicks'
                when event_type = 'view' and user_id % 5 = 3 then 'own-' || event_type
                else 'Не определен' end as receiver
    from events
""")
def receiver_by_uri(spark: SparkSession, d: str) -> DataFrame:
    """Receiver by effective URI; ``attribute`` and misses included."""
    found = values(spark, "uri receiver", [("/click", "Clicks"), ("iface-3", "attribute"), ("/purchase", "")])
    uri = request_uri(lambda key: f"attrs[{lit(key)}]", SHARED)
    df = events(spark, d).withColumn("request_url", F.expr(uri))
    got = receiver_lookup(df, found, "request_url", "concat('own-', attrs['event.type'])")
    return got.select("msg_id", "request_url", "receiver")


@query("""
    select 'p' || p_partkey as msg_id,
           case p_partkey % 4 when 0 then 'Failed schema extraction! java.io.IOException: Schema with name gone not found'
                when 1 then 'Failed schema extraction! java.io.IOException: Schema with name null not found'
                when 2 then 'Failed xml validation!' end as problem
    from part where p_partkey % 4 < 3
    union all
    select 'p' || p_partkey, case when p_partkey % 7 = 0 then 'Failed xml validation!' end from part where p_partkey % 4 = 3
""")
def schema_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A missing, an unnamed, a broken and a good schema."""
    docs = {f"s{i}": route(target("t", ["Pass"]), validate=v) for i, v in enumerate(["gone", None, "broken", "part"])}
    got = run(spark, part_messages(spark, d, "concat('s', p_partkey % 4)"), docs).routed()
    return got.selectExpr("msg_id", f"regexp_extract(attrs['error.msg'], {lit('^(Failed xml validation!|.*)')}, 1) as problem")


@query("""
    select 'n' || n_nationkey || '-' || c_custkey as msg_id, c_custkey % 3 as kind,
           case c_custkey % 3 when 0 then '<out><name>' || n_name || '</name></out>'
                when 1 then '<b>' || n_name || '</b>' else null end as content,
           case when c_custkey % 3 = 2 then 'java.io.IOException: XSLT with the name Missing not found' end as problem
    from customer join nation on n_nationkey = c_nationkey
""")
def transform_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A registered transform, the built-in one, and an unknown name."""
    df = dealt(spark, d, "customer").join(table(spark, d, "nation"), F.expr("n_nationkey = c_nationkey")).selectExpr(
        "concat('n', n_nationkey, '-', c_custkey) as msg_id",
        "concat('<e:Envelope xmlns:e=\"http://schemas.xmlsoap.org/soap/envelope/\"><e:Body><b>', n_name, '</b></e:Body></e:Envelope>') as content",
        f"{AT_START.format('shape', ', \'kind\', cast(c_custkey % 3 as string)')} as attrs",
    ).withColumn("attrs", F.expr("map_concat(map_filter(attrs, (k, v) -> k <> 'business.process.name'), map('business.process.name', concat('k', attrs['kind'])))"))
    docs = {f"k{i}": route(target("t", [f"ApplyXslt://?Name={n}"])) for i, n in enumerate(["Name", "RemoveEnvelope.xsl", "Missing"])}
    shapes = values(spark, "name input_ddl expr root_tag", [
        ("Name", "`e:Body` struct<b string>", "named_struct('name', doc.`e:Body`.b)", "out")])
    got = run(spark, df, docs, reshapes=shapes).routed()
    return got.selectExpr(
        "msg_id", "cast(attrs['kind'] as bigint) as kind",
        "case when error is null then content end as content",
        "attrs['error.msg'] as problem",
    )


# --- fan-out -----------------------------------------------------------------

@query("""
    select 'o' || o_orderkey as msg_id, t.target_id, t.receiver
    from orders cross join (values ('a', 'a'), ('b', 'b'), ('c', 'c')) t(target_id, receiver)
""")
def target_fanout(spark: SparkSession, d: str) -> DataFrame:
    """One row per target, with its id as receiver."""
    return _fan(spark, d, route(*[target(t, ["Pass"]) for t in "abc"], validate="order")).selectExpr(
        "msg_id", "target_id", attr("Receiver", "receiver"))


@query("""
    select 'o' || o_orderkey as msg_id, cast(p.path as integer) as path, p.mark,
           '<order><id>' || o_orderkey || '</id><status>' || o_orderstatus || '</status><cents>' ||
           cast(round(o_totalprice * 100) as bigint) || '</cents></order>' as content
    from orders cross join (values (0, 'm0'), (1, 'm1'), (2, cast(null as varchar))) p(path, mark)
""")
def path_fanout(spark: SparkSession, d: str) -> DataFrame:
    """Each path starts from the original message."""
    paths = [["UpdateAttribute://?mark=m${xform.path}"], ["UpdateAttribute://?mark=m1"], []]
    return _fan(spark, d, route(target("t", *paths), validate="order")).selectExpr("msg_id", "path", attr("mark"), "content")


@query("""
    select 'o' || o_orderkey as msg_id, 'o' || o_orderkey || '/0/0/0/' || u.i as lineage, u.url as target_url
    from orders cross join (values (0, 'u'), (1, 'v'), (2, 'null')) u(i, url)
    union all select 'o' || o_orderkey, 'o' || o_orderkey || '/1/0/0/0', 'w' from orders
""")
def url_fanout(spark: SparkSession, d: str) -> DataFrame:
    """One row per destination; a list and a single text."""
    doc = route(target("t", ["Pass"], url=["u", "v", None]), target("s", ["Pass"], url="w"), validate="order")
    return _fan(spark, d, doc).select("msg_id", "lineage", "target_url")


def _fan(spark: SparkSession, d: str, doc: str) -> DataFrame:
    from_orders = order_messages(spark, d).withColumn(
        "attrs", F.expr("map_concat(map_filter(attrs, (k, v) -> k <> 'business.process.name'), map('business.process.name', 'all'))"))
    return run(spark, from_orders, {"all": doc}).routed()


@query("""
    select 'o' || o_orderkey as msg_id, 'o' || o_orderkey || '/0/0/0.' || c.i || '/0' as lineage,
           cast(c.i as varchar) as copy_index, 'copy ' || c.i as label
    from orders cross join (values (0), (1), (2), (3)) c(i)
    where c.i <= case o_orderstatus when 'F' then 3 when 'O' then 0 when 'P' then 1 end
""")
def duplicate_copies(spark: SparkSession, d: str) -> DataFrame:
    """N copies and the original; N differs by row and may be negative."""
    steps_ = ["UpdateAttribute://?n=sql:case ${order.status} when 'F' then 3 when 'O' then -2 else 1 end",
              "DuplicateFlowFile://?Number=${n}", "UpdateAttribute://?label=copy ${copy.index}"]
    return _fan(spark, d, route(target("t", steps_), validate="order")).selectExpr("msg_id", "lineage", attr("copy.index"), attr("label"))


@query("""
    select 'o' || o_orderkey as msg_id, 'o' || o_orderkey || '/0/0/0.' || a.i || '.' || b.i || '/0' as lineage
    from orders cross join (values (0), (1)) a(i) cross join (values (0), (1), (2)) b(i)
""")
def duplicate_nested(spark: SparkSession, d: str) -> DataFrame:
    """Copies multiply, and the last step may copy."""
    doc = route(target("t", ["DuplicateFlowFile://?Number=1", "DuplicateFlowFile://?Number=2"]), validate="order")
    return _fan(spark, d, doc).select("msg_id", "lineage")


@query("""
    select 'e' || event_id as msg_id, r.route, case r.route when 'reply' then '' else
           '<event><type>' || event_type || '</type><user>' || user_id || '</user><cents>' ||
           cast(round(value * 100) as bigint) || '</cents></event>' end as content,
           case r.route when 'reply' then 'true' end as sync_response, r.seen
    from events cross join (values ('reply', cast(null as varchar)), ('reply', '1'), ('deliver', '2')) r(route, seen)
""")
def sync_reply(spark: SparkSession, d: str) -> DataFrame:
    """Replies from the target flag and from the step, with no content."""
    doc = route(target("t", ["UpdateAttribute://?seen=1", "SyncResponse", "UpdateAttribute://?seen=2"], syncValidation="true"), validate="event")
    got = run(spark, events(spark, d), {"events": doc}).routed()
    return got.selectExpr("msg_id", "route", "content", attr("sync.response"), attr("seen"))


# --- attributes and filters --------------------------------------------------

@query("""
    select 'e' || event_id as msg_id, event_type || '-' || user_id as a, '[' || event_type || '-' || user_id || ']' as b,
           '' as none, cast(user_id * 2 as varchar) as doubled, 'k=v' as eq, cast(null as varchar) as xform_group, '1' as xform_stage
    from events
""")
def attr_update(spark: SparkSession, d: str) -> DataFrame:
    """Templates see earlier values; hand-off keeps only its parameters."""
    steps_ = ["UpdateAttribute://?a=${event.type}-${user}&b=[${a}]&none=${absent}&doubled=sql:cast(${user} as bigint) * 2", "Custom://?eq=k=v"]
    got = run(spark, events(spark, d), {"events": route(target("t", steps_), validate="event")}).routed()
    return got.selectExpr("msg_id", *[attr(k) for k in ("a", "b", "none", "doubled", "eq", "xform.group", "xform.stage")])


@query("""
    select 'e' || event_id as msg_id, cast(p.path as integer) as path from events cross join (values (0), (1), (2)) p(path)
    where case p.path when 0 then event_type = 'click' when 1 then user_id >= 50 else true end
""")
def attr_filter(spark: SparkSession, d: str) -> DataFrame:
    """Exactly ``false`` drops; anything else, null included, keeps."""
    f = "RouteOnAttribute://?RoutingStrategy=r&Condition="
    paths = [[f"{f}sql:${{event.type}} = 'click'", "Pass"], ["Pass", f"{f}sql:cast(${{user}} as int) >= 50"],
             [f"{f}sql:${{absent}} = 'x'", f"{f}FALSE", f"{f}${{event.type}}"]]
    got = run(spark, events(spark, d), {"events": route(target("t", *paths), validate="event")}).routed()
    return got.select("msg_id", "path")


@query("""
    select 'e' || event_id as msg_id, 'deliver' as route, cast(p.path as integer) as path
    from events cross join (values (0), (1), (2)) p(path)
    where case when event_type = 'error' then p.path <= 0 when event_type = 'view' then p.path in (0, 1) else true end
      and not (event_type = 'error' and p.path = 0)
""")
def filter_ends_target(spark: SparkSession, d: str) -> DataFrame:
    """O14 with both original quirks: a last filter keeps, a suppressed path ends its target."""
    f = "RouteOnAttribute://?RoutingStrategy=r&Condition="
    paths = [[f"{f}sql:${{event.type}} <> 'error'", "Pass"], ["Pass", f"{f}false"], [f"{f}sql:${{event.type}} <> 'view'", "Pass"]]
    got = run(spark, events(spark, d), {"events": route(target("t", *paths), validate="event")},
              Settings(legacy_last_filter=True, stop_target_on_suppress=True)).routed()
    return got.select("msg_id", "route", "path")


@query("""
    select 'e' || event_id as msg_id, 'parked' as route, 'm' as strategy, 'user ' || user_id as condition, event_type as result,
           'RouteOnContent' as xform_group, p.stage as xform_stage, p.last as xform_last
    from events cross join (values ('0', cast(null as varchar)), ('1', 'true')) p(stage, last)
""")
def park(spark: SparkSession, d: str) -> DataFrame:
    """Tag and park; the last position is marked."""
    p = "RouteOnContent://?MatchRequirement=m&RouteCondition=user ${user}&Result=${event.type}"
    got = run(spark, events(spark, d), {"events": route(target("t", [p, "Pass"], ["Pass", p]), validate="event")}).routed()
    return got.selectExpr(
        "msg_id", "route", attr("content.match.strategy", "strategy"), attr("route.on.content.condition", "condition"),
        attr("route.on.content.result", "result"), attr("xform.group"), attr("xform.stage"), attr("xform.last"))


@query("""
    select 'e' || event_id as msg_id, event_type || '1' as a, event_type || '12' as b, 'u' as target_url, 't' as receiver
    from events where event_type <> 'error'
""")
def park_then_resume(spark: SparkSession, d: str) -> DataFrame:
    """Parked rows are written, read back and finish as in a straight run."""
    steps_ = ["RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${event.type} <> 'error'", "UpdateAttribute://?a=${event.type}1",
              "RouteOnContent://?MatchRequirement=m&RouteCondition=c", "UpdateAttribute://?b=${a}2"]
    docs = {"events": route(target("t", steps_), validate="event")}
    base = scratch(spark, "parked")
    write_routes(run(spark, events(spark, d), docs).routed(), base)
    got = run(spark, returned_messages(read_route(spark, base, "parked")), docs).routed()
    return got.selectExpr(f"regexp_extract(msg_id, {lit('^[^/]+')}, 0) as msg_id", attr("a"), attr("b"), "target_url", attr("Receiver", "receiver"))


_RESUMED = """
    select 'e' || event_id as msg_id,
           case event_type when 'click' then 'deliver' else 'failed' end as route,
           case event_type when 'click' then case when user_id % 2 = 0 then 'two' end end as mark,
           case event_type when 'error' then 'java.lang.IllegalArgumentException: Target not found'
                when 'view' then 'java.lang.Exception: Incorrect transformation path ' || (user_id % 5 + 1)
                when 'signup' then 'java.lang.NumberFormatException: For input string: "x' || user_id || '"'
                when 'purchase' then 'java.lang.NumberFormatException: For input string: ""' end as problem
    from events
"""


@query(_RESUMED)
def resume_positions(spark: SparkSession, d: str) -> DataFrame:
    """Target lookup, path bounds and skipping to the stage."""
    more = (
        ", 'target.id', case event_type when 'error' then 'gone' else 't' end"
        ", 'xform.path', case event_type when 'view' then cast(user_id % 5 + 1 as string) when 'signup' then concat('x', user_id) when 'purchase' then '' else '0' end"
        ", 'xform.stage', cast(user_id % 2 as string)"
    )
    # Even users stand at stage 0 and run stage 1; odd users have finished.
    df = event_messages(table(spark, d, "events"), more=more)
    docs = {"events": route(target("t", ["UpdateAttribute://?mark=one", "UpdateAttribute://?mark=two"]), validate="event")}
    got = run(spark, df, docs).routed()
    return got.selectExpr("msg_id", "route", attr("mark"), attr("error.msg", "problem"))


@query("""
    select 'e' || event_id as msg_id, e.route, e.problem
    from events cross join (values
        ('failed', 'java.lang.IllegalArgumentException: RouteOnAttribute RoutingStrategy'),
        ('failed', 'java.lang.IllegalArgumentException: RouteOnContent RouteCondition'),
        ('failed', 'java.lang.IllegalArgumentException: ReplaceText SearchValue'),
        ('failed', 'java.lang.Exception: Incorrect replace strategy'),
        ('failed', 'java.lang.IllegalArgumentException: ApplyXslt Name'),
        ('failed', 'java.lang.IllegalArgumentException: EvaluateXQuery null'),
        ('deliver', cast(null as varchar))) e(route, problem)
""")
def parameter_checks(spark: SparkSession, d: str) -> DataFrame:
    """Each path fails on its own; the others go on."""
    paths = [["RouteOnAttribute://?Condition=true"], ["RouteOnContent://?MatchRequirement=m"], ["ReplaceText://?ReplacementStrategy=RegexReplace"],
             ["ReplaceText://?ReplacementStrategy=Prepend&SearchValue=a&ReplacementValue=b"], ["ApplyXslt"], ["EvaluateXQuery://?a=b"], ["Pass"]]
    got = run(spark, events(spark, d), {"events": route(target("t", *paths), validate="event")}).routed()
    return got.selectExpr("msg_id", "route", attr("error.msg", "problem"))


@query("""
    select 'e' || event_id as msg_id, cast(p.path as integer) as path,
           case when p.path in (0, 2, 5, 6) then 'failed' else 'deliver' end as route,
           case p.path when 1 then case when user_id % 3 <> 0 then cast(100 // (user_id % 3) as varchar) end
                       when 3 then case when user_id = 0 then '2147483647' end
                       when 4 then case when user_id % 2 = 0 then event_type end
                       when 7 then 'kept' end as x
    from events cross join (values (0), (1), (2), (3), (4), (5), (6), (7)) p(path)
""")
def isolated_errors(spark: SparkSession, d: str) -> DataFrame:
    """Aggregates, missing fields, deep and unknown patterns fail their path; bad values are null; other paths deliver."""
    update = "UpdateAttribute://?x=sql:"
    paths = [
        [f"{update}count(1)"], [f"{update}100 div (cast(${{user}} as int) % 3)"], ["ApplyXslt://?Name=Missing field"],
        [f"{update}2147483647 + cast(${{user}} as int)"], [f"{update}split(${{event.type}} || ',', ',')[cast(${{user}} as int) % 2 * 7]"],
        [f"{update}regexp_replace(content, '(a|b)*c', '')"], [f"{update}content rlike ${{event.type}}"], ["UpdateAttribute://?x=kept"],
    ]
    shapes = values(spark, "name input_ddl expr root_tag", [("Missing field", "type string", "named_struct('a', doc.nothing)", "out")])
    got = run(spark, events(spark, d), {"events": route(target("t", *paths), validate="event")}, reshapes=shapes).routed()
    return got.selectExpr("msg_id", "path", "route", attr("x"))


@query("""
    select 'e' || event_id as msg_id,
           'Exception ''java.lang.NumberFormatException: For input string: "' || event_type || '"'' occurs while processing FlowFile ''event-' ||
           event_id || ''' in ''events'' scenario at ''t'' target at ''0'' path at 1 stage' as error
    from events
""")
def error_context(spark: SparkSession, d: str) -> DataFrame:
    """The error text names file, process, target, path and stage."""
    docs = {"events": route(target("t", ["Pass", "DuplicateFlowFile://?Number=${event.type}"]), validate="event")}
    return run(spark, events(spark, d), docs).routed().select("msg_id", "error")


@query("""
    select 'o' || o_orderkey as msg_id, case when o_orderpriority = '1-URGENT' then 'back' else o_orderpriority end as process,
           case when o_orderpriority = '1-URGENT' then '' end as status, case when o_orderpriority = '1-URGENT' then 'XI' end as input,
           case when o_orderpriority = '1-URGENT' then 'true' end as sync,
           'orders-1' as group_id,
           case when o_orderpriority = '1-URGENT' then 'unlisted' end as target_system
    from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
    union all select 'o' || o_orderkey, o_orderpriority, '501', null, null, null, null from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')
""")
def delivery_attributes(spark: SparkSession, d: str) -> DataFrame:
    """What a delivery carries, with and without a synchronous route."""
    docs = {"1-URGENT": route(target("unlisted", ["Pass"], response="back", input="XI", sync="true"), validate="order", sync="true"),
            "2-HIGH": route(target("listed", ["Pass"]), validate="order")}
    got = run(spark, order_messages(spark, d), docs, Settings(known_systems=("listed",), process_group_id="orders-1")).routed()
    return got.selectExpr(
        "msg_id", attr("business.process.name", "process"), attr("route.status.code", "status"), attr("route.input", "input"),
        attr("route.sync", "sync"), attr("processGroupId", "group_id"), attr("target_system"))


@query("""
    select 'e' || event_id as msg_id, case when user_id % 2 = 0 then case when event_type = 'click' then 'XI_OK' end
           else case when event_type = 'click' then '200' else '500' end end as status
    from events
""")
def status_codes(spark: SparkSession, d: str) -> DataFrame:
    """Protocol XI knows only 200."""
    df = table(spark, d, "events").selectExpr(
        "concat('e', event_id) as msg_id", "case when user_id % 2 = 0 then 'XI' else 'REST' end as protocol",
        "case when event_type = 'click' then '200' else '500' end as code")
    return df.selectExpr("msg_id", f"{status_code('protocol', 'code')} as status")


# --- text, XML, JSON ---------------------------------------------------------

_R = "ReplaceText://?ReplacementStrategy=RegexReplace"


def _documents(spark: SparkSession, d: str, *steps_: str) -> DataFrame:
    docs = {"documents": route(target("t", list(steps_)))}
    return run(spark, document_messages(spark, d), docs).routed()


@query("""
    select 'd' || doc_id as msg_id,
           regexp_replace(regexp_replace(text, '([0-9]+)-([0-9]+)', '<\\2:\\1>', 'g'), 'e+', '<$x\\\\>', 'g') as content from documents
""")
def regex_replace(spark: SparkSession, d: str) -> DataFrame:
    """Groups and a replacement that is plain text, over whole documents."""
    got = _documents(spark, d, f"{_R}&SearchValue=([0-9]+)-([0-9]+)&ReplacementValue=<$2:$1>", f"{_R}&SearchValue=e+&ReplacementValue=<$x\\>")
    return got.select("msg_id", "content")


@query("""
    select 'd' || doc_id as msg_id, case when source = 'web' or lang = 'en' then text else replace(text, lang, '[' || source || ']') end as content,
           case when source = 'web' or lang = 'en' then 'failed' else 'deliver' end as route
    from documents where source is not null and lang is not null
    union all select 'd' || doc_id, text, 'x' from documents where source is null or lang is null
""")
def regex_by_row(spark: SparkSession, d: str) -> DataFrame:
    """Pattern and replacement differ by row; an illegal one fails only its row."""
    steps_ = [
        "UpdateAttribute://?p=sql:case when ${source} = 'web' then '(' when ${lang} = 'en' then ${lang} || '|.' else ${lang} end"
        "&r=sql:case when ${lang} = 'en' then '\\u00243' else '[' || ${source} || ']' end",
        f"{_R}&SearchValue=${{p}}&ReplacementValue=${{r}}",
    ]
    return _documents(spark, d, *steps_).select("msg_id", "content", "route")


@query("""
    select 'd' || doc_id as msg_id, case when doc_id % 100 = 0 then 'failed' else 'deliver' end as route,
           cast(case when doc_id % 100 = 0 then length(text) + 1000000
                     else length(regexp_replace(text, '(?:[a-m]|[n-z])+e', '#', 'g')) end as integer) as n,
           case when doc_id % 100 = 0 then 'ReplaceText: illegal pattern or group reference, or a text too long for the pattern' end as problem
    from documents
""")
def regex_deep(spark: SparkSession, d: str) -> DataFrame:
    """A repeated group that meets a word of a million letters fails that row alone; the others deliver."""
    step = f"{_R}&SearchValue=(?:[a-m]|[n-z])+e&ReplacementValue=#"
    long = document_messages(spark, d).withColumn(
        "content", F.expr("case when cast(substring(msg_id, 2) as bigint) % 100 = 0 then concat(content, repeat('ab', 500000)) else content end"))
    got = run(spark, long, {"documents": route(target("t", [step]))}).routed()
    return got.selectExpr("msg_id", "route", "length(content) as n", attr("error.msg", "problem"))


@query("""
    select 'c' || c_custkey as msg_id, c_name as name, c_mktsegment as segment, cast(c_nationkey as varchar) as nation,
           case when c_custkey % 31 = 1 then 't' || c_nationkey end as tag,
           case when c_custkey % 31 > 1 then c_custkey % 31 else 0 end as numbered,
           case when c_custkey % 31 >= 30 then 't' || c_nationkey end as tag_30,
           cast(c_custkey % 31 as varchar) as tags
    from customer
""")
def xpath_extract(spark: SparkSession, d: str) -> DataFrame:
    """Nodes relative to the root; none, one, few and many; a count."""
    step = "EvaluateXQuery://?Destination=flowfile-attribute&name=name&segment=@segment&nation=/customer/nation&tag=tag&tags=count(tag)"
    got = run(spark, customer_messages(spark, d), {"customers": route(target("t", [step]), validate="customer")}).routed()
    return got.selectExpr(
        "msg_id", attr("name"), "attrs['segment'] as segment", attr("nation"), attr("tag"),
        f"cast(size(filter(map_keys(attrs), k -> k rlike {lit(r'^tag\.[0-9]+$')})) as bigint) as numbered", attr("tag.30"), attr("tags"))


@query("""
    select 'd' || doc_id as msg_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') as text, '2' as fields from documents
""")
def xpath_text(spark: SparkSession, d: str) -> DataFrame:
    """The whole text of a document through XML and back."""
    step = "EvaluateXQuery://?Destination=flowfile-attribute&text=text&fields=count(*)"
    got = run(spark, document_xml(spark, d), {"documents": route(target("t", [step]), validate="document")}).routed()
    return got.selectExpr("msg_id", attr("text"), attr("fields"))


@query("select 'p' || p_partkey as msg_id, case when p_partkey % 7 = 0 then 'failed' else 'deliver' end as route from part")
def xml_validate(spark: SparkSession, d: str) -> DataFrame:
    """Content against a schema by name."""
    got = run(spark, part_messages(spark, d), {"parts": route(target("t", ["Pass"]), validate="part")}).routed()
    return got.select("msg_id", "route")


@query("select 'g' || page_id as msg_id, 'failed' as route, html as content from pages")
def malformed_to_failed(spark: SparkSession, d: str) -> DataFrame:
    """Content that is not XML fails without ending the job."""
    got = run(spark, page_messages(spark, d), {"pages": route(target("t", ["Pass"]), validate="document")}).routed()
    return got.select("msg_id", "route", "content")


@query("""
    select 'd' || doc_id as msg_id, doc_id % 3 <> 2 as good from documents
    union all select 'p' || p_partkey, true from part
    union all select 'g' || page_id, false from pages
""")
def well_formed_check(spark: SparkSession, d: str) -> DataFrame:
    """The guard before every XPath that follows a rewrite."""
    whole = f"concat('<a>', {escaped(f'regexp_replace(text, {lit(chr(91) + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0B' + chr(92) + 'x0C' + chr(92) + 'x0E-' + chr(92) + 'x1F]')}, \'\')')}, '</a>')"
    broken = f"case doc_id % 3 when 2 then concat({whole}, '<b/>') when 1 then concat('<?xml version=\"1.0\"?>', {whole}) else {whole} end"
    df = (
        table(spark, d, "documents").selectExpr("concat('d', doc_id) as msg_id", f"{broken} as content")
        .unionByName(part_messages(spark, d).select("msg_id", "content"))
        .unionByName(page_messages(spark, d).select("msg_id", "content"))
    )
    return spread(df).selectExpr("msg_id", f"{well_formed(spark, 'content')} as good")


@query("""
    select 'c' || c_custkey as msg_id, c_name as name, cast(c_custkey as varchar) as key, c_mktsegment as segment,
           cast(c_nationkey as varchar) as nation,
           case when c_custkey % 31 = 0 then null when c_custkey % 31 = 1 then '"t' || c_nationkey || '"'
                else '[' || repeat('"t' || c_nationkey || '",', cast(c_custkey % 31 - 1 as integer)) || '"t' || c_nationkey || '"]' end as tags
    from customer
""")
def xml_to_json(spark: SparkSession, d: str) -> DataFrame:
    """Compact objects, repeats as arrays, attributes as keys."""
    got = run(spark, customer_messages(spark, d), {"customers": route(target("t", [], output="JSON"), validate="customer")}).routed()
    path = lit("$.customer.") 
    at = lambda field: f"get_json_object(content, concat({path}, '{field}'))"
    tags = f"case when msg_id is not null and {at('tag')} is not null and not startswith({at('tag')}, '[') then concat('\"', {at('tag')}, '\"') else {at('tag')} end"
    return got.selectExpr(
        "msg_id", f"{at('name')} as name", f"{at('key')} as key", f"{at('segment')} as segment", f"{at('nation.key')} as nation", f"{tags} as tags")


@query("""
    select 'c' || c_custkey as msg_id, '{"customer":[{"name":["' || c_name || '"]},' ||
           repeat('{"tag":["t' || c_nationkey || '"]},', cast(c_custkey % 31 as integer)) ||
           '{"nation":[{"key":["' || c_nationkey || '"]}]}]}' as content
    from customer
""")
def xml_to_json_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Order and repeats kept, attributes dropped."""
    got = run(spark, customer_messages(spark, d), {"customers": route(target("t", [], output="JSON"), validate="customer")},
              Settings(ordered_json=True)).routed()
    return got.select("msg_id", "content")


@query("""
    select 's' || s_suppkey as msg_id, '<supplier><code>S' || s_suppkey || '</code><place>' || (s_nationkey + 100) || '</place></supplier>' as content from supplier
    union all select 'c' || c_custkey, '<supplier><code>S' || c_custkey || '</code><place>' || (c_nationkey + 100) || '</place></supplier>' from customer
""")
def reshape_content(spark: SparkSession, d: str) -> DataFrame:
    """Content read by a schema, mapped and written under a new root."""
    parts = [
        table(spark, d, t).selectExpr(f"concat('{p}', {k}) as msg_id", f"concat('<s><key>', {k}, '</key><nation>', {n}, '</nation></s>') as content")
        for t, p, k, n in (("supplier", "s", "s_suppkey", "s_nationkey"), ("customer", "c", "c_custkey", "c_nationkey"))
    ]
    shaped = reshape(parts[0].unionByName(parts[1]), "key string, nation int",
                     "named_struct('code', concat('S', doc.key), 'place', doc.nation + 100)", "supplier")
    return shaped.selectExpr("msg_id", "content")


@query("""
    select 'o' || o_orderkey as msg_id, '<root><order>' || o_orderkey || '</order></root>' as wrapped,
           '<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Body><order>' || o_orderkey ||
           '</order></soapenv:Body></soapenv:Envelope>' as framed,
           '<order>' || o_orderkey || '</order>' as body from orders
""")
def envelope_and_root(spark: SparkSession, d: str) -> DataFrame:
    """Wrap in a root, put in an envelope and take out again."""
    df = table(spark, d, "orders").selectExpr("concat('o', o_orderkey) as msg_id", "concat('<order>', o_orderkey, '</order>') as content")
    framed = soap_envelope("content")
    return df.selectExpr("msg_id", f"{wrap_root('content')} as wrapped", f"{framed} as framed", f"{remove_envelope(spark, framed)} as body")


@query("""
    select 'c' || c_custkey as msg_id, case when c_custkey % 4 = 3 then 'failed' else 'deliver' end as route,
           case c_custkey % 4 when 0 then '<x xmlns="urn:d"><name>' || c_name || '</name></x>' when 1 then '<x>' || c_name || '</x>'
                when 2 then '<q:x xmlns:q="u">' || c_nationkey || '</q:x>' end as body
    from customer
""")
def envelope_cases(spark: SparkSession, d: str) -> DataFrame:
    """Default namespaces, headers that look like bodies, comments before the root; two bodies fail their row."""
    ns = 'xmlns:s="http://schemas.xmlsoap.org/soap/envelope/"'
    start = f"<s:Envelope {ns}"
    text = (
        f"case c_custkey % 4 when 0 then concat({lit(f'{start} xmlns=\"urn:d\"><s:Body><x><name>')}, c_name, '</name></x></s:Body></s:Envelope>')"
        f" when 1 then concat({lit(f'<!-- <s:Body> -->{start}><s:Header><Body>no</Body></s:Header><s:Body><x>')}, c_name, '</x></s:Body></s:Envelope>')"
        f" when 2 then concat({lit(f'{start} xmlns:q=\"u\"><s:Header xmlns:q=\"v\"/><s:Body><q:x>')}, c_nationkey, '</q:x></s:Body></s:Envelope>')"
        f" else concat({lit(f'{start}><s:Body><x/></s:Body><s:Body>')}, c_custkey, '</s:Body></s:Envelope>') end"
    )
    df = table(spark, d, "customer").selectExpr("concat('c', c_custkey) as msg_id", f"{text} as content", f"{AT_START.format('soap', '')} as attrs")
    got = run(spark, df, {"soap": route(target("t", ["ApplyXslt://?Name=RemoveEnvelope.xsl"]))}).routed()
    return got.selectExpr("msg_id", "route", "case when route = 'deliver' then content end as body")


@query("""
    select 'c' || c_custkey as msg_id, '{"c":{"code":"00' || c_custkey || '","e":["",""],"exp":"' || c_nationkey || 'E3","flag":' || (c_custkey % 2 = 0) ||
           ',"half":' || c_custkey || '.5,"neg":-' || (c_nationkey + 1) || ',"none":"","phone":"+49' || c_custkey || '","sign":"' || chr(57344) || 'n"}}' as content
    from customer
""")
def xml_to_json_types(spark: SparkSession, d: str) -> DataFrame:
    """Signs, leading zeros and exponents stay text, empty repeats are empty texts, numbers and booleans are typed."""
    text = (
        "concat('<c phone=\"+49', c_custkey, '\"><code>00', c_custkey, '</code><half>', c_custkey, '.50</half><neg> -', c_nationkey + 1, ' </neg><exp>', c_nationkey,"
        f" 'E3</exp><flag>', c_custkey % 2 = 0, '</flag><e/><e></e><none> </none><sign>', {lit(chr(57344) + 'n')}, '</sign></c>')"
    )
    df = table(spark, d, "customer").selectExpr("concat('c', c_custkey) as msg_id", f"{text} as content", f"{AT_START.format('types', '')} as attrs")
    return run(spark, df, {"types": route(target("t", ["Pass"], output="JSON"))}).routed().select("msg_id", "content")


@query("""
    select 'd' || doc_id as msg_id, text as content from documents
""")
def charset_decode(spark: SparkSession, d: str) -> DataFrame:
    """A message table whose content is bytes in a named charset."""
    folder = scratch(spark, "binary")
    df = table(spark, d, "documents").selectExpr("concat('d', doc_id) as msg_id", "encode(text, 'UTF-16LE') as content", "map('lang', lang) as attrs")
    df.write.parquet(folder)
    return messages(spark, folder, charset="UTF-16LE").select("msg_id", "content")


@query("""
    select 'o' || o_orderkey as msg_id, t.id as target_id from orders cross join (values ('F'), ('O'), ('P')) t(id)
    where t.id = o_orderstatus or o_orderkey % 3 = 0
""")
def permitted_target_list(spark: SparkSession, d: str) -> DataFrame:
    """The content names the targets it permits; none named means all."""
    df = spread(table(spark, d, "orders")).selectExpr(
        "concat('o', o_orderkey) as msg_id",
        "case when o_orderkey % 3 = 0 then '<o/>' else concat('<o><to>', o_orderstatus, '</to></o>') end as content")
    return fan_out_permitted(with_permitted(df, "to"), "array('F', 'O', 'P')").select("msg_id", "target_id")


@query("""
    select 'o' || o_orderkey as msg_id, case when o_orderkey % 2 = 0 then 'deliver' when o_orderstatus in ('F', 'O') then 'deliver' else 'failed' end as route,
           t.id as target_id,
           case t.id when 'F' then '<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"><soapenv:Body>' || x || '</soapenv:Body></soapenv:Envelope>'
                     when 'O' then '{"batch":{"order":{"cents":' || cents || ',"id":' || o_orderkey || ',"status":"' || status || '"}}}'
                     else x end as content,
           case when t.id is null then 'no permitted targets' end as problem
    from (select *, case when o_orderkey % 2 = 0 then 'none' else o_orderstatus end as status, cast(round(o_totalprice * 100) as bigint) as cents,
                 '<order><id>' || o_orderkey || '</id><status>' || status || '</status><cents>' || cents || '</cents></order>' as x from orders)
    left join (values ('F'), ('O')) t(id) on o_orderkey % 2 = 0 or t.id = o_orderstatus
""")
def restricted_targets(spark: SparkSession, d: str) -> DataFrame:
    """The route names an XPath of permitted targets, targets ask for an envelope and for a root element."""
    more = "case when o_orderkey % 2 = 0 then 'none' else o_orderstatus end"
    df = dealt(spark, d, "orders").selectExpr(
        "concat('o', o_orderkey) as msg_id",
        f"concat('<?xml version=\"1.0\"?><order><id>', o_orderkey, '</id><status>', {more}, '</status><cents>', {cents('o_totalprice')}, '</cents></order>') as content",
        "map('business.process.name', 'all') as attrs")
    doc = route(target("F", ["Pass"], output="SOAP"), target("O", ["Pass"], output="JSON", rootTag="batch"), validate="order",
                targetsRestrict="status[. != 'none']")
    got = run(spark, df, {"all": doc}).routed()
    return got.selectExpr("msg_id", "route", "target_id", f"regexp_replace(content, {lit('^<.xml[^>]*>')}, '') as content", attr("error.msg", "problem"))


@query("""
    select 'p' || p_partkey as msg_id, case when p_partkey % 7 = 0 then 'failed' else 'deliver' end as route,
           case when p_partkey % 7 <> 0 then 'two' end as label, case when p_partkey % 7 <> 0 then '<y><a>' || p_partkey || '</a></y>' end as content
    from part
""")
def duplicate_registry_keys(spark: SparkSession, d: str) -> DataFrame:
    """Of rows that repeat a key in routes, schemas and reshapes the greatest counts, in whatever order they come."""
    step = "ApplyXslt://?Name=Shape"
    docs = [("parts", route(target("t", ["UpdateAttribute://?label=" + x, step], url=x), validate="part")) for x in ("two", "one")]
    both = [(name, xsd) for name, xsd in SCHEMAS.items()] + [("part", "<a not a schema")]
    shapes = [("Shape", "key bigint", "named_struct('a', doc.key)", "y"), ("Shape", "key bigint", "doc.key", "z")]
    got = route_messages(
        part_messages(spark, d), values(spark, "process doc", docs), values(spark, "name xsd", both + both[:2]),
        values(spark, "name input_ddl expr root_tag", shapes)).routed()
    return got.selectExpr("msg_id", "route", attr("label"), "case when route = 'deliver' then content end as content")


@query("""
    select 'c' || c_custkey as msg_id, c_name as one, cast(c_custkey % 3 as varchar) as hits from customer
""")
def xpath_backslash(spark: SparkSession, d: str) -> DataFrame:
    """A doubled backslash in a path stands for one."""
    slash = lit(chr(92))
    df = table(spark, d, "customer").selectExpr(
        "concat('c', c_custkey) as msg_id",
        f"concat('<r><a>x', {slash}, 'y</a><b>', c_name, '</b>', repeat(concat('<c>', {slash}, '</c><c>/</c>'), cast(c_custkey % 3 as int)), '</r>') as content",
        f"{AT_START.format('slashes', '')} as attrs")
    double = chr(92) * 2
    step = f"EvaluateXQuery://?Destination=flowfile-attribute&one=b[../a = 'x{double}y']&hits=count(c[. = '{double}'])"
    got = run(spark, df, {"slashes": route(target("t", [step]))}).routed()
    return got.selectExpr("msg_id", attr("one"), attr("hits"))


@query("""
    select 'd' || doc_id as msg_id, regexp_matches(text, '[0-9]{3}') as part,
           case when lang = 'en' then regexp_full_match(text, '[^0-9]*') else not regexp_matches(text, '\\n') end as whole,
           case when lang = 'en' then cast(false as boolean) else true end as odd
    from documents
""")
def content_match(spark: SparkSession, d: str) -> DataFrame:
    """The match a parked message waits for."""
    df = document_messages(spark, d).selectExpr(
        "msg_id", "content", "'[0-9]{3}' as condition", "case when attrs['lang'] = 'en' then '[^0-9]*' else '.*' end as other",
        "case when attrs['lang'] = 'en' then '(' else '(?s).*' end as last")
    exact = lambda c: content_matches("content", c, "content must match exactly")
    return df.selectExpr("msg_id", f"{content_matches('content', 'condition')} as part", f"{exact('other')} as whole", f"{exact('last')} as odd")


# --- registries --------------------------------------------------------------

_PART_ROUTE = (
    "to_json(named_struct('validate', concat('v', p_size), 'sync', case when p_partkey % 2 = 0 then 'true' else 'false' end,"
    " 'targets', array(named_struct('id', p_brand, 'transformations', array(array(concat('UpdateAttribute://?size=', p_size, '&name= ', p_name),"
    " 'Pass'), array(concat('Type://?t=', p_type, '=x'))), 'targetPath', '[\"u\",\"v\"]'),"
    " named_struct('id', p_type, 'transformations', array(array('Last')), 'targetPath', p_name)))) as doc"
)


def _part_routes(spark: SparkSession, d: str) -> DataFrame:
    doc = f"case when p_partkey % 10 = 9 then '{{broken' else {_PART_ROUTE.removesuffix(' as doc')} end as doc"
    return table(spark, d, "part").selectExpr("concat('p', p_partkey) as process", doc)


@query("""
    select 'p' || p_partkey as process, case when p_partkey % 10 <> 9 then 'v' || p_size end as validate,
           p_partkey % 10 <> 9 and p_partkey % 2 = 0 as sync, p_partkey % 10 = 9 as bad,
           case when p_partkey % 10 = 9 then 0 else 3 end as paths, case when p_partkey % 10 = 9 then 0 else 5 end as deliveries
    from part
""")
def route_parse(spark: SparkSession, d: str) -> DataFrame:
    """Route documents to columns; a bad one is marked."""
    got = pipelines(parse_routes(_part_routes(spark, d)))
    deliveries = "aggregate(pipelines, 0, (n, p) -> n + size(p.urls))"
    return got.selectExpr("process", "validate", "sync", "bad", "cast(size(pipelines) as int) as paths", f"{deliveries} as deliveries")


@query("""
    select 'p' || p_partkey as process, s.target_pos, s.path, s.stage, s.name,
           case when s.name = 'UpdateAttribute' then cast(p_size as varchar) end as size,
           case when s.name = 'UpdateAttribute' then trim(p_name) end as part,
           case when s.name = 'Type' then p_type || '=x' end as t
    from part cross join (values (0, 0, 0, 'UpdateAttribute'), (0, 0, 1, 'Pass'), (0, 1, 0, 'Type'), (1, 0, 0, 'Last')) s(target_pos, path, stage, name)
    where p_partkey % 10 <> 9
""")
def step_table(spark: SparkSession, d: str) -> DataFrame:
    """One row per stage, with name and parameters."""
    got = steps(parse_routes(_part_routes(spark, d)))
    return got.selectExpr(
        "process", "target_pos", "path", "stage", "name", "params['size'] as size", "params['name'] as part", "params['t'] as t")


@query("""
    select 'p' || p_partkey as msg_id, case when p_partkey % 10 = 9 or p_partkey % 7 = 0 then 'failed' else 'deliver' end as route,
           case when p_partkey % 10 <> 9 and p_partkey % 7 <> 0 then p_brand end as target_id,
           case when p_partkey % 10 <> 9 and p_partkey % 7 <> 0 then p_name end as target_url,
           case when p_partkey % 10 <> 9 and p_partkey % 7 <> 0 then 'of ' || p_brand end as label
    from part
""")
def registry_per_part(spark: SparkSession, d: str) -> DataFrame:
    """A registry of one route per part, read from storage."""
    folder = scratch(spark, "routes")
    doc = (
        "to_json(named_struct('validate', 'part', 'targets', array(named_struct('id', p_brand, 'transformations',"
        f" array(array({lit('UpdateAttribute://?label=of ${brand}')})), 'targetPath', p_name))))"
    )
    table(spark, d, "part").selectExpr(
        "concat('p', p_partkey) as process", f"case when p_partkey % 10 = 9 then '{{broken' else {doc} end as doc"
    ).write.parquet(folder)
    got = route_messages(part_messages(spark, d, "concat('p', p_partkey)"), registry(spark, "routes", folder), schemas(spark))
    return got.routed().selectExpr("msg_id", "route", "target_id", "target_url", attr("label"))


@query("""
    select 'p' || p_partkey as msg_id, 'deliver' as route, 'of ' || p_brand as label, p_type as kind from part where p_partkey % 7 <> 0
    union all select 'p' || p_partkey, 'failed', null, null from part where p_partkey % 7 = 0
""")
def registry_in_several_plans(spark: SparkSession, d: str) -> DataFrame:
    """More distinct steps than a plan compiles; they run as data, in one scan of the messages."""
    doc = (
        "to_json(named_struct('validate', 'part', 'targets', array(named_struct('id', 't', 'transformations',"
        " array(array(concat('UpdateAttribute://?label=of ', p_brand), concat('Custom://?kind=', p_type))), 'targetPath', 'u'))))"
    )
    docs = table(spark, d, "part").selectExpr("concat(p_brand, '/', p_type) as process", f"{doc} as doc").distinct()
    got = route_messages(part_messages(spark, d, "concat(p_brand, '/', p_type)"), docs, schemas(spark), settings=Settings(max_steps=10))
    return got.routed().selectExpr("msg_id", "route", attr("label"), attr("kind"))


# --- audit and lineage -------------------------------------------------------

_RECEIVERS = [("/click", "Clicks"), ("iface-3", "attribute")]
_AUDIT_ROUTE = route(
    target("t", ["UpdateAttribute://?filename=new-${user}", "RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${event.type} <> 'error'", "Late"]),
    target("s", ["RouteOnContent://?MatchRequirement=m&RouteCondition=c", "Never"]), validate="event")


@query("""
    select 'e' || event_id || a.place as lineage, a.step, a.path, a.stage,
           case when a.place = '/0/0/0' then 'new-' || user_id else 'event-' || event_id end as file_name,
           case when event_type = 'error' then 'Не указан' else 's-' || event_type end as sender,
           case when event_type = 'click' then 'Clicks' when event_type = 'view' and user_id % 5 = 3 then a.own else 'Не определен' end as receiver
    from events cross join (values
        ('/0/0/0', 'UpdateAttribute', '0', '0', 't'), ('/0/0/0', 'RouteOnAttribute', '0', '1', 't'), ('/0/0/0', 'Late', '0', '2', 't'),
        ('/1/0/0', 'RouteOnContent', '0', '0', 's')) a(place, step, path, stage, own)
    where not (a.step = 'Late' and event_type = 'error')
""")
def audit_steps(spark: SparkSession, d: str) -> DataFrame:
    """One record per executed step, the suppressing and parking ones included."""
    got = run(spark, events(spark, d), {"events": _AUDIT_ROUTE}, Settings(shared_endpoint=SHARED)).audit(values(spark, "uri receiver", _RECEIVERS))
    return got.select("lineage", "step", "path", "stage", "file_name", "sender", "receiver")


@query("""
    select 'e' || event_id || '/0/0/0.' || c.i as lineage, c.kind as entry_type, c.step,
           case when c.kind = 'start' then 'e' || event_id || '/0/0/0' end as derivation,
           cast(case when c.kind = 'start' then 1 end as integer) as log_start, cast(case when c.kind = 'start' then 0 end as integer) as log_success
    from events cross join (values (0, 'processing', 'First'), (1, 'start', cast(null as varchar)), (2, 'start', null),
        (0, 'processing', 'After'), (1, 'processing', 'After'), (2, 'processing', 'After')) c(i, kind, step)
""")
def audit_copies(spark: SparkSession, d: str) -> DataFrame:
    """A start record per copy; the duplicating step itself has none."""
    doc = route(target("t", ["First", "DuplicateFlowFile://?Number=2", "After"]), validate="event")
    got = run(spark, events(spark, d), {"events": doc}).audit(values(spark, "uri receiver", _RECEIVERS))
    return got.select("lineage", "entry_type", "step", "derivation", "log_start", "log_success")


@query("""
    select 'e' || event_id as msg_id, 'UpdateAttribute' as step, 'INFO' as level, 'events' as process,
           'Сообщение в [Transform] c filename [event-' || event_id || '], бизнес-процесс [events], отправитель [' ||
           case when event_type = 'error' then 'Не указан' else 's-' || event_type end || '], получатель [' ||
           case when event_type = 'click' then 'Clicks' when event_type = 'view' and user_id % 5 = 3 then 't' else 'Не определен' end || ']' as message
    from events
""")
def audit_messages(spark: SparkSession, d: str) -> DataFrame:
    """The JSON form of the record."""
    doc = route(target("t", ["UpdateAttribute://?a=b"]), validate="event")
    got = audit_message(run(spark, events(spark, d), {"events": doc}, Settings(shared_endpoint=SHARED)).audit(values(spark, "uri receiver", _RECEIVERS)))
    field = lambda name, alias: f"get_json_object(message, {lit('$.' + name)}) as {alias}"
    return got.selectExpr(
        "msg_id", field("transformationEntity", "step"), field("level", "level"), field("_businessProcess", "process"), field("short_message", "message"))


@query("""
    select 'e' || event_id as parent_id, 'e' || event_id || '/' || t.i as child_id, 'clone' as kind from events cross join (values (0), (1)) t(i)
    union all
    select 'e' || event_id || '/' || t.i, 'e' || event_id || '/' || t.i || '/' || t.p || '/0', 'modified'
    from events cross join (values (0, 0), (0, 1), (1, 0)) t(i, p)
    union all
    select 'e' || event_id || '/' || t.i || '/' || t.p || '/0', 'e' || event_id || '/' || t.i || '/' || t.p || '/0/0', 'destination'
    from events cross join (values (0, 0), (0, 1), (1, 0)) t(i, p)
""")
def lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    """Clone per target, modified per path result, destination per url."""
    doc = route(target("t", ["Pass"], ["Pass"]), target("s", ["Pass"]), validate="event")
    return run(spark, events(spark, d), {"events": doc}).lineage()


@query("""
    with rows as (
        select 'e' || event_id as root, place, route, depth from events cross join (values
            ('/0/0/0.0/0', 'deliver', 4), ('/0/0/0.0/1', 'deliver', 4), ('/0/0/0.1/0', 'deliver', 4), ('/0/0/0.1/1', 'deliver', 4),
            ('/1/-/0', 'reply', 2), ('/1/0/0.r0', 'reply', 3), ('/1/0/0/0', 'parked', 3), ('/1/0/0/0/1/0/0/0', 'deliver', 6),
            ('/2/none/0', 'failed', 2), ('/3/0/0', 'failed', 2)) v(place, route, depth)
        where event_type <> 'error' or place like '/1%'
        union all select 'e' || event_id, '/2/none/0', 'failed', 2 from events where event_type = 'error'
        union all select 'e' || event_id, '/3/0/0', 'failed', 2 from events where event_type = 'error'
    )
    select root || place as lineage, route, root, cast(depth as bigint) as depth from rows
    union all
    select 'p' || p_partkey || '/-/-/0', 'failed', 'p' || p_partkey, 1 from part
""")
def lineage_joins_routed(spark: SparkSession, d: str) -> DataFrame:
    """Every routed row of a first pass and of the pass after it came back leads up to its message."""
    doc = route(
        target("t", ["RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${event.type} <> 'error'", "DuplicateFlowFile://?Number=1"], url=["u", "v"]),
        target("s", ["SyncResponse", "RouteOnContent://?MatchRequirement=m&RouteCondition=c", "UpdateAttribute://?a=b"], syncValidation="true"),
        target("none"), target("bad", ["DuplicateFlowFile://?Number=many"]), validate="event")
    both = events(spark, d).unionByName(part_messages(spark, d))
    first = run(spark, both, {"events": doc}).materialised(scratch(spark, "first"))
    base = scratch(spark, "routed")
    write_routes(first.routed(), base)
    later = run(spark, returned_messages(read_route(spark, base, "parked")), {"events": doc})
    ways = lineage_closure(first.lineage().unionByName(later.lineage()))
    rows = first.routed().unionByName(later.routed()).select("lineage", "route")
    return rows.join(ways, rows["lineage"] == ways["node"]).select("lineage", "route", "root", "depth")


# --- whole runs --------------------------------------------------------------

FIRST_PASS = {
    "1-URGENT": route(
        target("billing", ["UpdateAttribute://?label=urgent-${order.id}", "EvaluateXQuery://?Destination=flowfile-attribute&cents=cents"], url=["b1", "b2"]),
        target("archive", ["Pass"], url="a"), validate="order"),
    "2-HIGH": route(target("billing", ["DuplicateFlowFile://?Number=1", "UpdateAttribute://?label=copy-${copy.index}"], ["Pass"], url="b1"), validate="order"),
    "3-MEDIUM": route(target("billing", ["RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${order.status} = 'F'", "UpdateAttribute://?label=kept"], url="b1"), validate="order"),
    "5-LOW": route(target("archive", ["ReplaceText://?ReplacementStrategy=RegexReplace&SearchValue=status&ReplacementValue=state"], url="a", output="JSON"), validate="part"),
}

_FIRST_SQL = f"""
    select 'o' || o_orderkey as msg_id, v.route, v.target_id, v.target_url,
           case v.label when 'urgent' then 'urgent-' || o_orderkey else v.label end as label,
           case when v.label = 'urgent' then cast({cents('o_totalprice')} as varchar) end as cents,
           case when o_orderpriority = '4-NOT SPECIFIED' then '501' end as status
    from orders join (values
        ('1-URGENT', 'deliver', 'billing', 'b1', 'urgent'), ('1-URGENT', 'deliver', 'billing', 'b2', 'urgent'), ('1-URGENT', 'deliver', 'archive', 'a', null),
        ('2-HIGH', 'deliver', 'billing', 'b1', 'copy-0'), ('2-HIGH', 'deliver', 'billing', 'b1', 'copy-1'), ('2-HIGH', 'deliver', 'billing', 'b1', null),
        ('3-MEDIUM', 'deliver', 'billing', 'b1', 'kept'), ('5-LOW', 'failed', null, null, null),
        ('4-NOT SPECIFIED', 'failed', null, null, null)) v(priority, route, target_id, target_url, label) on v.priority = o_orderpriority
    where o_orderpriority <> '3-MEDIUM' or o_orderstatus = 'F'
"""


@query(_FIRST_SQL)
def first_pass(spark: SparkSession, d: str) -> DataFrame:
    """Lookup, validation, fan-out, steps, marks and destinations together."""
    got = run(spark, order_messages(spark, d), FIRST_PASS).routed()
    return got.selectExpr("msg_id", "route", "target_id", "target_url", attr("label"), attr("cents"), attr("route.status.code", "status"))


@query(f"select route, target_id, target_url, count(*) as deliveries from ({_FIRST_SQL}) group by 1, 2, 3")
def deliveries_by_target(spark: SparkSession, d: str) -> DataFrame:
    """How many rows go where."""
    got = run(spark, order_messages(spark, d), FIRST_PASS).routed()
    return got.groupBy("route", "target_id", "target_url").agg(F.count(F.lit(1)).alias("deliveries"))


@query(f"select route, count(*) as n from ({_FIRST_SQL}) group by 1")
def written_routes(spark: SparkSession, d: str) -> DataFrame:
    """O1, O2: messages from storage, routed output in one folder per route."""
    source, base = scratch(spark, "messages"), scratch(spark, "routed")
    order_messages(spark, d).write.parquet(source)
    write_routes(run(spark, messages(spark, source), FIRST_PASS).routed(), base)
    return spark.read.parquet(base).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, event_type, user_id from events")
def reformat_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of one format and schema written as another."""
    folder = scratch(spark, "json")
    reformat(spark, f"{d}/events.parquet", "parquet", folder, "json", target_columns=["event_id", "event_type", "user_id"])
    return spark.read.schema("event_id bigint, event_type string, user_id bigint").json(folder)


@query("""
    select event_id, case when event_type = 'error' or value <> round(value, 1) then null else event_type end as kind,
           case when event_type <> 'error' and value = round(value, 1) then user_id end as user_id,
           case when event_type <> 'error' and value = round(value, 1) then 'web' end as channel,
           case when event_type = 'error' then 'at.user: u' || user_id || ' is no bigint' end as user_problem,
           value <> round(value, 1) as cut_value
    from events
""")
def reformat_evolved(spark: SparkSession, d: str) -> DataFrame:
    """A reader schema resolved to a writer schema: aliases, a default, nested and narrower fields; rejects as rows."""
    base = scratch(spark, "evolved")
    user = "case when event_type = 'error' then concat('u', user_id) else cast(user_id as string) end"
    table(spark, d, "events").selectExpr(
        "cast(event_id as int) as event_id", "event_type", f"named_struct('user', {user}, 'ts', ts) as place", "value", "props").write.parquet(f"{base}/in")
    reformat(
        spark, f"{base}/in", "parquet", f"{base}/out", "json", rejects=f"{base}/rejects",
        writer_schema="event_id bigint not null, kind string not null, at struct<user: bigint, ts: timestamp, zone: string>, value decimal(12,1), channel string not null, note string",
        defaults={"channel": "'web'"}, aliases={"kind": ["event_type"], "at": ["place"]})
    out = spark.read.schema("event_id bigint, kind string, at struct<user: bigint>, channel string, note string").json(f"{base}/out")
    bad = spark.read.parquet(f"{base}/rejects")
    return out.selectExpr(
        "event_id", "kind", "at.user as user_id", "channel", "cast(null as string) as user_problem", "false as cut_value").unionByName(bad.selectExpr(
        "cast(get_json_object(record, '$.event_id') as bigint) as event_id", "cast(null as string) as kind", "cast(null as bigint) as user_id",
        "cast(null as string) as channel", "get(filter(problems, p -> startswith(p, 'at.user')), 0) as user_problem",
        "exists(problems, p -> startswith(p, 'value')) as cut_value"))


@query("""
    select 'e' || event_id as msg_id, 'e' || event_id || '/0/0/0/0' as lineage, 'deliver' as route, event_type || '!' as label
    from events where event_type <> 'error'
    union all select 'e' || event_id, 'e' || event_id || '/1/-/0', 'reply', null from events
    union all select 'e' || event_id, 'e' || event_id || '/1/0/0/0', 'parked', null from events
""")
def stream_route(spark: SparkSession, d: str) -> DataFrame:
    """The same plan over a stream of the event table, written per micro-batch."""
    doc = route(
        target("t", ["RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${event.type} <> 'error'", "UpdateAttribute://?label=${event.type}!"]),
        target("s", ["RouteOnContent://?MatchRequirement=m&RouteCondition=c"], syncValidation="true"), validate="event")
    raw = spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    base = scratch(spark, "stream")
    tables = lambda: {"routes": routes(spark, {"events": doc}), "schemas": schemas(spark)}
    cores = spark.sparkContext.defaultParallelism
    route_stream(event_messages(raw), tables, base, f"{base}/checkpoint", partitions=cores).awaitTermination()
    return read_batches(spark, base, "routed").selectExpr("msg_id", "lineage", "route", attr("label"))


@query("""
    select 'e' || event_id || '/0/0/0/0' as msg_id, 'deliver' as route, event_type || '12' as b, 'back' as result,
           cast(null as varchar) as problem
    from events where event_type <> 'error' and user_id % 4 in (1, 2)
    union all
    select 'e' || event_id || '/0/0/0/0', 'failed', null, null,
           'java.util.concurrent.TimeoutException: not returned within 2 hours'
    from events where event_type <> 'error' and user_id % 4 in (0, 3)
    union all
    select 'e' || event_id || '/0/0/0/0', 'failed', null, 'back', 'java.lang.IllegalStateException: returned unexpectedly or too late'
    from events where event_type <> 'error' and user_id % 4 = 3
""")
def park_return_stream(spark: SparkSession, d: str) -> DataFrame:
    """A stream parks rows and meets the stream of their returns; some never come, some too late."""
    steps_ = ["RouteOnAttribute://?RoutingStrategy=r&Condition=sql:${event.type} <> 'error'", "UpdateAttribute://?a=${event.type}1",
              "RouteOnContent://?MatchRequirement=m&RouteCondition=c", "UpdateAttribute://?b=${a}2"]
    docs = {"events": route(target("t", steps_), validate="event")}
    base = scratch(spark, "returns")
    source, back = f"{base}/in", f"{base}/back"
    sent = event_messages(table(spark, d, "events"), more=", 'at', cast(ts as string)")
    # A stream can't be dealt out by its rows, so its files are even.
    spread(sent).write.parquet(source)
    # Half of the users' rows return after ten minutes, a quarter after two days, a quarter never.
    user, at = "cast(attrs['user'] as int)", "cast(attrs['at'] as timestamp)"
    later = f"{at} + case when {user} % 4 = 3 then interval 2 days else interval 10 minutes end"
    parked = run(spark, messages(spark, source), docs).routed().where("route = 'parked'")
    parked.where(f"{user} % 4 <> 0").selectExpr(
        "lineage as msg_id", "content", "map_concat(attrs, map('result', 'back')) as attrs", f"{later} as returned_at").write.parquet(back)
    # A last row of each stream moves the watermarks past all others; it waits on.
    end = "timestamp'2099-01-01'"
    spark.sql(f"select 'end' as msg_id, '<event><type>x</type><user>1</user><cents>1</cents></event>' as content,"
              f" map('business.process.name', 'events', 'event.type', 'x', 'at', cast({end} as string)) as attrs").write.mode("append").parquet(source)
    spark.sql(f"select 'none' as msg_id, '' as content, map('a', 'b') as attrs, {end} as returned_at").write.mode("append").parquet(back)
    waiting = run(spark, messages(spark, source, streaming=True), docs).routed().where("route = 'parked'")
    coming = spark.readStream.schema("msg_id string, content string, attrs map<string,string>, returned_at timestamp").parquet(back)
    tables = lambda: {"routes": routes(spark, docs), "schemas": schemas(spark)}
    resume_stream(
        waiting.selectExpr("lineage", "content", "attrs", f"{at} as parked_at"), coming, tables, base, f"{base}/checkpoint", timeout="2 hours",
    ).awaitTermination()
    got = read_batches(spark, base, "routed")
    return got.selectExpr(
        f"regexp_extract(msg_id, {lit('^[^/]+/0/0/0/0')}, 0) as msg_id", "route", attr("b"), attr("result"), attr("error.msg", "problem"))
