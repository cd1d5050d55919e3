"""Messages, route documents and schemas made from the test tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from waybill import RouteRun, Settings, route_messages, session
from waybill.functions.render import lit
from waybill.session import spread


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table whose rows are dealt out while they are narrow, for a message is several times as long as its row, unless a task can hold them."""
    return spread(table(spark, d, name), least=session.TASK_ROWS)


def values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small registry as an inline table of strings."""
    names = columns.split()
    body = ", ".join(f"({', '.join(lit(v) for v in row)})" for row in rows)
    return spark.sql(f"select * from values {body} as t({', '.join(names)})")


def route(*targets: dict, validate: str | None = None, sync: str | None = None, **more: str) -> str:
    return json.dumps({"validate": validate, "sync": sync, "targets": list(targets), **more})


def target(id: str, *paths: list[str], url: str | list[str] = "u", **more: str) -> dict:
    return {"id": id, "transformations": list(paths), "targetPath": url, **more}


def _xsd(body: str) -> str:
    return f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{body}</xs:schema>'


def _record(root: str, *fields: tuple[str, str]) -> str:
    inner = "".join(f'<xs:element name="{name}" type="xs:{kind}"/>' for name, kind in fields)
    return _xsd(f'<xs:element name="{root}"><xs:complexType><xs:sequence>{inner}</xs:sequence></xs:complexType></xs:element>')


SCHEMAS = {
    "order": _record("order", ("id", "long"), ("status", "string"), ("cents", "long")),
    "event": _record("event", ("type", "string"), ("user", "long"), ("cents", "long")),
    "part": _record("part", ("key", "long"), ("size", "int")),
    "customer": _xsd(
        '<xs:element name="customer"><xs:complexType><xs:sequence><xs:element name="name" type="xs:string"/>'
        '<xs:element name="tag" type="xs:string" minOccurs="0" maxOccurs="unbounded"/>'
        '<xs:element name="nation"><xs:complexType><xs:sequence><xs:element name="key" type="xs:int"/></xs:sequence>'
        '</xs:complexType></xs:element></xs:sequence><xs:attribute name="key" type="xs:long"/>'
        '<xs:attribute name="segment" type="xs:string"/></xs:complexType></xs:element>'
    ),
    "document": _record("document", ("lang", "string"), ("text", "string")),
    "broken": "<xs:schema",
}


def schemas(spark: SparkSession) -> DataFrame:
    return values(spark, "name xsd", list(SCHEMAS.items()))


def routes(spark: SparkSession, docs: dict[str, str]) -> DataFrame:
    return values(spark, "process doc", list(docs.items()))


def run(
    spark: SparkSession, messages: DataFrame, docs: dict[str, str], settings: Settings | None = None,
    reshapes: DataFrame | None = None,
) -> RouteRun:
    return route_messages(messages, routes(spark, docs), schemas(spark), reshapes, settings)


def escaped(text: str) -> str:
    """SQL for a text inside an XML element."""
    return (
        f"replace(replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(13), '&#13;')"
    )


def cents(amount: str) -> str:
    return f"cast(round({amount} * 100) as bigint)"


def order_messages(spark: SparkSession, d: str, more: str = "") -> DataFrame:
    """One message per order; the process is its priority."""
    return dealt(spark, d, "orders").selectExpr(
        "concat('o', o_orderkey) as msg_id",
        "concat('<order><id>', o_orderkey, '</id><status>', o_orderstatus, '</status><cents>',"
        f" {cents('o_totalprice')}, '</cents></order>') as content",
        "map('business.process.name', o_orderpriority, 'filename', concat('order-', o_orderkey, '.xml'),"
        " 'order.id', cast(o_orderkey as string), 'order.status', o_orderstatus,"
        f" 'cust', cast(o_custkey as string){more}) as attrs",
    )


def event_messages(events: DataFrame, process: str = "'events'", more: str = "") -> DataFrame:
    """One message per event; also works on a stream."""
    return events.selectExpr(
        "concat('e', event_id) as msg_id",
        f"concat('<event><type>', event_type, '</type><user>', user_id, '</user><cents>', {cents('value')}, '</cents></event>') as content",
        f"map('business.process.name', {process}, 'filename', concat('event-', event_id), 'path', '/in',"
        " 'event.type', event_type, 'user', cast(user_id as string),"
        " 'http.query.param.senderService', case when event_type = 'error' then '' else concat('s-', event_type) end,"
        " 'http.request.uri', case when event_type = 'view' then '/sap/xi' else concat('/', event_type) end,"
        f" 'sap.Interface.value', concat('iface-', user_id % 5){more}) as attrs",
    )


def part_messages(spark: SparkSession, d: str, process: str = "'parts'") -> DataFrame:
    """One message per part; every seventh has a size that is not a number."""
    return dealt(spark, d, "part").selectExpr(
        "concat('p', p_partkey) as msg_id",
        "concat('<part><key>', p_partkey, '</key><size>', case when p_partkey % 7 = 0 then 'big' else cast(p_size as string) end,"
        " '</size></part>') as content",
        f"map('business.process.name', {process}, 'brand', p_brand) as attrs",
    )


def customer_messages(spark: SparkSession, d: str) -> DataFrame:
    """One nested message per customer, with attributes and 0 to 30 repeats."""
    return table(spark, d, "customer").selectExpr(
        "concat('c', c_custkey) as msg_id",
        f"concat('<?xml version=\"1.0\"?><customer key=\"', c_custkey, '\" segment=\"', {escaped('c_mktsegment')}, '\"><name>', {escaped('c_name')}, '</name>',"
        " repeat(concat('<tag>t', c_nationkey, '</tag>'), cast(c_custkey % 31 as int)),"
        " '<nation><key>', c_nationkey, '</key></nation></customer>') as content",
        "map('business.process.name', 'customers', 'segment', c_mktsegment) as attrs",
    )


# Position attributes that start a path at its first step, without validation.
AT_START = "map('business.process.name', '{}', 'target.id', 't', 'xform.path', '0', 'xform.stage', '-1'{})"


def document_messages(spark: SparkSession, d: str, process: str = "documents") -> DataFrame:
    """The whole text of each document as content."""
    attrs = AT_START.format(process, ", 'lang', lang, 'source', source")
    return table(spark, d, "documents").selectExpr("concat('d', doc_id) as msg_id", "text as content", f"{attrs} as attrs")


def document_xml(spark: SparkSession, d: str) -> DataFrame:
    """Each document as an XML message with its whole text in one element."""
    clean = f"regexp_replace(text, {lit('[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')}, '')"
    return table(spark, d, "documents").selectExpr(
        "concat('d', doc_id) as msg_id",
        f"concat('<document><lang>', {escaped('lang')}, '</lang><text>', {escaped(clean)}, '</text></document>') as content",
        "map('business.process.name', 'documents') as attrs",
    )


def page_messages(spark: SparkSession, d: str) -> DataFrame:
    """Raw pages as they are."""
    return table(spark, d, "pages").selectExpr(
        "concat('g', page_id) as msg_id", "html as content", "map('business.process.name', 'pages', 'url', url) as attrs"
    )
