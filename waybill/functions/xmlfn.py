"""XML checks and XML to JSON."""

from __future__ import annotations

import io
import json
import re
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from waybill.functions.render import lit
from waybill.functions.xpath import strip_declaration
from waybill.session import shared_file

# Accepts one element of any kind and nothing beside it.
ONE_ELEMENT_XSD = (
    '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="w"><xs:complexType>'
    '<xs:sequence><xs:any processContents="skip"/></xs:sequence></xs:complexType></xs:element></xs:schema>'
)


def schema_file(spark: SparkSession, xsd: str) -> str:
    """Put a schema where executors can read it; return its path."""
    return shared_file(spark, "xsd", xsd, ".xsd")


def schema_problem(spark: SparkSession, xsd: str) -> str | None:
    """Compile a schema once, on the driver; the error text if it is not valid."""
    jvm = spark._jvm
    try:
        factory = jvm.javax.xml.validation.SchemaFactory.newInstance("http://www.w3.org/2001/XMLSchema")
        factory.newSchema(jvm.javax.xml.transform.stream.StreamSource(jvm.java.io.StringReader(xsd)))
    except Exception as e:  # noqa: BLE001 - any Java exception is the finding
        cause = getattr(e, "java_exception", None)
        return cause.toString() if cause is not None else str(e)
    return None


_XS = "{http://www.w3.org/2001/XMLSchema}"
# Texts that are surely valid for a type, as Java patterns: plain characters and short numbers.
_SURE_TYPES = {
    "string": r"[\t\n\x20-\x25\x27-\x3B\x3D\x3F-\x5C\x5E-\uD7FF]*+",
    "long": r"-?[0-9]{1,18}+",
    "int": r"-?[0-9]{1,9}+",
    "integer": r"-?[0-9]{1,18}+",
    "decimal": r"-?[0-9]{1,18}+(?:\.[0-9]{1,18}+)?+",
    "boolean": r"(?:true|false|0|1)",
}
_BLANK = r"[\x20\t\n]*+"


def sure_form(xsd: str) -> str | None:
    """A Java pattern of plain documents that are valid for sure, for schemas of nested sequences; None for any other.

    It has tags without attributes, plain texts and no repeated group. What it does not match may be valid as well.
    """
    bound: dict[str, set[str]] = {}
    try:
        for _, (prefix, uri) in ElementTree.iterparse(io.BytesIO(xsd.encode("utf-8")), events=("start-ns",)):
            bound.setdefault(prefix, set()).add(f"{{{uri}}}")
        root = ElementTree.fromstring(xsd.encode("utf-8"))
    except (ElementTree.ParseError, ValueError):
        return None

    def body(element: ElementTree.Element) -> str:
        name, kind = element.get("name", ""), element.get("type")
        known = {"name", "type", "minOccurs", "maxOccurs"}
        if element.tag != f"{_XS}element" or not known.issuperset(element.keys()) or not re.fullmatch(r"[A-Za-z_][\w.-]{0,99}", name, re.A) or name == "bad":
            raise ValueError(name)
        if kind is not None:
            prefix, _, local = kind.rpartition(":")
            if len(element) or bound.get(prefix) != {_XS} or local not in _SURE_TYPES:
                raise ValueError(kind)
            inner = _SURE_TYPES[local]
        else:
            (record,) = element
            (sequence,) = record
            if record.tag != f"{_XS}complexType" or record.keys() or sequence.tag != f"{_XS}sequence" or sequence.keys():
                raise ValueError(name)
            inner = _BLANK + "".join(part(e) + _BLANK for e in sequence)
        return f"<{re.escape(name)}>{inner}</{re.escape(name)}>"

    def part(element: ElementTree.Element) -> str:
        least, most = element.get("minOccurs", "1"), element.get("maxOccurs", "1")
        if least not in ("0", "1") or most != "1":
            raise ValueError(f"{least} to {most}")
        return body(element) if least == "1" else f"(?:{body(element)})?+"

    try:
        if root.tag != f"{_XS}schema" or root.keys() or not len(root):
            return None
        roots = "|".join(body(e) for e in root)
    except ValueError:
        return None
    return rf"\A(?:<\?xml version=\x221\.0\x22\?>)?+(?:{roots})\z"


def valid_xml(content: str, xsd_path: str, sure: str | None = None) -> str:
    """True where the content is valid against the schema file; null is not. What matches ``sure`` (``sure_form``) is not parsed."""
    options = f"map('columnNameOfCorruptRecord', 'bad', 'rowValidationXSDPath', {lit(xsd_path)})"
    checked = f"from_xml({content}, 'bad string', {options}).bad is null"
    if sure:
        checked = f"case when {content} rlike {lit(sure)} then true else {checked} end"
    return f"({content} is not null and {checked})"


# Levels of elements in a plain text.
PLAIN_DEPTH = 8


def plain_inside(colon: str = "", depth: int = PLAIN_DEPTH) -> tuple[str, str]:
    """Java patterns of an element, and of all that may stand in one, that are well-formed for sure.

    There are plain texts and elements in ``depth`` levels, with one attribute at most. A ``colon`` (":") may stand
    in texts and names; prefixes need not be declared. Each loop is possessive, so it takes no stack and no second try.
    """
    signs = rf"\t\n\x20-\x25\x27-\x39{colon}\x3B\x3D\x3F-\x5C\x5E-\uD7FF"
    name = rf"[A-Za-z_][A-Za-z0-9_.{colon}-]{{0,99}}+"
    value = rf"(?:\x22[{signs}&&[^\x22]]*+\x22|\x27[{signs}&&[^\x27]]*+\x27)"
    attribute = rf"(?:[\x20\t\n]++(?!xmlns[^A-Za-z0-9_.:-]){name}{_BLANK}={_BLANK}{value})?+"
    element, inside = "", f"[{signs}]*+"
    for level in range(depth):
        element = rf"<(?<n{level}>{name}){attribute}{_BLANK}(?:/>|>{inside}</\k<n{level}>{_BLANK}>)"
        inside = rf"(?:[{signs}]++|{element})*+"
    return element, inside


# The validator takes an element of the name ``bad`` for its own column, in any case of the letters.
SURELY_WELL_FORMED = rf"\A(?:<\?xml version=\x221\.0\x22\?>)?+{_BLANK}(?!<(?i:bad)[^A-Za-z0-9_.:-]){plain_inside(':')[0]}{_BLANK}\z"


def well_formed(spark: SparkSession, content: str) -> str:
    """True where the content is one well-formed element, with no Python involved.

    The content is validated inside a wrapper element. Colons are masked, for
    undeclared prefixes are fine here. Document types are refused. What is plain is not parsed.
    """
    wrapped = f"concat('<w>', translate({strip_declaration(content)}, ':', '·'), '</w>')"
    checked = valid_xml(wrapped, schema_file(spark, ONE_ELEMENT_XSD))
    return f"({content} is not null and case when {content} rlike {lit(SURELY_WELL_FORMED)} then true else {checked} end)"


def shaped_xml(expr: str, doc: str, root_tag: str) -> str:
    """Write ``expr`` over the parsed document column ``doc`` as XML."""
    value = f"transform(array({doc}), doc -> {expr})[0]"  # binds the name; a literal that holds it stays
    return f"rtrim('\n', to_xml({value}, map('rowTag', {lit(root_tag)}, 'indent', '')))"


def root_name(content: str) -> str:
    """Name of the root element of well-formed content; only what does not start with its plain tag is parsed."""
    plain = f"regexp_extract({content}, {lit(r'\A<([A-Za-z_][A-Za-z0-9_.-]*)[\x20\t\n/>]')}, 1)"
    return f"coalesce(nullif({plain}, ''), xpath_string({content}, 'name(/*)'))"


# A sign of the private area. Before ``n`` it says that a text stays a text; a sign of the content is doubled.
_SIGN = "\ue000"
# Fixed value: what counts as a number.
_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?"


def _texts_marked(content: str) -> str:
    """The content with a mark before each scalar that Spark might take for more than a text, and in each empty element."""
    mark = f"{_SIGN}n"
    odd = rf"(?!(?:{_NUMBER}|true|false)\s*%s)(?=[+\-.0-9&]|(?i:true|false)\s*%s)"
    steps = [
        (_SIGN, _SIGN * 2),
        (rf">(\s*){odd % ('<', '<')}", f">$1{mark}"),
        (rf"=(\s*\x22\s*){odd % ('\\x22', '\\x22')}", f"=$1{mark}"),
        (rf"=(\s*\x27\s*){odd % ('\\x27', '\\x27')}", f"=$1{mark}"),
    ]
    for pattern, replacement in steps:
        content = f"regexp_replace({content}, {lit(pattern)}, {lit(replacement)})"
    # An empty element could be text inside a CDATA section, which is a text itself.
    empty = f"regexp_replace(c, {lit(r'<([^\s<>/!?]+)\s*(?:/>|>\s*</\1\s*>)')}, {lit(f'<$1>{mark}</$1>')})"
    section = f"replace(c, '<![CDATA[', {lit('<![CDATA[' + mark)})"
    return f"transform(array({content}), c -> case when contains(c, '<![CDATA[') then {section} else {empty} end)[0]"


def compact_json(content: str) -> str:
    """Objects by element name: repeats become arrays, attributes keys, scalars typed.

    A scalar is a number if it is written as JSON writes one without an exponent
    (``-1``, ``0.50``), a boolean if it is ``true`` or ``false``; blanks around it do not count. All else
    is text: signs, leading zeros, exponents, other capitals, entities and CDATA sections.
    An empty element is an empty text.
    """
    options = "map('attributePrefix', '', 'valueTag', 'content')"
    # Code generation does not cover XML to variant; a one-element array keeps it out.
    body = f"transform(array({_texts_marked(content)}), c -> to_json(from_xml(c, 'variant', {options})))[0]"
    body = f"regexp_replace({body}, {lit(rf'{_SIGN}(?:n|({_SIGN}))')}, {lit('$1')})"
    body = f"regexp_replace({body}, {lit(r'(?<!\\)(\x22:)null(?=[,}])')}, {lit('$1' + chr(34) * 2)})"
    return f"""concat('{{"', {root_name(content)}, '":', coalesce({body}, '""'), '}}')"""


def _ordered(text: str) -> str | None:
    out: list[str] = []
    counts: list[int] = []  # children written so far, per open element
    pending: list[str] = []

    def flush() -> None:
        chunk = "".join(pending)
        pending.clear()
        if not chunk.strip():
            return
        if len(counts) == 1:
            raise ValueError("text directly below the root")
        comma()
        out.append(json.dumps(chunk))

    def comma() -> None:
        if counts:
            if counts[-1]:
                out.append(",")
            counts[-1] += 1

    def opened(name: str, _attrs: list) -> None:
        flush()
        comma()
        uri, space, local = name.rpartition(" ")
        out.append(f"{{{json.dumps(f'{{{uri}}}{local}' if space else name)}:[")
        counts.append(0)

    def closed(_name: str) -> None:
        flush()
        counts.pop()
        out.append("]}")

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler = opened
    parser.EndElementHandler = closed
    parser.CharacterDataHandler = pending.append
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, ValueError):
        return None
    return "".join(out)


@F.pandas_udf(StringType())
def ordered_json(content: pd.Series) -> pd.Series:
    """``{root:[{child:[text or {..}]}]}``: order and repeats kept, attributes dropped.

    Null where the text is not well-formed or has text directly below the root.
    """
    return content.map(lambda c: None if c is None else _ordered(c))
