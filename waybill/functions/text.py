"""Text and code functions, as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waybill.functions.render import case, concat, lit
from waybill.functions.xmlfn import plain_inside, well_formed


def status_code(protocol: str, code: str) -> str:
    """Protocol ``XI`` knows only 200; every other protocol keeps the code."""
    return f"case when {protocol} = 'XI' then case when {code} = '200' then 'XI_OK' end else {code} end"


def literal_replacement(text: str) -> str:
    """A replacement with ``$`` before a non-digit is taken as plain text."""
    dollar, slash = lit("$"), lit("\\")
    quoted = f"replace(replace({text}, {slash}, {lit(chr(92) * 2)}), {dollar}, {lit(chr(92) + '$')})"
    return f"case when {text} rlike {lit(r'\$\D')} then {quoted} else {text} end"


def replace_text(content: str, pattern: str, replacement: str) -> str:
    """Replace every match; null where the pattern or a group is not legal.

    The pattern may differ by row, so a bad one must not end the job.
    """
    call = f"try_reflect('org.apache.commons.lang3.RegExUtils', 'replaceAll', {content}, {pattern}, {literal_replacement(replacement)})"
    known = f"{content} is not null and {pattern} is not null and {replacement} is not null"
    return f"case when {known} then {call} end"


def pattern_problem(spark: SparkSession, pattern: str, replacement: str | None = None) -> str | None:
    """Check a fixed pattern, and a replacement with it, once, on the driver."""
    regex = spark._jvm.java.util.regex.Pattern
    try:
        regex.compile(pattern)
        if replacement is not None:
            if regex.compile(r"\$\D").matcher(replacement).find():
                replacement = spark._jvm.java.util.regex.Matcher.quoteReplacement(replacement)
            # One alternative that always matches keeps the groups of the pattern.
            regex.compile(f"(?:{pattern})|^").matcher("").replaceAll(replacement)
    except Exception as e:  # noqa: BLE001 - any Java exception is the finding
        cause = getattr(e, "java_exception", None)
        return cause.toString() if cause is not None else str(e)
    return None


def wrap_root(content: str, tag: str = "root") -> str:
    """Put the content inside one element."""
    return concat(lit(f"<{tag}>"), content, lit(f"</{tag}>"))


# The namespaces of SOAP envelopes.
SOAP_NS = "http://schemas.xmlsoap.org/soap/envelope/"
SOAP_12_NS = "http://www.w3.org/2003/05/soap-envelope"


def soap_envelope(content: str) -> str:
    """Put the content inside the body of a SOAP envelope."""
    head = f'<soapenv:Envelope xmlns:soapenv="{SOAP_NS}"><soapenv:Body>'
    return concat(lit(head), content, lit("</soapenv:Body></soapenv:Envelope>"))


# The words of an envelope, as XPath steps whatever their prefix.
_ENVELOPE, _BODY = (f"*[name()='{n}' or substring-after(name(), ':')='{n}']" for n in ("Envelope", "Body"))
# A plain envelope, for which the cut is right without a look at the parsed document: its own prefix is all that is
# declared, and inside is plain without a colon. Groups: the prefix, what is inside.
PLAIN_ENVELOPE = (
    r"\A<((?!(?i:xml))[A-Za-z_][A-Za-z0-9_.-]{0,99}+):Envelope xmlns:\1=\x22(?:"
    rf"{'|'.join(ns.replace('.', '[.]') for ns in (SOAP_NS, SOAP_12_NS))})\x22>[\x20\t\n]{{0,20}}+<\1:Body>"
    rf"({plain_inside()[1]})</\1:Body>[\x20\t\n]{{0,20}}+</\1:Envelope>[\x20\t\n]{{0,20}}+\z"
)


def remove_envelope(spark: SparkSession, content: str) -> str:
    """Body of a SOAP envelope, empty if the body is; content whose root is none stays as it is.

    Namespaces that the body uses and the envelope or the body declares move to
    the body's first element. The text is cut by its form and the cut is held
    against the parsed document: null if elements, names or text differ. Content
    has to be well-formed. A plain envelope is not parsed.
    """
    gap = r"(?:\s|<!--(?s:.*?)-->){0,20}"
    prolog = r"^(?:\s|<!--(?s:.*?)-->|<\?(?s:.*?)\?>){0,20}"
    quoted = r"(?:\x22[^\x22]*\x22|\x27[^\x27]*\x27)"
    tag = lambda n: rf"(<(?:[\w.-]+:)?{n}\b[^>\x22\x27]*(?:{quoted}[^>\x22\x27]*){{0,60}}>)"
    header = r"(?:<(?:[\w.-]+:)?Header\b[^>]*/>|<((?:[\w.-]+:)?Header)\b[^>]*>(?s:.*?)</\2\s*>)?"
    end = rf"</(?:[\w.-]+:)?Envelope\s*>{prolog[1:]}$"
    # Groups: the envelope's tag, the name of the header, the body's tag, what is inside.
    whole = rf"{prolog}{tag('Envelope')}{gap}{header}{gap}{tag('Body')}(?:(?<=/>)|((?s:.*))</(?:[\w.-]+:)?Body\s*>){gap}{end}"
    part = lambda n: f"regexp_extract(c, {lit(whole)}, {n})"
    declared = r"(xmlns(?::[\w.-]+)?\s*=\s*(?:\x22[^\x22]*\x22|\x27[^\x27]*\x27))"
    of = lambda n: f"regexp_extract_all({part(n)}, {lit(declared)}, 1)"
    name = "trim(substring_index({}, '=', 1))".format
    # The body's own declarations come first and hide those of the envelope.
    listed = f"concat({of(3)}, {of(1)})"
    hidden = f"filter({listed}, (d, i) -> not exists(slice({listed}, 1, i), e -> {name('e')} = {name('d')}))"
    first = f"regexp_extract(b, {lit(rf'^{gap}<[^!?>][^>]*')}, 0)"
    soap = " or ".join(f"contains(d, {lit(ns)})" for ns in (SOAP_NS, SOAP_12_NS))
    used = case([
        (f"contains({first}, concat({name('d')}, '=')) or contains({first}, concat({name('d')}, ' '))", "false"),
        (f"{name('d')} = 'xmlns'", f"not ({soap})"),
    ], f"contains(b, concat(substring({name('d')}, 7), ':'))")
    names = f"array_join(transform(filter({hidden}, d -> {used}), d -> concat(' ', d)), '')"
    inner = f"trim({part(4)})"
    tagged = f"transform(array({inner}), b -> regexp_replace(b, {lit(rf'^({gap}<[^\s/>!?]+)')}, concat({lit('$1')}, {names})))[0]"
    body = f"/*/{_BODY}"  # the root is looked at below
    figures = lambda at: f"concat(count({at}//*), '|', count({at}/*), '|', name({at}/*[1]), '|', normalize-space({at}))"
    wrapped = "concat('<w>', b, '</w>')"
    parsed = f"xpath_string(c, {lit(f"concat(count({body}), '|', {figures(body)})")})"
    cut = f"xpath_string({wrapped}, {lit(f"concat('1|', {figures('/w')})")})"
    fits = f"{part(1)} <> '' and {well_formed(spark, wrapped)}"
    checked = f"transform(array({tagged}), b -> case when {fits} then case when {cut} = {parsed} then b end end)[0]"
    known = lambda c: " or ".join(f"contains({c}, {lit(ns)})" for ns in (SOAP_NS, SOAP_12_NS))
    # The parser names the root; a namespace that stands elsewhere makes no envelope.
    named = f"({known('c')}) and xpath_boolean(c, {lit(f'/{_ENVELOPE}')}) and ({part(1)} = '' or {known(part(1))})"
    other = f"transform(array({content}), c -> case when {named} then {checked} else c end)[0]"
    plain = lit(PLAIN_ENVELOPE)
    return f"case when {content} rlike {plain} then trim(regexp_extract({content}, {plain}, 2)) else {other} end"


def decoded(binary: str, charset: str = "UTF-8") -> str:
    """Bytes as text in a named charset."""
    return f"decode({binary}, {lit(charset)})"


def filled(value: str) -> str:
    """Null for an empty text."""
    return f"nullif({value}, '')"
