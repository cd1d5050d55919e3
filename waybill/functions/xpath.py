"""XPath values relative to the root element, one document parse per step.

Spark evaluates XPath from the document and wants the path as a literal, so
relative paths are prefixed while planning. All the values a step asks for come
back from a single ``xpath_string`` call as one separated text.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import SparkSession

from waybill.functions.render import case, lit


# Not allowed in any XML document, so it cannot occur in a value.
SEPARATOR = "\ufffe"
# Values read along with the count of each path; more are read in rounds.
NODE_COUNT = 4
# The Java XPath compiler refuses an expression with more than 100 operators.
OPERATOR_LIMIT = 95
# Operators that a round adds to each copy of a path.
_ROUND_COST = 8

_TOKEN = re.compile(
    r"""\s*(?:(?P<text>"[^"]*"|'[^']*')|(?P<num>\d+(?:\.\d*)?|\.\d+)
    |(?P<axis>[\w.-]+\s*::)|(?P<name>\w[\w.-]*(?::[\w*][\w.-]*)?)
    |(?P<op>//|\.\.|!=|<=|>=|[/@.*()\[\]|+=<>,$-]))""",
    re.X,
)
_NODE_TESTS = {"text", "node", "comment", "processing-instruction"}
_ON_CONTEXT = {"name", "local-name", "namespace-uri", "string", "normalize-space", "string-length", "number"}
_WORD_OPERATORS = {"and", "or", "div", "mod"}


def _tokens(path: str) -> list[tuple[str, str]]:
    found, at = [], 0
    path = path.rstrip()
    while at < len(path):
        m = _TOKEN.match(path, at)
        if not m:
            raise ValueError(f"cannot read XPath {path}")
        found.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    return found


def from_root(path: str, root: str = "/*") -> str:
    """Prefix the relative paths outside predicates with ``root``."""
    tokens = [*_tokens(path), ("end", "")]
    out: list[str] = []
    depth = 0
    before = "open"  # what stands before: an opener, a step separator or a value
    for i in range(len(tokens) - 1):
        kind, tok = tokens[i]
        following = tokens[i + 1][1]
        word = kind == "name" and tok in _WORD_OPERATORS
        if before == "value" and (word or tok == "*"):
            out.append(tok)
            before = "open"
            continue
        if kind == "gone":
            continue
        prefix = suffix = ""
        call = kind == "name" and following == "(" and tok not in _NODE_TESTS
        if tok == "$" or (call and tok == "lang"):
            raise ValueError(f"{tok} has no form relative to the root element")
        if before == "open" and tok == "/" and (following in _AFTER_PATH or following in _WORD_OPERATORS):
            kind = "value"
        elif before == "open" and depth == 0 and tok not in ("/", "//"):
            if call and tok in _ON_CONTEXT and tokens[i + 2][1] == ")":
                suffix = f" ( {root} )"
                tokens[i + 1] = tokens[i + 2] = ("gone", "")
            elif (kind in ("axis", "name") and not call) or tok in ("@", ".", "..", "*"):
                prefix = f"{root}/"
        out.append(prefix + tok + suffix)
        depth += (tok == "[") - (tok == "]")
        if kind == "axis" or (kind == "op" and tok in ("/", "//", "@")):
            before = "step"
        elif kind == "op" and tok not in (")", "]", ".", "..", "*"):
            before = "open"
        else:
            before = "value"
    return " ".join(out)


_AFTER_PATH = {"", ")", "]", ",", "|", "=", "!=", "<", ">", "<=", ">=", "+", "-"}


def xpath_problem(spark: SparkSession, path: str, nodes: bool) -> str | None:
    """Try a path once, on the driver, against an empty document."""
    try:
        rooted = from_root(path)
        if nodes and _operators(rooted) + _ROUND_COST > OPERATOR_LIMIT:
            raise ValueError("too many operators")
        jvm = spark._jvm
        source = jvm.org.xml.sax.InputSource(jvm.java.io.StringReader("<x/>"))
        engine = jvm.javax.xml.xpath.XPathFactory.newInstance().newXPath()
        engine.evaluate(f"count({rooted})" if nodes else rooted, source)
    except ValueError as e:
        return f"Incorrect XPath {path}: {e}"
    except Exception:  # noqa: BLE001 - any Java exception is the finding
        return f"javax.xml.xpath.XPathExpressionException: {path}"
    return None


def xpath_scalar(content: str, path: str) -> str:
    """Text result of an expression relative to the root element."""
    return f"xpath_string({content}, {lit(from_root(path))})"


def _operators(path: str) -> int:
    """Upper bound of what the XPath compiler counts as operators; signs inside names and texts are none."""
    signs = {"op": lambda t: sum(c in "/*+=|-<>![(@." for c in t), "axis": lambda t: 2, "name": lambda t: t.count(":") + (t in _WORD_OPERATORS)}
    return sum(signs[kind](token) for kind, token in _tokens(path) if kind in signs)


@dataclass(frozen=True)
class PackedPath:
    """Where the values of one path stand in a pack; ``nodes`` is None for a scalar."""

    path: str
    pack: int
    offset: int
    nodes: int | None


def pack_paths(paths: list[str], nodes: int = NODE_COUNT, scalars: Collection[str] = ()) -> list[PackedPath]:
    """Spread paths over as few packs (parses) as the operator limit allows.

    Reading fewer values at first is worth it when that saves a parse.
    """
    tries = [_pack(paths, n, scalars) for n in range(nodes, 0, -1)] or [_pack(paths, nodes, scalars)]
    return min(tries, key=lambda places: max((p.pack for p in places), default=0))


def _pack(paths: list[str], nodes: int, scalars: Collection[str]) -> list[PackedPath]:
    packed: list[PackedPath] = []
    pack, used, offset = 0, 0, 0
    for path in paths:
        each = _operators(from_root(path)) + 2
        own = None if path in scalars else max(0, min(nodes, OPERATOR_LIMIT // each - 1))
        fields = 1 + (own or 0)
        if used and used + each * fields > OPERATOR_LIMIT:
            pack, used, offset = pack + 1, 0, 0
        packed.append(PackedPath(path, pack, offset, own))
        used, offset = used + each * fields, offset + fields
    return packed


def fits_a_pack(path: str) -> bool:
    return _operators(from_root(path)) + 2 <= OPERATOR_LIMIT


def xpath_fields(content: str, paths: list[PackedPath]) -> str:
    """Scalars, node counts and first values of the paths of one pack, as an array from one parse."""
    parts = ["''"]
    for p in paths:
        rooted = from_root(p.path)
        if p.nodes is None:
            parts.append(rooted)
            continue
        parts.append(f"count({rooted})")
        parts.extend(f"({rooted})[{i}]" for i in range(1, p.nodes + 1))
    expr = "concat(" + f",'{SEPARATOR}',".join(parts) + ")"
    return f"split(xpath_string({content}, {lit(expr)}), {lit(SEPARATOR)}, -1)"


def field_scalar(fields: str, at: PackedPath) -> str:
    """The text of a packed scalar."""
    return f"{fields}[{at.offset + 1}]"


def field_values(fields: str, content: str, at: PackedPath) -> str:
    """Values of a path as an array, without a limit.

    Past the packed ones, elements that do not contain each other are read with
    all their text in one more pass; whatever else there is, in rounds.
    """
    found = f"cast({fields}[{at.offset + 1}] as int)"
    first = f"slice({fields}, {at.offset + 3}, least({found}, {at.nodes}))"
    cases = [(f"{found} <= {at.nodes}", first)]
    rooted = from_root(at.path)
    apart = (
        f"count(({rooted}) | ({rooted})//*) = count({rooted}) + count(({rooted})//*)"
        f" and count({rooted}) = count(({rooted})[self::*])"
    )
    if _operators(apart) <= OPERATOR_LIMIT:
        # A null stands for each element, before its text nodes.
        texts = f"xpath({content}, {lit(f'({rooted}) | ({rooted})//text()')})"
        split = f"split(array_join({texts}, '', {lit(SEPARATOR)}), {lit(SEPARATOR)}, -1)"
        # A CDATA section is a text node of its own that only counts as part of its neighbour.
        plain = f"not contains({content}, '<![CDATA[') and xpath_boolean({content}, {lit(apart)})"
        cases.append((plain, f"slice({split}, 2, {found})"))
    return case(cases, f"concat({first}, {_rounds(content, at, found)})")


# Holds the first position of a round, in front of the document.
_POSITION = "waybill-position"


def _rounds(content: str, at: PackedPath, found: str) -> str:
    """A few values per parse: the path has to stay a literal, so the document carries the position."""
    rooted = from_root(at.path)
    start = f"/processing-instruction('{_POSITION}')"
    per_round = max(1, OPERATOR_LIMIT // (_operators(rooted) + _ROUND_COST))
    picks = f",'{SEPARATOR}',".join(["''", *[f"({rooted})[{start}+{i}]" for i in range(1, per_round + 1)]])
    marked = f"concat('<?{_POSITION} ', i, '?>', {strip_declaration(content)})"
    values = f"split(xpath_string({marked}, {lit(f'concat({picks})')}), {lit(SEPARATOR)}, -1)"
    one_round = f"slice({values}, 2, least({found} - i, {per_round}))"
    return f"flatten(transform(sequence({at.nodes}, {found} - 1, {per_round}), i -> {one_round}))"


# Fixed value: an XML 1.0 declaration at the very start of a document.
DECLARATION = (
    r"""^<\?xml\s+version\s*=\s*(?:"1\.0"|'1\.0')"""
    r"""(?:\s+encoding\s*=\s*(?:"[A-Za-z][A-Za-z0-9._-]*"|'[A-Za-z][A-Za-z0-9._-]*'))?"""
    r"""(?:\s+standalone\s*=\s*(?:"(?:yes|no)"|'(?:yes|no)'))?\s*\?>"""
)


def strip_declaration(content: str) -> str:
    return f"regexp_replace({content}, {lit(DECLARATION)}, '')"

