"""Attribute templates as Spark SQL text, made while the plan is built.

Everything in ``functions`` takes and returns SQL expression text, for use in
``F.expr`` and ``selectExpr``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import Protocol

PLACEHOLDER = re.compile(r"\$\{([^}]*)\}")
_QUOTED = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`)""", re.DOTALL)
SQL_PREFIX = "sql:"


class TemplateError(ValueError):
    """The template uses something that has no column form."""


class Scope(Protocol):
    """Where a template finds its values, as SQL text."""

    def attr(self, name: str) -> str: ...

    def attr_column(self, name: str) -> str: ...

    def attrs(self) -> str: ...


class MapScope:
    """Attributes straight from the ``attrs`` map column."""

    def attr(self, name: str) -> str:
        return f"attrs[{lit(name)}]"

    attr_column = attr

    def attrs(self) -> str:
        return "attrs"


def lit(value: str | int | bool | None, kind: str = "string") -> str:
    """A Python value as a SQL literal; ``$`` is masked from variable substitution."""
    if value is None:
        return f"cast(null as {kind})"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    text = value.replace("\\", "\\\\").replace("'", "\\'").replace("$", "\\u0024")
    return f"'{text}'"


def lits(values: Iterable[str | int]) -> str:
    return ", ".join(map(lit, values))


def case(cases: Iterable[tuple[str, str]], default: str = "null") -> str:
    """``CASE`` over (condition, value) pairs; the default alone if there are none."""
    whens = " ".join(f"when {on} then {value}" for on, value in cases)
    return f"case {whens} else {default} end" if whens else default


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def is_fixed(template: str) -> bool:
    return not template.startswith(SQL_PREFIX) and not PLACEHOLDER.search(template)


def _name(raw: str) -> str:
    name = raw.strip().strip("'\"")
    if not name or re.search(r"[:()]", name):
        raise TemplateError(f"expression functions are not supported: ${{{raw}}}")
    return name


def _bound(body: str, scope: Scope) -> str:
    """A SQL expression with its names bound; quoted text stays as it is. A cast that fails gives null."""
    pieces = _QUOTED.split(body)
    if any(PLACEHOLDER.search(q) for q in pieces[1::2]):
        raise TemplateError("a placeholder inside quotes")
    plain = pieces[::2]
    if any(re.search(r"\battrs\b", p) for p in plain):
        whole = scope.attrs()
        plain = [re.sub(r"\battrs\b", lambda _: whole, p) for p in plain]
    plain = [re.sub(r"\bcast(\s*\()", r"try_cast\1", PLACEHOLDER.sub(lambda m: scope.attr_column(_name(m.group(1))), p), flags=re.I)
             for p in plain]
    pieces[::2] = plain
    return "".join(pieces)


class Nothing:
    """A scope of nulls, to look at a template alone."""

    def attr(self, name: str) -> str:
        return "cast(null as string)"

    attr_column = attr

    def attrs(self) -> str:
        return "cast(null as map<string,string>)"


def render(template: str, scope: Scope | None = None) -> str:
    """``${name}`` becomes the attribute (empty if absent).

    A template that starts with ``sql:`` is a Spark SQL expression. In it
    ``${name}`` is the attribute as a column (null if absent), ``attrs`` the
    whole map and ``content`` the text.
    """
    scope = scope or MapScope()
    if template.startswith(SQL_PREFIX):
        return f"cast(({_bound(template[len(SQL_PREFIX):], scope)}) as string)"
    parts: list[str] = []
    at = 0
    for m in PLACEHOLDER.finditer(template):
        if m.start() > at:
            parts.append(lit(template[at:m.start()]))
        parts.append(f"coalesce({scope.attr(_name(m.group(1)))}, '')")
        at = m.end()
    if at < len(template) or not parts:
        parts.append(lit(template[at:]))
    return parts[0] if len(parts) == 1 else concat(*parts)
