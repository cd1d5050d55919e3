"""Steps as data: their templates travel with the pipelines, so a plan does not grow with the registry.

A step whose parameters are plain templates needs no expression of its own. It
becomes a struct of literal and attribute parts, and one set of expressions runs
the steps of all pipelines. Only XPaths, ``sql:`` templates, replacements and
transforms are compiled, for Spark wants those as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.render import PLACEHOLDER, SQL_PREFIX, case, lit, lits
from waybill.operators.steps import (
    STEPS, duplicate, not_a_number, route_on_attribute, route_on_content, sync_response, update_attribute, whole_number,
)
from waybill.plans.context import Slots, merged
from waybill.sources.messages import EMPTY_MAP
from waybill.sources.registry import split_step, steps

_PLAIN = {
    "UpdateAttribute": update_attribute, "RouteOnAttribute": route_on_attribute, "RouteOnContent": route_on_content,
    "DuplicateFlowFile": duplicate, "SyncResponse": sync_response,
}
_NEEDED = {
    "RouteOnAttribute": ("RoutingStrategy", "Condition"), "RouteOnContent": ("MatchRequirement", "RouteCondition"),
    "DuplicateFlowFile": ("Number",),
}
_PARTS = "array<struct<text:string,attr:string>>"
_TOKENS = rf"{PLACEHOLDER.pattern}|[^$]+|\$"


def _named(raw: str) -> str:
    """The attribute a placeholder names."""
    return rf"regexp_replace(regexp_replace({raw}, {lit(r'^\s+|\s+$')}, ''), {lit('^[\'\"]+|[\'\"]+$')}, '')"


def parts(template: str) -> str:
    """A template as an array of literal and attribute parts."""
    tokens = f"regexp_extract_all({template}, {lit(_TOKENS)}, 0)"
    held = f"t rlike {lit('^' + PLACEHOLDER.pattern)}"
    name = _named("substring(t, 3, length(t) - 3)")
    return f"transform({tokens}, t -> named_struct('text', case when not ({held}) then t end, 'attr', case when {held} then {name} end))"


def _last(of: str, key: str) -> str:
    """The value of a parameter; of a repeated one the last."""
    return f"try_element_at(filter({of}entries, x -> x.key = {key}), -1).value"


def is_plain(of: str = "") -> str:
    """Whether the step in the fields ``name`` and ``entries`` can run as data; one with an error is left to the compiler."""
    names = [n for n, fn in _PLAIN.items() if STEPS.get(n) is fn]
    bad_name = f"{_named('r')} = '' or {_named('r')} rlike '[:()]'"
    odd = f"startswith(e.value, '{SQL_PREFIX}') or exists(regexp_extract_all(e.value, {lit(PLACEHOLDER.pattern)}, 1), r -> {bad_name})"
    templates = [f"{of}name = {lit(n)} and not exists({of}entries, e -> {odd})" + "".join(
        f" and coalesce({_last(of, lit(k))}, '') <> ''" for k in _NEEDED.get(n, ())) for n in names]
    handed_off = f"{of}name not in ({lits(STEPS)})"
    return f"(not exists({of}entries, e -> e.value is null) and ({' or '.join([handed_off, *templates])}))"


def _operation(of: str, sid: str) -> str:
    """A step as a struct of what it does; a compiled one is its number alone."""
    none = "cast(null as {})".format
    once = f"filter({of}entries, (e, i) -> not exists(slice({of}entries, 1, i), b -> b.key = e.key))"

    def put(key: str, held: str) -> str:
        return f"named_struct('key', {key}, 'parts', {held})"

    def fixed(value: str) -> str:
        return f"array(named_struct('text', {value}, 'attr', {none('string')}))"

    group = put("'xform.group'", fixed(f"{of}name"))
    result = f"case when exists({of}entries, e -> e.key = 'Result') then {parts(_last(of, lit('Result')))} end"
    parked = ", ".join([
        put(lit("content.match.strategy"), fixed(_last(of, lit("MatchRequirement")))),
        put(lit("route.on.content.condition"), parts(_last(of, lit("RouteCondition")))),
        put(lit("route.on.content.result"), result), group,
    ])
    many = f"array<struct<key:string,parts:{_PARTS}>>"
    sets = case([
        (f"{of}name = 'UpdateAttribute'", f"transform({once}, e -> {put('e.key', parts(_last(of, 'e.key')))})"),
        (f"{of}name = 'RouteOnContent'", f"array({parked})"),
        (f"{of}name in ('RouteOnAttribute', 'DuplicateFlowFile', 'SyncResponse')", f"cast(array() as {many})"),
    ], f"concat(transform({once}, e -> {put('e.key', fixed(_last(of, 'e.key')))}), array({group}))")

    def only(name: str, parameter: str) -> str:
        return f"case when {of}name = {lit(name)} then {parts(_last(of, lit(parameter)))} end"

    plain = (
        f"named_struct('sid', {none('int')}, 'name', {of}name, 'sets', {sets}, 'keep', {only('RouteOnAttribute', 'Condition')},"
        f" 'copies', {only('DuplicateFlowFile', 'Number')}, 'park', {of}name = 'RouteOnContent', 'reply', {of}name = 'SyncResponse')"
    )
    compiled = (
        f"named_struct('sid', {sid}, 'name', {of}name, 'sets', {none(many)}, 'keep', {none(_PARTS)}, 'copies', {none(_PARTS)},"
        " 'park', false, 'reply', false)"
    )
    return case([(is_plain(of), plain)], compiled)


def step_texts(parsed: DataFrame) -> DataFrame:
    """Every step of every path: ``stage``, ``text``, ``name``, ``entries``."""
    name, entries = split_step("text")
    texts = steps(parsed).selectExpr("stage", "coalesce(step, '') as text")
    return texts.selectExpr("stage", "text", f"{name} as name", f"{entries} as entries")


def with_operations(df: DataFrame, ids: dict[str, int]) -> DataFrame:
    """Pipelines with their steps as ``ops``; ``ids`` numbers the texts of the compiled ones."""
    table = f"map_from_arrays(cast(array({lits(ids)}) as array<string>), cast(array({lits(ids.values())}) as array<int>))"
    name, entries = split_step("s")
    fields = f"transform(transform(p.steps, s -> coalesce(s, '')), s -> named_struct('text', s, 'name', {name}, 'entries', {entries}))"
    kept = ", ".join(
        f"'{f}', p.{f}" for f in ("kind", "tpos", "target_id", "path", "urls", "output", "response", "input", "sync", "root")
    )
    done = f"named_struct({kept}, 'ops', transform({fields}, y -> {_operation('y.', f'{table}[y.text]')}))"
    return df.selectExpr("process", "validate", "sync", "restrict", "bad", f"transform(pipelines, p -> {done}) as pipelines")


@dataclass
class Outline:
    """What the plan has to know of the steps that are data."""

    stages: int
    copying: set[int]
    replying: set[int]
    audited: set[str]


def outline(parsed: DataFrame, audited: Sequence[str]) -> Outline:
    """How many stages there are, which of them copy or reply, and which of the ``audited`` keys are written: a row per stage."""
    plain = step_texts(parsed).withColumn("plain", F.expr(is_plain()))
    keys = f"filter(transform(entries, e -> e.key), k -> k in ({lits(audited)}))"
    rows = plain.groupBy("stage").agg(
        F.expr("max(plain and name = 'DuplicateFlowFile')").alias("copies"),
        F.expr("max(plain and name = 'SyncResponse')").alias("replies"),
        F.expr(f"array_distinct(flatten(collect_set(case when plain then {keys} end)))").alias("keys"),
    ).collect()
    return Outline(
        max((r["stage"] + 1 for r in rows), default=0), {r["stage"] for r in rows if r["copies"]},
        {r["stage"] for r in rows if r["replies"]}, {k for r in rows for k in r["keys"]})


def _rendered(held: str, written: str | None = None) -> str:
    """The text of an array of parts: what this step wrote, then slots (``env``), ``extra`` and the message's own attributes."""
    sources = [*([written] if written else []), "env", "extra"]
    value = case([(f"map_contains_key({m}, t.attr)", f"{m}[t.attr]") for m in sources], "attrs[t.attr]")
    return f"array_join(transform({held}, t -> case when t.attr is null then t.text else coalesce({value}, '') end), '')"


#: The fields of a step, which a stage reads as columns of their own.
FIELDS = ("sid", "name", "sets", "keep", "copies", "park", "reply")


def stage_columns(slots: Slots, legacy_last_filter: bool) -> list[dict[str, str]]:
    """Column changes, projection by projection, that run the data step of each row, given field by field."""
    env = ", ".join(f"{lit(k)}, cast({c} as string)" for k, c in slots.names.items())
    put = f"map_concat(map_filter(w, (k, v) -> k <> e.key), map(e.key, case when e.parts is not null then {_rendered('e.parts', 'w')} end))"
    number = whole_number("copy_text")
    dropped = "keep_text = 'false'" + (" and at_stage < n - 1" if legacy_last_filter else "")
    columns = {
        slot: f"case when map_contains_key(w, {lit(key)}) then w[{lit(key)}] else {slot} end" for key, slot in slots.names.items()
    }
    changed = {
        "w": f"case when size(o_sets) > 0 then aggregate(o_sets, {EMPTY_MAP}, (w, e) -> {put}) end",
        "keep_text": f"case when o_keep is not null then {_rendered('o_keep')} end",
        "copy_text": f"case when o_copies is not null then {_rendered('o_copies')} end",
    }
    applied = {
        **columns,
        "extra": merged("extra", f"map_filter(w, (k, v) -> k not in ({lits(slots.names)}))"),
        "alive": f"case when o_keep is not null then not coalesce({dropped}, false) else alive end",
        "parked": "case when o_park then at_stage else parked end",
        "error": f"case when o_copies is not null and {number} is null then {not_a_number('copy_text')} else error end",
        "d_copies": f"case when o_copies is not null then greatest({number}, 0) end",
    }
    if "copy.index" in slots.names:
        index = slots.names["copy.index"]
        return [{"env": f"map({env})"}, changed, applied, {index: f"case when o_copies is not null and error is null then '0' else {index} end"}]
    return [{"env": f"map({env})"}, changed, applied]
