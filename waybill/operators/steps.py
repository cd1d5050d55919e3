"""The steps a transformation path can name.

Each is a function of a :class:`~waybill.plans.context.StepContext`. A name
without a function is a hand-off. ``register_step`` adds one.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.patterns import runs_deep
from waybill.functions.render import concat, is_fixed, lit
from waybill.functions.text import literal_replacement, pattern_problem, remove_envelope, replace_text
from waybill.functions.xmlfn import shaped_xml
from waybill.functions.xpath import field_scalar, field_values, fits_a_pack, pack_paths, xpath_fields, xpath_problem, xpath_scalar
from waybill.plans.context import StepContext, StepError, merged

StepFunction = Callable[[StepContext], None]
STEPS: dict[str, StepFunction] = {}


def register_step(name: str, fn: StepFunction | None = None):
    """Add a step under a name, directly or as a decorator."""

    def add(f: StepFunction) -> StepFunction:
        STEPS[name] = f
        return f

    return add(fn) if fn else add


def hand_off(ctx: StepContext) -> None:
    """Any other name: parameters are stored as written and the path goes on."""
    for key, value in ctx.params.items():
        ctx.set(key, lit(value))
    ctx.set("xform.group", lit(ctx.step.name))


@register_step("SyncResponse")
def sync_response(ctx: StepContext) -> None:
    ctx.reply()


@register_step("UpdateAttribute")
def update_attribute(ctx: StepContext) -> None:
    for key, template in ctx.params.items():
        ctx.set(key, ctx.render(template))


@register_step("RouteOnAttribute")
def route_on_attribute(ctx: StepContext) -> None:
    ctx.required("RoutingStrategy")
    dropped = f"{ctx.render(ctx.required('Condition'))} = 'false'"
    if ctx.settings.legacy_last_filter:
        dropped = f"({dropped} and at_stage < n - 1)"
    ctx.drop_when(dropped)


@register_step("RouteOnContent")
def route_on_content(ctx: StepContext) -> None:
    ctx.set("content.match.strategy", lit(ctx.required("MatchRequirement")))
    ctx.set("route.on.content.condition", ctx.render(ctx.required("RouteCondition")))
    result = ctx.params.get("Result")
    ctx.set("route.on.content.result", lit(None) if result is None else ctx.render(result))
    ctx.set("xform.group", lit("RouteOnContent"))
    ctx.park()


@register_step("ReplaceText")
def replace_step(ctx: StepContext) -> None:
    strategy = ctx.required("ReplacementStrategy")
    ctx.set("replace.text.mode", lit(strategy))
    search = ctx.required("SearchValue")
    ctx.set("replace.text.search.value", ctx.render(search))
    replacement = ctx.required("ReplacementValue")
    ctx.set("replace.text.replacement.value", ctx.render(replacement))
    if strategy != "RegexReplace":
        raise StepError("java.lang.Exception: Incorrect replace strategy")
    pattern, text = ctx.render(search), ctx.render(replacement)
    if is_fixed(search):
        problem = pattern_problem(ctx.spark, search)
        if problem:
            raise StepError(problem)
    # A compiled pattern serves where it can't end the task; any other runs by a guarded call.
    safe = is_fixed(search) and not runs_deep(search)
    if safe and is_fixed(replacement) and not pattern_problem(ctx.spark, search, replacement):
        ctx.set_content(f"regexp_replace({ctx.content}, {pattern}, {literal_replacement(text)})")
        return
    replaced = replace_text(ctx.content, pattern, text)
    if safe:
        # Text without a reference cannot fail, so the compiled pattern serves.
        plain = f"not {text} rlike {lit(r'[$\\]')}"
        replaced = f"case when {plain} then regexp_replace({ctx.content}, {pattern}, {text}) else {replaced} end"
    result = ctx.stash(replaced)
    ctx.fail_when(f"{ctx.content} is not null and {result} is null", lit("ReplaceText: illegal pattern or group reference, or a text too long for the pattern"))
    ctx.set_content(result)


@register_step("EvaluateXQuery")
def evaluate_xpath(ctx: StepContext) -> None:
    destination = ctx.params.pop("Destination", None)
    if destination != "flowfile-attribute":
        raise StepError(f"java.lang.IllegalArgumentException: {ctx.step.name} {destination or 'null'}")
    ctx.require_xml()
    paths = {key: value.replace("\\\\", "\\") for key, value in ctx.params.items()}
    counts = {path for path in paths.values() if "count(" in path}
    for path in paths.values():
        problem = xpath_problem(ctx.spark, path, nodes=path not in counts)
        if problem:
            raise StepError(problem)
    together = {key: path for key, path in paths.items() if path not in counts or fits_a_pack(path)}
    places = dict(zip(together, pack_paths(list(together.values()), scalars=counts)))
    packs = [list(group) for _, group in groupby(places.values(), key=lambda p: p.pack)]
    fields = [ctx.stash(xpath_fields(ctx.content, pack)) for pack in packs]
    values = {
        key: ctx.stash(field_values(fields[at.pack], ctx.content, at)) for key, at in places.items() if at.nodes is not None
    }
    for key, path in paths.items():
        if key not in values:
            ctx.set(key, field_scalar(fields[places[key].pack], places[key]) if key in places else xpath_scalar(ctx.content, path))
            continue
        found = values[key]
        for name in list(ctx.slots.names):
            # A numbered attribute that another step writes has a column of its own.
            stem, _, number = name.rpartition(".")
            if stem == key and re.fullmatch("[1-9][0-9]*", number):
                ctx.set(name, f"case when size({found}) > 1 and size({found}) >= {number} then get({found}, {number} - 1) else {ctx.attr(name)} end")
        ctx.set(key, f"case when size({found}) = 1 then {found}[0] else {ctx.attr(key)} end")
        names = f"transform({found}, (v, i) -> concat({lit(f'{key}.')}, i + 1))"
        numbered = ctx.stash(f"case when size({found}) > 1 then map_from_arrays({names}, {found}) end")
        ctx.set_extra(merged("extra", numbered))
        ctx.flush()


@register_step("ApplyXslt")
def apply_transform(ctx: StepContext) -> None:
    name = ctx.required("Name")
    shape = ctx.reshapes.get(name)
    if shape is None and name != "RemoveEnvelope.xsl":
        raise StepError(f"java.io.IOException: XSLT with the name {name} not found")
    ctx.require_xml()
    if shape is None:
        body = ctx.stash(remove_envelope(ctx.spark, ctx.content))
        ctx.fail_when(f"{body} is null", lit("javax.xml.transform.TransformerException: the envelope has no form that can be taken off"))
        ctx.set_content(body)
        return
    ctx.shaped(shape, "doc")
    doc = ctx.stash(f"from_xml({ctx.content}, {lit(shape.input_ddl)})")
    ctx.set_content(ctx.shaped(shape, doc))


def reshape(df: DataFrame, input_ddl: str, expr: str, root_tag: str) -> DataFrame:
    """Rewrite well-formed content: read it as ``doc`` by a DDL, map it, write it."""
    parsed = df.withColumn("doc", F.expr(f"from_xml(content, {lit(input_ddl)})"))
    return parsed.withColumn("content", F.expr(shaped_xml(expr, "doc", root_tag))).drop("doc")


@register_step("DuplicateFlowFile")
def duplicate(ctx: StepContext) -> None:
    text = ctx.stash(ctx.render(ctx.required("Number")))
    number = whole_number(text)
    ctx.fail_when(f"{number} is null", f"coalesce({not_a_number(text)}, 'java.lang.NumberFormatException: null')")
    ctx.set("copy.index", lit("0"))
    ctx.copies(f"greatest({number}, 0)")


def whole_number(text: str) -> str:
    """Integer of a text as Java reads it; null if it is none."""
    return f"case when {text} rlike {lit(r'^[+-]?[0-9]+\z')} then try_cast({text} as int) end"


def not_a_number(text: str) -> str:
    return concat(lit('java.lang.NumberFormatException: For input string: "'), text, lit('"'))
