"""The routing plan: lookup, validation, fan-out, stages, finish.

A message never leaves its row's task: the route registry is joined by
broadcast (salted shuffle beyond a measured size), fan-out is one explode, and
each stage is a projection over the rows of all pipelines at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waybill.functions.render import case, concat, lit, lits
from waybill.functions.text import soap_envelope
from waybill.functions.xmlfn import compact_json, ordered_json, well_formed
from waybill.functions.xpath import strip_declaration
from waybill.operators.audit import EVENT, ROW_LINEAGE, audit_keys, audit_rows
from waybill.operators.lineage import lineage_rows
from waybill.operators.lookup import not_found
from waybill.operators.restrict import restricted
from waybill.operators.steps import not_a_number, whole_number
from waybill.plans.compile import Registry, compile_steps, named_reshapes, plan_registries, schema_checks
from waybill.plans.context import Settings, Slots, StepContext
from waybill.plans.datasteps import FIELDS, Outline, stage_columns, with_operations
from waybill.session import checkpointed, lookup_join, measured_bytes, spread, written
from waybill.sources.messages import EMPTY_MAP, as_messages
from waybill.sources.registry import parse_routes, pipelines

# Copies of a row that one array numbers.
COPY_BLOCK = 10_000

_STATE = [
    "msg_id", "attrs", "content", "p", "n", "start", "sync", "missed", "first",
    "error", "alive", "parked", "reply", "copy", "wf", "events",
]
_SUPPRESSED = "not alive and not reply and error is null"


def route_messages(
    messages: DataFrame,
    routes: DataFrame,
    schemas: DataFrame,
    reshapes: DataFrame | None = None,
    settings: Settings | None = None,
) -> RouteRun:
    """Plan the first pass and the resume pass over one message table."""
    settings = settings or Settings()
    parsed = parse_routes(routes)
    work = spread(as_messages(messages)).selectExpr("*", "attrs['business.process.name'] as process")
    waves = []
    for picked, found in plan_registries(parsed, schemas, settings):
        mine, own = (work, parsed) if picked is None else (work.where(picked), parsed.where(picked))
        waves.append(_wave(mine, own, found, reshapes, settings))
    return RouteRun(waves, settings)


@dataclass
class Wave:
    """Rows after the last stage, with the attribute slots they carry."""

    df: DataFrame
    slots: Slots
    snapshot: list[str]


class RouteRun:
    """The tables one run yields; each is an ordinary lazy DataFrame."""

    def __init__(self, waves: list[Wave], settings: Settings, step_counts: dict[str, int] | None = None):
        self.waves, self.settings, self.step_counts = waves, settings, step_counts

    def routed(self) -> DataFrame:
        """Delivered, reply, parked and failed rows."""
        return _union([_finish(w, self.settings) for w in self.waves])

    def audit(self, receivers: DataFrame, host: str = "", specification_base: str = "") -> DataFrame:
        """One row per executed step and per copy made."""
        own = self.settings
        return _union([audit_rows(w, receivers, host, specification_base, own.audit_group_id, own.shared_endpoint) for w in self.waves])

    def lineage(self) -> DataFrame:
        """Which row came from which, from messages down to the rows of ``routed()``."""
        sent = f"case when {_SENT} then size(p.urls) else 0 end"
        return _union([lineage_rows(_changed(_converted(w, self.settings), {"sent": sent})) for w in self.waves])

    def suppressed(self) -> DataFrame:
        """Rows a filter step dropped."""
        return _union([w.df.where(_SUPPRESSED).selectExpr("msg_id", f"{ROW_LINEAGE} as lineage") for w in self.waves])

    def materialised(self, path: str, count: Sequence[str] = ()) -> RouteRun:
        """Write the rows once to a shared path, so that every table reads them back.

        The steps named in ``count`` are counted while the rows are written: the
        new run's ``step_counts`` says how many audit records there are of each, with no pass of its own.
        """
        done, counts = [], dict.fromkeys(count, 0)
        for i, w in enumerate(self.waves):
            df, seen = w.df, Observation()
            if counts:
                df = df.observe(seen, *[F.expr(f"sum(size(filter(events, e -> e.step = {lit(name)})))").alias(name) for name in counts])
            df.write.mode("overwrite").parquet(f"{path}/wave={i}")
            for name, n in seen.get.items() if counts else ():
                counts[name] += n or 0
            back = w.df.sparkSession.read.schema(w.df.schema).parquet(f"{path}/wave={i}")
            done.append(Wave(back, w.slots, w.snapshot))
        return RouteRun(done, self.settings, counts if count else None)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _wave(work: DataFrame, parsed: DataFrame, found: Registry, reshapes: DataFrame | None, settings: Settings) -> Wave:
    spark = work.sparkSession
    slots, contexts = compile_steps(spark, found, settings, named_reshapes(found, reshapes))
    written = {key for ctx in contexts.values() for key in ctx.written} | (found.outline.audited if found.outline else set())
    snapshot = [key for key in audit_keys(settings.shared_endpoint) if key in written]
    ids = {t: s.sid for t, s in found.steps.items()}
    side = with_operations(pipelines(parsed), ids) if found.outline else _with_sids(pipelines(parsed), ids)
    size = measured_bytes(side) if found.outline else found.bytes
    df = lookup_join(work, side, "process", size=size, limit=settings.max_registry_bytes, salt_by=F.col("msg_id"))
    df = _admit(df, *schema_checks(spark, found))
    df = restricted(df, found.restricts)
    df = _enter(df, slots)
    for stage in range(found.outline.stages) if found.outline else sorted(found.stages):
        here = {sid: contexts[sid] for sid in sorted(found.stages.get(stage, ()))}
        df = _stage(df, stage, here, slots, snapshot, found.outline, settings)
        if settings.cut_every and (stage + 1) % settings.cut_every == 0 and not df.isStreaming:
            df = checkpointed(df)
    if settings.stop_target_on_suppress:
        df = _stop_after_suppressed(df, settings.max_registry_bytes)
    return Wave(df, slots, snapshot)


def _with_sids(df: DataFrame, ids: dict[str, int]) -> DataFrame:
    """Pipelines with step numbers in place of step texts."""
    table = f"map_from_arrays(cast(array({lits(ids)}) as array<string>), cast(array({lits(ids.values())}) as array<int>))"
    kept = ", ".join(
        f"'{name}', p.{name}" for name in ("kind", "tpos", "target_id", "path", "urls", "output", "response", "input", "sync", "root")
    )
    numbered = f"named_struct({kept}, 'sids', transform(p.steps, s -> {table}[coalesce(s, '')]))"
    return df.selectExpr("process", "validate", "sync", "restrict", "bad", f"transform(pipelines, p -> {numbered}) as pipelines")


def _changed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Replace or add columns given as SQL text, in one projection."""
    kept = [f"{columns[c]} as {c}" if c in columns else c for c in df.columns]
    return df.selectExpr(*kept, *[f"{e} as {c}" for c, e in columns.items() if c not in df.columns])


def _admit(df: DataFrame, good: dict[str, str], problems: dict[str, str]) -> DataFrame:
    """Whole-message checks: route found, resume position, schema, content."""
    stage, target, path = (f"attrs['{key}']" for key in ("xform.stage", "target.id", "xform.path"))
    position = f"{stage} is not null and {target} is not null and {path} is not null"
    df = df.selectExpr(
        "*", "bad is null as missed",
        f"coalesce(not bad and {position}, false) as resumed",
        f"coalesce(not bad and not ({position}), false) as first",
        f"case when {stage} = '' then -1 else {whole_number(stage)} end as stage_no",
        f"{whole_number(path)} as path_no",
    )
    same = f"filter(pipelines, p -> p.target_id = {target} and p.kind <> 'reply')"
    df = _changed(df, {"candidates": f"case when resumed then {same} end"})
    chosen = "filter(candidates, p -> p.kind = 'path' and p.tpos = candidates[0].tpos and p.path = path_no)"
    df = _changed(df, {"chosen": f"case when size(candidates) > 0 then {chosen} end"})

    failed = "Failed xml validation!"
    checks = [(f"validate = {lit(name)}", lit(f"{failed} {problem}")) for name, problem in problems.items()]
    for name, valid in good.items():
        text = lit(f"{failed} content is not valid against {name}")
        checks.append((f"validate = {lit(name)}", f"case when not {valid} then {text} end"))
    known = f"coalesce(validate in ({lits([*good, *problems])}), false)" if checks else "false"
    no_schema = concat(
        lit("Failed schema extraction! java.io.IOException: Schema with name "), "coalesce(validate, 'null')", lit(" not found")
    )
    at_first = case([(f"not {known}", no_schema)], f"coalesce({case(checks)}, case when size(pipelines) = 0 then 'no targets' end)")
    return _changed(df, {"error": case([
        ("missed", not_found("process")),
        ("bad", lit("route document is not JSON")),
        ("first", at_first),
        ("size(candidates) = 0", lit("java.lang.IllegalArgumentException: Target not found")),
        ("path_no is null", not_a_number(path)),
        ("size(chosen) = 0", concat(lit("java.lang.Exception: Incorrect transformation path "), "path_no")),
        ("stage_no is null", not_a_number(stage)),
    ], "cast(null as string)")})


def _enter(df: DataFrame, slots: Slots) -> DataFrame:
    """Fan out to pipelines and set the attributes a path starts with."""
    df = df.selectExpr(
        "msg_id", "attrs", "content", "sync", "missed", "first", "error",
        "case when resumed then stage_no else -1 end as start",
        "explode_outer(case when error is null then case when resumed then chosen else pipelines end end) as p",
    )
    on_path = "p.kind = 'path'"
    begin = {
        "Receiver": [("first and p is not null", "p.target_id")],
        "xform.path": [(f"first and {on_path}", "cast(p.path as string)")],
        "xform.stage": [(on_path, "'0'"), ("first", "'-1'")],
        "target.id": [(on_path, "p.target_id")],
        "target.output": [("p.output = 'JSON' and p.kind <> 'reply'", "'JSON'")],
    }
    return df.selectExpr(
        "msg_id", "attrs", "case when p.kind = 'reply' then '' else content end as content",
        "p", f"size(p.{'ops' if slots.data else 'sids'}) as n", "start", "sync", "missed", "first",
        "coalesce(error, case when p.kind = 'empty' then 'no transformations' end) as error",
        f"coalesce({on_path}, false) as alive", "cast(null as int) as parked",
        "coalesce(p.kind = 'reply', false) as reply", "'' as copy",
        "case when first and error is null then true end as wf", f"cast(array() as {EVENT}) as events",
        *([f"{EMPTY_MAP} as extra"] if slots.extra else []),
        *[f"{case(begin.get(key, []), f'attrs[{lit(key)}]')} as {slot}" for key, slot in slots.names.items()],
    )


def _stage(
    df: DataFrame, stage: int, here: dict[int, StepContext], slots: Slots, snapshot: list[str], outline: Outline | None, settings: Settings,
) -> DataFrame:
    """Run the steps of one stage on the rows that are at it."""
    keep = [*_STATE, *(["extra"] if slots.extra else []), *slots.names.values()]
    visiting = f"alive and parked is null and error is null and n > {stage}"
    at = slots.names["xform.stage"]
    step = f"case when {visiting} and start < {stage} then p.{'ops' if outline else 'sids'}[{stage}] end"
    df = _changed(df, {
        "op" if outline else "s": step,
        at: f"case when {visiting} then '{stage}' else {at} end",
        "at_stage": str(stage),
    })
    if outline:
        df = _changed(df, {"s": "op.sid", **{f"o_{f}": f"op.{f}" for f in FIELDS}}).drop("op")
        for columns in stage_columns(slots, settings.legacy_last_filter):
            df = _changed(df, columns)
    wanting = [sid for sid, ctx in here.items() if ctx.needs_xml]
    if wanting:
        check = f"case when s in ({lits(wanting)}) and wf is null then {well_formed(df.sparkSession, 'content')} end"
        df = _changed(df, {"wf": f"coalesce(wf, {check})"})
    for phase in range(max((len(ctx.phases) for ctx in here.values()), default=0)):
        cases: dict[str, list[tuple[str, str]]] = {}
        for sid, ctx in here.items():
            guarded = ctx.guarded_from is not None and phase >= ctx.guarded_from
            for name, value in ctx.phases[phase].items() if phase < len(ctx.phases) else ():
                cases.setdefault(name, []).append((f"s = {sid}{' and error is null' if guarded else ''}", value))
        if cases:
            known = set(df.columns)
            df = _changed(df, {name: case(found, name if name in known else "null") for name, found in cases.items()})
    return _multiply(df, stage, here, slots, snapshot, keep, outline)


def _event(entry_type: str, step: str, path: str, stage: str, derivation: str, slots: Slots, snapshot: list[str]) -> str:
    pairs = ", ".join(f"{lit(key)}, {slots.column(key)}" for key in snapshot)
    seen = f"map({pairs})" if pairs else "cast(null as map<string,string>)"
    return (
        f"named_struct('entry_type', '{entry_type}', 'step', {step}, 'path', {path}, 'stage', {stage},"
        f" 'derivation', {derivation}, 'seen', {seen})"
    )


def _multiply(
    df: DataFrame, stage: int, here: dict[int, StepContext], slots: Slots, snapshot: list[str], keep: list[str], outline: Outline | None,
) -> DataFrame:
    """Log the stage's steps; make its copies and replies by one explode (-1 is the reply)."""
    named: dict[str, list[int]] = {}
    for sid, ctx in here.items():
        if ctx.copies_column is None:
            named.setdefault(ctx.step.name, []).append(sid)
    none = lit(None)
    labels = [(f"s in ({lits(sids)})", lit(name)) for name, sids in named.items()]
    if outline:
        labels.append(("o_sid is null and o_copies is null", "o_name"))
    label = case(labels, none)
    event = _event("processing", label, slots.column("xform.path"), slots.column("xform.stage"), none, slots, snapshot)
    events = f"case when {label} is not null and error is null then array_append(events, {event}) else events end"

    copying = {f"s = {sid}": ctx.copies_column for sid, ctx in here.items() if ctx.copies_column is not None}
    replying = [f"s = {sid}" for sid, ctx in here.items() if ctx.replies]
    if outline and stage in outline.copying:
        copying["o_copies is not null"] = "d_copies"
    if outline and stage in outline.replying:
        replying.append("o_reply")
    if not copying and not replying:
        return df.selectExpr(*[f"{events} as events" if c == "events" else c for c in keep])
    copied = f"({' or '.join(copying)}) and error is null" if copying else "false"
    if copying:
        # Copies come in blocks, so that no row holds an array of all their numbers.
        kept = [*dict.fromkeys([*df.columns])]
        blocks = [(f"{on} and error is null", f"sequence(0, {number} div {COPY_BLOCK})") for on, number in copying.items()]
        df = df.selectExpr(*[f"`{c}`" for c in kept], f"explode({case(blocks, 'array(0)')}) as block")
    first, last = f"cast(block as bigint) * {COPY_BLOCK}", f"cast(block as bigint) * {COPY_BLOCK} + {COPY_BLOCK - 1}"
    numbers = [
        (f"{on} and error is null", f"sequence({first}, least(cast({number} as bigint), {last}))") for on, number in copying.items()
    ]
    if replying:
        numbers.append((f"({' or '.join(replying)}) and error is null", "array(0, -1)"))
    df = df.selectExpr(
        *[f"{events} as events" if c == "events" else c for c in keep],
        f"coalesce({copied}, false) as copied", f"explode({case(numbers, 'array(0)')}) as c",
    )
    if copying:
        index = slots.names["copy.index"]
        df = _changed(df, {index: f"case when copied then cast(c as string) else {index} end"})
        start = _event("start", none, none, none, ROW_LINEAGE, slots, snapshot)
        df = _changed(df, {
            "events": f"case when c > 0 then array({start}) else events end",
            "copy": "case when copied then concat(copy, '.', c) else copy end",
        })
    if replying:
        df = _changed(df, {
            "reply": "reply or c = -1",
            "alive": "alive and c <> -1",
            "content": "case when c = -1 then '' else content end",
            "events": "case when c = -1 then slice(events, 1, 0) else events end",
            "copy": f"case when c = -1 then concat(copy, '.r{stage}') else copy end",
        })
    return df.select(*keep)


def _stop_after_suppressed(df: DataFrame, limit: int) -> DataFrame:
    """A path suppressed before any copy also ends the later paths of its target.

    The rows are written once; from them the suppressed ones, without contents,
    say where each target stops, and that is broadcast back within ``limit``.
    """
    rows = written(df, "rows")
    stops = rows.where(f"{_SUPPRESSED} and copy = ''").groupBy(F.col("msg_id").alias("__id"), F.col("p.tpos").alias("__tpos")).agg(
        F.min("p.path").alias("__stop"))
    stops = F.broadcast(stops) if measured_bytes(stops) <= limit else stops
    known = rows.join(stops, F.expr("msg_id = __id and p.tpos = __tpos"), "left")
    return known.where("__stop is null or p.path is null or p.path <= __stop").select(*df.columns)


_SENT = "alive and error is null and size(p.urls) > 0"


def _converted(wave: Wave, settings: Settings) -> DataFrame:
    """What a target asks for at the end of a path: a root element, JSON, a SOAP envelope. A row that cannot have it fails."""
    as_json = f"coalesce({wave.slots.column('target.output')} = 'JSON', false)"
    ended = "alive and error is null and parked is null"
    bare = strip_declaration("content")
    named = f"p.root rlike {lit(r'^[A-Za-z_][\w.-]*$')}"
    df = _changed(wave.df, {
        "content": f"case when {ended} and p.root is not null then concat('<', p.root, '>', {bare}, '</', p.root, '>') else content end",
        "error": f"case when {ended} and not ({named}) then concat('Incorrect root tag ', p.root) else error end",
    })
    df = _changed(df, {"to_json": f"{ended} and {as_json}"})
    check = f"case when to_json and wf is null then {well_formed(df.sparkSession, 'content')} end"
    df = _changed(df, {"wf": f"coalesce(wf, {check})"})
    if settings.ordered_json:
        df = df.withColumn("json", ordered_json(F.expr("case when to_json and wf then content end")))
    else:
        df = _changed(df, {"json": f"case when to_json and wf then {compact_json('content')} end"})
    return _changed(df, {
        "content": f"case when to_json and json is not null then json when {ended} and p.output = 'SOAP' then {soap_envelope(bare)} else content end",
        "error": "coalesce(error, case when to_json and json is null then 'java.lang.Exception: Failed xml convertation!' end)",
    })


def _finish(wave: Wave, settings: Settings) -> DataFrame:
    """End-of-path marks, JSON, delivery attributes, destinations."""
    slots = wave.slots
    attr = slots.column
    as_json = f"coalesce({attr('target.output')} = 'JSON', false)"
    df = _converted(wave, settings)

    def out(route: str, url: str = lit(None), number: str = "cast(null as int)", error: str = lit(None)) -> str:
        return f"named_struct('route', {route}, 'url', {url}, 'url_no', {number}, 'error', {error})"

    sent = out("case when parked is not null then 'parked' else 'deliver' end", "u", "i")
    outputs = case([
        ("reply", f"array({out(lit('reply'))})"),
        ("error is not null", f"array({out(lit('failed'), error='error')})"),
        (_SENT, f"transform(p.urls, (u, i) -> {sent})"),
        ("alive", f"array({out(lit('failed'), error=lit('no destinations'))})"),
    ])
    # The route is a field of the explode, so a filter on it stays above the stages. Made before it and not in it, the list is
    # compiled; an outer explode has no filter on its size, which would make the list twice.
    df = df.selectExpr("*", f"{outputs} as outs").selectExpr("*", "explode_outer(outs) as out").where("out is not null")
    going = "out.route in ('deliver', 'parked')"
    synced = f"{going} and coalesce(sync, false)"
    unknown = f"p.target_id not in ({lits(settings.known_systems)})" if settings.known_systems else "p.target_id is not null"

    def when(condition: str, value: str, key: str) -> str:
        return case([(condition, value)], attr(key))

    final = {
        "xform.last": when(f"{going} and coalesce(parked = n - 1, false) and not {as_json}", "'true'", "xform.last"),
        "xform.group": when("out.route = 'deliver'", "null", "xform.group"),
        "error.msg": when("out.route = 'failed' and not missed", "out.error", "error.msg"),
        "route.error": when("missed", "out.error", "route.error"),
        "route.status.code": case([("missed", "'501'"), (synced, "''")], attr("route.status.code")),
        "business.process.name": when(synced, "p.response", "business.process.name"),
        "route.input": when(going, "p.input", "route.input"),
        "route.sync": when(going, "p.sync", "route.sync"),
        "processGroupId": when(going, lit(settings.process_group_id), "processGroupId"),
        "target_system": when(f"{going} and {unknown}", "p.target_id", "target_system"),
        "target_url": when(going, "out.url", "target_url"),
        "sync.response": when("out.route = 'reply'", "'true'", "sync.response"),
    }
    context = concat(
        lit("Exception '"), "out.error", lit("' occurs while processing FlowFile '"), f"coalesce({attr('filename')}, 'null')",
        lit("' in '"), f"coalesce({attr('business.process.name')}, 'null')",
        lit("' scenario at '"), f"coalesce({attr('target.id')}, p.target_id, 'null')",
        lit("' target at '"), f"coalesce({attr('xform.path')}, 'null')",
        lit("' path at "), f"coalesce({attr('xform.stage')}, 'null')", lit(" stage"),
    )
    whole = "p is null and (missed or first)"
    return df.selectExpr(
        "msg_id", f"concat_ws('/', {ROW_LINEAGE}, cast(out.url_no as string)) as lineage", "out.route as route",
        "p.target_id as target_id", "p.path as path", "out.url as target_url", "content",
        f"{slots.whole_map(final)} as attrs",
        f"case when out.error is not null then case when {whole} then out.error else {context} end end as error",
    )
