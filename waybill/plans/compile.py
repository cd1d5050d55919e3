"""From the route registry to the literals a plan needs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.xmlfn import schema_file, schema_problem, sure_form, valid_xml
from waybill.operators.audit import audit_keys
from waybill.operators.steps import STEPS, hand_off
from waybill.plans.context import Reshape, Settings, Slots, Step, StepContext, StepError
from waybill.plans.datasteps import Outline, is_plain, outline, step_texts
from waybill.session import one_per_key
from waybill.sources.registry import NO_VALUE, split_step

# Attributes the wave itself sets on every path.
WAVE_KEYS = ("Receiver", "xform.path", "xform.stage", "target.id", "target.output", "xform.group")


@dataclass
class Registry:
    """One chunk of the registry, read for planning."""

    steps: dict[str, Step] = field(default_factory=dict)
    stages: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    schemas: dict[str, str] = field(default_factory=dict)
    restricts: list[str] = field(default_factory=list)
    bytes: int = 0
    outline: Outline | None = None

    def by_sid(self) -> dict[int, Step]:
        return {s.sid: s for s in self.steps.values()}


def read_registry(
    parsed: DataFrame, schemas: DataFrame, most: int | None, data: bool = False, audited: Sequence[str] = ()
) -> Registry | None:
    """Distinct steps per stage, the schemas named, and the measured size.

    None if there are more than ``most`` distinct steps and schemas. With
    ``data``, steps that run as data are outlined instead.
    """
    name, entries = split_step("text")
    wanted = _wanted(parsed, data)
    rows = (wanted if most is None else wanted.limit(most + 1)).selectExpr("*", f"{name} as name", f"{entries} as entries").collect()
    if most is not None and len(rows) > most:
        return None
    found = Registry(outline=outline(parsed, audited) if data else None)
    validates = []
    for row in sorted(rows, key=lambda r: (r["text"], r["stage"])):
        if row["stage"] < 0:
            (validates if row["stage"] == -1 else found.restricts).append(row["text"])
            continue
        entries = [(e["key"], e["value"]) for e in row["entries"]]
        step = found.steps.setdefault(row["text"], Step(len(found.steps), row["text"], row["name"], entries))
        found.stages[row["stage"]].append(step.sid)
    usable = schemas.where(F.col("name").isin(validates) & (F.col("xsd") != ""))
    found.schemas = {r["name"]: r["xsd"] for r in one_per_key(usable.select("name", "xsd"), "name").collect()}
    weight = "cast(octet_length(to_json(targets)) + octet_length(coalesce(process, '')) + 256 as long)"
    found.bytes = int(parsed.selectExpr(f"sum({weight})").first()[0] or 0)
    return found


def plan_registries(parsed: DataFrame, schemas: DataFrame, settings: Settings) -> list[tuple[str | None, Registry]]:
    """The registry of each plan, with the condition on ``process`` that picks its messages.

    One plan that compiles every step, or else (always with ``steps_as_data``) one that runs plain steps as data.
    Only if what has to be compiled is still more than ``2 * max_steps`` texts are
    processes split by hash, again and again where it takes that, and each of
    these plans reads the messages. A process alone is never split.
    """
    limit, audited = settings.max_steps, audit_keys(settings.shared_endpoint)
    found = None if settings.steps_as_data else read_registry(parsed, schemas, 2 * limit)
    found = found or read_registry(parsed, schemas, 2 * limit, True, audited)
    if found:
        return [(None, found)]
    plans = []
    open_ = [([], -(-_wanted(parsed, True).count() // max(1, limit)))]
    while open_:
        chosen, parts = open_.pop()
        for part in range(parts):
            picked = [*chosen, f"pmod(xxhash64(coalesce(process, ''), {len(chosen)}), {parts}) = {part}"]
            own = parsed.where(" and ".join(picked))
            found = read_registry(own, schemas, 2 * limit, True, audited)
            if found is None and len(own.select("process").distinct().take(2)) < 2:
                found = read_registry(own, schemas, None, True, audited)
            if found is None:
                open_.append((picked, 2))
            else:
                plans.append((" and ".join(picked), found))
    return plans


def _wanted(parsed: DataFrame, data: bool) -> DataFrame:
    """Distinct (stage, step text) pairs, schema names as stage -1, restrictions as -2; with ``data``, of the compiled steps alone."""
    texts = step_texts(parsed).where(f"not {is_plain()}") if data else step_texts(parsed)
    texts = texts.select("stage", "text")
    names = parsed.selectExpr("inline(array(struct(-1 as stage, validate as text), struct(-2 as stage, restrict as text)))").where("text is not null")
    return texts.unionByName(names).distinct()


def named_reshapes(found: Registry, reshapes: DataFrame | None) -> dict[str, Reshape]:
    """The structural transforms the steps name."""
    wanted = [value for s in found.steps.values() if s.name == "ApplyXslt" for key, value in s.entries if key == "Name"]
    if reshapes is None or not wanted:
        return {}
    rows = one_per_key(reshapes.where(F.col("name").isin(wanted)).select("name", "input_ddl", "expr", "root_tag"), "name").collect()
    return {r["name"]: Reshape(r["input_ddl"], r["expr"], r["root_tag"]) for r in rows}


def compile_steps(
    spark: SparkSession, found: Registry, settings: Settings, reshapes: dict[str, Reshape]
) -> tuple[Slots, dict[int, StepContext]]:
    """Run every step function: once to learn what is written, once for the columns."""

    def run(slots: Slots) -> dict[int, StepContext]:
        contexts = {}
        for step in found.steps.values():
            ctx = StepContext(spark, step, slots, settings, reshapes)
            ctx.params = dict(step.entries)
            try:
                if any(value is None for _, value in step.entries):
                    raise StepError(NO_VALUE)
                STEPS.get(step.name, hand_off)(ctx)
            except StepError as e:
                ctx.fail(str(e))
            contexts[step.sid] = ctx
        return contexts

    slots = Slots(data=found.outline is not None)
    for key in WAVE_KEYS:
        slots.add(key)
    if found.outline and found.outline.copying:
        slots.add("copy.index")
    first = run(slots)
    slots.extra = slots.data or any(ctx.uses_extra for ctx in first.values())
    return slots, run(slots)


def schema_checks(spark: SparkSession, found: Registry) -> tuple[dict[str, str], dict[str, str]]:
    """Whether the content is valid, for usable schemas by name, and the errors of the others."""
    problems = {name: p for name, xsd in found.schemas.items() if (p := schema_problem(spark, xsd))}
    good = {
        name: valid_xml("content", schema_file(spark, xsd), sure_form(xsd)) for name, xsd in found.schemas.items() if name not in problems
    }
    return good, problems
