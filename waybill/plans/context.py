"""What a step sees and does while the plan is built.

Attributes that any step writes live in plain columns ("slots"), so a stage is
an ordinary projection. The attribute map is only put together at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from waybill.functions.render import SQL_PREFIX, Nothing, TemplateError, lit, lits, render
from waybill.functions.total import PartialExpression, total
from waybill.functions.xmlfn import shaped_xml


class StepError(ValueError):
    """The step cannot run; its message fails every row that reaches it."""


@dataclass
class Reshape:
    """Structural rewrite of the content: read by DDL, map, write under a root tag."""

    input_ddl: str
    expr: str
    root_tag: str


@dataclass
class Settings:
    """Choices of one routing run."""

    # What delivery attributes and audit records carry as the id of their installation.
    process_group_id: str = ""
    audit_group_id: str = ""
    known_systems: tuple[str, ...] = ()
    # An endpoint that many interfaces share: its URI, and the attribute that names the interface.
    shared_endpoint: tuple[str, str] | None = None
    ordered_json: bool = False
    legacy_last_filter: bool = False
    stop_target_on_suppress: bool = False
    # Beyond twice so many distinct steps, steps run as data; a plan compiles at most twice so many.
    max_steps: int = 256
    steps_as_data: bool = False
    max_registry_bytes: int = 64 * 1024 * 1024
    cut_every: int = 40


@dataclass
class Step:
    """One distinct step text of the registry."""

    sid: int
    text: str
    name: str
    entries: list[tuple[str, str | None]]


@dataclass
class Slots:
    """Attribute name to state column."""

    names: dict[str, str] = field(default_factory=dict)
    extra: bool = False
    # Steps run as data and write to ``extra``, where a null means that the attribute is gone.
    data: bool = False

    def add(self, key: str) -> None:
        self.names.setdefault(key, f"a{len(self.names)}")

    def column(self, key: str) -> str:
        if key in self.names:
            return self.names[key]
        base = f"attrs[{lit(key)}]"
        if self.data:
            return f"case when map_contains_key(extra, {lit(key)}) then extra[{lit(key)}] else {base} end"
        return f"coalesce(extra[{lit(key)}], {base})" if self.extra else base

    def whole_map(self, final: dict[str, str] | None = None) -> str:
        """The attribute map as it stands: ``final`` over slots over extra over the message's own."""
        values = {**self.names, **(final or {})}
        own = merged("attrs", "extra") if self.extra else "attrs"
        gone = " and (v is not null or not map_contains_key(extra, k))" if self.data else ""
        own = f"map_filter({own}, (k, v) -> k not in ({lits(values)}){gone})"
        # Without a lambda, in which Spark would not compile what makes the values.
        none = "cast(array() as array<struct<key:string,value:string>>)"
        entry = "case when {v} is not null then array(named_struct('key', {k}, 'value', cast({v} as string))) else {none} end"
        entries = ", ".join(entry.format(k=lit(k), v=v, none=none) for k, v in values.items())
        return f"map_concat({own}, map_from_entries(concat({entries})))"


def merged(old: str, new: str) -> str:
    """Map union where ``new`` wins, whatever the session's duplicate-key policy."""
    kept = f"map_filter({old}, (k, v) -> not map_contains_key({new}, k))"
    return f"case when coalesce(size({new}), 0) < 1 then {old} else map_concat({kept}, {new}) end"


class StepContext:
    """Collects the column changes of one step, phase by phase, as SQL text.

    A phase is one projection. Values stashed or set in a phase can be read as
    columns in the next; after ``fail_when`` the rest applies to good rows only.
    """

    def __init__(self, spark: SparkSession, step: Step, slots: Slots, settings: Settings, reshapes: dict[str, Reshape]):
        self.spark, self.step, self.slots, self.settings, self.reshapes = spark, step, slots, settings, reshapes
        self.phases: list[dict[str, str]] = [{}]
        self.guarded_from: int | None = None
        self.written: list[str] = []
        self.params: dict[str, str] = {}
        self.copies_column: str | None = None
        self.replies = False
        self.needs_xml = False
        self.uses_extra = False
        self._stashed = 0

    # reading
    content = "content"

    def attr(self, name: str) -> str:
        slot = self.slots.names.get(name)
        if slot and slot in self.phases[-1]:
            return self.phases[-1][slot]
        return self.slots.column(name)

    def attr_column(self, name: str) -> str:
        if self.slots.names.get(name) in self.phases[-1]:
            self.flush()
        return self.slots.column(name)

    def attrs(self) -> str:
        if self.phases[-1]:
            self.flush()
        return self.stash(self.slots.whole_map())

    def render(self, template: str) -> str:
        try:
            if template.startswith(SQL_PREFIX):
                template = SQL_PREFIX + total(template[len(SQL_PREFIX):], self.spark)
                frame = self.spark.range(0).selectExpr("cast(null as string) as content")
                self.check(frame, render(template, Nothing()))
            return render(template, self)
        except (TemplateError, PartialExpression, AnalysisException, ParseException) as e:
            why = str(e).splitlines()[0]
            raise StepError(f"java.lang.IllegalArgumentException: {self.step.name} {why}") from e

    def check(self, frame: DataFrame, text: str) -> None:
        """Let Spark analyse an expression where aggregates, windows and generators are not allowed."""
        frame.where(f"({text}) = ''")

    def shaped(self, shape: Reshape, doc: str) -> str:
        """The text of a structural transform over the parsed document ``doc``."""
        try:
            text = total(shape.expr, self.spark)
            frame = self.spark.range(1).selectExpr(f"from_xml(cast(null as string), {lit(shape.input_ddl)}) as doc")
            self.check(frame, shaped_xml(text, "doc", shape.root_tag))
            # Names that XML does not allow show on any row.
            frame.selectExpr(shaped_xml(text, "doc", shape.root_tag)).collect()
            return shaped_xml(text, doc, shape.root_tag)
        except (PartialExpression, PySparkException) as e:
            why = str(e).strip().splitlines()[0]
            raise StepError(f"java.lang.IllegalArgumentException: {self.step.name} {why}") from e

    def required(self, name: str) -> str:
        value = self.params.get(name)
        if not value:
            raise StepError(f"java.lang.IllegalArgumentException: {self.step.name} {name}")
        return value

    # changing
    def set(self, name: str, value: str) -> None:
        self.written.append(name)
        self.slots.add(name)
        self.phases[-1][self.slots.names[name]] = value

    def set_content(self, value: str) -> None:
        self.phases[-1]["content"] = value
        self.phases[-1]["wf"] = lit(None, "boolean")

    def set_extra(self, entries: str) -> None:
        self.uses_extra = True
        self.phases[-1]["extra"] = entries

    def fail(self, text: str) -> None:
        self.phases[-1]["error"] = lit(text)

    def fail_when(self, bad: str, text: str) -> None:
        """Fail the rows where ``bad`` holds; ``text`` is SQL too."""
        self.phases[-1]["error"] = f"case when {bad} then {text} end"
        self.flush()
        if self.guarded_from is None:
            self.guarded_from = len(self.phases) - 1

    def drop_when(self, bad: str) -> None:
        self.phases[-1]["alive"] = f"not coalesce({bad}, false)"

    def park(self) -> None:
        self.phases[-1]["parked"] = "at_stage"

    def copies(self, number: str) -> None:
        self.copies_column = self.stash(number)

    def reply(self) -> None:
        self.replies = True

    def require_xml(self) -> None:
        """The content must be well-formed XML here; else the row fails."""
        self.needs_xml = True
        self.fail_when("not coalesce(wf, false)", lit("org.xml.sax.SAXParseException: content is not well-formed XML"))

    def stash(self, value: str) -> str:
        """Compute once; the returned column is readable from here on."""
        name = f"t{self.step.sid}_{self._stashed}"
        self._stashed += 1
        self.phases[-1][name] = value
        self.flush()
        return name

    def flush(self) -> None:
        self.phases.append({})
