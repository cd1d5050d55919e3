"""Tool calls in chats: linked to their results by identifier, ordered by dependency, checked, as canonical JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import written
from waybill.llm.components import components

# How calls and results stand in a message, and the sign before an identifier that an argument refers to.
CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.DOTALL)
RESULT = re.compile(r"<tool_result>(.*?)</tool_result>", re.DOTALL)
REFERENCE = re.compile(r"^\$\{?([A-Za-z0-9_-]+)\}?$")

#: By tool, by argument: its JSON type and whether it must be there.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "fetch": {"url": ("string", True)},
    "calculate": {"expression": ("string", True), "digits": ("integer", False)},
}

EVENT = ("conv_id long, turn long, place int, kind string, role string, call_id string, name string, json string, "
         "needs array<string>, problem string")


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value, kind: str) -> bool:
    types = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}
    return isinstance(value, types[kind]) and (kind == "boolean" or not isinstance(value, bool))


def problem_of(name, arguments, schemas: dict) -> str | None:
    """Why a call's arguments don't fit the tool's schema. A reference to another call's result fits any type."""
    if name not in schemas:
        return "unknown tool"
    if not isinstance(arguments, dict):
        return "arguments are no object"
    schema = schemas[name]
    for key, (kind, needed) in sorted(schema.items()):
        if key not in arguments:
            if needed:
                return f"missing argument {key}"
        elif not (isinstance(arguments[key], str) and REFERENCE.match(arguments[key])) and not _is(arguments[key], kind):
            return f"argument {key} is no {kind}"
    extra = sorted(set(arguments) - set(schema))
    return f"unknown argument {extra[0]}" if extra else None


def references(value) -> Iterator[str]:
    if isinstance(value, str):
        if m := REFERENCE.match(value):
            yield m[1]
    elif isinstance(value, (dict, list)):
        for v in value.values() if isinstance(value, dict) else value:
            yield from references(v)


def _block(raw: str) -> dict | None:
    """A block as an object; null if it is none, or holds numbers that JSON has no form for."""
    try:
        found = json.loads(raw)
        canonical(found)
        return found if isinstance(found, dict) else None
    except (ValueError, RecursionError):
        return None


def _ident(value) -> str | None:
    return value if isinstance(value, str) else canonical(value) if value is not None else None


def events(turns: DataFrame, schemas: dict | None = None) -> DataFrame:
    """A row per message, call and result of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``), in place.

    The message comes first, with the blocks cut out; null texts are empty
    messages. A block that isn't JSON with an identifier is a call or result with a
    problem, never lost.
    """
    schemas = SCHEMAS if schemas is None else schemas

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, turn, role, text in batch[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None):
                text = text or ""
                found = sorted([(m.start(), "call", m[1]) for m in CALL.finditer(text)]
                               + [(m.start(), "result", m[1]) for m in RESULT.finditer(text)])
                plain = RESULT.sub("", CALL.sub("", text)) if found else text
                rows.append((conv, turn, 0, "message", role, None, None, canonical(plain), [], None))
                for place, (_, kind, raw) in enumerate(found, 1):
                    block = _block(raw)
                    ident = _ident(block.get("id")) if block else None
                    problem = "not readable" if block is None else "no identifier" if ident is None else None
                    if kind == "result":
                        body = canonical(block.get("content")) if block else canonical(raw)
                        rows.append((conv, turn, place, kind, role, ident, None, body, [], problem))
                        continue
                    name, arguments = (block.get("name"), block.get("arguments", {})) if block else (None, raw)
                    problem = problem or problem_of(name if isinstance(name, str) else None, arguments, schemas)
                    needs = sorted(set(references(arguments)))
                    rows.append((conv, turn, place, kind, role, ident, _ident(name), canonical(arguments), needs, problem))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in EVENT.split(", ")])
            yield out.astype({"conv_id": "Int64", "turn": "Int64"})

    return turns.select("conv_id", "turn", "role", "text").mapInPandas(read, EVENT)


#: Dependencies that one task orders at most; larger tangles of calls are ordered level by level.
TOGETHER = 100_000


def call_steps(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, step``: 0 for calls that need no other, else one more than the last they need.

    Calls that depend on each other, directly or through others, are a connected
    component; each is ordered in one pass over its thin rows, so a long chain takes
    no more jobs than a short one. Components of more than ``TOGETHER``
    dependencies are ordered level by level over all tasks. Calls on a cycle, and those that need
    them, get none. Needs that name no call of the conversation are left to ``linked_chats``.
    """
    keys = ["conv_id", "call_id"]
    needs = calls.select(*keys, F.explode("needs").alias("need"))
    known = calls.select(F.col("conv_id").alias("nc"), F.col("call_id").alias("need_id"))
    needs = written(needs.join(known, F.col("conv_id").eqNullSafe(F.col("nc")) & (F.col("need") == F.col("need_id")))
                    .select(*keys, "need").distinct(), "needs")
    waiting = needs.select(*keys).distinct()
    done = calls.select(*keys).alias("c").join(waiting.alias("w"), _same("c", "w"), "left_anti").withColumn("step", F.lit(0))
    if needs.isEmpty():
        return done
    node = lambda call: F.to_json(F.struct("conv_id", F.col(call).alias("call")))
    edges = needs.select("*", node("call_id").alias("a"), node("need").alias("b"))
    # A call that needs itself is a component of its own.
    found = components(edges.select("a", "b"))
    edges = edges.join(found, edges["a"] == found["node"], "left").withColumn("component", F.coalesce("component", "a"))
    sizes = edges.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    sized = written(edges.join(sizes, "component").select(*keys, "need", "component", "n"), "sized")
    kind = calls.schema["conv_id"].dataType.simpleString()
    ordered = sized.where(F.col("n") <= TOGETHER).groupBy("component").applyInPandas(_ordered, f"conv_id {kind}, call_id string, step int")
    large = sized.where(F.col("n") > TOGETHER)
    out = done.unionByName(ordered)
    return out if large.isEmpty() else out.unionByName(_by_level(large.select(*keys, "need")))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.call_id") == F.col(f"{b}.call_id"))


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    """The steps of one component's calls that need others."""
    open_, users = {}, {}
    for call, need in zip(rows["call_id"], rows["need"], strict=True):
        open_[call] = open_.get(call, 0) + 1
        users.setdefault(need, []).append(call)
    ready, step = [n for n in users if n not in open_], {}
    for need in ready:  # grows while it is read
        for call in users.get(need, ()):
            step[call] = max(step.get(call, 0), step.get(need, 0) + 1)
            open_[call] -= 1
            if not open_[call]:
                ready.append(call)
    placed = [c for c in open_ if not open_[c]]
    conv = None if pd.isna(rows["conv_id"].iloc[0]) else rows["conv_id"].iloc[0]
    return pd.DataFrame([(conv, c, step[c]) for c in placed], columns=["conv_id", "call_id", "step"], dtype=object)


def _by_level(needs: DataFrame) -> DataFrame:
    """The same for components of any size: a call gets its step when all it needs have theirs."""
    keys = ["conv_id", "call_id"]
    waiting = written(needs.groupBy(*keys).agg(F.count(F.lit(1)).alias("open")), "waiting")
    first = needs.select("conv_id", F.col("need").alias("call_id")).distinct()
    last = written(first.alias("f").join(waiting.alias("w"), _same("f", "w"), "left_anti").withColumn("step", F.lit(0)), "steps")
    done, step = last.limit(0), 0
    while not waiting.isEmpty():
        step += 1
        met = needs.alias("n").join(
            last.alias("l"), F.col("n.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("n.need") == F.col("l.call_id"))
        ).groupBy(F.col("n.conv_id").alias("conv_id"), F.col("n.call_id").alias("call_id")).agg(F.count(F.lit(1)).alias("met"))
        left = written(waiting.alias("w").join(met.alias("m"), _same("w", "m"), "left").select(
            "w.conv_id", "w.call_id", (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")), "waiting")
        last = written(left.where("open = 0").select(*keys, F.lit(step).alias("step")), "steps")
        if last.isEmpty():
            break
        done, waiting = done.unionByName(last), left.where("open > 0")
    return done


def linked_chats(turns: DataFrame, schemas: dict | None = None) -> DataFrame:
    """Messages and calls in order, each as canonical JSON; results move into their calls.

    Order within a conversation: by ``turn``, then ``step`` (null steps last),
    then ``place``. A message has no step and comes first in its turn.
    ``status`` of a call: ``linked`` with its result, ``unanswered``, ``invalid``
    (with ``problem``), ``repeated`` (its identifier was used before in the
    conversation), ``cyclic``. A result whose identifier no earlier call has, or
    that is unreadable, is ``orphan``; of several results of a call the first
    counts, the others are ``repeated``. Null conversation ids form one conversation. Calls and
    results meet in a hash join on conversation and identifier, so one
    conversation, however long, spreads over tasks. Extra columns are left out. Empty tables give no rows.
    """
    all_ = written(events(turns, schemas), "events")
    at = F.struct("turn", "place")
    calls = all_.where("kind = 'call' and call_id is not null")
    firsts = written(calls.groupBy("conv_id", "call_id").agg(
        F.min(at).alias("at"), F.min_by("needs", at).alias("needs")), "calls")
    same = _same
    steps = call_steps(firsts.select("conv_id", "call_id", "needs"))
    found = all_.where("kind = 'result' and problem is null").alias("r").join(firsts.alias("f"), same("r", "f")).where(
        "struct(r.turn, r.place) > f.at")
    answers = written(found.groupBy("r.conv_id", "r.call_id").agg(
        F.min(F.struct("r.turn", "r.place", "r.json")).alias("answer")), "answers")
    told = (
        all_.alias("e").join(firsts.drop("needs").alias("f"), same("e", "f"), "left")
        .join(steps.alias("s"), same("e", "s"), "left").join(answers.alias("a"), same("e", "a"), "left")
        .select("e.*", F.col("f.at").alias("first"), "s.step", "a.answer")
    )
    here = F.struct("turn", "place")
    status = (
        F.when(F.col("kind") == "message", "message")
        .when(F.col("kind") == "result", F.when(F.col("problem").isNotNull() | F.col("first").isNull() | (here <= F.col("first")), "orphan")
              .when(here == F.struct("answer.turn", "answer.place"), "joined").otherwise("repeated"))
        .when(F.col("problem").isNotNull(), "invalid").when(here != F.col("first"), "repeated")
        .when(F.col("step").isNull(), "cyclic").when(F.col("answer").isNull(), "unanswered").otherwise("linked")
    )
    text = lambda c: F.coalesce(_quoted(F.col(c)), F.lit("null"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    message = F.concat(F.lit('{"content":'), F.col("json"), F.lit(',"role":'), text("role"), F.lit(',"turn":'), number("turn"), F.lit("}"))
    result = F.when(F.col("status") == "linked", F.concat(F.lit(',"result":'), F.col("answer.json"))).otherwise("")
    call = F.concat(F.lit('{"arguments":'), F.col("json"), F.lit(',"id":'), text("call_id"), F.lit(',"name":'), text("name"), result, F.lit("}"))
    other = F.concat(F.lit('{"content":'), F.col("json"), F.lit(',"id":'), text("call_id"), F.lit("}"))
    return told.withColumn("status", status).where("status != 'joined'").select(
        "conv_id", "turn", F.when(F.col("kind") == "call", F.col("step")).alias("step"), "place", "role", "call_id", "status",
        "problem", F.when(F.col("kind") == "message", message).when(F.col("kind") == "call", call).otherwise(other).alias("json"))


def _quoted(text):
    """A short text as JSON; null for null, which ``to_json`` would leave out."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1))
