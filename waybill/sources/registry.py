"""Registries: small static tables, and the routes parsed from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.render import lit
from waybill.sources.messages import unique_entries

REGISTRY_SCHEMAS = {
    "routes": "process string, doc string",
    "schemas": "name string, xsd string",
    "reshapes": "name string, input_ddl string, expr string, root_tag string",
    "receivers": "uri string, receiver string",
    "values": "key string, value binary",
}

TARGETS_DDL = """array<struct<
    id string, transformations array<array<string>>, xforms array<array<string>>,
    targetPath string, output string, syncValidation string, rootTag string,
    response string, input string, sync string>>"""
ROUTE_DDL = f"validate string, sync string, targetsRestrict string, bad string, targets {TARGETS_DDL}"

# Fixed value: a parameter without a value fails the step with this text.
NO_VALUE = "java.lang.ArrayIndexOutOfBoundsException: Index 1 out of bounds for length 1"


def registry(spark: SparkSession, kind: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Load one registry; read again per micro-batch, so edits take effect."""
    return spark.read.format(fmt).schema(REGISTRY_SCHEMAS[kind]).load(path)


def parse_routes(routes: DataFrame) -> DataFrame:
    """Route documents to columns. ``bad`` marks a document that is not JSON.

    An absent or empty document counts as no route at all.
    """
    doc = f"from_json(doc, {lit(ROUTE_DDL)}, map('columnNameOfCorruptRecord', 'bad'))"
    no_targets = f"from_json('[]', {lit(TARGETS_DDL)})"
    parsed = routes.where("doc is not null and doc <> ''").selectExpr("process", f"{doc} as d")
    # A target keeps its paths under either of two names.
    target = (
        "named_struct('id', t.id, 'paths', coalesce(t.transformations, t.xforms, cast(array() as array<array<string>>)),"
        f" 'urls', {destinations('t.targetPath')}, 'output', t.output, 'reply', coalesce(t.syncValidation = 'true', false),"
        " 'response', t.response, 'input', t.input, 'sync', t.sync, 'root', nullif(t.rootTag, ''))"
    )
    return parsed.selectExpr(
        "process", "d.validate as validate", "coalesce(lower(d.sync) = 'true', false) as sync", "nullif(d.targetsRestrict, '') as restrict",
        "d is null or d.bad is not null as bad",
        f"transform(coalesce(d.targets, {no_targets}), t -> {target}) as targets",
    )


def destinations(target_path: str) -> str:
    """A destination field is one text or a JSON list of texts."""
    listed = f"case when startswith(ltrim({target_path}), '[') then from_json({target_path}, 'array<string>') end"
    return f"transform(coalesce({listed}, array({target_path})), u -> coalesce(u, 'null'))"


def pipelines(parsed: DataFrame) -> DataFrame:
    """One row per route with the flat list of its pipelines.

    ``kind`` is ``path`` for a transformation path, ``reply`` for the reply a
    target asks for before its paths, ``empty`` for a target without paths.
    """

    def entry(kind: str, path: str, steps: str) -> str:
        return (
            f"named_struct('kind', '{kind}', 'tpos', tpos, 'target_id', t.id, 'path', {path}, 'steps', {steps},"
            " 'urls', t.urls, 'output', t.output, 'response', t.response, 'input', t.input, 'sync', t.sync, 'root', t.root)"
        )

    none, no_path = "cast(array() as array<string>)", "cast(null as int)"
    reply, empty = entry("reply", no_path, none), entry("empty", no_path, none)
    paths = f"transform(t.paths, (s, i) -> {entry('path', 'i', f'coalesce(s, {none})')})"
    of_target = (
        f"concat(filter(array({reply}), r -> t.reply), filter(array({empty}), e -> size(t.paths) = 0), {paths})"
    )
    return parsed.selectExpr(
        "process", "validate", "sync", "restrict", "bad", f"flatten(transform(targets, (t, tpos) -> {of_target})) as pipelines"
    )


def split_step(step: str) -> tuple[str, str]:
    """Step text to its name and its key/value entries (value null if missing).

    Only the first ``://`` and the first ``=`` of a pair separate.
    """
    query = f"substring(coalesce(get(split({step}, '://', 2), 1), ''), 2)"
    pairs = f"filter(array({query}), q -> q <> '')"
    pairs = f"flatten(transform({pairs}, q -> split(regexp_replace(q, {lit('&+$')}, ''), '&')))"
    entry = "named_struct('key', trim(substring_index(p, '=', 1)), 'value', trim(nullif(get(split(p, '=', 2), 1), '')))"
    return f"split({step}, '://', 2)[0]", f"transform({pairs}, p -> {entry})"


def steps(parsed: DataFrame) -> DataFrame:
    """The step table: one row per stage of every path of every target."""
    name, entries = split_step("step")
    return (
        parsed.selectExpr("process", "posexplode(targets) as (target_pos, t)")
        .selectExpr("process", "target_pos", "t.id as target_id", "posexplode(t.paths) as (path, texts)")
        .selectExpr("process", "target_pos", "target_id", "path", "posexplode(texts) as (stage, step)")
        .selectExpr(
            "process", "target_pos", "target_id", "path", "stage", "step",
            f"{name} as name", f"{unique_entries(entries)} as params",
        )
    )
