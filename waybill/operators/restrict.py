"""Targets a message itself permits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.render import case, lit
from waybill.functions.xmlfn import well_formed
from waybill.functions.xpath import field_values, pack_paths, xpath_fields, xpath_problem


def with_permitted(df: DataFrame, path: str) -> DataFrame:
    """Add ``permitted``: the values of ``path`` in the content. Call it before the fan-out."""
    (at,) = pack_paths([path])
    work = df.withColumn("__good", F.expr(well_formed(df.sparkSession, "content")))
    work = work.withColumn("__fields", F.expr(f"case when __good then {xpath_fields('content', [at])} end"))
    listed = f"case when __good then {field_values('__fields', 'content', at)} end"
    return work.withColumn("permitted", F.expr(listed)).drop("__good", "__fields")


def fan_out_permitted(df: DataFrame, targets: str, alias: str = "target_id") -> DataFrame:
    """One row per permitted target of the array ``targets``.

    A message that names no target permits all of them.
    """
    everyone = "permitted is null or size(permitted) = 0"
    chosen = f"case when {everyone} then {targets} else filter({targets}, t -> array_contains(permitted, t)) end"
    return df.selectExpr("*", f"explode({chosen}) as {alias}").drop("permitted")


def restricted(df: DataFrame, paths: list[str]) -> DataFrame:
    """Keep the pipelines of targets that the content names by its route's ``restrict``, an XPath.

    ``df`` has admitted messages. A message that names no target goes to all of
    them; one that names only others fails. Messages on their way back are not asked again.
    """
    if not paths:
        return df
    asked = "first and error is null and restrict"
    problems = {path: problem for path in paths if (problem := xpath_problem(df.sparkSession, path, nodes=True))}
    good = {path: pack_paths([path])[0] for path in paths if path not in problems}
    fields = case([(f"{asked} = {lit(path)}", xpath_fields("content", [at])) for path, at in good.items()])
    listed = case([(f"{asked} = {lit(path)}", field_values("__fields", "content", at)) for path, at in good.items()])
    wrong = case([(f"{asked} = {lit(path)}", lit(problem)) for path, problem in problems.items()], "error")
    kept = "case when size(__listed) > 0 then filter(pipelines, p -> array_contains(__listed, p.target_id)) else pipelines end"
    named = df.withColumn("__fields", F.expr(fields)).withColumn("__listed", F.expr(listed))
    named = named.withColumns({"pipelines": F.expr(kept), "error": F.expr(wrong)})
    none = "case when size(__listed) > 0 and size(pipelines) = 0 then 'no permitted targets' else error end"
    return named.withColumn("error", F.expr(none)).drop("__fields", "__listed")


def content_matches(content: str, condition: str, requirement: str = "content must contain match") -> str:
    """Whether the content meets a parked condition: a match anywhere, or of the whole. An illegal pattern meets none."""
    part = f"concat('(?s:.*?)(?:', {condition}, ')(?s:.*)')"
    pattern = part if requirement == "content must contain match" else condition
    called = f"try_reflect('java.util.regex.Pattern', 'matches', {pattern}, {content})"
    return f"case when {content} is not null and {condition} is not null then coalesce(cast({called} as boolean), false) end"
