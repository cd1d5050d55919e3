"""Routed output: one partition folder per route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.sources.records import resolved

ROUTES = ("deliver", "reply", "parked", "failed")


def write_routes(routed: DataFrame, base: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Write all routes in one pass; each becomes its own ``route=`` folder. What is there already is only replaced if ``mode`` says so."""
    routed.write.mode(mode).partitionBy("route").format(fmt).save(base)


def read_route(spark: SparkSession, base: str, route: str, fmt: str = "parquet") -> DataFrame:
    """One route back from :func:`write_routes`; only its folder is read."""
    if route not in ROUTES:
        raise ValueError(f"unknown route {route}")
    return spark.read.format(fmt).load(base).where(F.col("route") == route)


def returned_messages(parked: DataFrame) -> DataFrame:
    """Parked rows as messages again, ready for the resume pass."""
    return parked.select(F.col("lineage").alias("msg_id"), "content", "attrs")


def reformat(
    spark: SparkSession,
    source: str,
    source_fmt: str,
    target: str,
    target_fmt: str,
    schema: str | None = None,
    target_columns: list[str] | None = None,
    source_options: dict[str, str] | None = None,
    target_options: dict[str, str] | None = None,
    mode: str = "errorifexists",
    writer_schema: str | None = None,
    defaults: dict[str, str] | None = None,
    aliases: dict[str, list[str]] | None = None,
    rejects: str | None = None,
) -> None:
    """Records of one format and schema to another.

    ``schema`` reads, ``writer_schema`` writes; see ``resolved`` for how the one
    becomes the other. Records that cannot are written as Parquet to ``rejects``;
    without that folder the first of them ends the job.
    """
    reader = spark.read.format(source_fmt).options(**(source_options or {}))
    df = (reader.schema(schema) if schema else reader).load(source)
    if target_columns:
        df = df.select(*target_columns)
    if writer_schema:
        good, bad = resolved(df, writer_schema, defaults, aliases)
        if rejects:
            bad.write.mode(mode).parquet(rejects)
        else:
            refused = bad.select(F.raise_error(F.concat(F.lit("a record that cannot be written: "), F.array_join("problems", "; "))).alias("x"))
            good = good.unionByName(refused.where("x is null").selectExpr(*[f"cast(null as {t}) as `{c}`" for c, t in good.dtypes]))
        df = good
    df.write.format(target_fmt).options(**(target_options or {})).mode(mode).save(target)
