"""Message tables: ``msg_id``, ``content`` text, ``attrs`` string map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waybill.functions.text import decoded

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("msg_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    ]
)

BINARY_SCHEMA = T.StructType([f if f.name != "content" else T.StructField("content", T.BinaryType()) for f in MESSAGE_SCHEMA.fields])


def messages(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    charset: str | None = None,
) -> DataFrame:
    """Read a message table, once or as a stream of new files.

    With ``charset`` the stored content is bytes in that charset.
    """
    schema = BINARY_SCHEMA if charset else MESSAGE_SCHEMA
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(schema)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return as_messages(reader.load(path), charset or "UTF-8")


def kafka_messages(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Messages from Kafka: the value is the content, the headers are the attributes."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    raw = reader.options(**options).option("includeHeaders", "true").load()
    none = "cast(array() as array<struct<key:string,value:binary>>)"
    entries = f"transform(coalesce(headers, {none}), h -> named_struct('key', h.key, 'value', {decoded('h.value')}))"
    return raw.selectExpr(
        "concat_ws('-', topic, partition, offset) as msg_id",
        f"{decoded('value')} as content",
        f"{unique_entries(entries)} as attrs",
    )


def unique_entries(entries: str) -> str:
    """Map from an array of key/value structs where the last entry of a key wins."""
    return (
        f"map_from_entries(filter({entries}, (e, i) -> not exists("
        f"slice({entries}, i + 2, size({entries})), later -> later.key = e.key)))"
    )


EMPTY_MAP = "map_from_arrays(cast(array() as array<string>), cast(array() as array<string>))"


def as_messages(df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Bring a table to the message columns; binary content is decoded."""
    binary = isinstance(df.schema["content"].dataType, T.BinaryType)
    return df.selectExpr(
        "cast(msg_id as string) as msg_id",
        f"{decoded('content', charset) if binary else 'content'} as content",
        f"coalesce(attrs, {EMPTY_MAP}) as attrs",
    )
