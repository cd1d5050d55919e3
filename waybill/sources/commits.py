"""Batches whose tables appear together.

Each try to write a batch has folders of its own. A manifest, put in place when
all tables are written, names the try that counts; readers follow manifests, so
they see all tables of a batch or none, however often it was begun.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFEST = "batch long, attempt string, tables array<struct<name:string,schema:string>>"


class _Files:
    """The file system a path is in, as Spark sees it."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.base = spark._jvm, base
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(name))] if self.exists(name) else []

    def put(self, name: str, text: str) -> None:
        """Write beside the place and move there, so that nobody reads half a file."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        out = self.fs.create(self.path(part), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if not self.fs.rename(self.path(part), self.path(name)):
            raise OSError(f"cannot write {self.base}/{name}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest(number: int) -> str:
    return f"commits/{number:012d}.json"


def is_committed(spark: SparkSession, base: str, number: int) -> bool:
    return _Files(spark, base).exists(_manifest(number))


def commit_batch(
    spark: SparkSession, base: str, number: int, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None,
) -> bool:
    """Write the tables of a batch under ``base`` and let them appear at once; False if the batch is there already."""
    files = _Files(spark, base)
    if files.exists(_manifest(number)):
        return False
    attempt = f"a{uuid.uuid4().hex}"
    for name, df in tables.items():
        writer = df.write.partitionBy(*(partition_by or {}).get(name, []))
        writer.parquet(f"{base}/{name}/batch={number}/attempt={attempt}")
    listed = [{"name": name, "schema": df.schema.json()} for name, df in tables.items()]
    files.put(_manifest(number), json.dumps({"batch": number, "attempt": attempt, "tables": listed}))
    return True


def committed(spark: SparkSession, base: str, since: int = 0) -> list:
    """The manifests from batch ``since`` on, in order: a small row per batch."""
    if not any(n.endswith(".json") for n in _Files(spark, base).names("commits")):
        return []
    found = spark.read.schema(_MANIFEST).option("pathGlobFilter", "*.json").json(f"{base}/commits")
    return found.where(f"batch >= {since}").orderBy("batch").collect()


def read_batches(spark: SparkSession, base: str, table: str, since: int = 0) -> DataFrame:
    """One table of all committed batches, with the column ``batch``; rows of unfinished tries are not seen."""
    held = [(m["batch"], m["attempt"], t["schema"]) for m in committed(spark, base, since) for t in m["tables"] if t["name"] == table]
    if not held:
        raise FileNotFoundError(f"no committed batch of {table} in {base}")
    schema = T.StructType.fromJson(json.loads(held[-1][2]))
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())])
    paths = [f"{base}/{table}/batch={number}/attempt={attempt}" for number, attempt, _ in held]
    return spark.read.schema(whole).option("basePath", f"{base}/{table}").parquet(*paths).select(*schema.names, "batch")


def remove_leftovers(spark: SparkSession, base: str) -> int:
    """Delete the tries that lost: those of committed batches that no manifest names. Running tries are left alone."""
    files, removed = _Files(spark, base), 0
    for manifest in committed(spark, base):
        for table in manifest["tables"]:
            folder = f"{table['name']}/batch={manifest['batch']}"
            for name in files.names(folder):
                if name.startswith("attempt=") and name != f"attempt={manifest['attempt']}":
                    files.remove(f"{folder}/{name}")
                    removed += 1
    return removed
