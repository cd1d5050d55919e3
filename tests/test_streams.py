"""Batches that appear whole, and parked rows that meet their returns."""

import datetime
import time
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from tests.helpers import message_table, one_path, registries
from waybill import messages, route_messages, session
from waybill.sources import commits
from waybill.sources.commits import commit_batch, read_batches, remove_leftovers
from waybill.streaming.route import dropped_late, match_returns, resume_stream, route_stream

PARK = one_path("RouteOnContent://?MatchRequirement=m&RouteCondition=c", "UpdateAttribute://?b=${seen}!")


def test_a_stop_between_two_writes_shows_nothing(spark, tmp_path):
    base = str(tmp_path)
    good = spark.range(10).withColumn("route", F.lit("a"))
    broken = spark.range(4).select(F.raise_error(F.lit("stop")).cast("string").alias("x"))
    with pytest.raises(FileNotFoundError):
        read_batches(spark, base, "one")
    with pytest.raises(PySparkException):
        commit_batch(spark, base, 0, {"one": good, "two": broken}, {"one": ["route"]})
    # The first table is written in full, but nobody sees it.
    assert list((tmp_path / "one").rglob("*.parquet")) and not (tmp_path / "commits").exists()
    with pytest.raises(FileNotFoundError):
        read_batches(spark, base, "one")
    assert commit_batch(spark, base, 0, {"one": good, "two": good}, {"one": ["route"]})
    assert read_batches(spark, base, "one").count() == read_batches(spark, base, "two").count() == 10
    with pytest.raises(PySparkException):
        commit_batch(spark, base, 1, {"one": good, "two": broken}, {"one": ["route"]})
    assert read_batches(spark, base, "one").count() == 10
    # Again is no second copy, and an empty table keeps its columns.
    assert not commit_batch(spark, base, 0, {"one": good, "two": good})
    assert commit_batch(spark, base, 1, {"one": good.limit(0), "two": good}, {"one": ["route"]})
    rows = read_batches(spark, base, "one")
    assert rows.count() == 10 and rows.columns == ["id", "route", "batch"] and read_batches(spark, base, "two", since=1).count() == 10
    assert remove_leftovers(spark, base) == 4 and remove_leftovers(spark, base) == 0
    assert read_batches(spark, base, "one").count() == 10 and read_batches(spark, base, "two").count() == 20


def test_a_stream_that_stops_before_its_manifest_gives_each_row_once(spark, tmp_path, monkeypatch):
    routes, schemas = registries(spark, {"p": one_path("Pass")})
    source, base, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    message_table(spark, [(f"m{i}", "<a/>", {"business.process.name": "p"}) for i in range(20)]).repartition(2).write.parquet(source)
    tables = lambda: {"routes": routes, "schemas": schemas}
    put, stops = commits._Files.put, [1]

    def stopping(self, name, text):
        if stops and name.endswith("1.json"):
            raise OSError(f"stopped at {stops.pop()}")
        put(self, name, text)

    monkeypatch.setattr(commits._Files, "put", stopping)
    start = lambda: route_stream(messages(spark, source, True, max_files_per_trigger=1), tables, base, check)
    with pytest.raises(PySparkException):
        start().awaitTermination(300)
    seen = read_batches(spark, base, "routed")
    assert seen.select("batch").distinct().count() == 1 and 0 < seen.count() < 20
    start().awaitTermination(300)
    rows = read_batches(spark, base, "routed")
    assert rows.count() == rows.select("lineage").distinct().count() == 20
    assert read_batches(spark, base, "lineage").where("kind = 'destination'").count() == 20
    assert remove_leftovers(spark, base) > 0 and read_batches(spark, base, "routed").count() == 20


AT = datetime.datetime(2024, 5, 1, 12)


def hours(n):
    return AT + datetime.timedelta(hours=n)


def test_returns_meet_what_waits(spark):
    attrs = {"business.process.name": "p", "k": "old"}
    parked = spark.createDataFrame(
        [(n, f"c-{n}", attrs, AT) for n in ("back", "late", "never", "early", "null")],
        "lineage string, content string, attrs map<string,string>, parked_at timestamp")
    returns = spark.createDataFrame(
        [("back", "new", {"k": "new"}, hours(0.5)), ("late", "new", {"k": "new"}, hours(3)), ("early", "x", {"k": "x"}, hours(-1)),
         ("stray", "s", {"k": "s"}, hours(0.1)), ("null", None, {"k": None}, hours(1))],
        "msg_id string, content string, attrs map<string,string>, returned_at timestamp")
    got = sorted(((r.msg_id, r.content, r.attrs["k"], (r.problem or "").split(": ")[-1]) for r in match_returns(parked, returns).collect()), key=str)
    lost, stray = "not returned within 1 hour", "returned unexpectedly or too late"
    assert got == sorted([
        ("back", "new", "new", ""), ("null", None, None, ""), ("late", "c-late", "old", lost), ("late", "new", "new", stray),
        ("never", "c-never", "old", lost), ("early", "c-early", "old", lost), ("early", "x", "x", stray), ("stray", "s", "s", stray)], key=str)


RETURN = "msg_id string, content string, attrs map<string,string>, returned_at timestamp"
WHEN = "cast(attrs['at'] as timestamp)"


class Parking:
    """Twelve messages that park, all but one of which come back, and a last row that moves the watermarks."""

    def __init__(self, spark, path, end_first):
        self.spark, self.base, self.source, self.back = spark, str(path / "out"), str(path / "in"), str(path / "back")
        self.routes, self.schemas = registries(spark, {"p": PARK})
        rows = [(f"m{i}", "<a/>", {"business.process.name": "p", "at": str(hours(i / 10))}) for i in range(12)]
        ends = [("end", "<a/>", {"business.process.name": "p", "at": "2099-01-01 00:00:00"})]
        again = [("again", *ends[0][1:])]
        for part in (ends, again, rows) if end_first else (rows, ends):  # a batch's rows are held against the watermark before it
            message_table(spark, part).coalesce(1).write.mode("append").parquet(self.source)
            time.sleep(1.1)  # files are read in the order of their times
        parked = route_messages(messages(spark, self.source), self.routes, self.schemas).routed().where("route = 'parked'")
        self.parked = parked.selectExpr("lineage", "content", "attrs", f"{WHEN} as parked_at")
        self.parked.where("lineage not like 'm3/%' and attrs['at'] < '2099'").selectExpr(
            "lineage as msg_id", "content", "map_concat(attrs, map('seen', lineage)) as attrs", "parked_at + interval 1 minute as returned_at",
        ).unionByName(spark.sql("select 'x' as msg_id, '' as content, map('a', 'b') as attrs, timestamp'2099-01-01' as returned_at")
        ).coalesce(1).write.parquet(self.back)

    def run(self, path):
        stream = route_messages(messages(self.spark, self.source, True, max_files_per_trigger=1), self.routes, self.schemas).routed()
        waiting = stream.where("route = 'parked'").selectExpr("lineage", "content", "attrs", f"{WHEN} as parked_at")
        returns = self.spark.readStream.schema(RETURN).parquet(self.back)
        query = resume_stream(waiting, returns, lambda: {"routes": self.routes, "schemas": self.schemas}, self.base, str(path / "check"))
        query.awaitTermination(300)
        return read_batches(self.spark, self.base, "routed")


def test_resumed_stream_equals_the_batch(spark, tmp_path):
    case = Parking(spark, tmp_path, end_first=False)
    got = case.run(tmp_path)
    returns = spark.read.parquet(case.back)
    straight = {r.lineage: r.attrs["b"] for r in route_messages(
        returns.where("msg_id <> 'x'").drop("returned_at"), case.routes, case.schemas).routed().collect()}
    assert {r.lineage: r.attrs["b"] for r in got.where("route = 'deliver'").collect()} == straight and len(straight) == 11
    (lost,) = got.where("route = 'failed'").collect()
    assert lost.msg_id == "m3/0/0/0/0" and "not returned" in lost.attrs["error.msg"]
    tables = {t: read_batches(spark, case.base, t).count() for t in ("lineage", "suppressed")}
    assert tables["lineage"] >= 22 and tables["suppressed"] == 0
    assert dropped_late(case.parked, returns, got, "2098-01-01").count() == 0


def test_rows_behind_the_watermark_are_found(spark, tmp_path):
    case = Parking(spark, tmp_path, end_first=True)
    got = case.run(tmp_path)
    assert got.where("route = 'deliver'").count() == 0
    late = dropped_late(case.parked, spark.read.parquet(case.back), got, "2098-01-01")
    rows = late.unionByName(got.drop("batch")).where("route = 'failed'").collect()
    # Each parked row and each return has one outcome; the last ones still wait.
    assert len(rows) == 12 + 11 and {r.msg_id.split("/")[0] for r in rows} == {f"m{i}" for i in range(12)}
    assert late.columns == got.drop("batch").columns and dropped_late(case.parked, spark.read.parquet(case.back), got, "2024-01-01").count() == 0


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def test_what_waits_is_kept_on_disk(spark, tmp_path):
    assert Parking(spark, tmp_path, end_first=False).run(tmp_path).count() == 12
    offsets = [p.read_text() for p in (tmp_path / "check" / "offsets").iterdir() if p.name.isdigit()]
    assert offsets and all("RocksDBStateStoreProvider" in text for text in offsets)
    # Only that query was told so.
    assert spark.conf.get(PROVIDER, None) is None


def test_a_stream_goes_on_with_the_store_it_began_with(spark, tmp_path):
    case = Parking(spark, tmp_path, end_first=False)
    spark.conf.set(PROVIDER, ON_HEAP)
    try:
        assert case.run(tmp_path).count() == 12
    finally:
        spark.conf.unset(PROVIDER)
    rows = [(n, "<a/>", {"business.process.name": "p", "at": f"2101-01-0{i} 00:00:00"}) for i, n in enumerate(("next", "last"), 1)]
    for row in rows:
        message_table(spark, [row]).coalesce(1).write.mode("append").parquet(case.source)
    spark.sql("select 'y' as msg_id, '' as content, map('a', 'b') as attrs, timestamp'2101-01-02' as returned_at").coalesce(1).write.mode("append").parquet(case.back)
    got = case.run(tmp_path)
    # Two more have waited too long: the one that the first run left in its state and the next.
    assert {r.msg_id.split("/")[0] for r in got.where("batch > 0 and route = 'failed' and error like '%not returned%'").collect()} >= {"end", "next"}
    texts = [p.read_text() for p in (tmp_path / "check" / "offsets").iterdir() if p.name.isdigit()]
    assert all("RocksDB" not in text for text in texts)


def test_the_stream_of_returns_reads_even_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    rows = spark.range(60).selectExpr(
        "id as event_id", "if(id % 5 = 0, 'error', 'click') as event_type", "id % 7 as user_id", "id / 4 as value", "timestamp'2026-01-01' as ts")
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    before = set(Path(session.shared_dir(spark)).glob("returns-*"))
    got = QUERIES["park_return_stream"](spark, str(tmp_path))
    assert got.where("msg_id like 'e%'").select("msg_id").distinct().count() == 48
    (base,) = set(Path(session.shared_dir(spark)).glob("returns-*")) - before
    # Six even files and the one of the last row.
    assert len(list((base / "in").glob("*.parquet"))) == 7
