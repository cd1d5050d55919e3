"""Schema resolution, and counts taken while rows are written."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import one_path, run
from waybill import reformat
from waybill.sources.records import resolved

WANT = "id bigint not null, n double, d decimal(5,1), day date, t string, sub struct<a: int not null, b: string>, list array<struct<x: tinyint>>, m map<string,int>, more string not null"


def test_records_meet_by_name_and_rejects_name_each_field(spark):
    have = "t int, id int, n float, d string, day timestamp, sub struct<a: string, extra: int>, items array<struct<x: int, y: int>>, m map<string,string>, junk int"
    rows = [
        (7, 1, 1.5, "2.5", None, ("3", 9), [(1, 2), (None, 3)], {"k": "4"}, 0),
        (None, None, None, None, None, None, None, None, None),
        (8, 2, 0.0, "2.55", None, ("x", 1), [(300, 0), (-300, 0)], {"k": "y"}, 0),
        (9, 3, 0.0, None, None, (None, 1), [], {}, 0),
    ]
    df = spark.createDataFrame(rows, have).withColumn("day", F.expr(
        "case id when 1 then timestamp'2024-01-02 00:00:00' when 2 then timestamp'2024-01-02 03:00:00' end"))
    good, bad = resolved(df, WANT, defaults={"more": "'std'"}, aliases={"list": ["items"]})
    assert [f.simpleString() for f in good.schema] == [
        "id:bigint", "n:double", "d:decimal(5,1)", "day:date", "t:string", "sub:struct<a:int,b:string>", "list:array<struct<x:tinyint>>", "m:map<string,int>", "more:string"]
    (row,) = good.collect()
    assert (row.id, row.n, str(row.d), str(row.day), row.t, tuple(row["sub"]), [x.x for x in row["list"]], row.m, row.more) == (
        1, 1.5, "2.5", "2024-01-02", "7", (3, None), [1, None], {"k": 4}, "std")
    found = {json.loads(r.record).get("id"): sorted(r.problems) for r in bad.collect()}
    assert found == {
        None: ["id: no value"], 3: ["sub.a: no value"],
        2: sorted(["d: 2.55 is no decimal(5,1)", "day: 2024-01-02 03:00:00 is no date", "sub.a: x is no int", "list.x: 300 is no tinyint",
                   "list.x: -300 is no tinyint", "m: y is no int"])}
    assert resolved(df.limit(0), WANT, {"more": "'x'"})[0].count() == 0
    missing = resolved(df, "id int, gone int not null")[1].collect()
    assert len(missing) == 4 and all("gone: no value" in r.problems for r in missing)
    assert resolved(df, "sub array<int>")[1].count() == 3  # a record is no array


def test_reformat_writes_rejects_or_stops(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("1", "a"), ("x", "b")], "id string, t string").write.json(source)
    with pytest.raises(PySparkException, match="x is no int"):
        reformat(spark, source, "json", out, "parquet", schema="id string, t string", writer_schema="id int, t string")
    reformat(spark, source, "json", f"{out}2", "parquet", schema="id string, t string", writer_schema="id int, t string", rejects=f"{out}-bad")
    assert [tuple(r) for r in spark.read.parquet(f"{out}2").collect()] == [(1, "a")]
    assert spark.read.parquet(f"{out}-bad").first().problems == ["id: x is no int"]


def test_steps_are_counted_while_rows_are_written(spark, tmp_path):
    cases = {
        "a": (one_path("Pass", "DuplicateFlowFile://?Number=2", "Custom://?k=1"), "<a/>"), "b": (one_path("Pass", "Pass"), "<a/>"),
        "c": (one_path("Pass", "RouteOnAttribute://?RoutingStrategy=r&Condition=false", "Custom"), "<a/>"), "d": (None, "<a/>"),
    }
    planned = run(spark, cases)
    spark.sparkContext.setJobGroup("counted", "")
    got = planned.materialised(str(tmp_path / "rows"), count=["Pass", "Custom", "RouteOnAttribute", "Nothing"])
    # One job fills the broadcast and one writes; the counts come with it.
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("others", "")
    receivers = spark.createDataFrame([("x", "y")], "uri string, receiver string")
    audit = {r["step"]: r["count"] for r in got.audit(receivers).where("entry_type = 'processing'").groupBy("step").count().collect()}
    assert got.step_counts == {"Pass": 4, "Custom": 3, "RouteOnAttribute": 1, "Nothing": 0} and audit == {k: v for k, v in got.step_counts.items() if v}
    planned.materialised(str(tmp_path / "plain"))
    assert planned.step_counts is None and jobs <= 3
