"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from catalog.inputs import document_messages, order_messages, run, table
from catalog.queries import FIRST_PASS, QUERIES
from waybill import Settings
from waybill.operators.lookup import multi_lookup
from waybill.session import heavy_keys, lookup_join

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def first_pass(spark):
    return run(spark, order_messages(spark, DATA), FIRST_PASS)


def test_one_broadcast_and_no_shuffle_beyond_the_spread(first_pass):
    plan = plan_of(first_pass.routed())
    assert plan.count("BroadcastHashJoin") == 1
    # The one shuffle brings the registry to one document per process; messages stay where they are.
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(process") == plan.count("hashpartitioning") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_schema_check_runs_once_and_before_the_fan_out(first_pass):
    plan = plan_of(first_pass.routed())
    assert plan.count("content is not valid against order") == 1
    assert plan.index("Generate explode(CASE WHEN isnull(error") < plan.index("content is not valid against order")


def test_route_filter_stays_above_the_stages(first_pass):
    plan = plan_of(first_pass.routed().where("route = 'failed'"))
    assert plan.count("content is not valid against order") == 1
    assert sum(line.lstrip(" +-:*").startswith("Filter") for line in plan.splitlines()) == 1
    assert plan.index("- Filter") < plan.index("Generate")


def test_unused_columns_are_pruned(first_pass):
    plan = plan_of(first_pass.routed().select("target_id", "route"))
    assert "map_concat" not in plan and "regexp_replace(content" not in plan.split("Generate")[0]
    audit = plan_of(first_pass.lineage())
    assert "target_url" not in audit


def test_scan_reads_only_what_the_messages_need(first_pass):
    plan = plan_of(first_pass.routed())
    assert "o_orderdate" not in plan.split("ReadSchema")[1]


def test_only_ordered_json_needs_python(spark):
    docs = {"documents": FIRST_PASS["5-LOW"]}
    messages = document_messages(spark, DATA)
    assert "ArrowEvalPython" not in plan_of(run(spark, messages, docs).routed())
    assert "ArrowEvalPython" in plan_of(run(spark, messages, docs, Settings(ordered_json=True)).routed())


def exchanged(df):
    """The columns that each shuffle of a plan moves."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [block.split("]", 2)[1] for block in text.split("\n\n") if re.match(r"\(\d+\) Exchange", block.strip())]


@pytest.mark.parametrize("keys", ["${cust}", "${cust},${order.id}", ",".join(["${cust}"] * 40)])
def test_multi_lookup_moves_no_content(spark, keys):
    names = table(spark, DATA, "customer").selectExpr("cast(c_custkey as string) as key", "c_name as value")
    found = multi_lookup(order_messages(spark, DATA), keys, names, attribute="v")
    assert "SortMergeJoin" not in plan_of(found)
    assert not any("o_orderstatus" in columns or "o_totalprice" in columns or "content" in columns for columns in exchanged(found))


def test_heavy_keys_spread_over_tasks(spark):
    """Half of all rows have one key and a tenth none; every task still gets about its share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        key = "case when id % 2 = 0 then 'hot' when id % 10 = 1 then null else cast(id % 5000 as string) end"
        left = spark.range(160_000).selectExpr("cast(id as string) as msg_id", f"{key} as k")
        right = spark.range(5000).selectExpr("cast(id as string) as k", "id as v").unionByName(
            spark.createDataFrame([("hot", -1)], "k string, v long"))
        assert heavy_keys(left, "k") == {"hot": 128, None: 26}
        joined = lookup_join(left, right, "k", limit=0, salt_by=F.col("msg_id"))
        plan = plan_of(joined)
        assert plan.count("SortMergeJoin") == 1 and "hashpartitioning(k#" in plan and "__salt" in plan
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 160_000 and max(sizes) <= 2 * 10_000
        assert joined.where("k = 'hot' and v = -1").count() == 80_000
        assert joined.where("k is null and v is null").count() == 16_000
        assert joined.where("k <> 'hot' and cast(v as string) = k").count() == 64_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_large_registry_reads_the_messages_once(spark):
    plan = plan_of(QUERIES["registry_in_several_plans"](spark, DATA))
    reads = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("p_size" in line for line in reads) == 1 and plan.count("Union") == 0
    # The plan holds none of the registry's texts.
    assert "Brand#" not in plan and len(plan) < 60_000


def test_suppressed_targets_stop_without_moving_contents(spark):
    plan = QUERIES["filter_ends_target"](spark, DATA)
    assert "Window" not in plan_of(plan) and "SortMergeJoin" not in plan_of(plan)
    assert not any("content" in columns for columns in exchanged(plan))


def test_every_query_has_sql():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
