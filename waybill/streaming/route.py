"""The routing plan over streams: micro-batches that appear whole, and parked rows that meet their returns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.functions.render import lit
from waybill.operators.lookup import failed_rows
from waybill.plans.context import Settings, merged
from waybill.plans.routing import RouteRun, route_messages
from waybill.sources.commits import _Files, commit_batch, is_committed

Registries = Callable[[], dict[str, DataFrame]]


def route_stream(
    stream: DataFrame,
    registries: Registries,
    base: str,
    checkpoint: str,
    settings: Settings | None = None,
    audit: bool = True,
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Route every micro-batch of ``stream`` to the tables ``routed``, ``lineage``, ``suppressed`` and ``audit`` under ``base``.

    ``registries`` is called per batch, so edits take effect; it returns
    ``routes`` and ``schemas``, and ``reshapes`` and ``receivers`` if wanted; the
    audit table needs the last. All tables of a batch appear together
    (``read_batches``), also when it has to be run again. ``partitions`` deals the
    rows of a batch out anew, for sources that give few and small splits.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        tables = registries()
        if partitions:
            batch = batch.repartition(partitions)
        run = route_messages(batch, tables["routes"], tables["schemas"], tables.get("reshapes"), settings)
        _commit(run, base, number, tables.get("receivers") if audit else None)

    return _started(stream, one_batch, checkpoint, trigger, base)


def _started(stream: DataFrame, one_batch: Callable, checkpoint: str, trigger: dict | None, base: str) -> StreamingQuery:
    def unless_done(batch: DataFrame, number: int) -> None:
        if not is_committed(batch.sparkSession, base, number):
            one_batch(batch, number)

    return (
        stream.writeStream.foreachBatch(unless_done)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _commit(run: RouteRun, base: str, number: int, receivers: DataFrame | None, failed: DataFrame | None = None) -> None:
    """All tables from one pass: the rows stay in a folder of this try until the batch is committed."""
    rows = f"rows/batch={number}-{uuid.uuid4().hex}"
    run = run.materialised(f"{base}/{rows}")
    spark = run.waves[0].df.sparkSession
    routed = run.routed()
    tables = {
        "routed": routed if failed is None else routed.unionByName(failed),
        "lineage": run.lineage(), "suppressed": run.suppressed(),
    }
    if receivers is not None:
        tables["audit"] = run.audit(receivers)
    commit_batch(spark, base, number, tables, {"routed": ["route"]})
    _Files(spark, base).remove(rows)


_STORE = "spark.sql.streaming.stateStore"
# The default store keeps all state of an executor's tasks as objects on its heap. This one keeps it in files on the
# executor's disk, with a bounded cache (500 MB an executor, if ``maxMemoryUsageMB`` doesn't say otherwise).
STATE_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    # One store for each task of the join in place of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start meanwhile keep their state on disk, unless the session names a store itself."""
    if spark.conf.get(f"{_STORE}.providerClass", None):
        yield
        return
    ours = {key: value for key, value in STATE_ON_DISK.items() if spark.conf.get(key, None) is None}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)


# Why a parked row or a return has no pair.
_LOST = "java.util.concurrent.TimeoutException: not returned within"
_STRAY = "java.lang.IllegalStateException: returned unexpectedly or too late"
_DROPPED = "java.lang.IllegalStateException: reached the stream behind its watermark"


def match_returns(parked: DataFrame, returns: DataFrame, timeout: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Parked rows (``lineage``, ``content``, ``attrs``, ``parked_at``) with their returns (``msg_id``, ``content``, ``attrs``, ``returned_at``).

    Gives messages ready for the resume pass, the returned content and attributes
    over the parked ones, and ``problem``: null for a pair, else why there is none.
    Both may be streams: rows wait in the join's state until their return comes or
    the watermark (``delay`` behind the latest times of both streams) has passed
    ``timeout``; so state is bounded by what is parked in that time. A return that
    nothing waits for, for it is too late or unknown, is a row with a problem too.
    Rows that reach a stream later than ``delay`` allows never get to the join;
    ``dropped_late`` finds them.
    """
    one = parked.withWatermark("parked_at", delay).selectExpr("lineage as p_id", "content as p_content", "attrs as p_attrs", "parked_at")
    two = returns.withWatermark("returned_at", delay).selectExpr("msg_id as r_id", "content as r_content", "attrs as r_attrs", "returned_at")
    on = F.expr(f"p_id = r_id and returned_at >= parked_at and returned_at <= parked_at + interval {timeout}")
    lost, stray = lit(f"{_LOST} {timeout}"), lit(_STRAY)
    return one.join(two, on, "full_outer").selectExpr(
        "coalesce(r_id, p_id) as msg_id", "case when r_id is null then p_content else r_content end as content",
        f"case when r_id is null then p_attrs when p_id is null then r_attrs else {merged('p_attrs', 'r_attrs')} end as attrs",
        f"case when r_id is null then {lost} when p_id is null then {stray} end as problem")


def resume_stream(
    parked: DataFrame,
    returns: DataFrame,
    registries: Registries,
    base: str,
    checkpoint: str,
    settings: Settings | None = None,
    timeout: str = "1 hour",
    delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Resume parked rows as their returns come in; those that never or wrongly return go to the failed route.

    See ``match_returns`` for the two streams and ``route_stream`` for the tables. What waits is kept
    on the executors' disks (``STATE_ON_DISK``); a checkpoint goes on with the store it began with.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        spark, tables = batch.sparkSession, registries()
        # Good and bad rows are read from one written copy, so the join's state is used once.
        folder = f"matched/batch={number}-{uuid.uuid4().hex}"
        batch.write.parquet(f"{base}/{folder}")
        both = spark.read.schema(batch.schema).parquet(f"{base}/{folder}")
        run = route_messages(both.where("problem is null").drop("problem"), tables["routes"], tables["schemas"], tables.get("reshapes"), settings)
        _commit(run, base, number, tables.get("receivers"), failed_rows(both.where("problem is not null"), "problem"))
        _Files(spark, base).remove(folder)

    with _state_on_disk(parked.sparkSession):
        return _started(match_returns(parked, returns, timeout, delay), one_batch, checkpoint, trigger, base)


def dropped_late(parked: DataFrame, returns: DataFrame, routed: DataFrame, watermark: str, timeout: str = "1 hour") -> DataFrame:
    """Rows that a ``resume_stream`` dropped for they were behind its watermark, as failed rows.

    ``parked`` and ``returns`` are the tables that the streams have read, ``routed``
    what came out, and ``watermark`` how far it has got (``lastProgress``). What is
    older and has no outcome was dropped; what may still wait in state is left out.
    """
    past = f"timestamp{lit(watermark)}"
    outcome = routed.selectExpr("msg_id", f"coalesce(startswith(error, {lit(_LOST)}), false) as lost", f"coalesce(error = {lit(_STRAY)}, false) as stray")
    gone = parked.where(f"parked_at + interval {timeout} < {past}").selectExpr("lineage as msg_id", "content", "attrs").join(
        outcome.where("not stray"), "msg_id", "left_anti")
    unheard = returns.where(f"returned_at < {past}").select("msg_id", "content", "attrs").join(outcome.where("not lost"), "msg_id", "left_anti")
    return failed_rows(gone.unionByName(unheard).withColumn("problem", F.lit(_DROPPED)), "problem")
