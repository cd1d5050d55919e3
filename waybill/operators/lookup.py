"""Lookups of a message table in small registries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.render import case, concat, lit, render
from waybill.functions.text import decoded, filled
from waybill.plans.context import merged
from waybill.session import BROADCAST_BYTES, lookup_join, measured_bytes, one_per_key, salted_join, written

# Texts for an unknown sender and an unknown receiver.
NO_SENDER = "Не указан"
NO_RECEIVER = "Не определен"


def route_lookup(df: DataFrame, routes: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``process`` and ``doc``; a miss carries the error text and status 501."""
    keyed = df.withColumn("process", F.expr("attrs['business.process.name']"))
    joined = lookup_join(keyed, routes.select("process", "doc"), "process", limit=limit, salt_by=F.col("msg_id"))
    missing = f"{filled('doc')} is null"
    return joined.withColumns({
        "route_error": F.expr(f"case when {missing} then {not_found('process')} end"),
        "status_code": F.expr(f"case when {missing} then '501' end"),
    })


def not_found(process: str) -> str:
    return concat(lit("Route named:"), f"coalesce({process}, 'null')", lit(" not found!"))


def request_uri(attr: Callable[[str], str], shared: tuple[str, str] | None = None) -> str:
    """The request URI; behind a ``shared`` endpoint (its URI and an attribute) the interface that the attribute names."""
    uri = attr("http.request.uri")
    return f"case when {uri} = {lit(shared[0])} then {attr(shared[1])} else {uri} end" if shared else uri


def sender(attr: Callable[[str], str]) -> str:
    return f"coalesce({filled(attr('http.query.param.senderService'))}, {lit(NO_SENDER)})"


def receiver_lookup(df: DataFrame, receivers: DataFrame, uri: str, own: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``receiver`` by URI; the value ``attribute`` means the row's own receiver."""
    renamed = receivers.selectExpr("uri as __uri", "receiver as __found")
    joined = lookup_join(df.withColumn("__uri", F.expr(uri)), renamed, "__uri", limit=limit, salt_by=F.col("msg_id"))
    value = f"case when __found = 'attribute' then {own} else __found end"
    return joined.withColumn("receiver", F.expr(f"coalesce({filled(value)}, {lit(NO_RECEIVER)})")).drop("__uri", "__found")


# Fixed value: several keys can only be written to attributes.
SEVERAL_KEYS = "java.io.IOException: Multiple Cache Value Identifiers specified without Put Cache Value In Attribute set"
# Up to so many keys of a message are looked up one by one in a broadcast table.
CHAIN = 16


def multi_lookup(
    df: DataFrame,
    keys: str,
    values: DataFrame,
    *,
    attribute: str | None = None,
    max_length: int | None = None,
    charset: str = "UTF-8",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Look up one or more keys per message in ``values (key, value)``.

    ``keys`` and ``attribute`` are templates. One key without ``attribute``
    replaces the content; else each value goes to ``attribute`` (one key) or
    ``attribute.key`` (several), cut at ``max_length`` if that is given.
    ``error`` tells of a blank or missing key; ``lookup_failed`` and
    ``lookup_passed`` part the rows by it.

    A table of values within ``limit`` is broadcast once and probed key by key, so
    messages stay where they are. A larger table, or lists of more than ``CHAIN``
    keys, meet the distinct lists of keys without any content; what the lists found
    is broadcast back if it is within ``limit``, else joined with heavy lists salted.
    """
    work = df.withColumn("__keys", F.expr(f"transform(filter(split({render(keys)}, ','), k -> k <> ''), k -> trim(k))"))
    text = decoded("value", charset) if dict(values.dtypes)["value"] == "binary" else "value"
    table = values.selectExpr("key as __k", f"{text} as __v").where("__k is not null")
    small = measured_bytes(table) <= limit
    most = work.agg(F.max(F.size("__keys"))).first()[0] or 0
    if small and most <= CHAIN:
        work = _probed(work, one_per_key(table, "__k"), most)
    else:
        work = _by_lists(work, table, limit)
    problems = [
        ("__keys is null or exists(__keys, k -> k = '')", lit("no key to look up")),
        ("exists(__found, v -> v is null)", lit("not every key was found")),
    ]
    if attribute is None:
        problems.append(("size(__keys) > 1", lit(SEVERAL_KEYS)))
    work = work.withColumn("error", F.expr(case(problems, "cast(null as string)")))
    if attribute is None:
        changed = work.withColumn("content", F.expr("case when error is null and size(__keys) = 1 then __found[0] else content end"))
    else:
        name = render(attribute)
        cut = (lambda v: v) if max_length is None else (lambda v: f"substring({v}, 1, {max_length})")
        one = f"map({name}, {cut("__found[0]")})"
        # The same key twice gives the same entry twice.
        several = (
            "map_from_entries(array_distinct(transform(sequence(1, size(__keys)), i -> "
            f"struct(concat({name}, '.', __keys[i - 1]), {cut("__found[i - 1]")}))))"
        )
        new = f"case when error is null and size(__keys) > 0 then case when size(__keys) = 1 then {one} else {several} end end"
        changed = work.withColumn("__new", F.expr(new)).withColumn("attrs", F.expr(merged("attrs", "__new")))
    return changed.select(*df.columns, "error")


def _probed(work: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """``__found`` by one broadcast that is probed for the first, second, ... key."""
    found = F.broadcast(table)
    for i in range(most):
        mine = found.withColumnsRenamed({"__k": "__k0", "__v": f"__v{i}"})
        work = work.join(mine, F.get("__keys", F.lit(i)) == F.col("__k0"), "left").drop("__k0")
    listed = "slice(array({}), 1, greatest(size(__keys), 0))".format(", ".join(f"__v{i}" for i in range(most))) if most else "cast(array() as array<string>)"
    return work.withColumn("__found", F.expr(f"coalesce({listed}, cast(array() as array<string>))"))


def _by_lists(work: DataFrame, table: DataFrame, limit: int) -> DataFrame:
    """``__found`` of each distinct list of keys, joined back to the messages.

    The messages are written first: a list that is collected anew may come in another order,
    and would not meet what was looked up.
    """
    work = written(work.withColumn("__list", F.expr("to_json(__keys)")), "messages")
    lists = work.where("__keys is not null").select("__list", "__keys").distinct()
    each = lists.selectExpr("__list", "posexplode(__keys) as (__at, __k)")
    looked = lookup_join(each, table, "__k", limit=limit, salt_by=F.struct("__list", "__at"))
    found = looked.groupBy("__list").agg(F.expr(
        "transform(sort_array(collect_list(struct(__at, __v))), x -> x.__v) as __found"))
    found = written(found, "lists")
    if measured_bytes(found) <= limit:
        joined = work.join(F.broadcast(found), "__list", "left")
    else:
        joined = salted_join(work, found, "__list", F.col("msg_id"))
    return joined.withColumn("__found", F.expr("coalesce(__found, cast(array() as array<string>))"))


def lookup_passed(found: DataFrame) -> DataFrame:
    """Messages whose keys were all found, ready for the routing plan."""
    return found.where("error is null").drop("error")


def lookup_failed(found: DataFrame) -> DataFrame:
    """The others, as failed rows: they go where failed messages go."""
    return failed_rows(found.where("error is not null"), "error")


def failed_rows(messages: DataFrame, why: str) -> DataFrame:
    """Messages that fail before the plan, in the columns of ``RouteRun.routed()``; ``why`` is a column."""
    return messages.selectExpr(
        "msg_id", "concat(msg_id, '/-/-/0') as lineage", "'failed' as route", "cast(null as string) as target_id",
        "cast(null as int) as path", "cast(null as string) as target_url", "content",
        f"{merged('attrs', f"map('error.msg', {why})")} as attrs", f"{why} as error")
