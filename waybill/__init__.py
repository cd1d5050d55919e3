"""Message routing and transformation on Spark."""

from waybill.operators.audit import audit_message
from waybill.operators.lineage import lineage_closure
from waybill.operators.lookup import lookup_failed, lookup_passed, multi_lookup, receiver_lookup
from waybill.operators.steps import register_step
from waybill.plans.context import Reshape, Settings
from waybill.plans.routing import RouteRun, route_messages
from waybill.sources.commits import commit_batch, read_batches, remove_leftovers
from waybill.sources.messages import as_messages, kafka_messages, messages
from waybill.sources.registry import registry
from waybill.sources.sinks import read_route, reformat, returned_messages, write_routes
from waybill.streaming.route import dropped_late, match_returns, resume_stream, route_stream

__all__ = [
    "Reshape", "RouteRun", "Settings", "as_messages", "audit_message", "commit_batch", "dropped_late", "kafka_messages",
    "lineage_closure", "lookup_failed", "lookup_passed", "match_returns", "messages", "multi_lookup", "read_batches", "read_route",
    "receiver_lookup", "reformat", "register_step", "registry", "remove_leftovers", "resume_stream", "returned_messages",
    "route_messages", "route_stream", "write_routes",
]
