"""The audit table, from the events the stages leave on each row."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from waybill.functions.render import concat, lit
from waybill.operators.lookup import receiver_lookup, request_uri, sender

if TYPE_CHECKING:
    from waybill.plans.routing import Wave

EVENT = (
    "array<struct<entry_type:string,step:string,path:string,stage:string,"
    "derivation:string,seen:map<string,string>>>"
)

# ``message/target/path`` of a row before any copy; the same in every run. A target without paths has ``none``.
ROW_START = (
    "concat_ws('/', msg_id, coalesce(cast(p.tpos as string), '-'),"
    " coalesce(cast(p.path as string), case when p.kind = 'empty' then 'none' end, '-'), '0')"
)
ROW_LINEAGE = f"concat({ROW_START}, copy)"

# Attributes an event shows as they were when it happened.
_AUDIT_KEYS = (
    "filename", "path", "http.query.param.senderService", "http.request.uri",
    "Receiver", "business.process.name",
)


def audit_keys(shared: tuple[str, str] | None) -> tuple[str, ...]:
    return (*_AUDIT_KEYS, shared[1]) if shared else _AUDIT_KEYS


# Fixed values of the audit record.
GROUP_NAME = "Transform"
LEVEL = "INFO"
UNKNOWN_POSITION = "unknow"


def audit_rows(
    wave: Wave, receivers: DataFrame, host: str, specification_base: str, group_id: str = "", shared: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per event of every row of the wave."""
    keys = audit_keys(shared)
    later = [k for k in keys if k not in wave.snapshot]
    df = wave.df.selectExpr(
        "msg_id", f"{ROW_LINEAGE} as lineage",
        *[f"{wave.slots.column(k)} as v{keys.index(k)}" for k in later],
        "explode(events) as e",
    )

    def attr(key: str) -> str:
        return f"e.seen[{lit(key)}]" if key in wave.snapshot else f"v{keys.index(key)}"

    df = df.selectExpr(
        "msg_id", "lineage", "e", "e.entry_type = 'processing' as working",
        f"{attr('filename')} as file_name", f"{attr('path')} as path_attr",
        f"{request_uri(attr, shared)} as request_url", f"{sender(attr)} as sender",
        f"{attr('Receiver')} as own_receiver", f"{attr('business.process.name')} as business_process",
    )
    df = receiver_lookup(df, receivers, "request_url", "own_receiver")
    group = f"'{GROUP_NAME}'"
    return df.selectExpr(
        "msg_id", "lineage", "e.entry_type as entry_type", "e.step as step",
        f"case when working then coalesce(e.path, '{UNKNOWN_POSITION}') end as path",
        f"case when working then coalesce(e.stage, '{UNKNOWN_POSITION}') end as stage",
        "file_name", "path_attr", f"{short_message()} as short_message", f"{lit(host)} as host",
        f"{group} as facility", f"{lit(group_id)} as group_id", f"{group} as group_name", f"'{LEVEL}' as level",
        "request_url", "sender", "receiver", "business_process",
        f"concat({lit(specification_base)}, coalesce(business_process, 'null')) as specification",
        "e.derivation as derivation",
        "case when not working then 1 end as log_start", "case when not working then 0 end as log_success",
    )


def short_message() -> str:
    """The sentence of an audit record (fixed wording)."""
    return concat(
        lit(f"Сообщение в [{GROUP_NAME}] c filename ["), "coalesce(file_name, 'null')",
        lit("], бизнес-процесс ["), "coalesce(business_process, 'null')",
        lit("], отправитель ["), "sender", lit("], получатель ["), "receiver", lit("]"),
    )


def audit_message(audit: DataFrame) -> DataFrame:
    """Audit rows as JSON text, with the field names of the log format."""
    fields = {
        "_fileName": "file_name", "path": "path_attr", "short_message": "short_message", "host": "host",
        "facility": "facility", "_groupId": "group_id", "level": "level", "_groupName": "group_name",
        "_messageUuid": "lineage", "_requestUrl": "request_url", "_sender": "sender", "_receiver": "receiver",
        "_entryType": "entry_type", "_LogStart": "log_start", "_LogSuccess": "log_success",
        "_businessProcess": "business_process", "specification": "specification", "derivation": "derivation",
        "transformationEntity": "step", "transformationPath": "path", "transformationStage": "stage",
    }
    body = ", ".join(f"'{name}', {column}" for name, column in fields.items())
    return audit.selectExpr("msg_id", "lineage", f"to_json(named_struct({body})) as message")
