"""Normalization of envelopes to canonical events."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import ids, payload, text

# Aliases of event kinds.
KINDS = {
    "session.started": ["session.started", "session_start"], "session.resumed": ["session.resumed", "session_resume"],
    "session.ended": ["session.ended", "session_end"], "message.user": ["message.user", "user"],
    "message.agent": ["message.agent", "assistant", "agent"], "message.system": ["message.system", "system"],
    "tool.started": ["tool.started", "tool_use"], "tool.finished": ["tool.finished"], "tool.failed": ["tool.failed"],
    "command.started": ["command.started"], "command.finished": ["command.finished"], "file.read": ["file.read"],
    "file.write": ["file.write", "file_edit"], "file.patch": ["file.patch"], "file.delete": ["file.delete"],
    "approval.requested": ["approval.requested", "approval_request"], "approval.resolved": ["approval.resolved", "approval_result"],
    "git.status": ["git.status"], "git.diff": ["git.diff"], "git.commit": ["git.commit"], "git.checkout": ["git.checkout"],
    "model.changed": ["model.changed"], "usage.reported": ["usage.reported"],
}


def kind_of(raw_kind: Column, v: Column) -> Column:
    """Canonical kind; unknown ones are errors."""
    return kind_named(text.first_nonempty(raw_kind, payload.string(v, "type"), payload.string(v, "kind")), failed(v))


def failed(v: Column) -> Column:
    """Whether a payload has an exit code above 0."""
    return F.coalesce(payload.number(v, "exit_code"), F.lit(0)) > 0


def kind_named(name: Column, failed: Column) -> Column:
    """Canonical kind of a name; results of tools are told apart by ``failed``."""
    table = F.create_map(*[F.lit(x) for kind, names in KINDS.items() for alias in names for x in (alias, kind)])
    return F.when(name == "tool_result", F.when(failed, "tool.failed").otherwise("tool.finished")).otherwise(
        F.coalesce(F.try_element_at(table, name), F.lit("error")))


def actor_of(kind: Column, source_type: Column, v: Column) -> tuple[Column, Column]:
    tool = kind.startswith("tool.") | kind.startswith("command.")
    who = F.when(kind.startswith("message.user"), "user").when(kind.startswith("message.agent"), "agent").when(tool, "tool").otherwise("system")
    name = F.when(who == "user", "user").when(tool, text.first_nonempty(payload.string(v, "tool"), F.lit("shell"))).otherwise(source_type)
    return who, name


def generic(rows: DataFrame) -> DataFrame:
    """Kind, status, actor and payload of flat records."""
    v = F.col("__v")
    ok = payload.is_object(v) | (F.trim("raw_payload") == "") | (F.trim("raw_payload") == "null")
    rows = rows.withColumns({"__ok": ok, "__name": text.first_nonempty(F.col("raw_kind"), payload.string(v, "type"), payload.string(v, "kind"))})
    ok = F.col("__ok")  # used several times, as is the name, but read once
    rows = rows.withColumn("kind", F.when(ok, kind_named(F.col("__name"), failed(v))).otherwise("error"))
    who, name = actor_of(F.col("kind"), F.col("source_type"), v)
    broken = F.to_json(F.struct(F.lit("payload is not an object").alias("reason"), "raw_kind", "source_type"))
    return rows.withColumns({
        "parse_status": F.when(F.col("kind") == "error", "failed").otherwise("ok"), "actor_kind": who, "actor_name": name,
        "payload": F.when(~ok, broken).when(payload.is_object(v), F.col("raw_payload")).otherwise("{}")})


def normalize(envelopes: DataFrame, classify=generic, previous: DataFrame | None = None, version: int = 1) -> DataFrame:
    """One event per envelope; sequences follow ``previous`` (session_key, sequence) where given."""
    v = F.col("__v")
    rows = envelopes.withColumn("__v", payload.parse(F.col("raw_payload")))
    rows = rows.withColumns({
        "source_session_key": text.first_nonempty(F.col("hint_session"), payload.string(v, "session_id"), payload.string(v, "conversation_id"),
                                                  F.trim("artifact_id"), F.lit("unknown")),
        "project_locator": text.first_nonempty(F.col("project_locator"), F.col("hint_project"), payload.string(v, "project"),
                                               payload.string(v, "workspace"), payload.string(v, "repo")),
        "timestamp": F.coalesce("source_timestamp", "observed_at")})
    rows = rows.withColumn("session_key", ids.session_key(F.col("source_instance_id"), F.col("source_session_key")))
    rows = rows.withColumn("sequence", F.row_number().over(Window.partitionBy("session_key").orderBy("ledger_offset")).cast("bigint"))
    if previous is not None:
        last = previous.groupBy("session_key").agg(F.max("sequence").alias("__last"))
        rows = rows.join(last, "session_key", "left").withColumn("sequence", F.col("sequence") + F.coalesce("__last", F.lit(0))).drop("__last")
    rows = classify(rows)
    return events_of(rows, version)


def events_of(rows: DataFrame, version: int) -> DataFrame:
    key = F.col("session_key") if version == 1 else ids.session_key(F.col("source_instance_id"), F.col("source_session_key"), F.col("machine_id"))
    rows = rows.withColumn("session_key", key)
    return rows.select(
        F.lit(version).alias("event_version"),
        ids.event_id(version, *[F.col(c) for c in ("source_type", "machine_id", "source_instance_id", "session_key", "sequence", "kind", "timestamp", "payload")]).alias("event_id"),
        "source_type", "source_instance_id", "machine_id", "session_key", "sequence", "timestamp", "kind", "actor_kind", "actor_name",
        ids.project_key(F.col("project_locator")).alias("project_key"), "project_locator", "source_session_key", "capabilities", "payload",
        "ledger_offset", "envelope_id", "parse_status")


def rewrite(events: DataFrame, version: str | int, machines: DataFrame | None = None) -> DataFrame:
    """Events in another version; machine ids come from (envelope_id, machine_id) where given."""
    wanted = {"": 1, "v1": 1, "1": 1, "v2": 2, "2": 2}.get(str(version))
    if wanted is None:
        raise ValueError(f"unknown event version {version!r}")
    rows = events
    if machines is not None:
        rows = rows.drop("machine_id").join(machines.select("envelope_id", "machine_id"), "envelope_id", "left")
    if wanted == 1:
        rows = rows.withColumn("session_key", ids.session_key(F.col("source_instance_id"), F.col("source_session_key")))
    out = events_of(rows.drop("event_version", "event_id", "project_key"), wanted)
    return out.withColumn("machine_id", F.lit(None).cast("string")) if wanted == 1 else out
