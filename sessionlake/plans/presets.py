"""Query presets over the analytics tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import text


@dataclass
class Tables:
    envelope_facts: DataFrame
    event_facts: DataFrame
    command_rollups: DataFrame
    session_rollups: DataFrame


ALIASES = {"failures": "attention", "sessions": "recent_sessions", "activity": "timeline", "": "overview"}
LIMITS = {"overview": 1, "attention": 20, "recent_sessions": 20, "projects": 20, "sources": 20, "command_health": 20, "timeline": 30, "coverage": 1}


def coverage_mode(cache_min: Column, retained_min: Column) -> Column:
    return (F.when(cache_min.isNull(), "complete_history").when(retained_min.isNull() | (cache_min < retained_min), "cache_preserved_history")
            .when(retained_min > 1, "retained_window_only").otherwise("complete_history"))


def row_counts(t: Tables) -> DataFrame:
    """(table_name, row_count), one pass per table."""
    out = None
    for name in ("envelope_facts", "event_facts", "command_rollups", "session_rollups"):
        part = getattr(t, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = part if out is None else out.unionByName(part)
    return out


def overview(t: Tables, ledger: DataFrame | None = None) -> DataFrame:
    """Sizes of the tables, and whether ``ledger``, what is retained of it, still covers them; without it all is."""
    one = F.lit(1).alias("__one")
    n = lambda df, name: df.agg(one, F.count(F.lit(1)).alias(name))
    envelopes = t.envelope_facts.agg(one, F.count(F.lit(1)).alias("envelopes"), F.min("ledger_offset").alias("c0"))
    kept = (t.envelope_facts if ledger is None else ledger).agg(one, F.min("ledger_offset").alias("r0"))
    sessions = t.session_rollups.agg(one, F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("failure_signal_count") > 0).alias("sessions_with_failures"))
    out = envelopes.join(kept, "__one").join(n(t.event_facts, "events"), "__one").join(sessions, "__one").join(n(t.command_rollups, "command_rollups"), "__one")
    return out.select("envelopes", "events", "sessions", "command_rollups", "sessions_with_failures", coverage_mode(F.col("c0"), F.col("r0")).alias("coverage"))


def _named(as_of: Column) -> dict[str, Column]:
    return {
        "session": text.display_session(F.col("source_type"), F.col("source_instance_id"), F.col("source_session_key"), F.col("global_session_key")),
        "source": text.display_source(F.col("source_type"), F.col("source_instance_id")),
        "project": text.display_project(F.col("project_locator"), F.col("project_key")),
        "last_seen": text.format_time(F.col("last_timestamp")), "age": text.format_age(F.col("last_timestamp"), as_of),
        "span": text.format_millis(F.col("duration_ms"))}


def attention(t: Tables, limit: int, as_of: Column) -> DataFrame:
    rows = (t.session_rollups.where("failure_signal_count > 0 or incomplete_command_rollup_count > 0")
            .orderBy(F.desc("failure_signal_count"), F.desc("incomplete_command_rollup_count"), F.desc("last_timestamp"), "global_session_key").limit(limit))
    n = _named(as_of)
    return rows.select("global_session_key", n["session"].alias("session"), n["source"].alias("source"), n["project"].alias("project"),
                       text.session_status(F.col("failure_signal_count"), F.col("incomplete_command_rollup_count")).alias("status"),
                       F.col("failure_signal_count").alias("failures"), F.col("failed_command_rollup_count").alias("failed_cmds"),
                       F.col("incomplete_command_rollup_count").alias("incomplete_cmds"), n["last_seen"].alias("last_seen"), n["age"].alias("age"), n["span"].alias("span"))


def recent_sessions(t: Tables, limit: int, as_of: Column) -> DataFrame:
    rows = t.session_rollups.orderBy(F.desc("last_timestamp"), "global_session_key").limit(limit)
    n = _named(as_of)
    return rows.select("global_session_key", n["session"].alias("session"), n["source"].alias("source"), n["project"].alias("project"),
                       F.col("event_count").alias("events"), F.col("user_message_count").alias("user_msgs"), F.col("agent_message_count").alias("agent_msgs"),
                       F.col("command_rollup_count").alias("commands"), n["last_seen"].alias("last_seen"), n["age"].alias("age"), n["span"].alias("span"))


def _grouped(t: Tables, keys: list[str]) -> DataFrame:
    return t.session_rollups.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("event_count").alias("events"), F.count_if(F.col("failure_signal_count") > 0).alias("failures"),
        F.sum("command_rollup_count").alias("commands"), F.sum("tool_failure_count").alias("tool_failures"), F.max("last_timestamp").alias("last_timestamp")
    ).orderBy(F.desc("last_timestamp"), F.desc("sessions"), *keys)


def projects(t: Tables, limit: int, as_of: Column) -> DataFrame:
    return _grouped(t, ["project_locator", "project_key"]).limit(limit).select(
        text.display_project(F.col("project_locator"), F.col("project_key")).alias("project"), "sessions", "events", "failures", "commands",
        text.format_time(F.col("last_timestamp")).alias("last_seen"))


def sources(t: Tables, limit: int, as_of: Column) -> DataFrame:
    return _grouped(t, ["source_type", "source_instance_id"]).limit(limit).select(
        text.display_source(F.col("source_type"), F.col("source_instance_id")).alias("source"), "sessions", "events", "failures", "commands",
        "tool_failures", text.format_time(F.col("last_timestamp")).alias("last_seen"))


def command_health(t: Tables, limit: int, as_of: Column) -> DataFrame:
    s = t.session_rollups.select("global_session_key", "source_type", F.col("source_instance_id").alias("si"), F.col("source_session_key").alias("ss"),
                                 "project_locator", "project_key")
    at = F.coalesce("finish_timestamp", "start_timestamp")
    rows = t.command_rollups.join(s, "global_session_key").withColumn("at", at).orderBy(F.desc("at"), "global_command_rollup_key").limit(limit)
    return rows.select(
        text.display_session(F.col("source_type"), F.col("si"), F.col("ss"), F.col("global_session_key")).alias("session"),
        text.display_project(F.col("project_locator"), F.col("project_key")).alias("project"),
        text.first_nonempty(F.col("tool_name"), F.lit("tool")).alias("tool"), text.command_status(F.col("status"), F.col("exit_code")).alias("status"),
        F.coalesce(F.col("exit_code").cast("string"), F.lit("-")).alias("exit_code"), text.format_millis(F.col("duration_ms")).alias("duration"),
        text.format_time(F.col("at")).alias("finished_at"))


def timeline(t: Tables, limit: int, as_of: Column | None = None) -> DataFrame:
    kind = F.col("kind")
    n = lambda c: F.count_if(c).cast("bigint")
    rows = t.event_facts.groupBy(F.date_trunc("day", "timestamp").alias("bucket")).agg(
        F.count(F.lit(1)).alias("events"), n(kind == "session.started").alias("sessions_started"), n(kind == "command.finished").alias("commands_finished"),
        (n(kind == "tool.failed") + n((kind == "command.finished") & (F.col("exit_code") != 0))).alias("failures"))
    return rows.orderBy(F.desc("bucket")).limit(limit).select(
        text.format_time(F.col("bucket")).alias("bucket_start"), "events", "sessions_started", "commands_finished", "failures")


def coverage(t: Tables, ledger: DataFrame, built_at: Column, size_bytes: int) -> DataFrame:
    one = F.lit(1).alias("__one")
    cache = t.envelope_facts.agg(one, F.min("machine_id").alias("machine"), F.min("ledger_instance_id").alias("ledger_instance"),
                                 F.min("ledger_offset").alias("c0"), F.max("ledger_offset").alias("c1"))
    kept = ledger.agg(one, F.min("ledger_offset").alias("r0"), F.max("ledger_offset").alias("r1"))
    return cache.join(kept, "__one").select(
        text.display(F.col("machine")).alias("machine"), text.display(F.col("ledger_instance")).alias("ledger_instance"),
        coverage_mode(F.col("c0"), F.col("r0")).alias("coverage"), text.format_range(F.col("c0"), F.col("c1")).alias("cache_offsets"),
        text.format_range(F.col("r0"), F.col("r1")).alias("retained_offsets"), F.coalesce("c1", F.lit(0)).alias("last_clean_offset"),
        text.format_time(built_at).alias("built_at"), text.format_bytes(F.lit(size_bytes)).alias("db_size"))


RUN: dict[str, Callable] = {"attention": attention, "recent_sessions": recent_sessions, "projects": projects, "sources": sources,
                            "command_health": command_health, "timeline": timeline}


def preset(name: str, t: Tables, as_of: Column, limit: int = 0, ledger: DataFrame | None = None,
           built_at: Column | None = None, size_bytes: int = 0) -> DataFrame:
    """A preset by name or alias; limit 0 is the preset's own.

    ``overview`` and ``coverage`` compare with the retained ledger (without it, all is retained); ``coverage`` also
    tells when and how large the tables were built.
    """
    name = ALIASES.get(name.strip(), name.strip())
    if name not in LIMITS:
        raise ValueError(f"unknown preset {name!r}; known: {', '.join(LIMITS)}")
    if limit < 0:
        raise ValueError("limit must not be negative")
    if name in RUN:
        return RUN[name](t, limit or LIMITS[name], as_of)
    if name == "overview":
        return overview(t, ledger)
    return coverage(t, t.envelope_facts if ledger is None else ledger, as_of if built_at is None else built_at, size_bytes)


def previews(t: Tables, keys: DataFrame, events: DataFrame, policy) -> DataFrame:
    """First user and last agent text of the sessions in ``keys``, under a policy."""
    from sessionlake.operators import policy as policies

    rows = events.join(keys.select("global_session_key"), "global_session_key", "left_semi")
    ok = policies.admitted(policy, F.col("project_locator"))
    new = policies.redacted(policy, F.col("payload"))
    got = lambda c: F.coalesce(F.try_variant_get(F.try_parse_json(c), "$.text", "string"), F.lit(""))
    rows = rows.withColumns({"__ok": ok, "__new": new})
    rows = rows.withColumns({"__said": F.when(F.col("__ok"), got(F.col("__new"))), "__raw": got(F.col("payload"))})
    said = lambda kind: F.when((F.col("kind") == kind) & (F.col("__said") != ""), F.col("ledger_offset"))
    out = rows.groupBy("global_session_key").agg(
        F.min_by("__said", said("message.user")).alias("u"), F.max_by("__said", said("message.agent")).alias("a"),
        F.max("__ok").alias("any"), F.max(F.col("__ok") & (F.col("__said") != F.col("__raw"))).alias("changed"))
    status = F.when(~F.col("any"), "filtered").when(F.col("changed"), "redacted").when(F.col("u").isNull() & F.col("a").isNull(), "empty").otherwise("available")
    return out.select("global_session_key", text.display(text.preview(F.coalesce("u", F.lit("")))).alias("first_user"),
                      text.display(text.preview(F.coalesce("a", F.lit("")))).alias("last_agent"), status.alias("content_status"))
