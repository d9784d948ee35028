"""Chat tables (sessions, messages) as a source of envelopes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import ids

# The columns that must exist.
SESSION_COLUMNS = ["id", "source", "model", "system_prompt", "started_at", "ended_at", "title", "input_tokens", "output_tokens",
                   "reasoning_tokens", "estimated_cost_usd", "actual_cost_usd"]
MESSAGE_COLUMNS = ["id", "session_id", "role", "content", "tool_call_id", "tool_calls", "tool_name", "timestamp", "token_count",
                   "finish_reason", "reasoning", "reasoning_content", "reasoning_details", "codex_reasoning_items", "codex_message_items"]
REASONING = ["reasoning", "reasoning_content", "reasoning_details", "codex_reasoning_items"]
TOOL_FIELDS = ["tool_call_id", "tool_calls", "tool_name", "codex_message_items"]


def require(df: DataFrame, columns: list[str], table: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} has no column {missing[0]}")


def epoch_time(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint"))


def chat_records(messages: DataFrame, sessions: DataFrame, after: int = 0, reasoning: bool = False, system_prompt: bool = False,
                 tool_output: bool = True) -> DataFrame:
    """(id, session_id, raw_kind, source_timestamp, raw_payload) of messages beyond a cursor, with their session."""
    require(sessions, SESSION_COLUMNS, "sessions")
    require(messages, MESSAGE_COLUMNS, "messages")
    drop = ([] if reasoning else REASONING) + ([] if tool_output else TOOL_FIELDS)
    keep = [c for c in MESSAGE_COLUMNS if c not in drop and c != "content"]
    own = [c for c in SESSION_COLUMNS if system_prompt or c != "system_prompt"]
    hidden = F.lit(not tool_output) & (F.col("m.role") == "tool")
    fields = [F.col(f"m.{c}").alias(c) for c in keep] + [F.when(~F.coalesce(hidden, F.lit(False)), F.col("m.content")).alias("content")]
    session = F.when(F.col("s.id").isNotNull(), F.struct(*[F.col(f"s.{c}").alias(c) for c in own]))
    role = F.trim(F.coalesce("m.role", F.lit("")))
    return (messages.where(F.col("id") > after).alias("m").join(sessions.alias("s"), F.col("m.session_id") == F.col("s.id"), "left")
            .select(F.col("m.id").alias("id"), F.col("m.session_id").alias("session_id"),
                    F.concat(F.lit("message."), F.when(role == "", "unknown").otherwise(role)).alias("raw_kind"),
                    epoch_time(F.col("m.timestamp")).alias("source_timestamp"),
                    F.to_json(F.struct(*fields, session.alias("session"))).alias("raw_payload")))


def chat_envelopes(records: DataFrame, profile: str, path: str, instance: str, machine: str, observed_at: Column) -> DataFrame:
    artifact = artifact_id(profile, path)
    rows = records.withColumns({"source_type": F.lit("chat_local"), "source_instance_id": F.lit(instance), "artifact_id": artifact,
                                "cursor_kind": F.lit("message_id"), "cursor_value": F.col("id").cast("string"),
                                "content_hash": ids.content_hash(F.col("raw_payload"))})
    return rows.select(
        ids.envelope_id(*[F.col(c) for c in ("source_type", "source_instance_id", "artifact_id", "cursor_kind", "cursor_value", "content_hash")]).alias("envelope_id"),
        "source_type", "source_instance_id", "artifact_id", F.lit(path).alias("artifact_locator"), F.lit("").alias("project_locator"),
        F.lit(machine).alias("machine_id"), "cursor_kind", "cursor_value", observed_at.alias("observed_at"), "source_timestamp", "raw_kind",
        "raw_payload", "content_hash", F.coalesce("session_id", F.lit("")).alias("hint_session"), F.lit("").alias("hint_project"),
        F.lit(None).cast("double").alias("confidence"), F.array(F.lit("messages"), F.lit("tool_calls"), F.lit("usage")).alias("capabilities"),
        F.col("id").alias("line"))


def is_profile_name(name: str) -> bool:
    return name not in ("", ".", "..") and "/" not in name and "\\" not in name


def profiles(tables: dict[str, tuple[DataFrame, DataFrame]], chosen: str = "default") -> list[str]:
    """Profile names: the default, 'all' (sorted), or a list; unknown names are dropped."""
    if chosen.strip().lower() == "all":
        return sorted(tables)
    return list(dict.fromkeys(x.strip() for x in chosen.split(",") if x.strip() in tables))


def artifact_id(profile: str, path: str) -> Column:
    return ids.stable_id("art", F.lit("hermes"), F.lit(profile), F.lit(path))


def start_after(cursor: str | None, token: str | None, artifact: str) -> int:
    """The message id to go on after, from a stored cursor and the artifact it was stored for.

    A cursor of another artifact is not used; one without an artifact, or that is no
    number, is an error.
    """
    cursor = (cursor or "").strip()
    if not cursor:
        return 0
    if not token:
        raise ValueError(f"checkpoint cursor {cursor!r} is missing artifact token")
    if token != artifact:
        return 0
    if not cursor.lstrip("+-").isdigit() or not cursor.isascii():
        raise ValueError(f"checkpoint cursor {cursor!r} is no message id")
    return int(cursor)


def read_profiles(databases: dict[str, tuple[str, DataFrame, DataFrame]], chosen: str, instance: str, machine: str, observed_at: Column,
                  checkpoints: dict[str, tuple[str, str]] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(envelopes, checkpoints) of the default profile and the chosen ones, as one table.

    ``databases`` has path, messages and sessions of each profile; ``chosen`` is 'all',
    a list of names or empty.  ``checkpoints`` has cursor and token of each profile; new
    ones are (profile, artifact_id, cursor, token), the cursor being the largest id read,
    or the old one where nothing was read.
    """
    spark = next(iter(databases.values()))[1].sparkSession
    names = {x: databases[x] for x in databases if x == "default" or is_profile_name(x)}
    wanted = [x for x in ["default", *sorted(names)] if x in names] if chosen.strip().lower() == "all" else [
        x for x in dict.fromkeys(["default", *(x.strip() for x in chosen.split(","))]) if x in names]
    envelopes, next_ones = None, None
    for name in dict.fromkeys(wanted):  # a handful of databases
        path, messages, sessions = names[name]
        own = spark.range(1).select(artifact_id(name, path)).first()[0]
        cursor, token = (checkpoints or {}).get(name, (None, None))
        after = start_after(cursor, token, own)
        part = chat_envelopes(chat_records(messages, sessions, after, **options), name, path, instance, machine, observed_at)
        done = messages.where(F.col("id") > after).agg(F.coalesce(F.max("id"), F.lit(after)).cast("string").alias("cursor")).select(
            F.lit(name).alias("profile"), F.lit(own).alias("artifact_id"), "cursor", F.lit(own).alias("token"))
        envelopes = part if envelopes is None else envelopes.unionByName(part)
        next_ones = done if next_ones is None else next_ones.unionByName(done)
    return envelopes, next_ones
