"""The driver's tables as a session ledger: ``events`` and ``conversations`` mapped to envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import ids
from sessionlake.plans import build
from sessionlake.plans.presets import Tables

AS_OF = "2024-02-15 00:00:00"
LEDGER_INSTANCE = "ledger-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    user = F.col("user_id").cast("string")
    finished = F.col("event_type") == "purchase"
    kind = (F.when(F.col("event_type") == "signup", "session.started").when(F.col("event_type") == "view", "message.user")
            .when(F.col("event_type") == "click", "command.started").when(finished, "command.finished").otherwise("tool.failed"))
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("ledger_offset"), F.concat(F.lit("src-"), (F.col("user_id") % 3).cast("string")).alias("source_instance_id"),
        F.concat_ws("-", user, F.date_format("ts", "yyyy-MM-dd")).alias("session"),
        F.concat(F.lit("repo://p"), (F.col("user_id") % 5).cast("string")).alias("project"), "ts", kind.alias("kind"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("c"), (k % 4).cast("string"))).alias("call_id"),
        F.when(finished & (k % 5 == 0), k * 10).alias("duration_ms"), F.when(finished, k % 3).alias("exit_code"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("view "), k.cast("string"))).alias("text"), k.alias("k"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw envelopes whose payload carries what the analytics need."""
    m = _mapped(spark, sf_dir)
    raw = F.to_json(F.struct("call_id", "duration_ms", "exit_code", "project", F.col("session").alias("session_id"), "text", F.col("kind").alias("type")))
    return _enveloped(m.withColumn("raw_payload", raw))


#: Types of records, aliases among them, that ``rich_ledger`` deals out in turn.
RICH = ["session_start", "session_resume", "session_end", "user", "assistant", "system", "tool_use", "tool_result", "tool.failed", "command.started",
        "command.finished", "file.read", "file_edit", "file.patch", "file.delete", "approval_request", "approval_result", "git.status", "git.diff",
        "git.commit", "git.checkout", "model.changed", "usage.reported", "mystery", "broken", "agent", "command.started", "command.finished", "tool_result"]


def rich_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw envelopes of all kinds, with texts, calls, outputs, exit codes and broken payloads."""
    k, ks = F.col("k"), F.col("k").cast("string")
    m = _mapped(spark, sf_dir).withColumn("kind", F.element_at(F.array(*[F.lit(x) for x in RICH]), ((F.col("ledger_offset") - 1) % len(RICH) + 1).cast("int")))
    kind = F.col("kind")
    command = kind.isin("command.started", "command.finished")
    said = lambda head, n: F.concat(F.lit(head), (k % n).cast("string"))
    head = F.when(k % 7 == 0, F.concat(F.lit("Command: bash -lc 'ls "), ks, F.lit("'\n"))).otherwise("")
    fields = F.struct(
        F.when(command & (k % 4 != 0), said("make t", 7)).when((kind == "file.patch") & (k % 2 == 0), said("apply  p", 3)).alias("command"),
        F.when(kind.isin("command.finished", "tool_result") | ((kind == "tool.failed") & (k % 2 == 0)), k % 3).alias("exit_code"),
        F.when(kind.startswith("git."), said("branch  b", 3)).alias("message"),
        F.when((kind == "model.changed") & (k % 2 == 0), said("m", 4)).alias("model"),
        F.when(kind == "tool.failed", F.concat(head, F.lit("step one\nboom: error "), ks, F.lit("\nrun again")))
        .when((kind == "command.finished") & (k % 3 != 0), F.concat(F.lit("Wall time: 1s\nOutput:\nno such file "), ks)).alias("output_text"),
        F.when(command & (k % 3 != 0), F.struct(said("c", 4).alias("call_id"))).alias("payload"),
        F.when(kind == "mystery", F.concat(F.lit("odd "), ks)).when((kind == "tool.failed") & (k % 5 == 0), F.concat(F.lit("reason  "), ks)).alias("reason"),
        F.when((kind == "user") | (kind.isin("assistant", "agent", "system") & (k % 5 != 0)), F.concat(F.lit("said   "), ks)).alias("text"),
        F.when(kind.isin("tool_use", "tool_result", "tool.failed", "file.patch") & (k % 2 == 1), said("tool", 5)).alias("tool_name"),
        kind.alias("type"))
    return _enveloped(m.withColumn("raw_payload", F.when(kind == "broken", F.concat(F.lit("not json "), ks)).otherwise(F.to_json(fields))))


def _enveloped(m: DataFrame) -> DataFrame:
    rows = m.withColumns({
        "source_type": F.lit("test_local"), "artifact_id": F.concat(F.lit("events-"), "source_instance_id"),
        "cursor_kind": F.lit("line"), "cursor_value": F.col("ledger_offset").cast("string")})
    rows = rows.withColumn("content_hash", ids.content_hash(F.col("raw_payload")))
    return rows.select(
        "ledger_offset", ids.envelope_id(*[F.col(c) for c in ("source_type", "source_instance_id", "artifact_id", "cursor_kind", "cursor_value", "content_hash")]).alias("envelope_id"),
        "source_type", "source_instance_id", "artifact_id", F.col("artifact_id").alias("artifact_locator"), F.col("project").alias("project_locator"),
        F.lit("machine-a").alias("machine_id"), "cursor_kind", "cursor_value", F.col("ts").alias("observed_at"), F.col("ts").alias("source_timestamp"),
        F.col("kind").alias("raw_kind"), "raw_payload", "content_hash", F.col("session").alias("hint_session"), F.lit("").alias("hint_project"),
        F.lit(0.8).alias("confidence"), F.array(F.lit("messages"), F.lit("commands")).alias("capabilities"))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return build.tables(ledger(spark, sf_dir), LEDGER_INSTANCE)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as JSON lines of a few artifacts; only some lines name their session and project."""
    m = _mapped(spark, sf_dir)
    value = F.to_json(F.struct(
        F.when(F.col("k") % 4 == 0, F.col("session")).alias("conversation_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.col("kind").alias("kind"), F.when(F.col("k") % 7 == 0, F.col("project")).alias("workspace")))
    value = F.when(F.col("k") % 11 == 10, F.concat(F.lit("not json "), F.col("k").cast("string"))).otherwise(value)
    return m.select(F.col("source_instance_id").alias("artifact_id"), F.concat(F.lit("/logs/"), "source_instance_id", F.lit(".jsonl")).alias("locator"),
                    F.lit("/logs").alias("project_root"), F.col("ledger_offset").alias("line"), value.alias("value"), "source_instance_id")


def chat_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``conversations`` as (messages, sessions) of a chat database."""
    c = table(spark, sf_dir, "conversations")
    text, long, double = (lambda n: F.lit(None).cast("string").alias(n)), (lambda n: F.lit(None).cast("bigint").alias(n)), (lambda n: F.lit(None).cast("double").alias(n))
    messages = c.select(
        (F.col("conv_id") * 1000 + F.col("turn") + 1).alias("id"), F.col("conv_id").cast("string").alias("session_id"), "role", F.col("text").alias("content"),
        text("tool_call_id"), text("tool_calls"), text("tool_name"), (F.lit(1704067200.0) + F.col("conv_id") * 60 + F.col("turn")).alias("timestamp"),
        long("token_count"), text("finish_reason"), F.lit("thought").alias("reasoning"), text("reasoning_content"), text("reasoning_details"),
        text("codex_reasoning_items"), text("codex_message_items"))
    sessions = c.where("conv_id % 5 <> 4").groupBy(F.col("conv_id").cast("string").alias("id")).agg(
        F.lit("cli").alias("source"), F.lit("m").alias("model"), F.lit("hidden").alias("system_prompt"), F.lit(1704067200.0).alias("started_at"),
        double("ended_at"), F.concat(F.lit("chat "), F.min("conv_id").cast("string")).alias("title"), F.count(F.lit(1)).alias("input_tokens"),
        long("output_tokens"), long("reasoning_tokens"), double("estimated_cost_usd"), double("actual_cost_usd"))
    return messages, sessions
