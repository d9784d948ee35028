"""Summaries and inspection of sessions over canonical events."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import payload, text
from sessionlake.operators.facts import FINISHED, STARTED, pair_sides

# Kinds always shown on a session's timeline.
TIMELINE = ["session.started", "session.resumed", "session.ended", "model.changed", "command.started", "command.finished", "tool.failed",
            "file.patch", "approval.requested", "approval.resolved", "git.status", "git.diff", "git.commit", "git.checkout", "message.user"]


_OUTPUT = ["output_text", "stderr", "stdout", "text", "reason"]
_INNER = ", ".join(f"{x}: string" for x in ["call_id", "output", *_OUTPUT])
_SHAPE = ", ".join(f"{x} string" for x in ["command", "message", "model", "name", "tool", "tool_name", *_OUTPUT]) + f", payload struct<{_INNER}>"


def _fields(events: DataFrame) -> DataFrame:
    """With ``exit_code``, ``duration_ms`` and the payload's fields that are shown, read once."""
    v = F.try_parse_json("payload")
    return events.withColumns({"exit_code": payload.integer(v, "exit_code"), "duration_ms": payload.integer(v, "duration_ms"),
                               "__f": F.from_json("payload", _SHAPE)})


def _text(*path: str) -> Column:
    return F.coalesce(F.col(".".join(["__f", *path])), F.lit(""))


def failure_output() -> Column:
    """The output of a record: of its inner payload if that has one, else its own."""
    return text.first_nonempty(*[_text("payload", k) for k in ("output", *_OUTPUT)], *[_text(k) for k in _OUTPUT])


def with_context(rows: DataFrame) -> DataFrame:
    """Adds ``call_id`` and ``context``: the command an event belongs to.

    That is its own, else that of the latest earlier start of the same call that has
    one, else what the first line of an earlier start's or of its own output says.
    """
    own, call = text.compact(_text("command")), F.trim(_text("payload", "call_id"))
    first_line = F.col("__line")
    rows = rows.withColumn("__line", F.trim(F.substring_index(F.replace(failure_output(), F.lit("\r\n"), F.lit("\n")), "\n", 1)))
    head = F.when(first_line.startswith("Command:"), text.compact(text.unwrap_command(F.substring(first_line, 9, 1 << 20)))).otherwise("")
    rows = rows.withColumns({"call_id": call, "__own": own, "__head": head})
    before = Window.partitionBy("session_key", "call_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda c: F.when((F.col("kind") == STARTED) & (F.col(c) != ""), F.col(c))
    earlier = F.coalesce(F.last(start("__own"), ignorenulls=True).over(before), F.first(start("__head"), ignorenulls=True).over(before))
    return rows.withColumn("context", text.first_nonempty(
        F.col("__own"), F.when(F.col("call_id") != "", earlier), F.col("__head"))).drop("__own", "__head", "__line")


def failed(kind: Column, exit_code: Column) -> Column:
    return (kind == "tool.failed") | ((kind == FINISHED) & F.coalesce(exit_code != 0, F.lit(False)))


def summarize(events: DataFrame, order: str | Column = "ledger_offset") -> DataFrame:
    """One row per session: counts, span in seconds, kinds, first given identity; ``position`` is where it begins in ``order``."""
    at = F.col(order) if isinstance(order, str) else order
    rows = _fields(events).withColumn("__order", at)
    given = lambda c: F.coalesce(F.min_by(F.col(c), F.when(F.col(c) != "", F.col("__order"))), F.lit("")).alias(c)
    return rows.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(failed(F.col("kind"), F.col("exit_code"))).alias("failures"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"),
        F.timestamp_diff("SECOND", F.min("timestamp"), F.max("timestamp")).alias("duration_s"),
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), given("source_type"), given("source_instance_id"),
        given("source_session_key"), given("project_locator"), F.min("__order").alias("position"))


def order_summaries(summaries: DataFrame, by: str = "input", failed_only: bool = False, limit: int | None = None) -> DataFrame:
    keys = {"input": [], "recent": [F.desc("last_timestamp"), F.desc("events"), F.desc("failures")],
            "biggest": [F.desc("events"), F.desc("failures"), F.desc("last_timestamp")],
            "failed": [F.desc("failures"), F.desc("last_timestamp"), F.desc("events")]}[by]
    rows = (summaries.where("failures > 0") if failed_only else summaries).orderBy(*keys, "position")
    return rows if limit is None else rows.limit(limit)


def kind_histogram(events: DataFrame) -> DataFrame:
    return events.groupBy("session_key", "kind").agg(F.count(F.lit(1)).alias("n"))


def inspect_header(events: DataFrame, session: str | None = None) -> DataFrame:
    """Identity, size and span of one session or of all."""
    rows = events if session is None else events.where((F.col("session_key") == session) | (F.col("source_session_key") == session))
    return summarize(rows).select("session_key", "source_type", "source_instance_id", "source_session_key", "project_locator",
                                  "events", "first_timestamp", "last_timestamp", "duration_s")


def command_events(events: DataFrame) -> DataFrame:
    """Command events with call id, exit code, output and command text."""
    rows = with_context(_fields(events)).where(F.col("kind").isin(STARTED, FINISHED))
    return rows.withColumns({"output": failure_output(), "command": F.col("context")}).drop("__f", "context")


def collapsed_commands(events: DataFrame) -> DataFrame:
    """Commands of each session: completed, started_only or finished_only.

    The duration is the one that a finish tells, else the time between both ends, if
    the finish is not the earlier one.
    """
    rows = command_events(events)
    out = pair_sides(rows.select(
        F.col("session_key").alias("session"), F.col("event_id").alias("key"), (F.col("kind") == STARTED).alias("started"), "call_id",
        F.struct("sequence", "event_id").alias("at"), "command",
        F.struct("sequence", "timestamp", "command", "exit_code", "duration_ms", "call_id", "output").alias("side")), second_key="command")
    status = F.when(F.col("s").isNull(), "finished_only").when(F.col("f").isNull(), "started_only").otherwise("completed")
    between = F.timestamp_diff("MILLISECOND", F.col("s.timestamp"), F.col("f.timestamp"))
    return out.select(
        F.col("session").alias("session_key"), status.alias("status"), text.first_nonempty(F.col("s.command"), F.col("f.command")).alias("command"),
        F.col("s.sequence").alias("start_sequence"), F.col("f.sequence").alias("finish_sequence"),
        F.when(F.col("f").isNull(), F.col("s.exit_code")).otherwise(F.col("f.exit_code")).alias("exit_code"),
        F.coalesce("f.duration_ms", F.when(F.col("f.timestamp") >= F.col("s.timestamp"), between)).alias("duration_ms"))


def filter_commands(commands: DataFrame, which: str = "all") -> DataFrame:
    bad, open_ = F.coalesce(F.col("exit_code") != 0, F.lit(False)), F.col("status") != "completed"
    return commands.where({"all": F.lit(True), "failed": bad, "incomplete": open_, "attention": bad | open_, "completed": ~open_}[which])


def head_tail(rows: DataFrame, limit: int, partition: str = "session_key", order: str = "sequence") -> DataFrame:
    """First half (rounded up) and last half of each session, with the number left out."""
    spec = Window.partitionBy(partition)
    out = rows.withColumns({"__n": F.row_number().over(spec.orderBy(order)), "__all": F.count(F.lit(1)).over(spec)})
    keep = (F.col("__all") <= limit) | (F.col("__n") <= (limit + 1) // 2) | (F.col("__n") > F.col("__all") - limit // 2)
    return out.where(keep).withColumn("omitted", F.greatest(F.col("__all") - limit, F.lit(0))).drop("__n", "__all")


def _joined(*parts: Column) -> Column:
    return F.concat_ws(" — ", *[text.not_blank(text.compact(p)) for p in parts])


def summarized(rows: DataFrame) -> DataFrame:
    """Adds ``summary``, what an event says, in one line; ``rows`` has ``__f``, ``exit_code`` and ``context``."""
    kind, code, command = F.col("kind"), F.col("exit_code"), text.first_nonempty(_text("command"), F.col("context"))
    tool = text.first_nonempty(_text("tool_name"), _text("tool"), _text("name"), F.col("actor_name"))
    exited = F.concat(F.lit("exit "), code.cast("string"))
    coded = F.when(code.isNull(), command).when(command == "", exited).otherwise(F.concat(command, F.lit(" ("), exited, F.lit(")")))
    said = (F.when(kind.isin("message.user", "message.agent", "message.system"), text.first_nonempty(_text("text"), _text("message"), _text("reason")))
            .when(kind.isin(STARTED, FINISHED), coded)
            .when(kind == "tool.failed", _joined(tool, command, F.coalesce(exited, F.lit("")), text.first_nonempty(_text("reason"), _text("output_text"), _text("text"))))
            .when(kind == "file.patch", _joined(tool, _text("command")))
            .when(kind == "model.changed", text.first_nonempty(_text("model"), _text("text")))
            .otherwise(text.first_nonempty(_text("text"), _text("message"), _text("command"), _text("reason"))))
    return rows.withColumn("__said", said).withColumn("summary", text.compact(F.col("__said"))).drop("__said")


def timeline(events: DataFrame) -> DataFrame:
    rows = summarized(with_context(_fields(events)))
    shown = F.col("kind").isin(*TIMELINE) | (F.col("kind").isin("message.agent", "message.system") & (F.col("summary") != ""))
    return rows.where(shown).select("session_key", "sequence", "timestamp", "kind", "summary")


def attention_events(events: DataFrame) -> DataFrame:
    """Failures with the line that tells why."""
    rows = summarized(with_context(_fields(events)).where(failed(F.col("kind"), F.col("exit_code"))))
    return rows.select("session_key", "sequence", "kind", "exit_code", "summary",
                       text.compact(text.failure_excerpt(failure_output()), 180).alias("detail"))


def tool_failures(events: DataFrame) -> DataFrame:
    rows = summarized(with_context(_fields(events)).where("kind = 'tool.failed'"))
    tool = text.first_nonempty(text.compact(text.first_nonempty(_text("tool_name"), _text("tool"), _text("name"))), text.compact(F.col("actor_name")))
    return rows.select("session_key", "sequence", tool.alias("tool"), text.compact(F.col("context")).alias("command"), "exit_code", "summary")
