"""Fact tables, command pairing and rollups."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import ids, payload, text

DERIVATION = "1"
STARTED, FINISHED = "command.started", "command.finished"


def envelope_facts(envelopes: DataFrame, ledger_instance: str) -> DataFrame:
    """22 columns per envelope; no payload text."""
    t = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    locator = text.first_nonempty(F.col("project_locator"), F.col("hint_project"), trim=True)
    return envelopes.select(
        ids.stable_id("gaenv", F.col("machine_id"), F.col("envelope_id")).alias("global_envelope_key"), t("machine_id"),
        F.lit(ledger_instance).alias("ledger_instance_id"), "ledger_offset", "envelope_id", "source_type", "source_instance_id", "artifact_id",
        t("artifact_locator"), locator.alias("project_locator"), ids.project_key(locator).alias("project_key"),
        F.coalesce("hint_session", F.lit("")).alias("source_session_key"),
        ids.global_session_key(F.col("machine_id"), F.col("source_instance_id"), F.col("hint_session")).alias("global_session_key"),
        "cursor_kind", "cursor_value", "observed_at", "source_timestamp", "raw_kind", "content_hash",
        F.octet_length("raw_payload").cast("bigint").alias("payload_bytes"), F.array_join("capabilities", ",").alias("capabilities_csv"),
        F.col("confidence").alias("parse_confidence"))


def event_facts(events: DataFrame, ledger_instance: str) -> DataFrame:
    """26 columns per event; names, calls and numbers of the payload only."""
    v = F.try_parse_json("payload")
    rows = events.withColumn("__v", v)
    v = F.col("__v")
    s = lambda *p: F.coalesce(payload.string(v, *p), F.lit(""))
    return rows.select(
        ids.stable_id("gaevt", F.col("machine_id"), F.col("event_id")).alias("global_event_key"),
        ids.stable_id("gaenv", F.col("machine_id"), F.col("envelope_id")).alias("global_envelope_key"), "machine_id",
        F.lit(ledger_instance).alias("ledger_instance_id"), "ledger_offset", "event_id", "event_version", "source_type", "source_instance_id",
        "session_key", "source_session_key",
        ids.global_session_key(F.col("machine_id"), F.col("source_instance_id"), F.col("source_session_key")).alias("global_session_key"),
        "project_key", "project_locator", "sequence", "timestamp", "kind", "actor_kind", "actor_name", "parse_status",
        F.array_join("capabilities", ",").alias("capabilities_csv"),
        text.first_nonempty(s("tool_name"), s("tool"), s("name"), F.col("actor_name"), trim=True).alias("tool_name"),
        text.first_nonempty(s("call_id"), s("payload", "call_id"), trim=True).alias("call_id"),
        payload.number(v, "exit_code").alias("exit_code"), payload.number(v, "duration_ms").alias("duration_ms"), "envelope_id")


def duplicates(facts: DataFrame, key: str) -> DataFrame:
    """Primary keys that occur more than once."""
    return facts.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def deduplicated(facts: DataFrame, key: str) -> DataFrame:
    """Rows with the smallest offset of each key."""
    return (facts.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("ledger_offset"))).where("__n = 1").drop("__n"))


def pair(commands: DataFrame, second_key: str | None = None) -> DataFrame:
    """(session, start_key, finish_key) of :func:`pair_sides`; ``commands`` needs no ``side``."""
    pairs = pair_sides(commands.withColumn("side", F.struct("key")), second_key)
    return pairs.select("session", F.col("s.key").alias("start_key"), F.col("f.key").alias("finish_key"))


def pair_sides(commands: DataFrame, second_key: str | None = None) -> DataFrame:
    """(session, s, f): starts and finishes of commands, each pair in one row.

    ``commands`` has session, key, started, call_id, the order column ``at`` and ``side``,
    a struct that becomes ``s`` of a start and ``f`` of a finish.  A
    finish takes the oldest open start with its call id; without one it takes the
    oldest open start of any kind, or (with ``second_key``) the oldest with equal text.

    One shuffle by session: its rows are read in order, as a stream, and only the sides
    of open starts are kept.
    """
    other = F.lit("") if second_key is None else F.col(second_key)
    rows = commands.select("session", "at", "started", F.coalesce("call_id", F.lit("")).alias("call_id"), F.coalesce(other, F.lit("")).alias("second"), "side")
    rows = rows.repartition("session").sortWithinPartitions("session", "at").drop("at")
    side = rows.schema["side"].dataType.simpleString()
    return rows.mapInArrow(_fold(second_key is not None), f"session string, s {side}, f {side}")


class _Open:
    """Open starts of one session, oldest first: where their sides are, and where each call id or text waits."""

    def __init__(self):
        self.sides: dict[int, int] = {}
        self.calls: dict[str, deque] = defaultdict(deque)
        self.texts: dict[str, deque] = defaultdict(deque)

    def start(self, n: int, side: int, call: str, second: str) -> None:
        self.sides[n] = side
        self.calls[call].append(n)
        self.texts[second].append(n)

    def take(self, waiting: dict[str, deque], name: str) -> int | None:
        queue = waiting.get(name) if name else None
        while queue:
            side = self.sides.pop(queue.popleft(), None)
            if side is not None:
                return side
        return None

    def oldest(self) -> int | None:
        return self.sides.pop(next(iter(self.sides))) if self.sides else None


def _fold(by_text: bool):
    """Folds sessions that lie in a row, in order; state is one session's open starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session, state, n, held = object(), _Open(), 0, None

        def pairs(sides: pa.Array, who: list, starts: list, finishes: list) -> pa.RecordBatch:
            pick = lambda at: sides.take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(who, pa.string()), pick(starts), pick(finishes)], ["session", "s", "f"])

        for batch in batches:
            own = batch.column("side")
            before = 0 if held is None else len(held)
            sides = own if not before else pa.concat_arrays([held, own])
            who, starts, finishes = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("session", "started", "call_id", "second")]
            for i, (name, started, call, second) in enumerate(zip(*columns, strict=True), before):
                if name != session:
                    for side in state.sides.values():
                        who.append(session)
                        starts.append(side)
                        finishes.append(None)
                    session, state = name, _Open()
                if started:
                    n += 1
                    state.start(n, i, call, second)
                    continue
                found = state.take(state.calls, call)
                if found is None:
                    found = state.take(state.texts, second) if by_text else state.oldest()
                who.append(session)
                starts.append(found)
                finishes.append(i)
            yield pairs(sides, who, starts, finishes)
            held = sides.take(pa.array(list(state.sides.values()), pa.int64()))
            state.sides = dict(zip(state.sides, range(len(held)), strict=True))
        if held is not None and len(held):
            yield pairs(held, [session] * len(held), list(state.sides.values()), [None] * len(held))

    return run


def command_rollups(events: DataFrame) -> DataFrame:
    """20 columns per command: completed, start_only or finish_only."""
    commands = events.where(F.col("kind").isin(STARTED, FINISHED))
    rows = pair_sides(commands.select(
        F.col("global_session_key").alias("session"), F.col("global_event_key").alias("key"), (F.col("kind") == STARTED).alias("started"),
        "call_id", F.struct("sequence", "timestamp", "global_event_key").alias("at"), F.struct(*[F.col(c) for c in (
            "machine_id", "source_instance_id", "source_session_key", "tool_name", "actor_name", "call_id", "global_event_key",
            "global_envelope_key", "sequence", "timestamp", "exit_code", "duration_ms")]).alias("side")))
    both = F.col("s").isNotNull() & F.col("f").isNotNull()
    either = lambda c: text.first_nonempty(F.col(f"s.{c}"), F.col(f"f.{c}"), trim=True)
    first = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"f.{c}"))
    given = lambda c: F.coalesce(F.col(c), F.lit(""))
    elapsed = F.timestamp_diff("MILLISECOND", F.col("s.timestamp"), F.col("f.timestamp"))
    none = lambda c: F.coalesce(text.not_blank(F.col(c)), F.lit("none"))
    return rows.select(
        ids.stable_id("gacmd", first("machine_id"), F.lit(DERIVATION), none("s.global_envelope_key"), none("f.global_envelope_key")).alias("global_command_rollup_key"),
        F.lit(DERIVATION).alias("derivation_version"), first("machine_id").alias("machine_id"), F.col("session").alias("global_session_key"),
        first("source_instance_id").alias("source_instance_id"), either("source_session_key").alias("source_session_key"),
        F.when(both, "completed").when(F.col("s").isNotNull(), "start_only").otherwise("finish_only").alias("status"),
        either("tool_name").alias("tool_name"), either("actor_name").alias("actor_name"), either("call_id").alias("call_id"),
        given("s.global_event_key").alias("start_global_event_key"), given("f.global_event_key").alias("finish_global_event_key"),
        given("s.global_envelope_key").alias("start_global_envelope_key"), given("f.global_envelope_key").alias("finish_global_envelope_key"),
        F.col("s.sequence").alias("start_sequence"), F.col("f.sequence").alias("finish_sequence"),
        F.col("s.timestamp").alias("start_timestamp"), F.col("f.timestamp").alias("finish_timestamp"), F.col("f.exit_code").alias("exit_code"),
        F.coalesce("f.duration_ms", F.when(both & (F.col("f.timestamp") >= F.col("s.timestamp")), elapsed)).alias("duration_ms"))


def session_rollups(events: DataFrame, commands: DataFrame) -> DataFrame:
    """24 columns per session."""
    n = lambda cond: F.count_if(cond).cast("bigint")
    kind = F.col("kind")
    named = ["machine_id", "source_type", "source_instance_id", "session_key", "source_session_key", "project_key", "project_locator"]
    bad_exit = (kind == FINISHED) & (F.col("exit_code") != 0)
    per = events.groupBy("global_session_key").agg(
        F.min_by(F.struct(*named), F.struct("sequence", "timestamp", "global_event_key")).alias("first"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"), F.count(F.lit(1)).alias("event_count"),
        n(kind == "message.user").alias("user_message_count"), n(kind == "message.agent").alias("agent_message_count"),
        n(kind == "message.system").alias("system_message_count"), n(kind.isin(STARTED, FINISHED)).alias("command_event_count"),
        n(kind == "tool.failed").alias("tool_failure_count"), n(kind == "file.patch").alias("file_patch_count"),
        (n(kind == "tool.failed") + n(bad_exit)).alias("failure_signal_count"),
        n(~F.coalesce("parse_status", F.lit("")).isin("", "ok")).alias("parse_failure_count"))
    cmd = commands.groupBy("global_session_key").agg(
        F.count(F.lit(1)).alias("command_rollup_count"), n(F.col("exit_code") != 0).alias("failed_command_rollup_count"),
        n(F.col("status").isin("start_only", "finish_only")).alias("incomplete_command_rollup_count"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return per.join(cmd, "global_session_key", "left").select(
        "global_session_key", F.lit(DERIVATION).alias("derivation_version"), *[F.col(f"first.{c}").alias(c) for c in named],
        "first_timestamp", "last_timestamp", F.timestamp_diff("MILLISECOND", F.col("first_timestamp"), F.col("last_timestamp")).alias("duration_ms"),
        "event_count", "user_message_count", "agent_message_count", "system_message_count", "command_event_count",
        zero("command_rollup_count"), zero("failed_command_rollup_count"), zero("incomplete_command_rollup_count"),
        "tool_failure_count", "file_patch_count", "failure_signal_count", "parse_failure_count")
