"""Builds in two phases, streaming state, frontiers, chat profiles and replay, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F
from test_sessions import _envelopes, _ledger

from sessionlake.operators import delivery, facts, normalize, policy
from sessionlake.plans import build, cache, sql
from sessionlake.sources import chat
from sessionlake.streaming import ingest


def rows_of(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def some_records(rnd, n):
    kinds = ["message.user", "command.started", "command.finished", "tool.failed"]
    return [{"type": rnd.choice(kinds), "session_id": f"s{rnd.randrange(12)}", "call_id": rnd.choice(["", "c1", "c2"]), "exit_code": rnd.randrange(2)} for _ in range(n)]


def test_a_refreshed_cache_equals_a_rebuild(spark, tmp_path):
    ledger = _ledger(spark, some_records(random.Random(1), 120)).cache()
    path, whole = str(tmp_path / "a"), str(tmp_path / "b")
    for upto in (50, 51, 51, 120):
        now = cache.refresh(spark, path, ledger.where(F.col("ledger_offset") <= upto), "machine-a", "ledger-1")
        assert (now["state"], now["last_clean_offset"], now["cache_min"], now["cache_max"]) == ("ready", upto, 1, upto)
    cache.refresh(spark, whole, ledger, "machine-a", "ledger-1")
    one, other = cache.read(spark, path, check=True), cache.read(spark, whole, check=True)
    plain = build.tables(ledger, "ledger-1")
    for name in build.KEYS:
        assert rows_of(getattr(one, name)) == rows_of(getattr(other, name)) == rows_of(getattr(plain, name)), name


def test_an_interrupted_build_asks_for_a_rebuild(spark, tmp_path, monkeypatch):
    ledger = _ledger(spark, some_records(random.Random(2), 30))
    path = str(tmp_path / "c")
    assert cache.state(spark, path) is None
    with pytest.raises(cache.RebuildRequired):
        cache.read(spark, path)
    cache.refresh(spark, path, ledger.where("ledger_offset <= 10"), "machine-a", "ledger-1")
    with monkeypatch.context() as m:
        m.setattr(facts, "session_rollups", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            cache.refresh(spark, path, ledger, "machine-a", "ledger-1")
    assert cache.state(spark, path)["state"] == "building"
    for again in (lambda: cache.read(spark, path), lambda: cache.refresh(spark, path, ledger, "machine-a", "ledger-1")):
        with pytest.raises(cache.RebuildRequired):
            again()
    cache.refresh(spark, path, ledger, "machine-a", "ledger-1", rebuild=True)
    assert cache.read(spark, path, check=True).event_facts.count() == 30
    for machine, instance in (("machine-b", "ledger-1"), ("machine-a", "ledger-2")):
        with pytest.raises(ValueError):
            cache.refresh(spark, path, ledger, machine, instance)
    now = cache.state(spark, path)
    spark.read.parquet(f"{path}/v{now['versions'][-1]}/event_facts").limit(1).write.mode("append").parquet(f"{path}/v{now['versions'][-1]}/event_facts")
    with pytest.raises(cache.RebuildRequired, match="event_facts"):
        cache.read(spark, path, check=True)


def test_a_stream_goes_on_from_its_state(spark, tmp_path):
    at = {k: str(tmp_path / k) for k in ("in", "ledger", "events", "cp")}
    call = lambda name, call_id: {"type": "response_item", "payload": {"type": "function_call", "name": name, "call_id": call_id}}
    done = lambda call_id: {"type": "response_item", "payload": {"type": "function_call_output", "call_id": call_id, "output": ""}}
    parts = [[call("grep", "c1"), done("c1")], [done("c1"), call("exec_command", "c2")], [done("c2"), done("c9")], [call("sed", "c1")], [done("c1"), done("c2")]]
    for k, records in enumerate(parts):
        _envelopes(spark, records).withColumn("line", F.col("line") + 10 * k).write.mode("append").parquet(at["in"])
        ingest.ingest(spark, at["in"], at["ledger"], at["events"], at["cp"], nested_records=True, compact=2).awaitTermination()
    events = spark.read.parquet(at["events"])
    ledger = spark.read.parquet(at["ledger"]).drop("batch")
    from sessionlake.operators import nested

    whole = normalize.normalize(ledger, nested.classify)
    assert rows_of(events.drop("batch")) == rows_of(whole)
    assert [r.actor_name for r in events.orderBy("ledger_offset").collect()] == ["grep", "grep", "grep", "shell", "shell", "tool", "sed", "sed", "shell"]
    state = ingest.KeyedState(spark, at["cp"] + "-state/sequences", "session_key string, sequence long", 2)
    assert {r.batch for r in state.before(5).collect()} == {4} and state.before(0).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_frontiers_equal_a_walk(spark, seed):
    rnd = random.Random(seed)
    base = {"a": (0, 0), "b": (7, 20), "c": (5, 5), "d": (3, 9)}
    rows = [(s, o, rnd.choices(["acked", "skipped", "quarantined", "pending"], [80, 10, 3, 1])[0], rnd.choice(["", None, f"e{o}"])) for s in "abc" for o in range(1, 90) if rnd.random() > 0.02]
    at = {(s, o): (st, e) for s, o, st, e in rows}
    want = set()
    for s, (acked, terminal) in base.items():
        last = ""
        while (x := at.get((s, acked + 1))) and x[0] in ("acked", "skipped"):
            acked, last = acked + 1, x[1] or last
        while (x := at.get((s, terminal + 1))) and x[0] != "pending":
            terminal += 1
        want.add((s, acked, terminal, max(terminal - acked, 0), last))
    items = spark.createDataFrame(rows, "sink_id string, ledger_offset long, status string, last_event_id string").repartition(3)
    stored = spark.createDataFrame([(s, *v) for s, v in base.items()], "sink_id string, acked_contiguous_offset long, terminal_contiguous_offset long")
    assert {tuple(r) for r in delivery.frontier(items, stored, width=8).collect()} == want


def test_commands_are_paired_in_one_shuffle(spark):
    rnd = random.Random(4)
    rows = [(f"s{rnd.randrange(3)}", f"k{i}", rnd.random() < 0.5, rnd.choice(["", "x", "y"]), i, rnd.choice(["", "a", "b"])) for i in range(400)]
    df = spark.createDataFrame(rows, "session string, key string, started boolean, call_id string, at long, text string").repartition(5)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    for second in (None, "text"):
        want = set()
        for s in {r[0] for r in rows}:
            left = []
            for _, key, started, call, _, text in sorted((r for r in rows if r[0] == s), key=lambda r: r[4]):
                if started:
                    left.append((key, call, text))
                    continue
                fits = [x for x in left if call and x[1] == call] or ([x for x in left if text and x[2] == text] if second else list(left))
                if fits:
                    left.remove(fits[0])
                want.add((s, fits[0][0] if fits else None, key))
            want |= {(s, x[0], None) for x in left}
        out = facts.pair(df, second)
        assert {tuple(r) for r in out.collect()} == want
        assert out._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [session") == 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def chat_tables(spark, ids):
    schema = "id long, session_id string, role string, content string, tool_call_id string, tool_calls string, tool_name string, timestamp double, token_count long, finish_reason string, reasoning string, " \
             "reasoning_content string, reasoning_details string, codex_reasoning_items string, codex_message_items string"
    messages = spark.createDataFrame([(i, "s", "user", f"m{i}", *[None] * 3, 1.0, None, *[None] * 6) for i in ids], schema)
    sessions = spark.createDataFrame([], "id string, source string, model string, system_prompt string, started_at double, ended_at double, title string, input_tokens long, output_tokens long, "
                                         "reasoning_tokens long, estimated_cost_usd double, actual_cost_usd double")
    return messages, sessions


def test_chat_profiles_are_one_table_with_cursors(spark):
    data = {name: (f"/db/{name}", *chat_tables(spark, ids)) for name, ids in (("default", [1, 2, 3]), ("zed", [5]), ("abc", [2, 9]), ("../x", [1]))}
    seen = F.lit("2024-01-01").cast("timestamp")
    read = lambda chosen, checkpoints=None: chat.read_profiles(data, chosen, "inst", "m", seen, checkpoints)
    rows, cursors = read("all")
    assert rows.count() == 6 and {(r.profile, r.cursor) for r in cursors.collect()} == {("default", "3"), ("abc", "9"), ("zed", "5")}
    assert rows.select("artifact_id").distinct().count() == 3
    stored = {r.profile: (r.cursor, r.token) for r in cursors.collect()}
    rows, cursors = read(" zed, ../x , zed, none", stored)
    assert rows.count() == 0 and {(r.profile, r.cursor) for r in cursors.collect()} == {("default", "3"), ("zed", "5")}
    other = {"default": ("2", "another artifact")}
    assert read("", other)[0].count() == 3
    own = stored["default"][1]
    assert read("", {"default": (" 2 ", own)})[0].count() == 1
    for bad in (("2", ""), ("2", None), ("two", own)):
        with pytest.raises(ValueError, match="checkpoint cursor"):
            read("", {"default": bad})


def test_replay_numbers_the_ledger_anew(spark):
    ledger = _ledger(spark, [{"type": "message.user", "session_id": "s", "text": str(i)} for i in range(4)])
    classes = spark.createDataFrame([("a", "idempotent"), ("b", "append_only")], "sink_id string, delivery_class string")
    sinks = {"a": policy.Policy(), "b": policy.Policy()}
    assert {r.sink_id for r in delivery.replay_ledger(ledger, sinks, classes).collect()} == {"a"}
    assert delivery.replay_ledger(ledger, sinks, classes, include_unsafe=True).count() == 8
    for requested in (["b"], ["none"]):
        with pytest.raises(ValueError, match="no sinks"):
            delivery.replay_ledger(ledger, sinks, classes, requested=requested)


def test_own_sql_has_no_previews(spark):
    with pytest.raises(ValueError, match="previews"):
        sql.run(spark, None, "select 1", previews=True)

