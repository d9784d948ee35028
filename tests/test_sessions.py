"""Normalization, pairing, redaction, presets, delivery and sinks on small fixtures."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sessionlake import registry
from sessionlake.functions import text
from sessionlake.operators import delivery, facts, ledger, nested, normalize, policy, sessions, sinks
from sessionlake.plans import build, presets, sql
from sessionlake.sources import chat, files
from sessionlake.streaming import ingest

def _at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def _envelopes(spark, records, resolver=files.nested_resolver, source="codex", instance="codex-local"):
    rows = [("art_x", "/logs/s.jsonl", "/logs", i + 1, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    lines = spark.createDataFrame(rows, "artifact_id string, locator string, project_root string, line long, value string")
    return files.envelopes(lines, resolver, source, instance, "machine-a", ["messages"], _at())


def _ledger(spark, records, **kw):
    return _envelopes(spark, records, **kw).withColumn("ledger_offset", F.col("line"))


def test_session_id_matches_known_value(spark):
    from sessionlake.functions import ids

    got = spark.range(1).select(ids.stable_id("sess", F.lit("a"), F.lit(None).cast("string"))).first()[0]
    import hashlib

    assert got == "sess_" + hashlib.sha256(b"a\x1f").hexdigest()[:16]


def test_rfc3339_fraction(spark):
    from sessionlake.functions import ids

    rows = spark.createDataFrame([("2024-01-02 03:04:05.120000",), ("2024-01-02 03:04:05",), ("2024-01-02 03:04:10",)], "t string")
    got = [r[0] for r in rows.select(ids.rfc3339_nano(F.col("t").cast("timestamp"))).collect()]
    assert got == ["2024-01-02T03:04:05.12Z", "2024-01-02T03:04:05Z", "2024-01-02T03:04:10Z"]


def test_carry_forward_and_fallbacks(spark):
    got = _envelopes(spark, [{"type": "a"}, {"type": "b", "session_id": "s1", "project": "/p"}, "broken", {"x": 1}]).orderBy("line").collect()
    assert [r["hint_session"] for r in got] == ["s.jsonl", "s1", "s1", "s1"]
    assert [r["hint_project"] for r in got] == ["/logs", "/p", "/p", "/p"]
    assert [r["raw_kind"] for r in got] == ["a", "b", "unknown", "unknown"]
    assert json.loads(got[2]["raw_payload"]) == {"raw_text": "broken"}


def test_nested_session(spark):
    msg = lambda **p: {"type": "response_item", "payload": p}
    records = [
        {"timestamp": "2024-01-01T10:00:00Z", "type": "session_meta", "payload": {"id": "sid", "cwd": "/tmp/project"}},
        {"type": "event_msg", "payload": {"type": "user_message", "message": "hi"}},
        msg(type="message", role="assistant", content=[{"type": "output_text", "text": "yo"}]),
        msg(type="function_call", name="exec_command", arguments='{"cmd":"ls"}', call_id="c1"),
        msg(type="function_call_output", call_id="c1", output="Command: /bin/bash -lc 'ls -a'\nProcess exited with code 3\nOutput:\nno"),
        {"type": "event_msg", "payload": {"type": "token_count", "info": {"n": 1}}},
        {"type": "turn_context", "payload": {"model": "m"}}, {"type": "compacted", "payload": {}},
    ]
    got = normalize.normalize(_ledger(spark, records), nested.classify).orderBy("sequence").collect()
    assert [r["kind"] for r in got] == ["session.started", "message.user", "message.agent", "command.started", "command.finished",
                                        "usage.reported", "model.changed", "message.system"]
    assert {r["source_session_key"] for r in got} == {"sid"} and {r["project_locator"] for r in got} == {"/tmp/project"}
    done = json.loads(got[4]["payload"])
    assert (done["exit_code"], done["command"], done["tool_name"]) == (3, "ls -a", "exec_command")


def test_flat_session_with_tool_result(spark):
    records = [{"created_at": "2024-01-01T10:00:00Z", "kind": "session_start", "conversation_id": "c", "workspace": "/w"},
               {"kind": "tool_result", "exit_code": 1, "stderr": "bad"}, {"kind": "tool_result", "exit_code": 0}, "[1]"]
    got = normalize.normalize(_ledger(spark, records, resolver=files.flat_resolver, source="claude")).orderBy("sequence").collect()
    assert [r["kind"] for r in got] == ["session.started", "tool.failed", "tool.finished", "error"]
    assert [r["parse_status"] for r in got] == ["ok", "ok", "ok", "failed"]


def test_versions_round_trip(spark):
    rows = _ledger(spark, [{"type": "message.user", "session_id": "s", "text": "<a>"}])
    one = normalize.normalize(rows)
    two = normalize.rewrite(one, 2, rows)
    back = normalize.rewrite(two, "v1")
    assert one.first()["event_id"] != two.first()["event_id"]
    assert one.first()["event_id"] == back.first()["event_id"]
    with pytest.raises(ValueError):
        normalize.rewrite(one, "v9")


def _rule(rows, by_text):
    opened, out = [], []
    for key, started, call, second in rows:
        if started:
            opened.append((key, call, second))
            continue
        hit = next((o for o in opened if call and o[1] == call), None)
        if hit is None and by_text:
            hit = next((o for o in opened if second and o[2] == second), None)
        elif hit is None and opened:
            hit = opened[0]
        if hit:
            opened.remove(hit)
        out.append((hit[0] if hit else None, key))
    return out + [(o[0], None) for o in opened]


@pytest.mark.parametrize("by_text", [False, True])
@pytest.mark.parametrize("partitions", [1, 7])
def test_pairing_equals_the_sequential_rule(spark, by_text, partitions):
    rnd, rows, want = random.Random(5), [], set()
    for s in range(300):
        calls = rnd.choice([[""], ["a", "b"], ["", "a", "b"]])
        one = [(f"{s}-{i}", rnd.random() < 0.5, rnd.choice(calls), rnd.choice(["", "x", "y"])) for i in range(rnd.randrange(1, 9))]
        want |= {(str(s), *p) for p in _rule(one, by_text)}
        rows += [(str(s), k, st, c, i, t) for i, (k, st, c, t) in enumerate(one)]
    df = spark.createDataFrame(rows, "session string, key string, started boolean, call_id string, at int, command string").repartition(partitions)
    got = facts.pair(df, "command" if by_text else None)
    assert {tuple(r) for r in got.collect()} == want


def test_redaction_is_recursive_and_keeps_non_objects(spark):
    p = policy.Policy(redact_keys=("token",), regexes=((r"Bearer \w+", "Bearer [REDACTED]"), ("(", "x")))
    rows = spark.createDataFrame([('{"a":[{"token":{"x":1}}],"h":"Authorization: Bearer abc123"}',), ("[1]",), (None,), ("oops",)], "p string")
    got = [r[0] for r in rows.select(policy.redacted(p, F.col("p"))).collect()]
    assert json.loads(got[0]) == {"a": [{"token": "[REDACTED]"}], "h": "Authorization: Bearer [REDACTED]"}
    assert got[1:] == ["[1]", None, "oops"]
    deny = policy.Policy(denied_paths=("/a/b",), allowed_projects=())
    paths = spark.createDataFrame([("/a/bc",), ("/a//b/x",), ("/c",)], "p string")
    assert [r[0] for r in paths.select(policy.admitted(deny, F.col("p"))).collect()] == [False, False, True]
    assert policy.Policy(drop_raw=True, redact_keys=("a",)).overridden(policy.Policy()) == policy.Policy(redact_keys=("a",))


def test_failure_excerpt(spark):
    raw = "Command: x\nWall time: 1\nOutput:\nstarting\nerror: boom:\nrun go mod tidy\n"
    rows = spark.createDataFrame([(raw,), ("",), (None,), ("first:\nsecond",), ("plain",)], "t string")
    got = [r[0] for r in rows.select(text.failure_excerpt(F.col("t"))).collect()]
    assert got == ["error: boom: run go mod tidy", "", "", "first: second", "plain"]


def test_display_and_formats(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.format_millis(F.lit(61_000))) == "1m" and one(text.format_millis(F.lit(None).cast("long"))) == "0s"
    assert one(text.format_bytes(F.lit(1536))) == "1.5 KiB"
    assert one(text.preview(F.lit("```a  b```"))) == "a b"
    assert one(text.unwrap_command(F.lit("/bin/bash -lc 'ls -a'"))) == "ls -a"
    assert one(text.display_session(F.lit("t"), F.lit(" "), F.lit(""), F.lit("gasess_0123456789"))) == "t#23456789"


def test_frontier_of_known_case(spark):
    rows = [("s", 1, "acked"), ("s", 2, "skipped")]
    df = lambda r: spark.createDataFrame(r, "sink_id string, ledger_offset long, status string")
    assert tuple(delivery.frontier(df(rows)).first()) == ("s", 2, 2, 0)
    assert tuple(delivery.frontier(df([*rows, ("s", 3, "quarantined")])).first()) == ("s", 2, 3, 1)


def test_byte_cap_lets_the_first_item_pass(spark):
    rows = [("s", i, "pending", b) for i, b in [(1, 500), (2, 60), (3, 50), (5, 10)]]
    df = spark.createDataFrame(rows, "sink_id string, ledger_offset long, status string, payload_bytes long")
    got = {(r["ledger_offset"], r["__island"], r["batch_no"]) for r in delivery.byte_capped(df, 100).collect()}
    assert {(o, b) for o, _, b in got} == {(1, 0), (2, 1), (3, 2), (5, 0)}


def test_byte_cap_streams_an_unbroken_ledger(spark):
    rnd = random.Random(5)
    sizes = {s: [rnd.randrange(1, 90) for _ in range(2500)] for s in ("a", "b")}
    rows = [(s, i, "pending", b) for s, v in sizes.items() for i, b in enumerate(v, 1) if s == "a" or i % 700]
    df = spark.createDataFrame(rows, "sink_id string, ledger_offset long, status string, payload_bytes long").repartition(5)
    want, island, last = {}, None, {}
    for s, o, _, b in rows:
        if last.get(s) != o - 1:
            n = size = count = 0
        elif size + b > 300 or count >= 6:
            n, size, count = n + 1, 0, 0
        want[s, o], size, count, last[s] = n, size + b, count + 1, o
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    out = delivery.byte_capped(df, 300, 6)
    got = {(r["sink_id"], r["ledger_offset"]): r["batch_no"] for r in out.collect()}
    plan = out._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert got == want
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_byte_capped_query_has_the_unfiltered_sink(spark):
    rows = registry.QUERIES["h2_byte_capped_batches"](spark, "/root/testdata/sf0.001")
    assert {r["sink_id"] for r in rows.select("sink_id").distinct().collect()} == {"archive", "lake"}


def test_sql_guard(spark):
    for good in ("select 1", "with a as (select 1) select * from a"):
        sql.check_read_only(spark, good)
    for bad in ("drop table x", "insert into x values (1)", "set a=1"):
        with pytest.raises(ValueError):
            sql.check_read_only(spark, bad)


def test_presets_and_previews(spark):
    base = {"session_id": "s", "project": "repo://project"}
    records = [dict(base, type="session.started"), dict(base, type="message.user", text="hello"), dict(base, type="command.started", call_id="call-1"),
               dict(base, type="command.finished", call_id="call-1", exit_code=1, duration_ms=1200), dict(base, type="tool.failed", exit_code=2)]
    rows = _ledger(spark, records)
    t = build.tables(rows)
    s = t.session_rollups.first()
    assert (s["event_count"], s["failed_command_rollup_count"], s["failure_signal_count"], s["user_message_count"]) == (5, 1, 2, 1)
    assert presets.preset("failures", t, _at()).first()["status"] == "failed"
    assert presets.preset("", t, _at()).first()["coverage"] == "complete_history"
    for bad in (("nope", 0), ("timeline", -1)):
        with pytest.raises(ValueError):
            presets.preset(bad[0], t, _at(), bad[1])
    events = normalize.normalize(rows).join(t.event_facts.select("event_id", "global_session_key"), "event_id")
    show = lambda p: presets.previews(t, t.session_rollups, events, p).first()
    assert (show(policy.Policy())["first_user"], show(policy.Policy())["content_status"]) == ("hello", "available")
    assert show(policy.Policy(redact_keys=("text",)))["content_status"] == "redacted"
    assert show(policy.Policy(denied_paths=("repo://project",)))["content_status"] == "filtered"


def test_head_tail_and_summary(spark):
    rows = _ledger(spark, [{"type": "message.user", "session_id": "s", "text": str(i)} for i in range(6)])
    events = normalize.normalize(rows)
    got = sessions.head_tail(events.select("session_key", "sequence"), 4).orderBy("sequence").collect()
    assert [(r["sequence"], r["omitted"]) for r in got] == [(1, 2), (2, 2), (5, 2), (6, 2)]
    assert sessions.summarize(events).first()["kinds"] == "message.user"


def test_files_snapshot_sinks_and_stream(spark, tmp_path):
    root = tmp_path / "logs"
    (root / ".git").mkdir(parents=True)
    (root / ".git" / "x.jsonl").write_text("{}\n")
    (root / "a.jsonl").write_text('{"type":"message.user","session_id":"s"}\n\n{"type":"message.agent"}\n')
    (root / "b.json").write_text('[{"type":"a"},{"type":"b"}]')
    assert files.discover(spark, str(root)).count() == 2
    assert [(r["line"]) for r in files.read_lines(spark, str(root)).where("locator like '%a.jsonl'").orderBy("line").collect()] == [1, 3]
    assert files.read_documents(spark, str(root)).count() == 2
    rows = _ledger(spark, [{"type": "message.user", "session_id": "s", "text": "x"}])
    manifest = build.export(spark, build.tables(rows), str(tmp_path / "snap"), "machine-a", "ledger-1", "2024-01-01T00:00:00Z")
    assert [t["row_count"] for t in manifest["tables"]] == [1, 1, 0, 1]
    build.compatible(manifest, "machine-a", "ledger-1")
    with pytest.raises(ValueError):
        build.compatible(manifest, "other", "ledger-1")
    events = normalize.normalize(rows)
    sinks.jsonl(events, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["payload"]["text"] == "x"
    sealed = delivery.seal(delivery.batches(delivery.outbox(events, {"a": policy.Policy()})))
    sent = sinks.deliver_with(sealed, lambda sink, batch, body: ("success", sink)).first()
    assert (sent["outcome"], sent["message"]) == ("success", "a")
    with pytest.raises(ValueError):
        delivery.object_key("{prefix}/x", "p")
    env = _envelopes(spark, [{"type": "message.user", "session_id": "s"}, {"type": "message.agent"}])
    for n in (1, 2):
        env.write.mode("append").parquet(str(tmp_path / "in"))
        ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "ledger"), str(tmp_path / "events"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "events")).orderBy("ledger_offset").collect()
    assert [r["ledger_offset"] for r in got] == [1, 2, 3, 4] and [r["sequence"] for r in got] == [1, 2, 3, 4]


def test_chat_columns_and_empty_inputs(spark):
    with pytest.raises(ValueError, match="source"):
        chat.require(spark.createDataFrame([], "id string"), chat.SESSION_COLUMNS, "sessions")
    empty = _ledger(spark, [{"type": "x"}]).where("false")
    assert build.tables(empty).session_rollups.count() == 0
    good, dead = ledger.bind_machine(_ledger(spark, [{"type": "x"}]), F.lit("machine-b"))
    assert good.count() == 0 and dead.first()["message"] == "machine ids differ"


def test_hidden_folders_upper_case_names_and_broken_arrays(spark, tmp_path):
    for name, body in {"a.jsonl": '{"n":1}\n\n{"n":2}\n', ".codex/deep/U.JSONL": '{"n":3}', "_old/b.json": '[{"n":4},{"n":5}]', ".git/c.jsonl": '{"n":6}',
                       "bad.json": '[{"n":', "D.Json": '{"n":7}'}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    root = str(tmp_path)
    assert {r["relative"] for r in files.discover(spark, root).collect()} == {"a.jsonl", ".codex/deep/U.JSONL", "_old/b.json", "bad.json", "D.Json"}
    rows = files.artifact_lines(spark, root)
    got = {(r["locator"][len(root) + 1 :], r["line"], r["value"], r["cursor_kind"]) for r in rows.collect()}
    assert got == {("a.jsonl", 1, '{"n":1}', "line"), ("a.jsonl", 3, '{"n":2}', "line"), (".codex/deep/U.JSONL", 1, '{"n":3}', "line"),
                   ("_old/b.json", 1, '{"n":4}', "item"), ("_old/b.json", 2, '{"n":5}', "item"), ("D.Json", 1, '{"n":7}', "item")}
    dead = files.broken_documents(spark, root).collect()
    assert [(r["kind"], r["payload"]) for r in dead] == [("source_read", '[{"n":')]
    done = files.next_checkpoints(rows)
    assert files.artifact_lines(spark, root, done).count() == 0


def test_values_are_carried_over_chunks_of_lines(spark, monkeypatch):
    monkeypatch.setattr(files, "CHUNK", 3)
    rows = [("art", "/d/s.jsonl", "/root", i, '{"conversation_id":"s%d"}' % i if i in (2, 7) else "{}") for i in range(1, 14)]
    lines = spark.createDataFrame(rows, "artifact_id string, locator string, project_root string, line long, value string")
    out = files.envelopes(lines, files.flat_resolver, "t", "i", "m", [], F.lit("2024-01-01").cast("timestamp"))
    assert [r["hint_session"] for r in out.orderBy("line").collect()] == ["s.jsonl"] + ["s2"] * 5 + ["s7"] * 7


def test_replay_takes_the_sinks_of_the_plan(spark):
    from sessionlake.operators import delivery

    events = spark.createDataFrame([(i, "p", "{}", f"e{i}", None) for i in range(1, 6)],
                                   "ledger_offset long, project_locator string, payload string, event_id string, timestamp timestamp")
    classes = spark.createDataFrame([("a", "idempotent"), ("b", "append_only")], "sink_id string, delivery_class string")
    sinks = {"a": policy.Policy(), "b": policy.Policy()}
    assert {(r["sink_id"], r["ledger_offset"]) for r in delivery.replay(events, sinks, classes, after=2, upto=4).collect()} == {("a", 3), ("a", 4)}
    assert delivery.replay(events, sinks, classes, include_unsafe=True).count() == 10
    assert delivery.replay(events, sinks, classes, requested=["b"]).count() == 0
