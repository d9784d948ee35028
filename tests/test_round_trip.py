"""Batches, sealed formats, canonical lines, redaction, the SQL guard and odd records, against plain versions."""

import datetime as dt
import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from sessionlake.functions import payload, regexes
from sessionlake.operators import cutting, delivery, nested, normalize, policy, sessions, sinks
from sessionlake.plans import sql
from sessionlake.sources import canonical

ITEMS = "sink_id string, ledger_offset long, status string, payload_bytes long, created_at timestamp"


def queue(rnd, gap, n=700):
    rows = []
    for sink in "ab":
        at = 0
        for _ in range(n):
            at += 1 + (rnd.random() < gap) * rnd.choice([1, 2, 40, 3000])
            rows.append((sink, at, "pending", rnd.choice([0, 0, 10, 30, 60, 100, 150]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(900))))
    return rows


def one_batch(q, i, max_events, max_bytes):
    """The batch from item ``i`` on, as a plain loop selects it, and whether it is full."""
    chosen, total, full = [], 0, False
    for j in range(i, len(q)):
        if q[j][1] != q[i][1] + j - i or (max_bytes > 0 and total > 0 and total + q[j][3] > max_bytes):
            break
        chosen.append(q[j])
        total += q[j][3]
        if len(chosen) >= max_events or (max_bytes > 0 and total >= max_bytes):
            full = True
            break
    return chosen, full


@pytest.mark.parametrize(("max_events", "max_bytes", "gap"), [(5, 100, 0.02), (1, 0, 0.3), (7, 0, 0.1), (4, 60, 0.0)])
def test_batches_cut_in_blocks_equal_a_loop(spark, monkeypatch, max_events, max_bytes, gap):
    monkeypatch.setattr(cutting, "FAN", 3)
    monkeypatch.setattr(cutting, "RANGE", 50)
    rows = queue(random.Random(max_events), gap)
    want = {}
    for sink in "ab":
        q = [r for r in rows if r[0] == sink]
        i = 0
        while i < len(q):
            if i == 0 or q[i][1] != q[i - 1][1] + 1:
                island, number = q[i][1], 0
            chosen, _ = one_batch(q, i, max_events, max_bytes)
            want |= {(sink, r[1]): (chosen[0][1], chosen[-1][1], number, island) for r in chosen}
            i, number = i + len(chosen), number + 1
    df = spark.createDataFrame(rows, ITEMS).repartition(5)
    got = {(r.sink_id, r.ledger_offset): (r.batch_start, r.batch_end, r.batch_no, r["__island"]) for r in delivery.byte_capped(df, max_bytes, max_events).collect()}
    assert got == want


def test_ready_batches_stop_at_the_first_that_is_not_ready(spark):
    rows = queue(random.Random(8), 0.05, 300)
    rules = {"a": delivery.Batching(max_events=4, max_bytes=200, max_age=600 * 60), "b": delivery.Batching(max_events=1, window_every=3600, window_offset=120)}
    now = dt.datetime(2024, 1, 1, 14)
    want = set()
    for sink, rule in rules.items():
        q = [r for r in rows if r[0] == sink]
        i = 0
        while i < len(q):
            chosen, full = one_batch(q, i, rule.max_events, rule.max_bytes)
            old = rule.max_age > 0 and (now - chosen[0][4]).total_seconds() >= rule.max_age
            born = (chosen[0][4] - dt.datetime(1970, 1, 1)).total_seconds() - rule.window_offset
            passed = not rule.window_every or (now - dt.datetime(1970, 1, 1)).total_seconds() >= (born // rule.window_every + 1) * rule.window_every + rule.window_offset
            if not ((full or old or rule.max_events == 1) and passed):
                break
            want |= {(sink, r[1], chosen[0][1], chosen[-1][1]) for r in chosen}
            i += len(chosen)
    got = delivery.ready_batches(spark.createDataFrame(rows, ITEMS), F.lit("2024-01-01 14:00:00").cast("timestamp"), rules)
    assert {(r.sink_id, r.ledger_offset, r.batch_start, r.batch_end) for r in got.collect()} == want and want


def test_queues_are_cut_once_into_a_row_for_each_batch(spark):
    rules = {"a": delivery.Batching(max_events=4, max_bytes=200, max_age=600 * 60), "b": delivery.Batching(max_events=2)}
    items = spark.createDataFrame(queue(random.Random(9), 0.05, 300), ITEMS)
    now = F.lit("2024-01-01 14:00:00").cast("timestamp")
    rows, spans = delivery.ready_batches(items, now, rules), delivery.ready_spans(items, now, rules)
    for out in (rows, spans):  # the cut is stored: what follows runs no Python
        assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    want = rows.groupBy("sink_id", "batch_start", "batch_end").agg(F.count(F.lit(1)), F.sum("payload_bytes"))
    assert sorted(map(tuple, spans.collect())) == sorted(map(tuple, want.collect())) != []


def test_texts_of_batches_are_never_broadcast(spark, tmp_path):
    events_of(spark, 9).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))  # files have a size, by which Spark would broadcast
    raw = events.select("*", *[F.lit("x").alias(c) for c in ("artifact_id", "artifact_locator", "cursor_kind", "cursor_value", "raw_kind", "content_hash", "hint_session", "hint_project")],
                        F.col("timestamp").alias("observed_at"), F.col("timestamp").alias("source_timestamp"), F.col("payload").alias("raw_payload"), F.lit(0.8).alias("confidence"))
    out = delivery.outbox_batches(events, raw, {"all": policy.Policy()})
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("raw is not null").count() == 8


def test_empty_queue(spark):
    df = spark.createDataFrame([], ITEMS)
    assert delivery.byte_capped(df, 10).count() == 0 and delivery.batches(df).count() == 0


# --- redaction ----------------------------------------------------------------------------


def redact(spark, rules, texts):
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    return [r[0] for r in df.select(policy.redacted(rules, F.col("p"))).collect()]


def test_keys_are_redacted_at_any_depth(spark):
    rules = policy.Policy(redact_keys=("password", "a b"))
    texts = ['{"password":{"k":[1,{"z":"q"}]},"x":1}', '{"b":[{"password":"s\\"e"},{"pass\\u0077ord":12,"c":true}],"password":null}', '{"password":[], "x": {"password" : {"a":{}} , "y":1}}',
             '{"n":"password","a b":[[]]}', '{"password":1,"password":"x"}', "[1]", "no", None, "{}", '{"é":"password: \\\\"}']
    assert redact(spark, rules, texts) == [
        '{"password":"[REDACTED]","x":1}', '{"b":[{"password":"[REDACTED]"},{"pass\\u0077ord":"[REDACTED]","c":true}],"password":"[REDACTED]"}',
        '{"password":"[REDACTED]", "x": {"password" : "[REDACTED]" , "y":1}}', '{"n":"password","a b":"[REDACTED]"}', '{"password":"[REDACTED]","password":"[REDACTED]"}',
        "[1]", "no", None, "{}", '{"é":"password: \\\\"}']


def test_patterns_follow_the_other_dialect(spark):
    texts = ['{"t 1":"a 12 \\"34\\"","n":[5,"p\\u0061 6"]}']
    run = lambda *rules: redact(spark, policy.Policy(regexes=rules), texts)[0]
    assert run(("[[:digit:]]+", "N")) == '{"t 1":"a N \\"N\\"","n":[5,"pa N"]}'
    assert run((r"\d", r"c\d")) == '{"t 1":"a c\\\\dc\\\\d \\"c\\\\dc\\\\d\\"","n":[5,"pa c\\\\d"]}'
    assert run((r"(a) (\d)", "$2x-${2}x-$$-$9")) == '{"t 1":"-1x-$-2 \\"34\\"","n":[5,"p-6x-$-"]}'
    assert run((r"(?P<w>[a-z])(?P<d_1>\s)", "${d_1}$w")) == '{"t 1":" a12 \\"34\\"","n":[5,"p a6"]}'
    assert run((r"(?i)A", "1"), ("1+", "y")) == '{"t 1":"y y2 \\"34\\"","n":[5,"py 6"]}'
    with pytest.warns(UserWarning, match="left out"):
        assert run(("(", "x"), ("a", "b")) == '{"t 1":"b 12 \\"34\\"","n":[5,"pb 6"]}'
    for bad in (r"(?=a)", r"(a)\1", "a**", "(", "[a", "x{2000}", "[[:nope:]]", r"\y", "*a", "(?P<n>a)(?P<n>b)"):
        with pytest.raises(ValueError):
            regexes.translate(bad)


@pytest.mark.parametrize(("pattern", "text", "found"), [
    (r"a$", "a\n", None), (r"(?m)a$", "a\n", "a"), (r"[^\s]+", "\x0bx y", "\x0bx"), (r"[]a]+", "]a]", "]a]"), (r"[a[b]+", "[ab", "[ab"), (r"x{,2}", "x{,2}", "x{,2}"),
    (r"\Qa.b\E+", "a.bb", "a.bb"), (r"\x{41}\101", "AA", "AA"), (r"[[:^alpha:]]", "ab1", "1"), (r"\pL\p{Greek}", "aα", "aα"), (r"a.c", "a\rc", "a\rc"), (r"[a&&b]+", "a&b", "a&b"),
    (r"\z", "x", ""), (r"(?:a|b)+?c", "abc", "abc"), ("(?U)a+", "aaa", "a"), ("(?U:a+?)(b+)", "aabb", "aabb"), ("#}]", "#}]", "#}]")])
def test_patterns_mean_the_same(spark, pattern, text, found):
    matcher = spark._jvm.java.util.regex.Pattern.compile(regexes.translate(pattern).pattern).matcher(text)
    assert (matcher.group() if matcher.find() else None) == found


def test_redaction_needs_no_python(spark):
    rules = policy.Policy(redact_keys=("k",), regexes=(("a", "b"),))
    plan = spark.range(1).select(policy.redacted(rules, F.lit('{"k":1}')))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_raw_data_and_views(spark):
    rows = spark.createDataFrame([("p", '{"k":{"x":1},"t":"a"}'), ("denied/x", "{}")], "project_locator string, raw_payload string")
    rules = policy.Policy(redact_keys=("k",), regexes=(("a", "b"),), denied_paths=("denied",))
    assert [r.raw_payload for r in policy.apply_raw(rules, rows).collect()] == ['{"k":"[REDACTED]","t":"b"}']
    assert policy.apply_raw(policy.Policy(drop_raw=True), rows).count() == 0
    view = policy.views(spark, {"s": rules}).first()
    assert (view.policy_id, view.drop_raw, view.redacted_keys, view.regex_count, view.denied_paths) == ("s", False, ["k"], 1, ["denied"])


# --- guard --------------------------------------------------------------------------------

GOOD = ["select kind, count(*) from event_facts group by 1 having count(*) > 1 order by 2 desc limit 3", "with a as (select * from EVENT_FACTS) select * from a",
        "select * from (select lower(kind) k, row_number() over w n from event_facts window w as (order by abs(sequence))) where n in (select max(sequence) from event_facts)",
        "select * from event_facts lateral view explode(split(kind, '.')) t as x", "select 'x; drop table y' t", "select /*+ broadcast(e) */ * from event_facts e",
        "with recursive r as (select 1 n union all select n + 1 from r where n < 3) select * from r", "select * from session_rollups s where exists (select 1 from command_rollups)"]
BAD = ["select * from parquet.`/any/path`", "with a as (select reflect('java.lang.System', 'getProperty', 'user.home') x) select * from a",
       "select java_method('java.lang.System', 'exit', '1')", "select * from event_facts where exists (select * from json.`/x`)", "insert into event_facts select 1",
       "select (select max(x) from csv.`/x`)", "select * from range(10)", "select * from event_facts lateral view reflect('a', 'b') t as x",
       "select row_number() over w from event_facts window w as (order by reflect('a', 'b'))", "select builtin.reflect('a', 'b')", "select transform(kind) using 'cat' from event_facts",
       "with a as (select 1) select * from (with b as (select 2) select * from b) join b", "select transform(array(1), x -> reflect('a', 'b', x))", "values (reflect('a', 'b'))",
       "select input_file_name() from event_facts", "drop table event_facts", "set x=1"]


def test_guard_looks_at_the_whole_query(spark):
    for query in GOOD:
        sql.check_read_only(spark, query)
    for query in BAD:
        with pytest.raises(ValueError):
            sql.check_read_only(spark, query)
            pytest.fail(query)


# --- odd records --------------------------------------------------------------------------


def test_numbers_that_do_not_fit_are_missing(spark):
    v = F.parse_json(F.lit('{"e":1e300,"f":123456789012345678901234567890,"g":12.7,"h":"99999999999999999999","i":"12"}'))
    row = spark.range(1).select(*[payload.number(v, k).alias(k) for k in "efg"], payload.integer(v, "h").alias("h"), payload.integer(v, "i").alias("i")).first()
    assert tuple(row) == (None, None, 12, None, 12)
    texts = spark.createDataFrame([("Process exited with code 99999999999999999999",), ('{"output":"Process exited with code 99999999999999999999","metadata":{"exit_code":3}}',)], "o string")
    assert [r[0] for r in texts.select(nested.parse_output(F.col("o"))[2]).collect()] == [None, 3]


def nested_events(spark, records):
    rows = [(i, "env", "codex_local", "inst", "art", "art", "p", "m", "line", str(i), dt.datetime(2024, 1, 1), None, "x", json.dumps(r) if not isinstance(r, str) else r, "h", "s", "", 0.8, ["c"])
            for i, r in enumerate(records, 1)]
    schema = ("ledger_offset long, envelope_id string, source_type string, source_instance_id string, artifact_id string, artifact_locator string, project_locator string, machine_id string, "
              "cursor_kind string, cursor_value string, observed_at timestamp, source_timestamp timestamp, raw_kind string, raw_payload string, content_hash string, hint_session string, "
              "hint_project string, confidence double, capabilities array<string>")
    out = normalize.normalize(spark.createDataFrame(rows, schema), nested.classify).orderBy("ledger_offset").collect()
    return [(r.kind, r.actor_kind, r.actor_name, r.parse_status, json.loads(r.payload)) for r in out]


def test_nested_records_of_all_types(spark):
    item = lambda **k: {"type": "response_item", "payload": k}
    message = lambda **k: {"type": "event_msg", "payload": k}
    cases = [
        (message(type="tool_result", exit_code=2), "tool.finished", "tool"), (message(kind="user"), "message.system", "codex_local"),
        (message(type="tool_use", name="grep"), "tool.started", "grep"), (message(type="user_message", message="hi"), "message.user", "user"),
        (message(type="item_completed"), "message.system", "codex_local"), (message(type="token_count", info=5), "usage.reported", "codex_local"),
        (item(type="tool_result", exit_code=2), "tool.failed", "tool"), (item(kind="user"), "message.user", "user"), (item(type="strange"), "error", "codex_local"),
        (item(type="message", role="developer", content="x"), "message.system", "codex_local"), (item(type="message", role="assistant", content=[{"text": "a"}, {"output_text": "b"}, 3]), "message.agent", "assistant"),
        (item(type="reasoning", content="hidden"), "message.agent", "codex_local"), (item(type="function_call", name="exec_command", call_id="c1", arguments='{"cmd":"ls"}'), "command.started", "shell"),
        (item(type="function_call_output", call_id="c1", output="Process exited with code 1", command="given"), "command.finished", "shell"),
        (item(type="custom_tool_call", name="apply_patch", call_id="c2", input="no json"), "file.patch", "apply_patch"), (item(type="custom_tool_call_output", call_id="c2", output='{"output":"ok","metadata":{"exit_code":0}}'), "file.patch", "apply_patch"),
        (item(type="function_call_output", call_id="c9", output="Process exited with code 4"), "tool.failed", "tool"), (item(type="function_call_output", name="own", call_id="c3", output=""), "tool.finished", "own"),
        (item(type="function_call_output", call_id="c3", output=""), "tool.finished", "tool"), (item(type="web_search_call", status="completed"), "tool.finished", "web_search"), (item(type="web_search_call"), "tool.started", "web_search"),
        ({"type": "session_meta", "payload": {"id": 1}}, "session.started", "codex_local"), ({"type": "turn_context"}, "model.changed", "codex_local"), ({"type": "compacted"}, "message.system", "codex_local"),
        ({"payload": {"type": "assistant", "role": "r"}}, "message.agent", "r"), ({"type": "git.diff", "payload": {"type": "user"}}, "git.diff", "codex_local"), ({"kind": "user", "payload": {}}, "message.user", "user"),
    ]
    got = nested_events(spark, [c[0] for c in cases])
    assert [(g[0], g[2]) for g in got] == [(c[1], c[2]) for c in cases]
    shown = {i: g[4] for i, g in enumerate(got)}
    assert shown[5]["usage"] is None and shown[10]["text"] == "a\nb" and "text" not in shown[11] and shown[12]["command"] == "ls"
    assert shown[13]["command"] == "given" and shown[13]["exit_code"] == 1 and shown[13]["tool_name"] == "exec_command" and shown[15]["exit_code"] == 0
    assert nested_events(spark, ["[1]"])[0][:4] == ("error", "system", "codex_local", "failed")


def test_nested_records_are_made_twice_and_fields_read_once(spark):
    rows = normalize.normalize(spark.read.schema("ledger_offset long, envelope_id string, source_type string, source_instance_id string, artifact_id string, project_locator string, machine_id string, observed_at timestamp, "
                                                 "source_timestamp timestamp, raw_kind string, raw_payload string, hint_session string, hint_project string, capabilities array<string>").json(
        spark.sparkContext.parallelize([])), nested.classify)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and plan.count("try_variant_get(") < 250


def test_rows_without_a_call_keep_their_own_names(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, ""), (2, "", ""), (2, "", "b")], "ledger_offset long, call_id string, own_name string").repartition(1)
    assert sorted(r.call_name for r in nested.call_names(df).collect()) == ["", "", "a", "b"]


def test_names_of_calls_are_carried_over_ranges(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["hot", "hot", "b", "", None]), rnd.choice(["", "", "n%d" % i])) for i in range(1, 400)]
    last, want = {}, {}
    for i, call, name in rows:
        want[i] = name or (last.get(call, "") if call else "")
        if call and name:
            last[call] = name
    df = spark.createDataFrame(rows, "ledger_offset long, call_id string, own_name string").repartition(4)
    assert {r.ledger_offset: r.call_name for r in nested.call_names(df, bucket=16).collect()} == want


# --- canonical lines and objects ----------------------------------------------------------


def events_of(spark, n):
    rows = [(i, f"e{i}", "t", "i", None if i % 2 else "m", f"s{i % 3}", i, dt.datetime(2024, 1, 1, 0, 0, i, 123456 if i % 2 else 0), "message.user", "user", "u", "" if i % 2 else "pk", "p", "ss", ["a"] if i % 3 else [],
             json.dumps({"text": f"t{i}", "n": {"x": [1, None]}}), f"v{i}", "ok") for i in range(1, n)]
    return spark.createDataFrame(rows, "ledger_offset long, event_id string, source_type string, source_instance_id string, machine_id string, session_key string, sequence long, timestamp timestamp, kind string, "
                                       "actor_kind string, actor_name string, project_key string, project_locator string, source_session_key string, capabilities array<string>, payload string, envelope_id string, "
                                       "parse_status string").withColumn("event_version", F.lit(2))


def test_an_export_is_read_back(spark, tmp_path):
    events = events_of(spark, 40)
    sinks.jsonl(events, str(tmp_path / "out"))
    (tmp_path / "out" / "part-bad.txt").write_text('{"event_id":"x"\n\n{"sequence":"no number"}\n{"timestamp":"yesterday"}\n{"event_id":"few","unknown":1}\n[1]\n')
    lines = canonical.read_lines(spark, str(tmp_path / "out"))
    got = canonical.events(lines)
    norm = lambda df: sorted(str([json.dumps(json.loads(v), sort_keys=True) if k == "payload" else v for k, v in r.asDict().items()]) for r in df.select(*sorted(events.columns)).collect())
    assert norm(got.where("event_id <> 'few'")) == norm(events)
    few = got.where("event_id = 'few'").first()
    assert (few.line, few.sequence, few.kind, few.capabilities, few.payload) == (5, 0, "", [], None)
    dead = {(r.reference.rpartition(":")[2], r.message) for r in canonical.dead_letters(lines).collect()}
    assert dead == {("1", "malformed event"), ("3", "malformed event"), ("4", "time is not RFC 3339"), ("6", "malformed event")}
    assert sessions.summarize(got.where("event_id <> 'few'"), F.struct("locator", "line")).drop("position").count() == 3


def test_lines_are_read_once_for_events_and_dead_letters(spark):
    lines = delivery.export_lines(events_of(spark, 9)).select(F.lit("x").alias("locator"), F.col("ledger_offset").alias("line"), "value")
    for out in (canonical.events(lines), canonical.dead_letters(lines)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("StructsToJsonEvaluator") <= 2


def test_sealed_formats_and_objects(spark, tmp_path):
    events = events_of(spark, 30).withColumn("project_locator", F.lit("p"))
    raw = spark.createDataFrame([(i, f"v{i}", "t", "i", "art", "", "p", "", "line", str(i), dt.datetime(2024, 1, 1), None, "k", '{"z":1}', "h", "ss", "", 0.5, ["a"]) for i in range(1, 30)],
                                "ledger_offset long, envelope_id string, source_type string, source_instance_id string, artifact_id string, artifact_locator string, project_locator string, machine_id string, "
                                "cursor_kind string, cursor_value string, observed_at timestamp, source_timestamp timestamp, raw_kind string, raw_payload string, content_hash string, hint_session string, "
                                "hint_project string, confidence double, capabilities array<string>")
    items = delivery.outbox_batches(events, raw, {"all": policy.Policy(), "few": policy.Policy(drop_raw=True)})
    batched = delivery.batches(items, 10)
    sealed = delivery.seal_as(batched).collect()
    assert len(sealed) == 6
    for r in sealed:
        body = json.loads(bytes(r.payload))
        assert len(body["events"]) == r.event_count and ("raw_envelopes" in body) == (r.sink_id == "all")
        assert body["events"][0]["raw_ref"]["ledger_offset"] == r.ledger_min_offset and r.headers == {"Content-Type": "application/json"}
    lines = delivery.seal_as(batched, "canonical_jsonl").orderBy("sink_id", "ledger_min_offset").first()
    packed = delivery.seal_as(batched, "canonical_jsonl.gz").orderBy("sink_id", "ledger_min_offset").first()
    assert bytes(lines.payload).count(b"\n") == 10 and gzip.decompress(bytes(packed.payload)) == bytes(lines.payload) and packed.headers["Content-Encoding"] == "gzip"
    with pytest.raises(ValueError):
        delivery.seal_as(batched, "xml")
    for _ in range(2):  # a repeated batch replaces its object
        sinks.objects(delivery.seal_as(batched), str(tmp_path / "store"))
    found = {str(p.relative_to(tmp_path / "store")): p.read_bytes() for p in (tmp_path / "store").rglob("*") if p.is_file()}
    assert found == {r.object_key: bytes(r.payload) for r in sealed}
