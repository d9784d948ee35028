"""Classification of nested records (``type`` with a ``payload`` object)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import payload, text
from sessionlake.operators import normalize
from sessionlake.operators.normalize import actor_of, kind_named

_COMMAND = r"Command:\s+[^\n]*-lc '([^']*)'"
_EXIT = r"Process exited with code (\d+)"
# Messages of the system.
_SYSTEM = ["task_started", "task_complete", "context_compacted", "turn_aborted", "item_completed"]
_CALLS = ["function_call", "custom_tool_call"]
_OUTPUTS = ["function_call_output", "custom_tool_call_output"]


#: Ledger offsets that share a window when names of calls are looked up.
BUCKET = 100_000


def call_names(rows: DataFrame, call_id: str = "call_id", name: str = "own_name", order: str = "ledger_offset", stored: str | None = None,
               bucket: int = BUCKET, known: DataFrame | None = None) -> DataFrame:
    """Adds ``call_name``: the own name, else the latest earlier name that was stored for the same call.

    ``stored`` is the column of names to remember, by default the own ones.  Each range
    of offsets of a call is filled for itself, then from the last name of the ranges
    before, so a call with very many rows is many tasks; only a row for each call and
    range is carried over.  Rows without a call id go along, each as a range of its own,
    so that ``rows`` are made twice and not three times.  ``known`` (call_id, name) has
    the names from before these rows.
    """
    given = F.coalesce(F.col(call_id), F.lit("")) != ""
    own, kept = F.when(F.col(name) != "", F.col(name)), F.when(F.col(stored or name) != "", F.col(stored or name))
    called = rows.where(given).withColumn("__bucket", F.floor(F.col(order) / bucket))
    every = rows.withColumn("__bucket", F.when(given, F.floor(F.col(order) / bucket)).otherwise(-1 - F.col(order)))
    last = called.groupBy(call_id, "__bucket").agg(F.max_by(kept, F.when(kept.isNotNull(), F.col(order))).alias("__last"))
    ranges = Window.partitionBy(call_id).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(call_id, "__bucket", F.last("__last", ignorenulls=True).over(ranges).alias("__carried"))
    before = Window.partitionBy(call_id, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if known is not None:
        carried = carried.join(known.select(F.col("call_id").alias(call_id), F.col("name").alias("__known")), call_id, "left").withColumn(
            "__carried", F.coalesce("__carried", "__known")).drop("__known")
    found = F.coalesce(own, F.when(given, F.last(kept, ignorenulls=True).over(before)), F.col("__carried"), F.lit(""))
    return every.join(carried.hint("merge"), [call_id, "__bucket"], "left").withColumn("call_name", found).select(*rows.columns, "call_name")


def parse_output(output: Column) -> tuple[Column, Column, Column]:
    """(text, command, exit code) of a tool's output, wrapped in JSON or not; what the text says wins."""
    v = F.try_parse_json(output)
    return parsed_output(v, F.coalesce(payload.string(v, "output"), output, F.lit("")))


def parsed_output(v: Column, body: Column) -> tuple[Column, Column, Column]:
    """Like :func:`parse_output`, of an output's JSON, if it is any, and its text."""
    command = F.regexp_extract(body, _COMMAND, 1)
    code = F.regexp_extract(body, _EXIT, 1)
    return body, command, F.coalesce(F.when(code != "", code.try_cast("bigint")), payload.number(v, "metadata", "exit_code"))


def content_text(content: Column) -> Column:
    """A string, or the texts of its parts in lines."""
    parts = F.try_variant_get(content, "$", "array<variant>")
    one = lambda p: F.coalesce(payload.string(p, "text"), payload.string(p, "input_text"), payload.string(p, "output_text"))
    joined = F.array_join(F.filter(F.transform(parts, one), lambda x: x.isNotNull() & (x != "")), "\n")
    return F.coalesce(F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(content, "$", "string")), joined, F.lit(""))


def _named_rows(rows: DataFrame) -> DataFrame:
    """With type, inner type, call id, own name and the name that a call stores.

    They come out of an ``explode``, so that a filter on them does not parse a record again.
    """
    v = F.col("__v")
    s = lambda *p: F.coalesce(payload.string(v, *p), F.lit("")).alias("_".join(p))
    rows = rows.withColumn("__n", F.explode(F.array(F.struct(s("type"), *[s("payload", k) for k in ("type", "call_id", "name", "tool_name", "tool")]))))
    rows = rows.withColumns({
        "__top": F.col("__n.type"), "__inner": F.col("__n.payload_type"), "call_id": F.col("__n.payload_call_id"),
        "own_name": text.first_nonempty(*[F.col(f"__n.payload_{k}") for k in ("name", "tool_name", "tool")])}).drop("__n")
    calls = F.col("__inner").isin(_CALLS) & (F.col("__top") == "response_item")
    return rows.withColumn("__stored", F.when(calls, F.col("own_name")).otherwise(""))


def stored_names(envelopes: DataFrame) -> DataFrame:
    """(call_id, name): the latest name that the calls among raw envelopes store."""
    rows = _named_rows(envelopes.withColumn("__v", payload.parse(F.col("raw_payload")))).where((F.col("__stored") != "") & (F.col("call_id") != ""))
    return rows.groupBy("call_id").agg(F.max_by("__stored", "ledger_offset").alias("name"))


def classify(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Kind, status, actor and payload of nested records.

    Names are stored by calls alone; ``known`` (call_id, name) has earlier ones.  The
    table of aliases sees the payload of a ``response_item``, but not that of an
    ``event_msg``.
    """
    v, inner = F.col("__v"), F.try_variant_get("__v", "$.payload", "variant")
    s = lambda *p: F.coalesce(payload.string(v, *p), F.lit(""))
    rows = call_names(_named_rows(rows), stored="__stored", known=known)
    top, kind = F.col("__top"), F.col("__inner")
    item = top == "response_item"
    # What is used more than once is a column, else each use reads the record again.
    rows = rows.withColumns({
        "__object": payload.is_object(v), "__role": s("payload", "role"), "__given": text.not_blank(s("payload", "command")),
        "__arguments": F.when(item & kind.isin(_CALLS), text.first_nonempty(s("payload", "arguments"), s("payload", "input"))),
        "__output": F.when(item & kind.isin(_OUTPUTS), s("payload", "output")).otherwise(""),
        "__key": s("kind"), "__inner_key": s("payload", "kind"), "__inner_name": text.first_nonempty(payload.string(inner, "name"), payload.string(inner, "tool")),
        "__failed": normalize.failed(v), "__inner_failed": normalize.failed(inner)})
    rows = rows.withColumns({"__read": F.try_parse_json("__output"), "__arguments": F.try_parse_json("__arguments")})
    arguments = F.col("__arguments")
    rows = rows.withColumn("__body", F.coalesce(payload.string(F.col("__read"), "output"), "__output", F.lit("")))
    body, command, code = parsed_output(F.col("__read"), F.col("__body"))
    rows = rows.withColumns({
        "__exit": code,
        "__command": F.when(item & kind.isin(_CALLS), text.first_nonempty(payload.string(arguments, "cmd"), payload.string(arguments, "command")))
        .when(item & kind.isin(_OUTPUTS), text.first_given(command, F.col("__given"))).otherwise(""),
        "__tool": F.when(item & (kind == "web_search_call"), "web_search").when(item & kind.isin(_CALLS), F.col("own_name"))
        .when(item & kind.isin(_OUTPUTS), F.when(F.col("call_name") == "", "tool").otherwise(F.col("call_name"))).otherwise("")})
    name, role = F.col("__tool"), F.col("__role")
    rows = rows.withColumns({
        "__blind": kind_named(text.first_nonempty(kind), F.lit(False)),
        "__seen": kind_named(text.first_nonempty(kind, F.col("__inner_key")), F.col("__inner_failed")),
        "__other": kind_named(text.first_nonempty(top, kind, F.col("__inner_key")), F.col("__inner_failed"))})
    blind, other = F.col("__blind"), F.col("__other")
    event_msg = (F.when(kind == "user_message", "message.user").when(kind == "agent_message", "message.agent")
                 .when(kind == "token_count", "usage.reported").when(kind.isin(_SYSTEM) | (blind == "error"), "message.system").otherwise(blind))
    message = F.when(role == "user", "message.user").when(role == "assistant", "message.agent").otherwise("message.system")
    call = F.when(name == "exec_command", "command.started").when(name == "apply_patch", "file.patch").otherwise("tool.started")
    output = (F.when(name == "exec_command", "command.finished").when(name == "apply_patch", "file.patch")
              .when(F.coalesce(F.col("__exit"), F.lit(0)) > 0, "tool.failed").otherwise("tool.finished"))
    search = F.when(s("payload", "status") == "completed", "tool.finished").otherwise("tool.started")
    response = (F.when(kind == "message", message).when(kind == "reasoning", "message.agent").when(kind.isin(_CALLS), call)
                .when(kind.isin(_OUTPUTS), output).when(kind == "web_search_call", search).otherwise(F.col("__seen")))
    rows = rows.withColumn("kind", F.when(~F.col("__object"), "error").when(top == "session_meta", "session.started").when(top == "turn_context", "model.changed")
                           .when(top == "compacted", "message.system").when(top == "event_msg", event_msg).when(item, response)
                           .when(other == "error", kind_named(text.first_nonempty(top, F.col("__key")), F.col("__failed"))).otherwise(other))
    command_kind = F.col("kind").startswith("command.")
    tool = command_kind | F.col("kind").startswith("tool.") | (F.col("kind") == "file.patch")
    who, plain = actor_of(F.col("kind"), F.col("source_type"), v)
    rows = rows.withColumn("__shown", text.first_nonempty(name, F.col("__inner_name")))
    named = F.col("__shown")
    shown = (F.when(command_kind, F.when(named.isin("", "exec_command"), "shell").otherwise(named)).when(tool, text.first_nonempty(named, F.lit("tool")))
             .when(F.col("kind") == "message.agent", text.first_nonempty(role, F.col("source_type"))).otherwise(plain))
    said = F.when(top == "event_msg", s("payload", "message")).when(
        item & (kind == "message"), content_text(F.try_variant_get(v, "$.payload.content", "variant"))).otherwise("")
    info = F.try_variant_get(v, "$.payload.info", "variant")
    given = lambda c: F.when(c != "", c)
    rows = rows.withColumns({"__said": said, "__info": F.when(kind == "token_count", F.when(payload.is_object(info), info).otherwise(F.parse_json(F.lit("null"))))})
    rows = rows.withColumn("__extra", F.from_json(F.to_json(F.struct(
        given(F.col("__said")).alias("text"), given(name).alias("tool_name"), given(F.col("__command")).alias("command"), F.col("__exit").alias("exit_code"),
        F.col("__info").alias("usage"))), "map<string,variant>"))
    extra = F.col("__extra")
    merged = F.to_json(F.map_concat(F.map_filter(F.from_json("raw_payload", "map<string,variant>"), lambda k, _: ~F.map_contains_key(extra, k)), extra))
    broken = F.to_json(F.struct(F.lit("payload is not an object").alias("reason"), "raw_kind", "source_type"))
    return rows.withColumns({
        "parse_status": F.when(F.col("kind") == "error", "failed").otherwise("ok"),
        "actor_kind": F.when(tool, "tool").otherwise(who), "actor_name": shown,
        "payload": F.when(F.col("__object"), F.to_json(F.try_parse_json(merged))).otherwise(broken)})
