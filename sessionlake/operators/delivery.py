"""Delivery as data: outbox, batches, attempts, progress."""

import gzip
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import ids
from sessionlake.operators import cutting, normalize
from sessionlake.operators import policy as policies
from sessionlake.operators.stored import stored
from sessionlake.sources import canonical


def outbox(events: DataFrame, sinks: dict[str, policies.Policy], existing: DataFrame | None = None) -> DataFrame:
    """One item per event and sink: pending, or skipped where the policy leaves nothing."""
    parts = []
    for sink, policy in sinks.items():  # a handful of sinks
        ok = policies.admitted(policy, F.col("project_locator"))
        parts.append(events.select(
            F.lit(sink).alias("sink_id"), "ledger_offset", F.when(ok, "pending").otherwise("skipped").alias("status"),
            F.when(ok, policies.redacted(policy, F.col("payload"))).alias("payload"), F.col("event_id").alias("last_event_id"),
            F.col("timestamp").alias("created_at")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.withColumn("payload_bytes", F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint"))
    return out if existing is None else out.join(existing.select("sink_id", "ledger_offset"), ["sink_id", "ledger_offset"], "left_anti")


def outbox_batches(events: DataFrame, envelopes: DataFrame, sinks: dict[str, policies.Policy]) -> DataFrame:
    """Outbox items with what is sent of them: ``event`` and ``raw``, JSON of the redacted event and raw envelope.

    ``raw`` is missing where a sink drops raw data.  Texts are joined by merging: Spark's
    estimate of them is far below their size, and a broadcast passes through the driver.
    """
    parts = []
    for sink, policy in sinks.items():  # a handful of sinks
        own = policies.apply(policy, events).select(
            "ledger_offset", canonical.event_json().alias("event"), F.col("event_id").alias("last_event_id"), F.col("timestamp").alias("created_at"))
        raw = policies.apply_raw(policy, envelopes).select("ledger_offset", canonical.envelope_json().alias("raw"))
        parts.append(own.join(raw.hint("merge"), "ledger_offset", "left").select(
            F.lit(sink).alias("sink_id"), "ledger_offset", F.lit("pending").alias("status"), "event", "raw", "last_event_id", "created_at"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    size = F.octet_length("event") + F.coalesce(F.octet_length("raw"), F.lit(0))
    return out.withColumn("payload_bytes", size.cast("bigint"))


def released(created: Column, as_of: Column, every: int, offset: int = 0) -> Column:
    """Whether the window boundary after a time (epoch-aligned, seconds) has passed."""
    at = F.unix_seconds(created.cast("timestamp")) - offset
    boundary = (F.floor(at / every) + 1) * every + offset
    return F.unix_seconds(as_of.cast("timestamp")) >= boundary


def batches(items: DataFrame, max_events: int = 100) -> DataFrame:
    """Pending items with ``batch_no``: consecutive offsets, at most ``max_events`` each; ``__island`` is the first of them."""
    rows = cutting.islands(items.where("status = 'pending'"))
    return rows.withColumn("batch_no", F.floor((F.col("ledger_offset") - F.col("__island")) / max_events))


def byte_capped(items: DataFrame, max_bytes: int, max_events: int = 1000) -> DataFrame:
    """Like :func:`batches`, also capped by bytes, with ``batch_start`` and ``batch_end``.

    An item that would take a batch over ``max_bytes`` begins the next one, unless all
    items before it are empty; at the limit or beyond, a batch is closed.  Where one
    ends depends on the one before, which :mod:`~sessionlake.operators.cutting`
    resolves by blocks of offsets.
    """
    pending = items.where("status = 'pending'")
    cut = cutting.numbered(cutting.islands(cutting.batch_starts(pending, (max_events, max_bytes))))
    more = [c for c in items.columns if c not in cut.columns]
    return cut.hint("merge").join(pending.select("sink_id", "ledger_offset", *more), ["sink_id", "ledger_offset"]) if more else cut


@dataclass(frozen=True)
class Batching:
    """When batches of a sink are closed and handed out; times in seconds."""

    max_events: int = 1
    max_bytes: int = 0
    max_age: int = 0
    window_every: int = 0
    window_offset: int = 0


def ready_spans(items: DataFrame, as_of: Column, rules: dict[str, Batching]) -> DataFrame:
    """The batches of pending items that may be sealed now: (sink_id, batch_start, batch_end, event_count, payload_bytes).

    A batch is ready when it is full by count or bytes, or its first item is old
    enough, or batches hold one event; and its window has passed.  The first batch that
    is not ready blocks all that follow it in its sink.
    """
    pending = items.where((F.col("status") == "pending") & F.col("sink_id").isin(*rules))
    heads = stored(cutting.batch_spans(pending, {sink: (rule.max_events, rule.max_bytes) for sink, rule in rules.items()}))
    now, ready = F.unix_micros(as_of.cast("timestamp")), F.lit(False)
    for sink, rule in rules.items():  # a handful of sinks
        full = (F.col("n") >= rule.max_events) | (F.lit(rule.max_bytes > 0) & (F.col("size") >= rule.max_bytes)) | F.lit(rule.max_events == 1)
        old = F.lit(rule.max_age > 0) & (now - F.col("born") >= rule.max_age * 1_000_000)
        passed = released(F.timestamp_micros("born"), as_of, rule.window_every, rule.window_offset) if rule.window_every > 0 else F.lit(True)
        ready = ready | ((F.col("sink_id") == sink) & (full | old) & passed)
    blocked = heads.groupBy("sink_id").agg(F.min(F.when(~ready, F.col("batch_start"))).alias("blocked_from"))  # a row for each sink
    return heads.join(F.broadcast(blocked), "sink_id").where(F.col("blocked_from").isNull() | (F.col("batch_start") < F.col("blocked_from"))).select(
        "sink_id", "batch_start", "batch_end", F.col("n").alias("event_count"), F.col("size").alias("payload_bytes"))


def ready_batches(items: DataFrame, as_of: Column, rules: dict[str, Batching]) -> DataFrame:
    """Pending items of the :func:`ready_spans`, with ``batch_start`` and ``batch_end``."""
    pending = items.where((F.col("status") == "pending") & F.col("sink_id").isin(*rules))
    spans = ready_spans(items, as_of, rules).select(
        "sink_id", F.explode(F.sequence("batch_start", "batch_end")).alias("ledger_offset"), "batch_start", "batch_end")
    return pending.join(spans.hint("merge"), ["sink_id", "ledger_offset"])


def seal(batched: DataFrame, key_template: str = "{prefix}/{sink_id}/{batch_id}.jsonl", prefix: str = "batches") -> DataFrame:
    """One row per batch: id, offsets, count, payload lines, digest and object key."""
    out = batched.groupBy("sink_id", "__island", "batch_no").agg(
        F.min("ledger_offset").alias("ledger_min_offset"), F.max("ledger_offset").alias("ledger_max_offset"), F.count(F.lit(1)).alias("event_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ledger_offset", "payload"))), lambda x: x["payload"]), "\n").alias("payload"))
    out = out.withColumns({
        "batch_id": ids.stable_id("batch", F.col("sink_id"), F.col("ledger_min_offset"), F.col("ledger_max_offset")),
        "payload_bytes": F.octet_length("payload").cast("bigint"), "payload_sha256": F.sha2("payload", 256)})
    return out.withColumn("object_key", object_key(key_template, prefix)).drop("__island", "batch_no")


#: Formats of sealed batches: media type and further headers.
FORMATS = {"oas_batch_json": ("application/json", {}), "canonical_jsonl": ("application/x-ndjson", {}),
           "canonical_jsonl.gz": ("application/x-ndjson", {"Content-Encoding": "gzip"})}


def seal_as(batched: DataFrame, fmt: str = "oas_batch_json", key_template: str = "{prefix}/{sink_id}/{batch_id}.json", prefix: str = "batches") -> DataFrame:
    """One row per batch of :func:`outbox_batches` items, its ``payload`` (bytes) in one of :data:`FORMATS`."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported payload format: {fmt}")
    rows = batched.groupBy("sink_id", "__island", "batch_no").agg(
        F.min("ledger_offset").alias("ledger_min_offset"), F.max("ledger_offset").alias("ledger_max_offset"), F.count(F.lit(1)).alias("event_count"),
        F.array_sort(F.collect_list(F.struct("ledger_offset", "event", "raw"))).alias("items"))
    events = F.col("items.event")
    if fmt == "oas_batch_json":
        raws = F.filter("items.raw", lambda x: x.isNotNull())
        raw = F.when(F.size(raws) > 0, F.concat(F.lit(',"raw_envelopes":['), F.array_join(raws, ","), F.lit("]"))).otherwise("")
        payload = F.concat(F.lit('{"events":['), F.array_join(events, ","), F.lit("]"), raw, F.lit("}")).cast("binary")
    else:
        payload = F.concat(F.array_join(events, "\n"), F.lit("\n")).cast("binary")
        if fmt.endswith(".gz"):
            payload = _gzip(payload)
    kind, headers = FORMATS[fmt]
    rows = rows.withColumn("payload", payload).withColumns({
        "batch_id": ids.stable_id("batch", F.col("sink_id"), F.col("ledger_min_offset"), F.col("ledger_max_offset")),
        "payload_bytes": F.octet_length("payload").cast("bigint"), "payload_sha256": F.sha2("payload", 256), "content_type": F.lit(kind),
        "headers": F.create_map(*[F.lit(x) for pair in ({"Content-Type": kind} | headers).items() for x in pair])})
    return rows.withColumn("object_key", object_key(key_template, prefix)).drop("__island", "batch_no", "items")


def _gzip(data: Column) -> Column:
    @F.pandas_udf("binary")
    def pack(batch: pd.Series) -> pd.Series:
        return batch.map(lambda x: gzip.compress(x, mtime=0))

    return pack(data)


def object_key(template: str, prefix: str) -> Column:
    unique = ("{batch_id}", "{payload_sha256}", "{ledger_min_offset}", "{ledger_max_offset}")
    if not any(u in template for u in unique):
        raise ValueError("the key template needs a token that differs between batches")
    out = F.replace(F.lit(template), F.lit("{prefix}"), F.lit(prefix))
    for name in ("sink_id", "batch_id", "payload_sha256", "ledger_min_offset", "ledger_max_offset"):
        out = F.replace(out, F.lit("{" + name + "}"), F.col(name).cast("string"))
    return out


#: Ranges of statuses: delivered, worth another try, and refused for good.
SUCCESS, RETRY, PERMANENT = ((200, 299),), ((429, 429), (500, 599)), ((400, 499),)

Ranges = tuple[tuple[int, int], ...]


def classify_response(code: Column, has_token: Column, success: Ranges = SUCCESS, retry: Ranges = RETRY, permanent: Ranges = PERMANENT) -> Column:
    """Outcome of an HTTP status.

    401 and 403 are blocked only where a token was sent.  A status of 400 to 499 in no
    range is tried again; anything else that is in none is permanent.
    """
    def within(ranges: Ranges) -> Column:
        out = F.lit(False)
        for low, high in ranges:
            out = out | code.between(low, high)
        return out

    return (F.when(within(success), "success").when(has_token & (code == 401), "blocked_auth").when(has_token & (code == 403), "blocked_config")
            .when(within(retry) | (code.between(400, 499) & ~within(permanent)), "retry").otherwise("permanent"))


def backoff_seconds(attempt: Column, initial: int = 10, most: int = 300, jitter: Column | None = None) -> Column:
    plain = F.least(F.lit(float(most)), F.lit(float(initial)) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0))))
    return plain if jitter is None else plain * (F.lit(0.8) + jitter * 0.4)


def batch_states(attempts: DataFrame, poison: int = 20) -> DataFrame:
    """State of each batch from its attempts (sink_id, batch_id, attempted_at, attempt, outcome)."""
    order = F.struct("attempted_at", "attempt")
    latest = attempts.groupBy("sink_id", "batch_id").agg(
        F.max_by("outcome", order).alias("outcome"), F.count(F.lit(1)).alias("attempt_count"), F.max("attempted_at").alias("last_attempt"))
    dead = (F.col("outcome") == "permanent") | (F.col("attempt_count") >= poison)
    state = (F.when(F.col("outcome") == "success", "acked").when(dead, "quarantined").when(F.col("outcome").startswith("blocked"), F.col("outcome"))
             .otherwise("retrying"))
    wait = backoff_seconds(F.col("attempt_count"))
    return latest.withColumns({"status": state, "next_attempt_at": F.when(
        ~state.isin("acked", "quarantined"), F.col("last_attempt") + F.make_dt_interval(secs=wait))})


def due(states: DataFrame, as_of: Column, limit: int = 128) -> DataFrame:
    return (states.where(~F.col("status").isin("acked", "quarantined") & (F.col("next_attempt_at") <= as_of))
            .orderBy("next_attempt_at", "sink_id", "batch_id").limit(limit))


def requeue(states: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """Quarantined batches among ``batch_ids`` go back to pending."""
    marked = states.join(batch_ids.select("batch_id", F.lit(True).alias("__chosen")), "batch_id", "left")
    return marked.withColumn("status", F.when(F.col("__chosen") & (F.col("status") == "quarantined"), "pending").otherwise(F.col("status"))).drop("__chosen")


def frontier(items: DataFrame, base: int | DataFrame = 0, width: int = cutting.RANGE) -> DataFrame:
    """Per sink: offsets up to which all is acked, and up to which all is settled, and the last event delivered.

    ``base`` is where all sinks begin, or a table (sink_id, acked_contiguous_offset,
    terminal_contiguous_offset) of stored frontiers, which go on from there.  Ranges of
    offsets are summarised each for itself (first, last, first gap, first bad item);
    the summaries of a sink, a row for each range, are then read in order.  Sinks of the
    table without items keep their frontier.
    """
    names = ["acked_contiguous_offset", "terminal_contiguous_offset"]
    if isinstance(base, int):
        begin = items.select("sink_id").distinct().select("sink_id", *[F.lit(base).cast("bigint").alias(c) for c in names])
    else:
        begin = base.select("sink_id", *names)
    begin = begin.select("sink_id", F.col(names[0]).alias("__acked"), F.col(names[1]).alias("__terminal"))
    settled = ["acked", "skipped", "quarantined"]
    inside = Window.partitionBy("sink_id", "__range").orderBy("ledger_offset")
    order = Window.partitionBy("sink_id").orderBy("__range")
    ahead = items.join(F.broadcast(begin), "sink_id", "inner")  # a row for each sink

    def reached(start: str, good: list[str]) -> DataFrame:
        rows = ahead.where(F.col("ledger_offset") > F.col(start)).withColumn("__range", F.floor(F.col("ledger_offset") / width))
        rows = rows.withColumn("__before", F.lag("ledger_offset").over(inside))
        ranges = rows.groupBy("sink_id", "__range").agg(
            F.min("ledger_offset").alias("low"), F.max("ledger_offset").alias("high"), F.first(start).alias("start"),
            F.min(F.when(F.col("__before") != F.col("ledger_offset") - 1, F.col("__before"))).alias("gap"),
            (F.min(F.when(~F.col("status").isin(good), F.col("ledger_offset"))) - 1).alias("bad"))
        last = F.coalesce(F.lag("high").over(order), F.col("start"))
        ranges = ranges.withColumn("end", F.least("gap", "bad", F.when(F.col("low") != last + 1, last)))
        return ranges.groupBy("sink_id").agg(F.coalesce(F.min("end"), F.max("high")).alias(f"{start}_end"))

    out = begin.join(reached("__acked", settled[:2]), "sink_id", "left").join(reached("__terminal", settled), "sink_id", "left")
    acked, terminal = F.coalesce("__acked_end", "__acked"), F.coalesce("__terminal_end", "__terminal")
    out = out.select("sink_id", acked.alias(names[0]), terminal.alias(names[1]), F.greatest(terminal - acked, F.lit(0)).alias("gap_count"), "__acked")
    if "last_event_id" not in items.columns:
        return out.drop("__acked")
    done = items.where(F.col("last_event_id") != "").join(F.broadcast(out.select("sink_id", "__acked", F.col(names[0]).alias("__end"))), "sink_id")
    last = done.where((F.col("ledger_offset") > F.col("__acked")) & (F.col("ledger_offset") <= F.col("__end"))).groupBy("sink_id").agg(
        F.max_by("last_event_id", "ledger_offset").alias("last_event_id"))
    return out.drop("__acked").join(last, "sink_id", "left").withColumn("last_event_id", F.coalesce("last_event_id", F.lit("")))


def summary(items: DataFrame, attempts: DataFrame, as_of: Column) -> DataFrame:
    """Queue and attempts of the last minute per sink."""
    n = lambda c: F.count_if(F.col("status") == c).alias(c)
    queue = items.groupBy("sink_id").agg(
        F.count_if(~F.col("status").isin("acked", "skipped")).alias("queue_depth"), F.min(F.when(F.col("status") == "pending", F.col("created_at"))).alias("oldest_pending"),
        n("pending"), n("acked"), n("skipped"), n("quarantined"))
    recent = attempts.where((F.col("attempted_at") <= as_of) & (F.unix_seconds(F.col("attempted_at").cast("timestamp")) > F.unix_seconds(as_of) - 60)).groupBy("sink_id").agg(
        F.sum("event_count").alias("events_last_minute"), F.count(F.lit(1)).alias("attempts_last_minute"),
        F.count_if(F.col("outcome") == "success").alias("successes_last_minute"), F.max("payload_bytes").alias("max_bytes_last_minute"))
    return queue.join(recent, "sink_id", "left").na.fill(0)


def provider_stats(stats: DataFrame, new: DataFrame) -> DataFrame:
    """Counters per sink and provider, added up."""
    counters = ["successful_resolutions", "auth_failures", "config_failures"]
    return stats.unionByName(new).groupBy("sink_id", "provider").agg(*[F.sum(c).alias(c) for c in counters], F.max("updated_at").alias("updated_at"))


def replay_plan(sinks: DataFrame, include_unsafe: bool = False, requested: list[str] | None = None) -> DataFrame:
    """(sink_id, included, reason) of sinks (sink_id, delivery_class)."""
    rows = sinks if requested is None else sinks.where(F.col("sink_id").isin(*requested))
    safe = F.col("delivery_class") == "idempotent"
    return rows.select("sink_id", (safe | F.lit(include_unsafe)).alias("included"),
                       F.when(safe, "idempotent").when(F.lit(include_unsafe), F.concat(F.col("delivery_class"), F.lit(" sink included on request")))
                       .otherwise(F.concat(F.col("delivery_class"), F.lit(" sink skipped"))).alias("reason"))


def export_lines(events: DataFrame) -> DataFrame:
    """Canonical events as JSON lines, in their public form."""
    return events.select("ledger_offset", canonical.event_json().alias("value"))


def replay(events: DataFrame, sinks: dict[str, policies.Policy], classes: DataFrame, after: int = 0, upto: int | None = None,
           include_unsafe: bool = False, requested: list[str] | None = None) -> DataFrame:
    """Outbox items of a range of the ledger for the sinks that :func:`replay_plan` includes."""
    chosen = {r["sink_id"] for r in replay_plan(classes, include_unsafe, requested).where("included").collect()}  # a handful of sinks
    rows = events.where(F.col("ledger_offset") > after)
    rows = rows if upto is None else rows.where(F.col("ledger_offset") <= upto)
    wanted = {name: policy for name, policy in sinks.items() if name in chosen}
    return outbox(rows, wanted) if wanted else outbox(rows, sinks).where(F.lit(False))


def replay_ledger(ledger: DataFrame, sinks: dict[str, policies.Policy], classes: DataFrame, classify=normalize.generic,
                  include_unsafe: bool = False, requested: list[str] | None = None) -> DataFrame:
    """Outbox items of the whole ledger, normalized anew with fresh sequences, for the sinks of the plan; an error if there are none."""
    plan = replay_plan(classes, include_unsafe, requested).collect()  # a handful of sinks
    chosen = {r["sink_id"] for r in plan if r["included"]} & set(sinks)
    if not chosen:
        blocked = sorted(r["sink_id"] for r in plan if not r["included"])
        raise ValueError("replay selected no sinks" + (f"; left out as not idempotent: {', '.join(blocked)}" if blocked else ""))
    return outbox(normalize.normalize(ledger, classify), {name: policy for name, policy in sinks.items() if name in chosen})
