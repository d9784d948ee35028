"""Canonical events as JSON lines: written in their public form, and read again as a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import ids
from sessionlake.sources import files

#: The public form of an event; ``payload`` keeps whatever it holds.
SHAPE = ("event_version int, event_id string, source_type string, source_instance_id string, machine_id string, session_key string, sequence long, "
         "timestamp string, kind string, actor struct<kind string, name string>, context struct<source_type string, project_key string, "
         "project_locator string, source_session_key string, capabilities array<string>>, payload variant, "
         "raw_ref struct<ledger_offset long, envelope_id string>, parse_status string, __corrupt string")
_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:\d\d)$"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}


def event_json(payload: str = "payload") -> Column:
    """The line of an event; empty optional fields are left out, the machine also in version 1."""
    given = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    capabilities = F.when(F.size("capabilities") > 0, F.col("capabilities")).alias("capabilities")
    context = F.struct("source_type", given("project_key"), given("project_locator"), given("source_session_key"), capabilities)
    return F.to_json(F.struct(
        "event_version", "event_id", "source_type", "source_instance_id",
        F.when((F.col("event_version") != 1) & (F.col("machine_id") != ""), F.col("machine_id")).alias("machine_id"), "session_key", "sequence",
        ids.rfc3339_nano(F.col("timestamp")).alias("timestamp"), "kind",
        F.struct(F.coalesce("actor_kind", F.lit("")).alias("kind"), F.coalesce("actor_name", F.lit("")).alias("name")).alias("actor"), context.alias("context"),
        F.coalesce(F.try_parse_json(payload), F.parse_json(F.lit("null"))).alias("payload"),
        F.struct("ledger_offset", "envelope_id").alias("raw_ref"), given("parse_status")))


def envelope_json(raw: str = "raw_payload") -> Column:
    """The JSON of a raw envelope, its payload as it was read."""
    given = lambda c, name=None: F.when(F.col(c) != "", F.col(c)).alias(name or c)
    time = lambda c: ids.rfc3339_nano(F.col(c))
    hints = F.struct(given("hint_session", "source_session_key"), given("hint_project", "project_hint"), "confidence",
                     F.when(F.size("capabilities") > 0, F.col("capabilities")).alias("capabilities"))
    return F.to_json(F.struct(
        F.lit(1).alias("envelope_version"), "envelope_id", "source_type", "source_instance_id", "artifact_id", given("artifact_locator"), given("project_locator"),
        given("machine_id"), F.struct(F.col("cursor_kind").alias("kind"), F.col("cursor_value").alias("value")).alias("cursor"), time("observed_at").alias("observed_at"),
        F.when(F.col("source_timestamp").isNotNull(), time("source_timestamp")).alias("source_timestamp"), "raw_kind",
        F.coalesce(F.try_parse_json(raw), F.parse_json(F.lit("null"))).alias("raw_payload"), "content_hash", hints.alias("parse_hints")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(locator, line, value) of a file or folder of JSON lines, whatever its files are called."""
    return files.numbered(spark.read.text(path).select("value", "_metadata"))


def _parsed(lines: DataFrame) -> DataFrame:
    """``lines`` with the event ``__e`` and ``__bad``, what is wrong with it.

    The event comes out of an ``explode``, as filters stay behind it: pushed through a
    plain column, one on ``__bad`` would repeat all that made the line several times.
    """
    rows = lines.withColumn("__e", F.explode(F.array(F.from_json("value", SHAPE, _OPTIONS))))
    time = F.try_to_timestamp(F.when(F.col("__e.timestamp").rlike(_TIME), F.col("__e.timestamp")))
    bad = F.when(F.col("__e").isNull() | F.col("__e.__corrupt").isNotNull(), "malformed event").when(
        F.col("__e.timestamp").isNotNull() & time.isNull(), "time is not RFC 3339")
    return rows.withColumns({"__time": time, "__bad": bad})


def events(lines: DataFrame) -> DataFrame:
    """The events of ``lines`` (locator, line, value), with the columns of normalized ones and their place.

    Missing fields are empty, a missing time is null; unknown ones are ignored.  Lines that are no event are left
    to :func:`dead_letters`.
    """
    rows = _parsed(lines).where("__bad is null")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c.split(".")[-1])
    e = lambda c: text(f"__e.{c}")
    zero = lambda c: F.coalesce(F.col(f"__e.{c}"), F.lit(0)).alias(c.split(".")[-1])
    return rows.select(
        zero("event_version"), e("event_id"), e("source_type"), e("source_instance_id"), F.col("__e.machine_id").alias("machine_id"), e("session_key"),
        zero("sequence"), F.col("__time").alias("timestamp"), e("kind"),
        e("actor.kind").alias("actor_kind"), e("actor.name").alias("actor_name"), e("context.project_key"), e("context.project_locator"),
        e("context.source_session_key"), F.coalesce("__e.context.capabilities", F.array().cast("array<string>")).alias("capabilities"),
        F.to_json("__e.payload").alias("payload"), zero("raw_ref.ledger_offset"), e("raw_ref.envelope_id"), e("parse_status"), "locator", "line")


def dead_letters(lines: DataFrame) -> DataFrame:
    """(kind, reference, message, payload) of lines that are no event."""
    return _parsed(lines).where("__bad is not null").select(
        F.lit("canonical_read").alias("kind"), F.concat_ws(":", "locator", F.col("line").cast("string")).alias("reference"),
        F.col("__bad").alias("message"), F.col("value").alias("payload"))
