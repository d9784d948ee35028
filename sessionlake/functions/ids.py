"""Stable identifiers and hashes as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x1f"


def text(c: Column) -> Column:
    """Missing text is the empty text."""
    return F.coalesce(c, F.lit(""))


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix + '_' + first 16 hex digits of SHA-256 over the parts."""
    joined = F.concat_ws(SEP, *[text(p.cast("string")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(joined, 256), 1, 16))


def content_hash(payload: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text(payload), 256))


def rfc3339_nano(ts: Column) -> Column:
    """UTC with the fraction's trailing zeros cut."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.regexp_replace(F.substring(full, 20, 7), r"\.?0*$", ""), F.lit("Z"))


def canonical_json(payload: Column) -> Column:
    """Compact JSON with sorted keys; HTML-sensitive characters escaped."""
    out = F.to_json(F.try_parse_json(payload))
    for raw, escaped in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"), (" ", "\\u2028"), (" ", "\\u2029")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def session_key(instance: Column, source_session: Column, machine: Column | None = None) -> Column:
    return stable_id("sess", *([machine] if machine is not None else []), instance, source_session)


def project_key(locator: Column) -> Column:
    return F.when(text(locator) == "", "").otherwise(stable_id("proj", locator))


def global_session_key(machine: Column, instance: Column, source_session: Column) -> Column:
    return stable_id("gasess", machine, instance, source_session)


def event_id(version: int, source_type, machine, instance, session, sequence, kind, ts, payload) -> Column:
    head = [source_type, machine] if version == 2 else [source_type]
    digest = content_hash(canonical_json(payload))
    return stable_id("evt", *head, instance, session, sequence.cast("string"), kind, rfc3339_nano(ts), digest)


def envelope_id(source_type, instance, artifact, cursor_kind, cursor_value, digest) -> Column:
    return stable_id("env", source_type, instance, artifact, cursor_kind, cursor_value, digest)
