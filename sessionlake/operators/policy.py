"""Redaction policies: row filters, recursive key redaction, replacements."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.functions import jsontext, regexes
from sessionlake.functions.text import clean_path

REDACTED = "[REDACTED]"


@dataclass(frozen=True)
class Policy:
    drop_raw: bool = False
    redact_keys: tuple[str, ...] = ()
    regexes: tuple[tuple[str, str], ...] = field(default=())
    allowed_projects: tuple[str, ...] = ()
    denied_paths: tuple[str, ...] = ()

    def overridden(self, own: Policy | None) -> Policy:
        """This policy with the non-empty fields of a sink's own; drop_raw is always the own one's."""
        if own is None:
            return self
        pick = lambda a, b: b or a
        return Policy(own.drop_raw, pick(self.redact_keys, own.redact_keys), pick(self.regexes, own.regexes),
                      pick(self.allowed_projects, own.allowed_projects), pick(self.denied_paths, own.denied_paths))


def admitted(policy: Policy, locator: Column) -> Column:
    """Whether a project passes the allow list and the denied path prefixes."""
    ok = F.lit(True)
    if policy.allowed_projects:
        ok = ok & locator.isin(*policy.allowed_projects)
    for path in policy.denied_paths:
        ok = ok & ~clean_path(locator).startswith(clean_path(F.lit(path)))
    return F.coalesce(ok, F.lit(False))


def redacted(policy: Policy, payload: Column) -> Column:
    """Payload JSON with keys and texts redacted at any depth; only objects change.

    Values of the keys are replaced whole; patterns are those of a linear-time engine
    (see :mod:`~sessionlake.functions.regexes`) and are applied in turn to all other
    strings that are not keys.  A pattern that is not valid there is left out, with a
    warning.
    """
    if not policy.redact_keys and not policy.regexes:
        return payload
    rules = []
    for pattern, new in policy.regexes:
        try:
            rule = regexes.translate(pattern)
        except ValueError as e:
            warnings.warn(f"redaction rule left out: {e}", stacklevel=2)
            continue
        rules.append((rule.pattern, regexes.replacement(new, rule)))

    def replaced(value: Column) -> Column:
        for pattern, new in rules:
            value = F.regexp_replace(value, F.lit(pattern), F.lit(new))
        return value

    out = jsontext.rewrite(payload, list(policy.redact_keys), REDACTED, replaced if rules else None)
    if rules:
        return out
    touched = payload.contains("\\")  # a key may be written with escapes
    for key in policy.redact_keys:
        touched = touched | payload.contains(f'"{key}"')
    return F.when(touched, out).otherwise(payload)


def apply(policy: Policy, rows: DataFrame, column: str = "payload") -> DataFrame:
    """Rows that a policy admits, their payload redacted."""
    return rows.where(admitted(policy, F.col("project_locator"))).withColumn(column, redacted(policy, F.col(column)))


def apply_raw(policy: Policy, envelopes: DataFrame) -> DataFrame:
    """Raw envelopes that a policy lets through, their ``raw_payload`` redacted; none where it drops raw data."""
    if policy.drop_raw:
        return envelopes.where(F.lit(False))
    return apply(policy, envelopes, "raw_payload")


def views(spark: SparkSession, policies: dict[str, Policy]) -> DataFrame:
    """What a policy does, a row for each name, without its patterns."""
    rows = [(name, p.drop_raw, list(p.redact_keys), len(p.regexes), list(p.allowed_projects), list(p.denied_paths)) for name, p in policies.items()]
    return spark.createDataFrame(rows, "policy_id string, drop_raw boolean, redacted_keys array<string>, regex_count int, "
                                       "allowed_projects array<string>, denied_paths array<string>")
