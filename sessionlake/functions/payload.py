"""Getters over a JSON payload held as a variant."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(raw: Column) -> Column:
    return F.try_parse_json(raw)


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def string(v: Column, *path: str) -> Column:
    """Value as text; numbers and objects are written out, null is missing."""
    return F.try_variant_get(v, "$." + ".".join(path), "string")


def number(v: Column, *path: str) -> Column:
    """A JSON number, truncated; texts do not count, and what does not fit 64 bits is missing."""
    name = "$." + ".".join(path)
    kind = F.schema_of_variant(F.try_variant_get(v, name, "variant"))
    whole = kind.startswith("BIGINT") | kind.startswith("INT")
    return F.when(whole, F.try_variant_get(v, name, "bigint")).when(
        kind.startswith("DECIMAL") | kind.startswith("DOUBLE"), F.try_variant_get(v, name, "double").try_cast("bigint"))


def integer(v: Column, *path: str) -> Column:
    """A JSON number, truncated, or a text that is a whole number."""
    return F.coalesce(number(v, *path), F.when(F.trim(string(v, *path)).rlike(r"^[+-]?[0-9]+$"), F.trim(string(v, *path)).try_cast("bigint")))


def time(v: Column, *keys: str) -> Column:
    """First of the keys that holds an RFC 3339 time."""
    return F.coalesce(*[F.try_to_timestamp(F.when(string(v, k).rlike(r"^\d{4}-\d\d-\d\dT"), string(v, k))) for k in keys])
