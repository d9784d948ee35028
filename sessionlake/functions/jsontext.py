"""Rewriting JSON texts in place: string literals are cut out, rewritten and put back, all in built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A string, a bracket, or what stands between.  Possessive, so that long texts need no stack.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]]|[^"{}\[\]]++'
_COLON = r"^\s*:"
_ONLY_COLON = r"^\s*:\s*$"
_SCALAR = r"^(\s*:\s*)[^\s,]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object; unlike a variant, keys may be repeated."""
    return F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False))


def decoded(token: Column) -> Column:
    """What a string literal says."""
    plain = F.substring(token, F.lit(2), F.char_length(token) - 2)
    return F.when(token.contains("\\"), F.get_json_object(F.concat(F.lit('{"x":'), token, F.lit("}")), "$.x")).otherwise(plain)


def encoded(text: Column) -> Column:
    """The string literal of a text."""
    wrapped = F.to_json(F.struct(text.alias("x")))
    return F.substring(wrapped, F.lit(6), F.char_length(wrapped) - 6)


def rewrite(text: Column, keys: list[str], mark: str, on_value: Callable[[Column], Column] | None = None) -> Column:
    """A JSON object with the values of ``keys`` replaced by ``mark`` and other strings (not keys) by ``on_value``, at any depth.

    Values may be texts, numbers or whole objects and arrays.  Everything else stays as
    it is written.  Texts that are no JSON objects come back unchanged.
    """
    literal = encoded(F.lit(mark))
    quoted = lambda x: x.startswith('"')

    def with_tokens(t: Column) -> Column:
        key = lambda x, i: quoted(x) & F.coalesce(F.get(t, i + 1).rlike(_COLON), F.lit(False))
        changed = (lambda x: let(decoded(x), lambda old: let(on_value(old), lambda new: F.when(new == old, x).otherwise(encoded(new))))) if on_value else (lambda x: x)
        if not keys:
            return F.transform(t, lambda x, i: F.when(quoted(x) & ~key(x, i), changed(x)).otherwise(x))

        def with_marks(hit: Column) -> Column:
            """``hit``: whether each token is one of the keys."""
            held = lambda i, back: (i >= back) & F.coalesce(F.get(hit, i - back), F.lit(False))
            opens = lambda i: held(i, 2) & F.get(t, i).isin("{", "[") & F.get(t, i - 1).rlike(_ONLY_COLON)

            def fold(acc: Column, i: Column) -> Column:
                x, depth = F.get(t, i), acc["depth"]
                after = F.when(depth == 0, F.when(opens(i), 1).otherwise(0)).otherwise(
                    depth + F.when(x.isin("{", "["), 1).when(x.isin("}", "]"), -1).otherwise(0))
                start = F.when((depth == 0) & (after == 1), i).otherwise(acc["start"])
                closed = (depth > 0) & (after == 0)
                spans = F.when(closed, F.concat(acc["spans"], F.array(F.struct(acc["start"].alias("low"), i.alias("high"))))).otherwise(acc["spans"])
                return F.struct(after.alias("depth"), start.alias("start"), spans.alias("spans"))

            none = F.array().cast("array<struct<low:int,high:int>>")
            at = F.sequence(F.lit(0), F.size(t) - 1)
            spans = F.when(F.exists(at, opens), F.aggregate(
                at, F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("start"), none.alias("spans")), fold, lambda acc: acc["spans"])).otherwise(none)

            def with_spans(cut: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    inside = F.exists(cut, lambda c: (c["low"] <= i) & (i <= c["high"]))
                    starts = F.exists(cut, lambda c: c["low"] == i)
                    return (F.when(inside, F.when(starts, literal).otherwise(""))
                            .when(held(i, 2) & quoted(x) & F.get(t, i - 1).rlike(_ONLY_COLON), literal)
                            .when(held(i, 1) & x.rlike(_SCALAR), F.regexp_replace(x, _SCALAR, F.concat(F.lit("$1"), literal)))
                            .when(quoted(x) & ~key(x, i), changed(x)).otherwise(x))

                return F.transform(t, one)

            return let(spans, with_spans)

        return let(F.transform(t, lambda x, i: key(x, i) & decoded(x).isin(*keys)), with_marks)

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.when(is_object(text), F.array_join(let(tokens, with_tokens), "")).otherwise(text)
