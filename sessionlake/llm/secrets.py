"""Secret scans: base patterns and character Markov models.

Main path: DataFrame functions only.

Base patterns find assignments of passwords and tokens, access keys and long hex
strings.  The method adds runs of 16 or more key characters that look more like
random strings than like ordinary identifiers: two character bigram models, one of
random strings and one of identifiers, are compared by log-likelihood ratio.  They
are trained from labelled samples: values that the base patterns find anywhere in
the corpus count as random; all other runs of key characters in a bounded sample of
documents as ordinary, those with digits (numbers, dates, versions, ids, paths) included
(``SAMPLE_DOCS``; the sample is drawn by hash of the id).  Without samples a model
is uniform, so the scan still works on a corpus without secrets.

Rules: null text counts as empty.  Offsets are code points, ends are exclusive.
Markov spans that lie inside a base span are not repeated.  Every row gets a row,
repeated rows too; other columns are ignored by :func:`scan` and kept by
:func:`redact`.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import let

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Hex runs: those too short to count need not be extracted.
_HEX_SCAN = r"(?<![0-9a-f])[0-9a-f]{24,}+"
_KEY = "A-Za-z0-9+/_=-"
RUN = rf"(?<![{_KEY}])[{_KEY}]{{16,}}+"
_ORDINARY = rf"(?<![{_KEY}])[{_KEY}]{{4,}}+"
KINDS = ["assign", "access", "hex", "markov"]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: Documents (expected) whose words train the model of identifiers.
SAMPLE_DOCS = 4000
#: A run counts as random from this log-likelihood ratio on, in total and per character.
MIN_TOTAL, MIN_MEAN = 6.0, 0.25
#: Weight of the single characters' shares in the pairs' shares, in counts.
PRIOR = 20


def _prefix_sums(a: Column) -> Column:
    """Running sums of an array of ints, by doubling shifts."""
    steps = F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)).cast("double"))).cast("int")
    add = lambda x, y: x + F.coalesce(y, F.lit(0))
    shifted = lambda acc, j: F.concat(
        F.array_repeat(F.lit(0), F.pow(F.lit(2.0), j).cast("int")), acc
    )
    return F.aggregate(
        F.sequence(F.lit(0), steps),
        a,
        lambda acc, j: F.zip_with(acc, F.slice(shifted(acc, j), F.lit(1), F.size(acc)), add),
    )


def _found(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    """Spans (s, e, kind, value) of a pattern whose group is long enough."""
    none = F.array().cast("array<struct<s:int,e:int,kind:int,value:string>>")
    every = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))

    def spans(matches: Column) -> Column:
        values = every(group) if group else matches
        lengths = F.transform(matches, lambda m: F.char_length(m))
        gaps = F.slice(
            F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p)), F.lit(1), F.size(matches)
        )
        both = lambda n: F.zip_with(
            _prefix_sums(F.zip_with(gaps, n, lambda g, m: g + m)), n,
            lambda end, m: F.struct((end - m).alias("s"), end.alias("e")),
        )
        whole = let(lengths, lambda n: let(both(n), lambda at: F.zip_with(
            at, values,
            lambda x, v: F.struct(
                x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), v.alias("value")))))
        kept = F.filter(whole, lambda x: F.char_length(x["value"]) >= least)
        return F.when(F.size(matches) > 0, kept).otherwise(none)

    return let(every(0), spans)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns, by start, then kind."""
    return F.array_sort(F.concat(
        _found(text, ASSIGN, 0, MIN_VALUE, 2),
        _found(text, ACCESS, 1, MIN_ACCESS),
        _found(text, _HEX_SCAN, 2, MIN_HEX),
    ), lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"]))


def samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(token, random): labelled samples from the documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    secrets = docs.select(F.explode(base_spans(text)).alias("x")).select(F.col("x.value").alias("token"))
    secrets = secrets.where("char_length(token) >= 16 and token rlike '[0-9]'")
    share = min(1.0, sample_docs / max(1, docs.count()))
    drawn = docs.where(
        F.crc32(F.concat(F.lit("words:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
        < int(share * (1 << 32))
    )
    found = let(base_spans(text), lambda b: F.transform(F.filter(
        _found(text, _ORDINARY, 3, 4), lambda r: ~F.exists(b, lambda x: (x["s"] < r["e"]) & (x["e"] > r["s"]))), lambda r: r["value"]))
    plain = drawn.select(F.explode(found).alias("token"))
    return secrets.withColumn("random", F.lit(True)).unionByName(plain.withColumn("random", F.lit(False)))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, at 128 * first + second.

    Character pairs are counted by Spark; two tables of at most 68 x 68 counts
    come to the driver.
    """
    chars = F.filter(F.split("token", ""), lambda c: c != "")
    pair = let(chars, lambda c: F.zip_with(
        c, F.slice(c, F.lit(2), F.size(c)),
        lambda a, b: F.struct(F.ascii(a).alias("a"), F.ascii(b).alias("b"))))
    counts = (
        labelled.select("random", F.explode(pair).alias("p"))
        .where("p.b is not null and p.a < 128 and p.b < 128")
        .groupBy("random", "p.a", "p.b").count().collect()
    )
    key = [c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-."]
    table: dict[bool, dict[tuple[int, int], float]] = {True: {}, False: {}}
    for r in counts:
        table[r["random"]][r["a"], r["b"]] = r["count"]
    out = [0.0] * (128 * 128)
    rows = {x: {a: sum(table[x].get((a, b), 0) for b in key) for a in key} for x in (True, False)}
    alone = {
        x: {b: (sum(table[x].get((a, b), 0) for a in key) + 0.5) / (sum(rows[x].values()) + 0.5 * len(key)) for b in key}
        for x in (True, False)
    }
    smooth = lambda x, a, b: (table[x].get((a, b), 0) + PRIOR * alone[x][b]) / (rows[x][a] + PRIOR)
    for a in key:
        for b in key:
            out[128 * a + b] = round(math.log(smooth(True, a, b) / smooth(False, a, b)), 4)
    return out


def _random_runs(text: Column, ratios: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def score(run: Column) -> Column:
        codes = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.ascii(c))
        return let(codes, lambda c: F.aggregate(
            F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c)), lambda a, b: a * 128 + b),
            F.lit(0.0), lambda acc, i: acc + F.get(table, i)))

    random = lambda x: let(score(x["value"]), lambda v: (
        (v >= MIN_TOTAL) & (v >= MIN_MEAN * (x["e"] - x["s"]))))
    return F.filter(_found(text, RUN, 3, 16), random)


def find(text: Column, ratios: list[float]) -> Column:
    """All spans of a text, by start, then kind."""
    order = lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"])

    def with_runs(base: Column) -> Column:
        new = F.filter(_random_runs(text, ratios), lambda r: ~F.exists(
            base, lambda b: (b["s"] <= r["s"]) & (b["e"] >= r["e"])))
        return let(new, lambda n: F.when(F.size(n) > 0, F.array_sort(F.concat(base, n), order)).otherwise(base))

    return let(base_spans(text), with_runs)


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Secrets of every row; trains on ``docs`` when no model is given."""
    ratios = train(samples(docs)) if ratios is None else ratios
    spans = docs.select("doc_id", find(F.coalesce(F.col("text"), F.lit("")), ratios).alias("all"))
    base = F.filter("all", lambda x: x["kind"] < 3)
    count = lambda kind: F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("bigint")
    return spans.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def redact(docs: DataFrame, ratios: list[float] | None = None, marker: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced; ``n_chars`` follows where it exists."""
    ratios = train(samples(docs)) if ratios is None else ratios
    text = F.col("text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(
        F.when(s["s"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["s"] - acc["at"]), F.lit(marker))).alias("out"),
        F.greatest(acc["at"], s["e"]).alias("at"))
    clean = let(find(F.coalesce(text, F.lit("")), ratios), lambda spans: F.when(
        F.size(spans) > 0,
        F.aggregate(spans, start, step, lambda acc: F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))).otherwise(text))
    out = docs.withColumn("text", clean)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
