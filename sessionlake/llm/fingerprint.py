"""Document fingerprints by winnowing, and likeness of documents by them.

Main path: DataFrame functions only.

Rules: null text counts as empty.  A text without tokens has an empty
fingerprint; two empty fingerprints are alike (1.0), an empty and another are
not (0.0).  White space separates tokens, case does not count, CJK characters
are tokens of their own, and unbroken runs are cut after 64 characters.  Equal
texts, and texts that differ in white space or case only, have equal
fingerprints.  Rows with null ``doc_id`` come last; equal ids are ordered by a hash
of the text, then by text.  Repeated rows each get their row.  Other columns are
ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm import winnowing
from sessionlake.llm.common import let

K = 4
WINDOW = 8
_CJK = r"぀-ヿ㐀-鿿가-힯"
TOKENS = rf"[{_CJK}]|[^\s{_CJK}]{{1,64}}"
#: Rows in a bucket of the neighbour search, and the most buckets there may be.
BUCKET_ROWS = 512
MAX_BUCKETS = 100_000
_FIRST = -(1 << 63)
_PLACE = "struct<k:bigint,h:bigint>"


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Winnowed fingerprint of a text as an array of packed longs."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKENS), F.lit(0))
    return winnowing.fingerprints(winnowing.word_hashes(tokens), k, window)


def as_string(fp: Column) -> Column:
    """Sixteen hex digits per entry: nine of the hash, seven of the position."""
    plain = lambda x: F.lpad(F.lower(F.hex(x.bitwiseXOR(F.lit((1 << 28) - 1)))), 16, "0")
    return F.array_join(F.transform(fp, plain), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the hash sets of two fingerprints, 0 to 1."""
    hashes = lambda fp: F.array_distinct(F.transform(fp, winnowing.gram_hash))

    def ratio(x: Column, y: Column) -> Column:
        def of(common: Column) -> Column:
            union = F.size(x) + F.size(y) - common
            return F.when(union == 0, F.lit(1.0)).otherwise(common / union)

        return let(F.size(F.array_intersect(x, y)), of)

    return let(hashes(a), lambda x: let(hashes(b), lambda y: ratio(x, y)))


def _place(docs: DataFrame) -> Column:
    """Place of a row in the order of descending ids, equal ids by a hash of the text."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST))
    return F.struct(F.bitwise_not(key).alias("k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))


def bounds(docs: DataFrame) -> list[tuple[int, int]]:
    """First places of buckets of equal size, in order; at most ``MAX_BUCKETS``.

    Places are sorted by range, without texts, and numbered inside each range; the
    first of each bucket's worth of numbers is a bound.
    """
    count = docs.count()
    size = max(BUCKET_ROWS, -(-count // (MAX_BUCKETS // 2)))
    sessions = max(1, min(2000, count // size))
    places = docs.select(_place(docs).alias("p")).select("p.*").repartitionByRange(sessions, "k", "h").sortWithinPartitions("k", "h")
    numbered = places.withColumn("bucket", F.floor(F.monotonically_increasing_id() / size))
    firsts = numbered.groupBy("bucket").agg(F.min(F.struct("k", "h")).alias("p")).select("p.*").distinct()
    return sorted((r["k"], r["h"]) for r in firsts.collect())


def _bucket(place: Column, firsts: list[tuple[int, int]]) -> Column:
    """(n, first): how many bounds lie at or before a place, and whether it is the last of them; looked up in two steps."""
    width = max(1, int(len(firsts) ** 0.5))
    chunks = [firsts[i : i + width] for i in range(0, len(firsts), width)]
    array = lambda rows, kind: F.from_json(F.lit(json.dumps(rows)), kind)
    pair = lambda x: {"k": x[0], "h": x[1]}
    heads = array([pair(c[0]) for c in chunks], f"array<{_PLACE}>")
    table = array([[pair(x) for x in c] for c in chunks], f"array<array<{_PLACE}>>")
    up_to = lambda items: F.size(F.filter(items, lambda x: x <= place))
    found = lambda i, items: let(up_to(items), lambda j: F.struct(
        ((i - 1) * width + j).alias("n"), F.coalesce(F.get(items, j - 1) == place, F.lit(False)).alias("first")))
    return let(up_to(heads), lambda i: let(F.coalesce(F.get(table, i - 1), F.array().cast(f"array<{_PLACE}>")), lambda items: found(i, items)))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket, order columns) with each document's follower's text.

    The follower has the next smaller id; that of the last document is the first.
    Rows are dealt to buckets of equal size in that order, so a window never spans
    the table: the head of each bucket is also sent, as a marked copy, to the bucket
    before it.  Columns whose names start with ``__`` are for further windows over
    the same layout; drop rows where ``__copy`` is true in the end.
    """
    firsts = bounds(docs)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _place(docs).alias("__place"))
    if not firsts:
        placed = base.withColumns({"__bucket": F.lit(1), "__copy": F.lit(False)})
    else:
        base = base.withColumn("__at", _bucket(F.col("__place"), firsts)).withColumns({"__own": F.col("__at.n"), "__head": F.col("__at.first")})
        head = F.col("__head")
        to = lambda bucket, copy: F.struct(bucket.alias("bucket"), F.lit(copy).alias("copy"))
        own = to(F.col("__own"), False)
        before = to(F.when(F.col("__own") > 1, F.col("__own") - 1).otherwise(F.lit(len(firsts))), True)
        placed = base.withColumn("__to", F.explode(F.when(head, F.array(own, before)).otherwise(F.array(own)))).select(
            "doc_id", "text", "__place", F.col("__to.bucket").alias("__bucket"), F.col("__to.copy").alias("__copy"))
    return placed.withColumn("next_text", F.coalesce(F.lead("text").over(next_window()), F.lit("")))


def next_window() -> Window:
    return Window.partitionBy("__bucket").orderBy("__copy", "__place", "text")


def edited(text: Column, follower: Column) -> Column:
    """The last half of a text replaced by the first characters of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, 1, F.char_length(text) - half), F.substring(follower, 1, half))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and their edited forms, with likenesses."""
    kept = ["doc_id", "__bucket", "__copy", "__place", "text"]
    own = with_next(docs).withColumn("__edited", edited(F.col("text"), F.col("next_text")))
    own = own.select(*kept, "__edited", fingerprint(F.col("text")).alias("__fp"))
    own = own.withColumn("__next_fp", F.lead("__fp").over(next_window()))
    done = own.where(~F.col("__copy")).select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("__edited"), 256).alias("edited_sha256"),
        F.col("__fp"),
        "__next_fp",
        fingerprint(F.col("__edited")).alias("__edited_fp"),
    )
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("__fp")).alias("fingerprint"),
        as_string(F.col("__edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("__fp"), F.col("__edited_fp")).alias("near_edited"),
        likeness(F.col("__fp"), F.col("__next_fp")).alias("near_next"),
    )
