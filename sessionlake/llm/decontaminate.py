"""Benchmark decontamination by winnowing.

Main path: DataFrame functions only.  Texts and items are cut into words, and
both are winnowed with k-grams of 4 words and windows of 7, so any 10 words that
occur in both share a selected k-gram.  Selected k-grams of documents and items
are joined, and each hit is extended to both sides over the words that surround
it.  Every occurrence of a window of 10 words holds a hit whose surroundings
(6 words to each side) cover the whole window, so the union of the extended hits
is the union of all occurrences.  Items of fewer than 10 words are one window:
for each such length all n-grams of the documents are compared.

Rules: null or wordless texts have no words and are clean; null or wordless
items match nothing.  Items with equal words are compared once and all reported.
Items without id count for hits and are not listed.  Repeated document rows each
get their row.  An empty benchmark leaves all clean.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sessionlake.llm import winnowing
from sessionlake.llm.common import let, words

SPAN = 10
K = 4
WINDOW = SPAN - K + 1
SIDE = SPAN - K
#: Benchmark fingerprints up to which they are broadcast (about 200 bytes each).
BROADCAST_ROWS = 200_000


def _selected(h: Column, short: list[int]) -> Column:
    """Array of (size, gram, at, around): selected k-grams of an array of word hashes."""
    around = lambda p: F.transform(
        F.sequence(F.lit(-SIDE), F.lit(K + SIDE - 1)), lambda o: F.get(h, p + o)
    )
    entry = lambda size, gram, at, ctx: F.struct(
        F.lit(size).alias("size"), gram.alias("gram"), at.cast("int").alias("at"), ctx.alias("around")
    )
    long_ones = F.transform(
        winnowing.fingerprints(h, K, WINDOW),
        lambda f: let(
            winnowing.position(f).cast("int"), lambda p: entry(SPAN, winnowing.gram_hash(f), p, around(p))
        ),
    )
    none = F.lit(None).cast("array<bigint>")
    extra = [
        F.when(F.size(h) >= n, F.transform(winnowing.kgram_hashes(h, n), (lambda n: lambda g, i: entry(n, g, i, none))(n)))
        .otherwise(F.array().cast("array<struct<size:int,gram:bigint,at:int,around:array<bigint>>>"))
        for n in short
    ]
    long_ones = F.when(F.size(h) >= SPAN, long_ones).otherwise(
        F.array().cast("array<struct<size:int,gram:bigint,at:int,around:array<bigint>>>")
    )
    return F.concat(long_ones, *extra) if extra else long_ones


def benchmark_grams(items: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """(grams, classes, short lengths): items with equal words form one class."""
    cut_up = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    classes = (
        cut_up.where(F.size("w") > 0)
        .groupBy(F.xxhash64(F.array_join("w", " ")).alias("class"))
        .agg(F.collect_set("item").alias("ids"), F.first("w").alias("w"))
    )
    lengths = classes.where(F.size("w") < SPAN).select(F.size("w").alias("n")).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # nine at most
    hashed = classes.select("class", winnowing.word_hashes(F.col("w")).alias("h"))
    mine = lambda h: F.when(F.size(h) >= SPAN, _selected(h, [])).otherwise(
        F.array(F.struct(
            F.size(h).alias("size"), F.element_at(_whole(h, short), 1).alias("gram"),
            F.lit(0).alias("at"), F.lit(None).cast("array<bigint>").alias("around"),
        ))
    )
    grams = hashed.select("class", F.explode(let(F.col("h"), mine)).alias("g")).select("class", "g.*")
    return grams, classes.select("class", "ids"), short


def _whole(h: Column, short: list[int]) -> Column:
    """The hash of a whole short item, as an array of one."""
    out = F.array(F.lit(0).cast("bigint"))
    for n in short:
        out = F.when(F.size(h) == n, winnowing.kgram_hashes(h, n)).otherwise(out)
    return out


def _run(at: str, mine: str, theirs: str, size: str) -> tuple[Column, Column]:
    """Start and end of the equal words around a hit; empty if k-grams differ."""
    same = F.zip_with(F.col(mine), F.col(theirs), lambda a, b: F.coalesce(a == b, F.lit(False)))

    def bounds(eq: Column) -> Column:
        reach = lambda part: F.coalesce(
            F.nullif(F.array_position(part, False), F.lit(0)) - 1, F.lit(SIDE)
        ).cast("int")
        left = reach(F.reverse(F.slice(eq, 1, SIDE)))
        right = reach(F.slice(eq, SIDE + K + 1, SIDE))
        equal = F.forall(F.slice(eq, SIDE + 1, K), lambda x: x)
        span = F.struct((F.col(at) - left).alias("s"), (F.col(at) + K + right).alias("e"))
        return F.when(equal, span)

    whole = F.struct(F.col(at).alias("s"), (F.col(at) + F.col(size)).alias("e"))
    return F.when(F.col(size) < SPAN, whole).otherwise(let(same, bounds))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row: words, words hit, items found, verdict."""
    grams, classes, short = benchmark_grams(items)
    grams = grams.select("class", "size", "gram", F.col("at").alias("item_at"), F.col("around").alias("item_around"))
    if grams.count() <= BROADCAST_ROWS:
        grams, classes = F.broadcast(grams), F.broadcast(classes)
    # A row for the document itself goes ahead of its k-grams: it carries n_words.  Its
    # gram only spreads these rows; no item has a k-gram of no words.
    own = F.array(F.struct(
        F.lit(0).alias("size"), F.xxhash64("doc_id", "text").alias("gram"), F.lit(0).alias("at"),
        F.lit(None).cast("array<bigint>").alias("around"),
    ))
    rows = docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("__text"),
        F.explode(let(
            winnowing.word_hashes(words(F.col("text"))),
            lambda h: F.concat(
                F.transform(own, lambda o: o.withField("at", F.size(h))), _selected(h, short)
            ),
        )).alias("g"),
    ).select("doc_id", "__text", "g.*")
    hits = (
        rows.join(grams, ["size", "gram"], "left")
        .where((F.col("size") == 0) | F.col("class").isNotNull())
        .withColumn("run", F.when(F.col("size") > 0, _run("at", "around", "item_around", "size")))
        .where((F.col("size") == 0) | (F.col("run.e") - F.col("run.s") >= F.col("size")))
        .select(
            "doc_id", "__text", "class",
            F.when(F.col("size") == 0, F.col("at")).alias("n"),
            F.coalesce(F.col("run.s"), F.lit(0)).alias("s"), F.coalesce(F.col("run.e"), F.lit(0)).alias("e"),
        )
    )
    key = ["doc_id", "__text"]
    before = W.partitionBy(*key).orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    per_doc = (
        hits.withColumn("seen", F.coalesce(F.max("e").over(before), F.lit(0)))
        .withColumn("new", F.greatest(F.col("e") - F.greatest("s", "seen"), F.lit(0)))
        .groupBy(*key)
        .agg(
            F.max("n").alias("n_words"),
            F.sum("new").alias("n_hit"),
            F.count("n").alias("copies"),
            F.collect_set("class").alias("classes"),
        )
    )
    listed = (
        per_doc.withColumn("class", F.explode_outer("classes"))
        .join(classes, "class", "left")
        .groupBy(*key)
        .agg(
            F.first("n_words").alias("n_words"), F.first("n_hit").alias("n_hit"),
            F.first("copies").alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"),
        )
    )
    return listed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
