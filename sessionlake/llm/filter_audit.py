"""What a chain of quality filters removes, for every order of the filters.

Each document is reduced to a mask of the filters that it fails, and masks are
counted.  The subsets of filters already applied form a lattice; an edge leads from
a subset to the one with one more filter, and its removals are the documents whose
mask holds that filter and none of the subset.  ``reach`` counts the orders that
lead to a subset (forward), ``leave`` those that lead from it to the full set
(backward): an edge lies on reach x leave of all orders, which weights its removals
for Shapley values.  The steps of each single order are read from the same edges.

Rules: null texts count as empty, a null part as the empty string.  A row without
id is no copy of another and makes none.  Rows that share an id are documents of
their own; none of them is a smaller id to the other.  A document is good (toxic)
if any label of its id says so.  Other columns are ignored, whatever their names.
An empty table has no parts and so no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch, small_batches

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
_SIGNS = re.compile(rb"[#$%&*|]")


def _own_failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails by itself."""
    words = text.split()
    capitals = 0
    if text:
        b = np.frombuffer(text, np.uint8)
        capitals = int(((b >= 65) & (b <= 90)).sum())
        n_chars = int(((b & 0xC0) != 0x80).sum())
    few = len(words) < MIN_WORDS
    plain = 100 * len(set(words)) < MIN_DISTINCT * len(words)
    loud = bool(text) and 100 * capitals > MAX_CAPITALS * n_chars
    return few | plain << 1 | loud << 2 | (_SIGNS.search(text) is not None) << 3


def own_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of each row; the mask has filters A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([_own_failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "digest"])

    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the filters that they fail.

    Copies of a text are counted with partial aggregation and found by its digest and
    smallest id together, so a text that a third of the rows hold is no hot key.
    """
    scratch = Scratch(docs.sparkSession)
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    rows = scratch.table(own_masks(docs).groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("docs")))
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(0).alias("copy"))
    marked = known.join(first, ["digest", "doc_id"], "left").join(flags, "doc_id", "left").select(
        "part", "docs", "good", "toxic", (F.col("mask") + F.when(F.col("copy").isNull(), 16).otherwise(0)).alias("mask"))
    nameless = rows.where("doc_id is null").select(
        "part", "docs", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "mask")
    of = lambda flag: F.sum(F.col("docs") * F.coalesce(flag, F.lit(0))).alias(flag)
    return scratch.table(marked.unionByName(nameless).groupBy("part", "mask").agg(F.sum("docs").alias("docs"), of("good"), of("toxic")))


def lattice(n: int) -> list[tuple[int, int, int]]:
    """(subset, filter, orders through it) of every edge of the lattice of n filters."""
    full = (1 << n) - 1
    reach, leave = {0: 1}, {full: 1}
    for s in range(1, full + 1):
        reach[s] = sum(reach[s & ~(1 << f)] for f in range(n) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | 1 << f] for f in range(n) if not s >> f & 1)
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(full) for f in range(n) if not s >> f & 1]


def edges(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, subset, filter, ...): what each edge of the lattice removes, with the filter's Shapley sum.

    Each part has at most 2 ** n masks, so the size of this follows the number of parts alone.
    """
    every = F.array(*[F.struct(F.lit(s).alias("subset"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(w).cast("bigint").alias("orders"))
                      for s, f, w in lattice(len(filters))])
    subset, own = F.col("e.subset"), F.col("e.bit")
    fails = F.col("mask").bitwiseAND(own) != 0
    before = F.col("mask").bitwiseAND(subset) != 0
    total = lambda cond, what="docs": F.sum(F.when(cond, F.col(what)).otherwise(0))
    each = counts.withColumn("e", F.explode(every)).groupBy("part", "e").agg(
        total(~fails & ~before).alias("kept"), total(fails & ~before).alias("removed"), total(fails & before).alias("redundant"),
        total(F.col("mask") == own).alias("unique_fails"), total(fails & ~before, "good").alias("good_lost"),
        total(fails & ~before, "toxic").alias("toxic_lost"))
    shapley = each.groupBy("part", F.col("e.filter").alias("filter")).agg(F.sum(F.col("removed") * F.col("e.orders")).alias("shapley"))
    return each.select("part", "e.subset", "e.filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost").join(
        shapley, ["part", "filter"])


def steps(filters: str = FILTERS) -> Column:
    """The edges that every order of the filters takes, as an array."""
    out = []
    for order in permutations(range(len(filters))):
        name = "".join(filters[f] for f in order)
        for k, f in enumerate(order):
            subset = sum(1 << g for g in order[:k])
            out.append((name, k + 1, subset, f))
    # One literal text is parsed once; thousands of literals would be compiled.
    return F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{k},"s":{s},"f":{f}}}' for o, k, s, f in out) + "]"),
                       "array<struct<o:string,k:int,s:int,f:int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    found = edges(mask_counts(docs, labels))
    places = found.select("part").distinct().select("part", F.explode(steps()).alias("x")).select(
        "part", F.col("x.s").alias("subset"), F.col("x.f").alias("filter"), F.col("x.o").alias("filter_order"), F.col("x.k").alias("step"))
    return places.join(found, ["part", "subset", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
