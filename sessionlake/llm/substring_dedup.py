"""Substring deduplication by hashing lines, sentences and runs of short ones.

Texts are cut in units at line breaks and, by default, also after sentence ends.
A unit is normalised (case, white space) and hashed; digests are grouped over all
documents; the earliest occurrence by (doc_id, offset) stays, the others are
removed.  Offsets are code points in the original text.

Short units repeat by chance, so ``min_words`` applies to what is repeated: units
of fewer words are hashed together with their neighbours, over line breaks too, as
the shortest passages of enough words that begin or end with them.  A unit is
removed if it lies in such a passage that occurs before.  Any run of consecutive
units that is repeated as a whole and has enough words is covered by such passages,
whole lines of short sentences included.  Where a passage overlaps its own first
occurrence, only what lies behind that is removed.  Without ``sentences`` each line
counts alone, and lines of fewer words stay.

Rules: null and empty texts have no units.  Repeats inside a document count.
Rows without id come after all others.  Rows that share an id count as one place:
a unit that stays at an offset of that id stays in each of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch, small_batches

MIN_WORDS = 8
_LINES = re.compile(r"[^\n]+")
_SENTENCES = re.compile(r"[^\n]+?(?:[.!?]+(?=[ \n])|(?=\n)|$)", re.S)


def _windows(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """First and last unit of the shortest passages of ``least`` words from each unit on and up to it."""
    out, low, total = set(), 0, 0
    for high, size in enumerate(sizes):
        total += size
        up_to = None
        while total >= least:
            out.add((low, high))
            up_to, total, low = low, total - sizes[low], low + 1
        if up_to is None and low:
            back, words = low, total
            while words < least:
                back -= 1
                words += sizes[back]
            up_to = back
        if up_to is not None:
            out.add((up_to, high))
    return sorted(out)


def passages(docs: DataFrame, sentences: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, doc_id, spans, digest) of the units and runs of units long enough; ``row`` tells rows of ``docs`` apart.

    ``spans`` has start, end and number of words of each unit in turn.
    """
    pattern = _SENTENCES if sentences else _LINES

    def cut_up(text: str, spans: list[int], ends: list[int], digests: list[bytes]) -> int:
        units, plain, sizes = [], [], []
        for m in pattern.finditer(text):
            words = m.group().lower().split()
            if words:
                lead = len(m.group()) - len(m.group().lstrip())
                units.append((m.start() + lead, m.end(), len(words)))
                plain.append(" ".join(words))
                sizes.append(len(words))
        ranges = _windows(sizes, min_words) if sentences else [(i, i) for i, n in enumerate(sizes) if n >= min_words]
        for i, j in ranges:
            for unit in units[i : j + 1]:
                spans.extend(unit)
            ends.append(len(spans))
            digests.append(hashlib.blake2b(" ".join(plain[i : j + 1]).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        return len(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                spans, ends, digests, rows, counts = [], [0], [], at, []
                while at < batch.num_rows and len(spans) < 1_000_000:
                    counts.append(cut_up(batch.column("text")[at].as_py() or "", spans, ends, digests))
                    at += 1
                owner = pa.array([i for i, n in enumerate(counts, rows) for _ in range(n)], pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spans, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(owner), batch.column("doc_id").take(owner), lists, pa.array(digests, pa.binary())],
                    ["row", "doc_id", "spans", "digest"])

    rows = small_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, spans array<int>, digest binary")


def repeated_units(docs: DataFrame, sentences: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit to remove, with the occurrence that stays.

    ``unit_hash``, ``n_occurrences`` and the first place are those of the unit if it is
    long enough and repeated on its own, else of the repeated passage it lies in.

    Digests are counted with partial aggregation, so a unit that a third of the
    documents share is reduced before the shuffle; only then are its occurrences
    joined to the first one.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(passages(docs, sentences, min_words))
    start, end = F.col("spans")[0], F.element_at("spans", -2)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", start.alias("start"), end.alias("end"), "row")
    first = scratch.table(found.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (start == F.col("first.start"))
    later = scratch.table(found.join(first, "digest").where(~is_first))
    scratch.drop(found, first)
    unit = F.explode(F.transform(
        F.sequence(F.lit(0), F.size("spans") - 3, F.lit(3)),
        lambda i: F.struct(F.get("spans", i).alias("start"), F.get("spans", i + 1).alias("end"), F.get("spans", i + 2).alias("n_words"))))
    # The passages of a text come together before they are cut in units again.
    marked = later.repartition("row").select("row", "doc_id", "digest", "first", "n", F.size("spans").alias("size"), unit.alias("unit"))
    marked = marked.where((F.col("row") != F.col("first.row")) | (F.col("unit.start") >= F.col("first.end")))
    best = F.min(F.struct("size", "first", "digest", "n", "doc_id", "unit")).alias("b")
    return marked.groupBy("row", F.col("unit.start").alias("start")).agg(best).select(
        "b.doc_id", "b.unit.start", "b.unit.end", "b.unit.n_words",
        F.col("b.first.doc_id").alias("first_doc_id"), F.col("b.first.start").alias("first_start"),
        F.lower(F.hex("b.digest")).alias("unit_hash"), F.col("b.n").alias("n_occurrences"))


def without_repeats(docs: DataFrame, sentences: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``; ``removed`` keeps their original spans."""
    spans = repeated_units(docs, sentences, min_words).groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))
    joined = docs.join(spans.withColumnRenamed("doc_id", "__id"), docs["doc_id"].eqNullSafe(F.col("__id")), "left").drop("__id")
    kept = F.aggregate(
        "removed",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"])).alias("out"),
            s["end"].alias("at")),
        lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.char_length("text"))),
    )
    return joined.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept))
