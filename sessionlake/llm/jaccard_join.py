"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

Sets of word shingles are put in bands of size: from l to l / threshold.  Two
sets that are similar enough lie in the same or in neighbouring bands, and differ
in at most k elements, where k follows from the upper end of the larger one's
band.  The domain of elements is cut in n1 parts by hash, about three quarters of
k, so in a third of them at least two such sets differ in at most one element (k2 = 1).
Each part is cut in n2 sub-parts, and all subsets of n2 - k2 sub-parts are
enumerated: on one of those the sets agree fully.  A signature is the hash of a
set's elements in such a subset.  Each set signs for its own band and for the next.

As more parts than needed are cut, similar sets share not one but a known number
of signatures, t (those on empty subsets are not counted and need not be made).
So a set may leave out its t - 1 most frequent signatures: of all that two similar
sets share, the rarest is kept by both.  Passages that many documents share, which
alone would put unrelated texts in one group, are left out this way.

Sets that share signatures are compared exactly, unless their sizes or parity
sketches already rule a link out.  Copies (equal sets) count once.  Groups are not
expanded into pairs: in each group the members are compared with a pivot (the one
that shares most signatures), links are joined to components, and only groups that
still span several components go on, without that pivot.  The documents of groups
that are left after ``ROUNDS`` are compared where prefixes of their sets meet.

A signature that many rows of a batch share is one row with a list of their ids
before it is shuffled.  After signatures of one document only are gone, groups are
summed with partial aggregation and joined to their members, so that Spark can
split the large ones.

Rules: a text with fewer words than a shingle is one shingle; null or wordless
texts have empty sets and no links.  Rows that share an id are one document: it has
the links of all of them.  Rows without id get no component.  Other columns are
ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import chain, combinations
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch, broadcast_if_small, small_batches
from sessionlake.llm.components import components

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
#: Up to this many differing elements, parts are cut in three instead of two.
FINE = 40
ROUNDS = 3
#: Fewest bits of the sketches that rule pairs out.
SKETCH_BITS = 1024
#: Ids or pairs of compared documents up to which they are broadcast (16 bytes each).
BROADCAST_IDS = 1_000_000


def _mix(x: np.ndarray, odd: int) -> np.ndarray:
    out = x >> np.uint64(31)
    out ^= x
    out *= _ODD[odd]
    out ^= out >> np.uint64(29)
    return out


def shingle_sets(texts: list[bytes | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text, one after the other, and how many each has."""
    words = [(t or b"").lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total = int(counts.sum())
    h = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, total)
    sizes = np.where(counts > 0, np.maximum(counts - n + 1, 1), 0)
    ends = np.cumsum(sizes)
    # Place of each shingle's first word; texts of fewer words than a shingle are one shingle.
    at = np.arange(int(sizes.sum())) + np.repeat(np.cumsum(counts) - counts - (ends - sizes), sizes)
    used = np.repeat(np.minimum(counts, n), sizes)
    out = np.zeros(len(at), np.uint64)
    h = np.append(h, np.zeros(n, np.uint64))
    for j in range(n):
        mixed = _mix(out + h[at + j], j)
        out = mixed if (used > j).all() else np.where(used > j, mixed, out)
    out = _mix(out, 7)
    for low, high in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        out[low:high].sort()
    first = np.zeros(len(out) + 1, bool)
    first[ends - sizes] = True
    first = first[:-1]
    first[1:] |= out[1:] != out[:-1]
    owner = np.repeat(np.arange(len(texts)), sizes)
    return out[first], np.bincount(owner[first], minlength=len(texts))


def _batches(texts: list[bytes | None]) -> Iterator[slice]:
    """Texts in slices of a few megabytes."""
    low = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= 2_000_000:
            yield slice(low, i + 1)
            low, size = i + 1, 0
    if low < len(texts):
        yield slice(low, len(texts))


@dataclass(frozen=True)
class Measure:
    """Shingle length and threshold, as a fraction num / den."""

    n: int = 3
    num: int = 90
    den: int = 100

    def linked(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)

    @cache
    def bands(self, bits: int) -> np.ndarray:
        """Lower ends of the bands, until two lie above all numbers of so many bits."""
        out = [1]
        while out[-1] < 1 << bits:
            out.append(out[-1] * self.den // self.num + 1)
        return np.array([*out, out[-1] * self.den // self.num + 1])

    @cache
    def parts(self, low: int) -> tuple[int, int, int, list[list[int]]]:
        """Parts, sub-parts, spare parts and the enumerated subsets of the band from ``low`` on."""
        top = low * self.den // self.num
        return _parts(2 * (self.den - self.num) * top // (self.den + self.num))

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """Signatures of a nonempty set, for its own band and the next one.

        The lowest bit of a signature is that of its band's number.
        """
        return self.signed_sets(elements, np.array([len(elements)]))[0]

    def surplus(self, elements: np.ndarray) -> tuple[int, int]:
        """How many signatures a set may leave out, of its even and its odd band."""
        even, odd = self.signed_sets(elements, np.array([len(elements)]))[2][0]
        return int(even), int(odd)

    def signed_sets(self, elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signatures of many nonempty sets, the set of each, and how many signatures each set may leave out.

        A part is weak where a subset of its sub-parts is empty in the set.  Of two similar
        sets, at least one more than ``spare`` parts share a signature, and where that is
        on an empty subset the part is weak in both.  A set with no more weak parts than
        that makes none on empty subsets; it shares at least spare + 1 - weak signatures
        with the other and leaves out one less.  A set with more weak parts makes all its
        signatures and leaves out none, as the other may share just one with it.
        """
        lows = self.bands(int(sizes.max()).bit_length())
        band = np.searchsorted(lows, sizes, "right") - 1
        owner = np.repeat(np.arange(len(sizes)), sizes)
        x, y = _mix(elements, 3) >> np.uint64(32), _mix(elements, 4) >> np.uint64(32)
        low_bits = (elements & np.uint64(0xFFFFFFFF)).astype(np.float64)
        high_bits = (elements >> np.uint64(32)).astype(np.float64)
        found, sets, surplus = [], [], np.zeros((len(sizes), 2), np.int64)
        for i in (band, band + 1):
            kinds, kind = np.unique(i, return_inverse=True)
            known = [self.parts(int(lows[k])) for k in kinds]
            n1, n2, spare = (np.array([p[c] for p in known])[kind] for c in range(3))
            base = np.cumsum(n1 * n2) - n1 * n2
            m1, m2 = n1.astype(np.uint64)[owner], n2.astype(np.uint64)[owner]
            cell = (((x * m1) >> np.uint64(32)) * m2 + ((y * m2) >> np.uint64(32))).astype(np.int64) + base[owner]
            cells = int(n1 @ n2)
            some = np.bincount(cell, minlength=cells) > 0
            sums = np.bincount(cell, low_bits, cells).astype(np.uint64) + (np.bincount(cell, high_bits, cells).astype(np.uint64) << np.uint64(32))
            sums = _mix(sums, 5)
            for width in np.unique(n2):
                chosen = np.flatnonzero(n2 == width)
                subsets = next(p[3] for p in known if p[1] == width)
                of = np.repeat(chosen, n1[chosen])
                part = np.arange(len(of)) - np.repeat(np.cumsum(n1[chosen]) - n1[chosen], n1[chosen])
                at = base[of] + part * width
                mixed = [_mix(sums[at + q], q) for q in range(width)]
                full = np.stack([reduce(or_, (some[at + q] for q in subset)) for subset in subsets], axis=1)
                weak = n1 - np.bincount(of, full.all(axis=1), len(sizes)).astype(np.int64)
                surplus[chosen, i[chosen] & 1] = np.maximum(0, spare - weak)[chosen]
                kept = full | (weak > spare)[of][:, None]
                for s, subset in enumerate(subsets):
                    total = _mix(part.astype(np.uint64) + (i[of] * 8 + s + 1).astype(np.uint64) * _ODD[0], 1)
                    for q in subset:
                        total = _mix(total + mixed[q], 2)
                    total = (total << np.uint64(1)) | (i[of] & 1).astype(np.uint64)
                    found.append(total[kept[:, s]])
                    sets.append(of[kept[:, s]])
        return np.concatenate(found), np.concatenate(sets), surplus


@cache
def _parts(k: int) -> tuple[int, int, int, list[list[int]]]:
    """Parts, sub-parts, spare parts and the enumerated subsets for sets that differ in k elements.

    Of n1 parts, spare + 1 at least hold one difference or none.
    """
    least = k // 2 + 1
    spare = least // 2 if k else 0
    n2, k2 = (1, 0) if k == 0 else (3, 1) if k <= FINE else (2, 1)
    return least + spare, n2, spare, [list(q) for q in combinations(range(n2), n2 - k2)]


def _text_bytes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def _sketches(elements: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Parities of the elements of each set per hash bucket, a power of two of at least the set's size.

    Sketches differ in at most as many bits as sets in elements.  Folding one by
    half gives the sketch of half the size.
    """
    bits = np.array([max(SKETCH_BITS, 1 << (int(n) - 1).bit_length()) if n else SKETCH_BITS for n in sizes], np.int64)
    base = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bucket = (_mix(elements, 6) & (bits - 1).astype(np.uint64)[owner]).astype(np.int64) + base[owner]
    packed = np.packbits((np.bincount(bucket, minlength=int(bits.sum())) & 1).astype(np.uint8)).view(np.int64)
    return np.split(packed, (np.cumsum(bits) // 64)[:-1])


def _digests(elements: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """Digest of each set, null for an empty one."""
    ends = np.cumsum(sizes).tolist()
    return [hashlib.blake2b(elements[end - n : end].tobytes(), digest_size=16).digest() if n else None for end, n in zip(ends, sizes.tolist(), strict=True)]


def set_digests(docs: DataFrame, measure: Measure) -> DataFrame:
    """(doc_id, n, digest, sketch, even, odd) for each row; the digest of an empty set is null.

    ``even`` and ``odd`` are how many signatures the set may leave out.
    """

    @F.pandas_udf("n long, digest binary, sketch array<bigint>, even int, odd int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, parts = batch.tolist(), []
            for piece in _batches(texts):
                elements, sizes = shingle_sets(texts[piece], measure.n)
                surplus = np.zeros((len(sizes), 2), np.int64)
                if len(elements):
                    surplus[sizes > 0] = measure.signed_sets(elements, sizes[sizes > 0])[2]
                parts.append(pd.DataFrame({
                    "n": sizes, "digest": _digests(elements, sizes), "sketch": _sketches(elements, sizes), "even": surplus[:, 0], "odd": surplus[:, 1]}))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: [] for c in ("n", "digest", "sketch", "even", "odd")})

    return _text_bytes(docs).select("doc_id", of("text").alias("s")).select("doc_id", "s.*")


def signed(docs: DataFrame, measure: Measure) -> DataFrame:
    """(signature, doc_id, others); sets that a task has met before are not signed again.

    ``others`` lists further documents of the batch with that signature, else it is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes | None] = {None}
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            for piece in _batches(texts):
                elements, sizes = shingle_sets(texts[piece], measure.n)
                new = np.zeros(len(sizes), bool)
                for i, digest in enumerate(_digests(elements, sizes)):
                    new[i] = digest not in met
                    met.add(digest)
                if new.any():
                    signature, at, _ = measure.signed_sets(elements[np.repeat(new, sizes)], sizes[new])
                    yield _rows(signature.view(np.int64), ids[piece][new][at])

    return _text_bytes(docs.where(F.col("doc_id").isNotNull())).mapInArrow(
        run, "signature long, doc_id long, others array<long>")


def _rows(signature: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row for each signature: those of one document in its place, others with a list."""
    order = np.argsort(signature, kind="stable")
    new = np.concatenate(([True], signature[order][1:] != signature[order][:-1]))
    first = np.sort(order[new])
    counts = np.diff(np.append(np.flatnonzero(new), len(order)))
    more = np.zeros(len(order), np.int64)
    more[order[new]] = counts - 1
    more = more[first]
    # The others of each list, in the order of the rows that hold them.
    rest = order[~new]
    owner = np.repeat(order[new], counts - 1)
    rest = rest[np.argsort(owner, kind="stable")]
    offsets = np.concatenate(([0], np.cumsum(more))).astype(np.int32)
    lists = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32(), mask=np.append(more == 0, False)), pa.array(doc[rest], pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(signature[first]), pa.array(doc[first]), lists], ["signature", "doc_id", "others"])


def set_arrays(rows: DataFrame, measure: Measure) -> DataFrame:
    """``rows`` with ``elements``, the set of their ``text``, in its place."""

    @F.pandas_udf("array<bigint>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = batch.tolist(), []
            for piece in _batches(texts):
                elements, sizes = shingle_sets(texts[piece], measure.n)
                out += np.split(elements.view(np.int64), np.cumsum(sizes)[:-1])
            yield pd.Series(out, dtype=object)

    # Else Spark would move conditions on the sets, and with them this function, below the joins that choose the rows.
    of = of.asNondeterministic()
    return rows.withColumn("elements", of(F.col("text").cast("binary"))).drop("text")


def _possible(pairs: DataFrame, sketches: DataFrame, measure: Measure) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not rule out.  Nothing similar is lost:
    sketches differ in no more bits than the sets in elements."""
    side = lambda k: sketches.select(F.col("doc_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
    half = lambda x: (F.size(x) / 2).cast("int")
    folded = lambda x, y: F.when(F.size(x) <= F.size(y), x).otherwise(F.zip_with(
        F.slice(x, F.lit(1), half(x)), F.slice(x, half(x) + 1, half(x)), lambda p, q: p.bitwiseXOR(q)))
    a, b = F.col("s_a"), F.col("s_b")
    apart = F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    both = F.col("n_a") + F.col("n_b")
    close = (apart * (measure.den + measure.num) <= both * (measure.den - measure.num)) & (
        F.least("n_a", "n_b") * measure.den >= F.greatest("n_a", "n_b") * measure.num)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(close).select("a", "b").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) whose sets are similar.

    Sets are made where the texts lie and sent once for each pair, to the first of it.
    """
    small = pairs.count() <= BROADCAST_IDS
    near = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    text = docs.select("doc_id", "text")
    there = set_arrays(text.withColumnRenamed("doc_id", "b").join(near(pairs), "b"), measure)
    here = set_arrays(text.withColumnRenamed("doc_id", "a").join(near(pairs.select("a").distinct()), "a", "left_semi"), measure)
    joined = there.join(here.withColumnRenamed("elements", "others"), "a")
    common = F.size(F.array_intersect("elements", "others"))
    return joined.where(measure.linked(common, F.size("elements"), F.size("others"))).select("a", "b").distinct()


def shared_signatures(docs: DataFrame, measure: Measure, named: DataFrame, scratch: Scratch) -> DataFrame:
    """(signature, doc_id) of representatives, without the most frequent ones that they may leave out.

    Signatures that no other document has are gone.
    """
    others = F.coalesce("others", F.array().cast("array<bigint>"))
    found = (
        signed(docs, measure)
        .withColumn("n", F.sum(F.size(others) + 1).over(Window.partitionBy("signature")))
        .where("n > 1")
        .select("signature", F.explode(F.concat(F.array("doc_id"), others)).alias("doc_id"))
    )
    members = named.select("doc_id", "representative").distinct()
    rows = scratch.table(
        found.join(members, "doc_id").select("signature", F.col("representative").alias("doc_id")).distinct())
    counts = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    may = named.where("doc_id = representative").groupBy("doc_id").agg(F.min("even").alias("even"), F.min("odd").alias("odd"))
    parity = F.col("signature").bitwiseAND(F.lit(1))
    order = Window.partitionBy("doc_id", "parity").orderBy(F.desc("n"), "signature")
    ranked = (
        rows.join(counts, "signature").withColumn("parity", parity)
        .withColumn("place", F.row_number().over(order))
        .join(may, "doc_id")
        .where(F.col("place") > F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd")))
    )
    out = scratch.table(ranked.select("signature", "doc_id"))
    scratch.drop(rows)
    return out


def links(docs: DataFrame, measure: Measure, named: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(node, component) of the documents that stand for their copies and have links, if any.

    ``named`` has (doc_id, representative, n, sketch, even, odd) of nonempty sets; copies map to one id.
    """
    shared = shared_signatures(docs, measure, named, scratch)
    weights = shared.groupBy("doc_id").agg(F.count(F.lit(1)).alias("weight"))
    sketches = scratch.table(named.where("doc_id = representative").select("doc_id", "n", "sketch").join(
        weights.select("doc_id"), "doc_id", "left_semi").distinct())
    live = scratch.table(shared.join(weights, "doc_id"))
    scratch.drop(shared)
    # Rows of one id may stand in several groups of copies.
    found = scratch.table(named.groupBy("doc_id").agg(F.min("representative").alias("a"), F.max("representative").alias("b")).where(
        "a < b").select("a", "b"))
    parts = None if found.isEmpty() else scratch.table(components(found, scratch))
    for turn in range(ROUNDS + 1):
        rows = live.withColumn("component", F.col("doc_id"))
        if parts is not None:
            rows = live.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
                "component", F.coalesce("component", "doc_id"))
        groups = rows.groupBy("signature").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.max(F.struct("weight", F.col("doc_id").alias("id"), "component")).alias("top"),
        ).where("low < high").select("signature", "top")
        open_rows = scratch.table(rows.join(groups, "signature"))
        scratch.drop(live)
        if open_rows.isEmpty():
            break
        if turn < ROUNDS:
            pivot = F.col("top.id")
            pairs = open_rows.where(F.col("component") != F.col("top.component")).select(
                F.least("doc_id", pivot).alias("a"), F.greatest("doc_id", pivot).alias("b"))
            # Compared with all others, a pivot has done its part in the group.
            live = scratch.table(open_rows.where(F.col("doc_id") != pivot).select("signature", "doc_id", "weight"))
        else:
            pairs = _prefix_pairs(open_rows.select("doc_id", "component").distinct(), docs, measure, scratch)
        near = scratch.table(_possible(pairs.distinct(), sketches, measure))
        new = scratch.table(_verified(near, docs, measure))
        scratch.drop(open_rows, near)
        if not new.isEmpty():
            found = scratch.table(found.unionByName(new))
            parts = scratch.table(components(found, scratch))
    return parts


def _prefix_pairs(rows: DataFrame, docs: DataFrame, measure: Measure, scratch: Scratch) -> DataFrame:
    """Pairs of documents in different components whose prefixes meet.

    The elements of each set stand in one order, rarest among these documents first,
    so passages that many documents share do not make pairs.  Of similar sets x and y,
    x not larger, the first common element is among the first n - ceil(2nt / (1 + t)) + 1
    of x (n elements, threshold t) and the first n - ceil(nt) + 1 of y, and neither has
    too few elements from there on to reach the overlap that the sizes ask for.
    Elements whose documents all lie in one component make no pairs.
    """
    near = broadcast_if_small(scratch.table(rows), BROADCAST_IDS)
    some = set_arrays(docs.select("doc_id", "text").join(near, "doc_id"), measure)
    # Rows that share an id keep their places apart; repeated rows get equal ones.
    sets = some.select("doc_id", "component", "elements", F.size("elements").alias("n"), F.xxhash64("elements").alias("set"))
    cells = scratch.table(sets.select("doc_id", "component", "n", "set", F.explode("elements").alias("e")))
    counts = cells.groupBy("e").agg(
        F.count(F.lit(1)).alias("docs"), (F.min("component") < F.max("component")).alias("mixed")).where("docs > 1")
    num, den, n = measure.num, measure.den, F.col("n")
    # Elements of one document only go first and are left out, so places are counted from the end.
    rest = F.dense_rank().over(Window.partitionBy("doc_id", "set").orderBy(F.desc("docs"), F.desc("e"))).alias("rest")
    placed = cells.join(counts, "e").select("doc_id", "component", "n", "e", "mixed", rest)
    keyed = scratch.table(placed.where(F.col("mixed") & (F.col("rest") * den >= n * num)).select("doc_id", "component", "n", "e", "rest").distinct())
    scratch.drop(cells)
    side = lambda k: [F.col(c).alias(f"{c}_{k}") for c in ("doc_id", "component", "n", "rest")]
    x = keyed.where(F.col("rest") * (num + den) >= 2 * num * n).select("e", *side("x"))
    y = keyed.select("e", *side("y"))
    ordered = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("doc_id_x") < F.col("doc_id_y")))
    enough = F.least("rest_x", "rest_y") * (num + den) >= (F.col("n_x") + F.col("n_y")) * num
    return x.join(y, "e").where(ordered & enough & (F.col("component_x") != F.col("component_y"))).select(
        F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b"))


def join_components(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    digests = scratch.table(set_digests(small_batches(docs), measure))
    copies = scratch.table(
        digests.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("representative"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    named = scratch.table(digests.join(copies, "digest", "left").drop("digest").withColumn(
        "representative", F.when(F.col("doc_id").isNotNull(), F.coalesce("representative", "doc_id"))))
    scratch.drop(digests, copies)
    parts = links(docs, measure, named.where("n > 0 and doc_id is not null"), scratch)
    out = named.select("doc_id", F.col("n").alias("n_shingles"), "representative")
    if parts is None:
        return out.withColumnRenamed("representative", "component_id")
    return out.join(parts.withColumnRenamed("node", "representative"), "representative", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "representative").alias("component_id"))
