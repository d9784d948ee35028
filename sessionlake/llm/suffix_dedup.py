"""Exact removal of long repeated byte strings, by externally sorted and induced suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else too.
Sorting all suffixes would show it: such a string is a common prefix, of ``LENGTH``
bytes or more, of two neighbours.  As in induced sorting, only a sample of the
suffixes is sorted directly and the others follow from it.

* Sample.  Of the grams of ``GRAM`` bytes in each string of ``LENGTH`` bytes the one
  with the smallest hash is taken, the rightmost of equals.  Equal strings take equal
  grams at equal places, so the suffixes that start at these places (the anchors) meet.
* Sort.  Suffixes with equal grams are a shard.  Spark sorts them by the bytes to the
  right, on disk where they don't fit in memory: it is the queue of this sort.
  Common prefixes of neighbours are read off.
* Induction.  The suffixes one byte earlier are in the order of that byte, then of the
  suffixes just sorted; their common prefixes are minima over ranges of the old ones,
  plus one.  So each shard goes back byte by byte, as far as a string with that anchor
  can begin, and tells at each step which suffixes share ``LENGTH`` bytes with a
  neighbour.  What no longer can leaves the shard.

Nothing deeper than ``LENGTH`` is needed, so the recursion ends with the sample: its
suffixes are compared directly.  Only surroundings that differ are sent: anchors whose
whole reach is equal are counted by hash, and copies of a text are one text.  Shards
of more than ``SHARD`` different surroundings are not sorted in one task; their
strings are counted by hash, in partial sums.  All steps are tables or shuffles that
Spark can make again.  All joins are merges: Spark judges by the size of the files, in
which repeats take little space, and a broadcast passes through the driver.

Rules: null texts are empty.  Texts shorter than ``LENGTH`` keep all bytes.  Repeats in
one text count, overlapping ones too.  Rows that share an id are documents of their
own.  Other columns are ignored, whatever their names.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch

LENGTH = 400
#: Bytes of the hashed grams, a power of two.
GRAM = 64
#: Different surroundings of one gram up to which a task sorts them.
SHARD = 20_000
_REACH = LENGTH - GRAM  # bytes to the left of an anchor at which a string can begin
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _ODD[0]) ^ (np.arange(1, 257, dtype=np.uint64) * _ODD[1] >> np.uint64(17))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, size = _BYTE[data], 1
    while size < GRAM:
        h = h[:-size] * _ODD[0] + h[size:]
        h ^= h >> np.uint64(29)
        h *= _ODD[1]
        size *= 2
    return h ^ (h >> np.uint64(32))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, from the minima up to and from the ends of blocks."""
    full = -(-len(keys) // width) * width
    blocks = np.full(full, np.uint64(2**64 - 1))
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    up_to = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    last = len(keys) - width + 1
    return np.minimum(since[:last], up_to[width - 1 : width - 1 + last])


def _piece_anchors(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of the anchors of pieces (text, offset, bytes); strings don't cross pieces."""
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    h = _gram_hashes(data)
    at = np.arange(len(h), dtype=np.uint64)
    least = _window_minima((h & ~_PLACE) | (_PLACE - at), LENGTH - GRAM + 1)
    starts = np.zeros(len(data) + 1, np.int8)
    starts[ends - sizes] += 1
    starts[ends - LENGTH + 1] -= 1
    inside = np.cumsum(starts)[: len(least)] > 0
    found = (_PLACE - (np.unique(least[inside]) & _PLACE)).astype(np.int64)
    of = np.searchsorted(ends, found, "right")
    text = np.array([p[0] for p in pieces])[of]
    offset = np.array([p[1] for p in pieces])[of]
    return text, found - (ends - sizes)[of] + offset, h[found]


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of all anchors; texts of any length are taken in overlapping pieces."""
    out, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), _PIECE):
            pieces.append((i, at, text[at : at + _PIECE + LENGTH - 1]))
            size += len(pieces[-1][2])
            if size >= _PIECE:
                out.append(_piece_anchors(pieces))
                pieces, size = [], 0
    if pieces:
        out.append(_piece_anchors(pieces))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, place, h = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((place, text))
    text, place, h = text[order], place[order], h[order]
    new = np.append(True, (text[1:] != text[:-1]) | (place[1:] != place[:-1]))
    return text[new], place[new], h[new]


def anchors(texts: DataFrame) -> DataFrame:
    """(id, place, to_left, to_right, gram, around) of each anchor; ``around`` hashes the bytes within its reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("text").to_pylist()
            text, place, h = anchors_of(data)
            to_left = np.minimum(place, _REACH)
            to_right = np.minimum(np.array([len(t) for t in data], np.int64)[text] - place, LENGTH)
            around = np.fromiter(
                (xxhash.xxh3_64_intdigest(data[i][p - x : p + y], x) for i, p, x, y in
                 zip(text.tolist(), place.tolist(), to_left.tolist(), to_right.tolist(), strict=True)), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(text)), pa.array(place), pa.array(to_left.astype(np.int32)),
                 pa.array(to_right.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(around.view(np.int64))],
                ["id", "place", "to_left", "to_right", "gram", "around"])

    return texts.select("id", "text").mapInArrow(run, "id binary, place long, to_left int, to_right int, gram long, around long")


def _surroundings(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(gram, to_right, to_left, alone, id, place): bytes to the right, and to the left backwards, of each member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, text, rows in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("rows"), strict=True):
                rows = rows.values
                at = [rows.field(k).to_pylist() for k in ("place", "to_left", "to_right")]
                yield pa.RecordBatch.from_arrays(
                    [rows.field("gram"), pa.array([text[p : p + y] for p, _, y in zip(*at, strict=True)], pa.binary()),
                     pa.array([text[p - x : p][::-1] for p, x, _ in zip(*at, strict=True)], pa.binary()),
                     rows.field("alone"), pa.array([id_] * len(rows), pa.binary()), rows.field("place")],
                    ["gram", "to_right", "to_left", "alone", "id", "place"])

    by_text = members.groupBy("id").agg(F.collect_list(F.struct("gram", "place", "to_left", "to_right", "alone")).alias("rows"))
    return texts.join(by_text.hint("merge"), "id").select("id", "text", "rows").mapInArrow(
        run, "gram long, to_right binary, to_left binary, alone boolean, id binary, place long")


def _padded(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(-1, width)
    return data, np.array([len(v) for v in values], np.int64)


def induce(gram: np.ndarray, to_right: list[bytes], to_left: list[bytes]) -> np.ndarray:
    """Which strings that begin 0, 1, 2, ... bytes before each anchor occur at another one of its gram.

    Rows are sorted by gram, then by the bytes to the right.  One row for each anchor,
    one column for each distance.
    """
    right, right_size = _padded(to_right, LENGTH)
    left, left_size = _padded(to_left, _REACH)
    total = len(gram)
    found = np.zeros((total, _REACH + 1), bool)
    differ = right[1:] != right[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    common = np.minimum(common, np.minimum(right_size[1:], right_size[:-1]))
    minima = [np.append(0, common).astype(np.int16)]  # of ranges of 1, 2, 4, ... neighbours
    while 1 << len(minima) <= total:
        step = 1 << (len(minima) - 1)
        minima.append(np.minimum(minima[-1][:-step], minima[-1][step:]))

    def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes ``low`` < ``high``: the least of the neighbours' between."""
        size = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(size):
            on = size == k
            out[on] = np.minimum(minima[k][low[on] + 1], minima[k][high[on] - (1 << int(k)) + 1])
        return out

    live = np.arange(total)
    of = np.cumsum(np.append(False, gram[1:] != gram[:-1]))  # suffixes that agree so far
    changed, best = True, np.zeros(total, np.int64)
    for back in range(_REACH + 1):
        if back:
            stay = left_size[live] >= back
            before = left[live, back - 1].astype(np.int64)
            if not stay.all() or ((of[1:] == of[:-1]) & (before[1:] != before[:-1])).any():
                live, key = live[stay], (of * 256 + before)[stay]
                order = np.argsort(key, kind="stable")
                live, key = live[order], key[order]
                of = np.cumsum(np.append(False, key[1:] != key[:-1])) if len(key) else key
                changed = True
        while changed and len(live):
            near = np.flatnonzero(of[1:] == of[:-1])
            shared = between(live[near], live[near + 1])
            best = np.zeros(len(live), np.int64)
            best[near] = shared
            best[near + 1] = np.maximum(best[near + 1], shared)
            # A string can only be shared where it does not reach further right than any neighbour agrees.
            hope = best >= LENGTH - left_size[live]
            changed = not hope.all()
            live, of, best = live[hope], of[hope], best[hope]
        if not len(live):
            break
        found[live[best >= LENGTH - back], back] = True
    return found


def _runs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of true values."""
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _induced(surroundings: DataFrame) -> DataFrame:
    """(id, low, high): spans of the strings that shards share, anchors that are counted already left out."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        gram, to_right, to_left, alone, ids, place = zip(*rows, strict=True)
        row, first, last = _runs(induce(np.array(gram, np.int64), list(to_right), list(to_left)) & np.array(alone)[:, None])
        at = np.array(place, np.int64)[row]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in row], pa.binary()), pa.array(at - last), pa.array(at - first + LENGTH)], ["id", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            new = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            if len(rows) >= SHARD and new:
                whole = len(rows)  # all but the last shard, which may go on
                while whole and rows[whole - 1][0] == rows[-1][0]:
                    whole -= 1
                if whole:
                    yield spans(rows[:whole])
                    rows = rows[whole:]
            rows.extend(new)
        if rows:
            yield spans(rows)

    sorted_ = surroundings.repartition("gram").sortWithinPartitions("gram", "to_right")
    return sorted_.mapInArrow(run, "id binary, low long, high long")


def _counted(surroundings: DataFrame) -> DataFrame:
    """(id, low, high) of shared strings, counted by hash within their gram; for shards of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, right, left, alone, id_, place in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                around = left[::-1] + right
                n = len(around) - LENGTH + 1
                skip = max(len(left) - _REACH, 0)
                low = place - len(left)
                hashes = [xxhash.xxh3_64_intdigest(around[i : i + LENGTH]) for i in range(skip, min(n, len(left) + 1))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * len(hashes), pa.int64()), pa.array(np.array(hashes, np.uint64).view(np.int64)),
                     pa.array([alone] * len(hashes), pa.bool_()), pa.array([id_] * len(hashes), pa.binary()),
                     pa.array(np.arange(low + skip, low + skip + len(hashes))), pa.array(place - np.arange(low + skip, low + skip + len(hashes)))],
                    ["gram", "string", "alone", "id", "low", "back"])

    strings = surroundings.mapInArrow(run, "gram long, string long, alone boolean, id binary, low long, back long")
    # One string may hold its gram several times, so the place of the gram in it counts too.
    # A row that stands for several equal surroundings counts as two.
    shared = strings.groupBy("gram", "back", "string").agg(F.sum(F.when(F.col("alone"), 1).otherwise(2)).alias("n")).where("n > 1").drop("n")
    return strings.where("alone").join(shared.hint("merge"), ["gram", "back", "string"]).select("id", "low", (F.col("low") + LENGTH).alias("high"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(id, text, copies) of the texts of ``LENGTH`` bytes or more; ``id`` is half of their SHA-256."""
    text = F.col("text").cast("binary")
    return docs.where(F.octet_length("text") >= LENGTH).select(_text_id(text).alias("id"), text.alias("text")).groupBy("id").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def _text_id(text):
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def repeated_spans(texts: DataFrame, scratch: Scratch, shard: int = SHARD) -> DataFrame:
    """(id, low, high): spans that cover all bytes of repeated strings in the distinct ``texts`` (id, text)."""
    found = scratch.table(anchors(texts))
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    rows = scratch.table(found.join(twice.hint("merge"), "gram", "left_semi"))
    scratch.drop(found)
    own = F.struct("id", "place", "to_left", "to_right")
    kinds = scratch.table(rows.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("one")))
    equal = kinds.where("n > 1").select("gram", "around")
    spans = rows.join(equal.hint("merge"), ["gram", "around"], "left_semi").select(
        "id", (F.col("place") - F.col("to_left")).alias("low"), (F.col("place") + F.col("to_right")).alias("high"))
    many = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    members = kinds.join(many.hint("merge"), "gram").select("gram", "one.*", (F.col("n") == 1).alias("alone"), (F.col("kinds") > shard).alias("big"))
    members = scratch.table(members)
    around = scratch.table(_surroundings(members.where("not big"), texts))
    spans = spans.unionByName(_induced(around))
    if not members.where("big").isEmpty():
        spans = spans.unionByName(_counted(scratch.table(_surroundings(members.where("big"), texts))))
    spans = scratch.table(spans)
    scratch.drop(around, kinds, rows, members)
    return spans


def _cut(texts: DataFrame) -> DataFrame:
    """(id, kept, n_removed, n_spans) from (id, text, spans): texts without the bytes of their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, text, spans in zip(batch.column("id"), batch.column("text"), batch.column("spans"), strict=True):
                text, kept, at, removed, runs = text.as_py(), [], 0, 0, 0
                low, high = (np.asarray(spans.values.field(k)) for k in ("low", "high"))
                order = np.argsort(low, kind="stable")
                low, high = low[order], np.maximum.accumulate(high[order])
                new = np.append(True, low[1:] > high[:-1])
                for a, b in zip(low[new].tolist(), high[np.append(np.flatnonzero(new)[1:] - 1, -1)].tolist(), strict=True):
                    kept.append(text[at:a])
                    at, removed, runs = b, removed + b - a, runs + 1
                kept.append(text[at:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id_.as_py()], pa.binary()), pa.array([b"".join(kept)], pa.binary()), pa.array([removed]), pa.array([runs])],
                    ["id", "kept", "n_removed", "n_spans"])

    return texts.mapInArrow(run, "id binary, kept binary, n_removed long, n_spans long")


def changed_texts(docs: DataFrame, scratch: Scratch, shard: int = SHARD) -> DataFrame:
    """(id, kept, n_removed, n_spans) of the distinct texts that lose bytes; ``kept`` is what remains.

    A text that several rows hold is repeated as a whole.
    """
    texts = scratch.table(distinct_texts(docs))
    spans = repeated_spans(texts, scratch, shard)
    single = spans.groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = _cut(texts.where("copies = 1").join(single.hint("merge"), "id").select("id", "text", "spans"))
    whole = texts.where("copies > 1").select(
        "id", F.lit(b"").alias("kept"), F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"))
    return cut.unionByName(whole)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``.  Cut characters become U+FFFD; ``bytes`` is exact."""
    changed = changed_texts(docs, Scratch(docs.sparkSession)).select(F.col("id").alias("__id"), F.col("kept").alias("__kept"))
    own = F.col("text").cast("binary")
    joined = docs.withColumn("__own", F.coalesce(own, F.lit(b""))).join(changed.hint("merge"), _text_id(F.col("__own")) == F.col("__id"), "left")
    kept = F.coalesce("__kept", "__own")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"],
                         F.when(F.col("text").isNotNull(), F.make_valid_utf8(kept.cast("string"))).alias("text"), kept.alias("bytes"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    scratch = Scratch(docs.sparkSession)
    changed = scratch.table(changed_texts(docs, scratch).select("id", F.sha2("kept", 256).alias("kept_sha256"), "n_removed", "n_spans"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("own"))
    rows = rows.withColumn("id", F.unhex(F.substring("own", 1, 32)))
    return rows.join(changed.hint("merge"), "id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"))
