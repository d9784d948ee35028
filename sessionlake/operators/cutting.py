"""Cutting a queue into batches where each batch ends by the one before, in parallel.

From any offset it is known where a batch that starts there ends: at a gap, after
``max_events`` items, or by its bytes.  Offsets are taken in blocks.  As a batch has
few items, it leaves its block at one of few places; so a block is a small table, from
the place where a batch enters it to the place where one leaves it.  Tables of many
blocks are composed to one, level by level, until one table stands for a sink; then the
entries are handed down again, and each block cuts its own items.  No task holds a
sink, however long its queue is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.stored import stored

#: Blocks whose tables are composed in one task.
FAN = 256
#: Offsets that share a window when islands of consecutive offsets are found.
RANGE = 100_000
#: A table, or the table of several: from the place of entry to the place behind ``last`` where a batch enters.
_NODE = "sink_id string, at long, first long, last long, leaves array<long>"


def ends_of(offsets: np.ndarray, sizes: np.ndarray, max_events: int, max_bytes: int) -> np.ndarray:
    """Index of the last item of the batch that starts at each item.

    An item that would pass the byte limit begins the next batch, unless all before it
    are empty; at the limit or beyond, a batch is closed.
    """
    n = len(offsets)
    at = np.arange(n)
    gaps = np.flatnonzero(np.diff(offsets) != 1)
    end = np.append(gaps, n - 1)[np.searchsorted(gaps, at)] if n else at
    end = np.minimum(end, at + max_events - 1)
    if max_bytes > 0 and n:
        total = np.cumsum(sizes)
        before = total - sizes
        full = np.searchsorted(total, before + max_bytes)  # first item that reaches the limit
        filled = np.flatnonzero(sizes > 0)
        first = np.append(filled, n)[np.searchsorted(filled, at)]  # first item that is not empty
        inside = np.minimum(full, n - 1)
        kept = (full == first) | (total[inside] - before == max_bytes)
        end = np.minimum(end, np.where(full >= n, n - 1, np.where(kept, inside, inside - 1)))
    return end


def islands(items: DataFrame, width: int = RANGE) -> DataFrame:
    """``items`` (sink_id, ledger_offset, ...) with ``__island``, the first of the consecutive offsets around each one.

    Ranges of offsets are looked at each for itself; a row for each range tells whether
    it goes on from the one before.
    """
    rows = items.withColumn("__range", F.floor(F.col("ledger_offset") / width))
    inside = Window.partitionBy("sink_id", "__range").orderBy("ledger_offset")
    rows = rows.withColumn("__gap", F.when(F.lag("ledger_offset").over(inside) != F.col("ledger_offset") - 1, F.col("ledger_offset")))
    ranges = rows.groupBy("sink_id", "__range").agg(
        F.min("ledger_offset").alias("low"), F.max("ledger_offset").alias("high"), F.max("__gap").alias("gap"))
    order = Window.partitionBy("sink_id").orderBy("__range")
    goes_on = F.coalesce(F.lag("high").over(order) == F.col("low") - 1, F.lit(False))
    ranges = ranges.withColumn("own", F.when(~goes_on, F.col("low")))
    before = F.last(F.coalesce("gap", "own"), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("sink_id", "__range", F.coalesce("own", before).alias("__first"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(ranges, ["sink_id", "__range"]).withColumn(
        "__island", F.coalesce(F.last("__gap", ignorenulls=True).over(upto), "__first")).drop("__range", "__gap", "__first")


def numbered(cut: DataFrame, width: int = RANGE) -> DataFrame:
    """Items of :func:`batch_starts`, with :func:`islands`, and ``batch_no``, from 0 in each island."""
    heads = cut.where("ledger_offset = batch_start").select("sink_id", "__island", "batch_start").withColumn(
        "__range", F.floor(F.col("batch_start") / width))
    keys = ["sink_id", "__island", "__range"]
    earlier = Window.partitionBy("sink_id", "__island").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = heads.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(*keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys).orderBy("batch_start")) - 1
    numbers = heads.withColumn("__own", own).join(counts, keys).select("sink_id", "batch_start", (F.col("__own") + F.col("__before")).alias("batch_no"))
    return cut.join(numbers, ["sink_id", "batch_start"])


def _named(sink: str, n: int) -> np.ndarray:
    return np.full(n, sink, object)


def _each(df: DataFrame, keys: list[str], order: str, run: Callable[[tuple, pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``run`` over the rows of each key, in order, as a stream."""

    def done(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = run(tuple(held[0][keys].iloc[0]), pd.concat(held)) if held else None
        if out is not None:
            yield out

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            key = batch[keys]
            ends = [*(np.flatnonzero((key != key.shift()).any(axis=1).to_numpy())[1:]).tolist(), len(batch)]
            for low, high in zip([0, *ends], ends, strict=False):
                part = batch.iloc[low:high]
                if held and tuple(held[0][keys].iloc[0]) != tuple(part[keys].iloc[0]):
                    yield from done(held)
                    held = []
                held.append(part)
        yield from done(held)

    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInPandas(stream, schema)


def _blocks(items: DataFrame, width: int, max_events: int) -> DataFrame:
    """Items by block, the first ones of each block also with the block before, where its last batch may end."""
    block = F.floor(F.col("ledger_offset") / width)
    spill = (F.col("ledger_offset") - block * width) < max_events
    return items.withColumn("__block", F.explode(F.when(spill, F.array(block, block - 1)).otherwise(F.array(block))))


def batch_starts(items: DataFrame, limits: dict[str, tuple[int, int]] | tuple[int, int], blocks_per_event: int = 16) -> DataFrame:
    """(sink_id, ledger_offset, payload_bytes, batch_start, batch_end) of ``items``, with the offsets of their batch's ends.

    ``limits`` are events and bytes (0: any number) of a batch, for all sinks or by name.
    """

    def rows(pdf: pd.DataFrame, first: np.ndarray, last: np.ndarray) -> dict:
        offsets, size, own = pdf["ledger_offset"].to_numpy(), last - first + 1, slice(first[0], last[-1] + 1)
        return {"ledger_offset": offsets[own], "payload_bytes": pdf["payload_bytes"].to_numpy()[own],
                "batch_start": np.repeat(offsets[first], size), "batch_end": np.repeat(offsets[last], size)}

    return _cut(items.select("sink_id", "ledger_offset", "payload_bytes"), limits, blocks_per_event, rows,
                "ledger_offset long, payload_bytes long, batch_start long, batch_end long")


def batch_spans(items: DataFrame, limits: dict[str, tuple[int, int]] | tuple[int, int], blocks_per_event: int = 16) -> DataFrame:
    """A row for each batch: (sink_id, batch_start, batch_end, n, size, born), ``born`` being its first item's ``created_at`` in microseconds.

    Offsets of a batch are consecutive, so its items need no rows of their own.
    """

    def rows(pdf: pd.DataFrame, first: np.ndarray, last: np.ndarray) -> dict:
        offsets, total = pdf["ledger_offset"].to_numpy(), np.append(0, np.cumsum(pdf["payload_bytes"].to_numpy()))
        return {"batch_start": offsets[first], "batch_end": offsets[last], "n": last - first + 1, "size": total[last + 1] - total[first], "born": pdf["born"].to_numpy()[first]}

    born = F.unix_micros(F.col("created_at").cast("timestamp")).alias("born")
    return _cut(items.select("sink_id", "ledger_offset", "payload_bytes", born), limits, blocks_per_event, rows,
                "batch_start long, batch_end long, n long, size long, born long")


def _cut(items: DataFrame, limits: dict[str, tuple[int, int]] | tuple[int, int], blocks_per_event: int,
         rows: Callable[[pd.DataFrame, np.ndarray, np.ndarray], dict], schema: str) -> DataFrame:
    """``rows`` of the items of each block and the places of its batches' first and last items.

    Blocks have a least width: with few events to a batch, they would else be too many small groups.
    """
    of = (lambda sink: limits) if isinstance(limits, tuple) else (lambda sink: limits[sink])
    max_events = limits[0] if isinstance(limits, tuple) else max(n for n, _ in limits.values())
    width = max(max_events * blocks_per_event, RANGE // 8)
    own = stored(items)
    narrow = _blocks(own, width, max_events)

    def sorted_ends(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        offsets = pdf["ledger_offset"].to_numpy()
        return offsets, ends_of(offsets, pdf["payload_bytes"].to_numpy(), *of(pdf["sink_id"].iloc[0])) if len(pdf) else offsets

    def table(key, pdf: pd.DataFrame) -> pd.DataFrame | None:
        block = int(key[1])
        offsets, end = sorted_ends(pdf)
        low, high = block * width, (block + 1) * width
        own = int(np.searchsorted(offsets, high))
        if not own:
            return None
        follows = offsets[end] + 1  # where the next batch starts
        leaves = [0] * (own + 1)
        after, follows = np.searchsorted(offsets, follows).tolist(), follows.tolist()
        for i in range(own - 1, -1, -1):  # a batch ends in its block or in the items behind
            leaves[i] = follows[i] - high if follows[i] >= high else leaves[after[i]] if after[i] < own else 0
        leaves = np.array(leaves, np.int64)
        enter = np.searchsorted(offsets[:own], low + np.arange(max_events + 1))
        return pd.DataFrame({"sink_id": _named(key[0], 1), "at": [block], "first": [block], "last": [block], "leaves": [leaves[enter]]})

    tables = _each(narrow.select("sink_id", "ledger_offset", "payload_bytes", "__block"), ["sink_id", "__block"], "ledger_offset", table, _NODE)
    top = own.agg(F.max("ledger_offset")).first()[0]
    entered = stored(_entries(tables, 0 if top is None else top // width))

    def cut(key, pdf: pd.DataFrame) -> pd.DataFrame | None:
        """The first row says where the block is entered, the others are its items."""
        enters, pdf = pdf["payload_bytes"].iloc[0], pdf.iloc[1:]
        offsets, end = sorted_ends(pdf)
        high = (int(key[1]) + 1) * width
        i, inside, firsts = int(np.searchsorted(offsets, int(key[1]) * width + enters)), int(np.searchsorted(offsets, high)), []
        ends = end.tolist()
        while i < inside:
            firsts.append(i)
            i = ends[i] + 1
        if not firsts:
            return None
        first = np.array(firsts)
        out = rows(pdf, first, end[first])
        return pd.DataFrame({"sink_id": _named(key[0], len(next(iter(out.values()))))} | out)

    # Blocks with entries only: what lies in front of a sink's first block ends nothing.
    heads = entered.select("sink_id", F.col("at").alias("__block"), F.lit(-1).cast("bigint").alias("ledger_offset"), F.col("enters").alias("payload_bytes"),
                           *[F.lit(0).cast("bigint").alias(c) for c in items.columns[3:]])
    inside = narrow.join(heads.select("sink_id", "__block"), ["sink_id", "__block"], "left_semi")
    return _each(heads.unionByName(inside), ["sink_id", "__block"], "ledger_offset", cut, f"sink_id string, {schema}")


def _passed(pdf: pd.DataFrame, enters: np.ndarray | int) -> list:
    """Entries of consecutive tables, and behind the last; after missing blocks a batch begins at the first place."""
    out, last = [enters], None
    for first, end, leaves in zip(pdf["first"], pdf["last"], pdf["leaves"], strict=True):
        if last is not None and first != last + 1:
            out[-1] = out[-1] * 0
        out.append(np.asarray(leaves)[out[-1]])
        last = end
    return out


def _entries(tables: DataFrame, top: int) -> DataFrame:
    """(sink_id, at, enters): where the batches of each sink enter its blocks, up to block ``top``; the first is entered at its start."""

    def compose(key, pdf: pd.DataFrame) -> pd.DataFrame:
        through = _passed(pdf, np.arange(len(pdf["leaves"].iloc[0])))[-1]
        return pd.DataFrame({"sink_id": _named(key[0], 1), "at": [int(key[1])], "first": [pdf["first"].iloc[0]], "last": [pdf["last"].iloc[-1]], "leaves": [through]})

    def descend(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("at")
        enters = [int(x) for x in _passed(left, int(right["enters"].iloc[0]))[:-1]]
        return pd.DataFrame({"sink_id": _named(key[0], len(enters)), "at": left["at"].to_numpy(), "enters": enters})

    group = F.floor(F.col("at") / FAN)
    levels = [tables]
    while top > 0:
        levels.append(_each(levels[-1].withColumn("above", group), ["sink_id", "above"], "at", compose, _NODE))
        top //= FAN
    entered = levels.pop().select("sink_id", "at", F.lit(0).cast("bigint").alias("enters"))
    for level in reversed(levels):
        entered = level.withColumn("above", group).groupBy("sink_id", "above").cogroup(entered.groupBy("sink_id", "at")).applyInPandas(
            descend, "sink_id string, at long, enters long")
    return entered
