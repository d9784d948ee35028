"""A Merkle manifest of a dataset: a tree of SHA-256 digests with states that can be resumed.

Rows are leaves.  The leaves of a language, by id, are the lowest nodes of a tree;
every eight consecutive nodes have a parent, the digest of their hexadecimal
digests, until one remains: the subroot.  The subroots, by language, are the leaves
of a last tree, whose root stands for the dataset.

A parent keeps its children's digests and, before each child slot, the state of the
hash so far.  To learn the root that a changed leaf would give, the state before its
slot is resumed with the new digest and the siblings to the right only, and so on
up to the root.  Siblings of all levels, hashed in turn, are the leaf's proof.

Levels are built from below, each from the table of the last one, an eighth of it in
size.  Folding goes the other way: each parent is joined with the path above it, so
that a leaf meets its whole path in one join by the number of its first parent; every
key has one row on one side and eight at most on the other.  No tree, level or
language passes through one task; positions come from ranges of keys.

Rules: null columns count as '-', a null language comes first; rows without id come
first in their language.  Rows that share an id follow each other by digest; equal
rows are leaves of their own.  Texts of any length are hashed whole, in the JVM.
Other columns are ignored, whatever their names.  An empty table has no root, and
no rows come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm import midstate
from sessionlake.llm.common import Scratch, ascii_lower, crc_mod

ARITY = 8
#: The tree over all languages; names of the others begin with '-' or '='.
TOP = ""
_STEP = "struct<slot:int,before:binary,children:binary>"


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of the columns of a document, each with its length in bytes."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in (doc_id, source, lang, n_chars, text)]).cast("binary"), 256)


def placed(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``idx`` (from 0, by ``order`` within ``tree``) and ``n``, the tree's rows.

    Rows are dealt by ranges of their keys; only counts per range and tree are summed
    up, so a tree that holds most rows is many tasks.
    """
    keys = ["tree", *order]
    ranged = scratch.table(rows.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("rows"))
    by = Window.partitionBy("tree")
    starts = counts.select("tree", "range", F.sum("rows").over(by).alias("n"),
                           (F.sum("rows").over(by.orderBy("range")) - F.col("rows")).alias("start"))
    own = Window.partitionBy("tree", "range").orderBy(*[F.asc_nulls_first(c) for c in order])
    numbered = ranged.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(starts, ["tree", "range"]).withColumn("idx", F.col("start") + F.col("own")).drop("range", "own", "start")


def _hashed(groups: DataFrame) -> DataFrame:
    """(tree, idx, n, digest, before, children) from (tree, idx, n, kids): digests and states of parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kids = batch.column("kids").combine_chunks() if isinstance(batch.column("kids"), pa.ChunkedArray) else batch.column("kids")
            ends = np.asarray(kids.offsets)
            first, count = ends[:-1], np.diff(ends)
            data = np.frombuffer(b"".join(kids.values.to_pylist()), np.uint8).reshape(-1, 32)
            blocks = midstate.hex_block(data)
            state = np.repeat(midstate.START[None, :], len(count), axis=0)
            before = np.zeros((len(count), ARITY, 32), np.uint8)
            for slot in range(int(count.max(initial=0))):
                on = np.flatnonzero(count > slot)
                before[on, slot] = midstate.to_bytes(state[on])
                state[on] = midstate.compress(state[on], blocks[first[on] + slot])
            digest = midstate.finish(state, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("idx"), batch.column("n"),
                 pa.array([x.tobytes() for x in digest], pa.binary()),
                 pa.array([x[:k].tobytes() for x, k in zip(before, count, strict=True)], pa.binary()),
                 pa.array([data[i : i + k].tobytes() for i, k in zip(first, count, strict=True)], pa.binary())],
                ["tree", "idx", "n", "digest", "before", "children"])

    return groups.mapInArrow(run, "tree string, idx long, n long, digest binary, before binary, children binary")


def grow(leaves: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Levels of parents above ``leaves`` (tree, idx, n, digest), lowest first, and the root of each tree.

    A level has (tree, idx, n, digest, before, children); ``n`` is the number of the
    tree's nodes on it.  Trees end at the level where one node remains.
    """
    levels: list[DataFrame] = []
    roots = leaves.where("n = 1").select("tree", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves
    while most > 1:
        kid = F.struct(F.col("idx").alias("at"), "digest")
        groups = nodes.where("n > 1").groupBy("tree", F.floor(F.col("idx") / ARITY).alias("idx")).agg(
            F.array_sort(F.collect_list(kid)).alias("kids"), F.ceil(F.max("n") / ARITY).alias("n"))
        nodes = scratch.table(_hashed(groups.withColumn("kids", F.col("kids.digest")).select("tree", "idx", "n", "kids")))
        levels.append(nodes)
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // ARITY)
    return levels, roots


def paths(levels: list[DataFrame], above: DataFrame | None, scratch: Scratch) -> DataFrame | None:
    """(tree, idx, before, children, path, ...) of the lowest parents, with the steps from there to the root.

    ``above`` (tree, top, ...) has the steps that follow a tree's root, and columns to pass down.
    """
    last, columns = None, ["tree", "idx", "before", "children", "path", *([] if above is None else above.columns[2:])]
    for level in reversed(levels):
        rows = level.select("tree", "idx", "n", "before", "children")
        ends = rows.where("n = 1")
        ends = ends.withColumn("path", _nothing()) if above is None else ends.join(above, "tree").withColumnRenamed("top", "path")
        found = ends.select(*columns)
        if last is not None:
            up = last.withColumnsRenamed({"idx": "up", "before": "b", "children": "c", "path": "p"})
            slot = (F.col("idx") % ARITY).cast("int")
            inner = rows.where("n > 1").withColumn("up", F.floor(F.col("idx") / ARITY)).join(up, ["tree", "up"])
            found = found.unionByName(inner.withColumn("path", F.concat(F.array(_step(slot, "b", "c")), "p")).select(*columns))
        found = scratch.table(found)
        scratch.drop(last)
        last = found
    return last


def _nothing() -> Column:
    return F.array().cast(f"array<{_STEP}>")


def _step(slot: Column, before: str, children: str) -> Column:
    """A parent as seen from one of its children: the state before it, and all children."""
    return F.struct(slot.alias("slot"), F.substring(before, slot * 32 + 1, F.lit(32)).alias("before"), F.col(children).alias("children"))


def _folded(rows: DataFrame) -> DataFrame:
    """``rows`` (..., digest, path) with ``folded`` and ``proof``, both hexadecimal, for digest and path."""
    kept = [f for f in rows.schema.fields if f.name not in ("digest", "path")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
            ends = np.asarray(batch.column("path").offsets)
            steps = batch.column("path").values
            slots = np.asarray(steps.field("slot"), np.int64)
            before = np.frombuffer(b"".join(steps.field("before").to_pylist()), np.uint8).reshape(-1, 32)
            lists = steps.field("children").to_pylist()
            count = np.array([len(x) // 32 for x in lists], np.int64)
            first = np.cumsum(count) - count
            blocks = midstate.hex_block(np.frombuffer(b"".join(lists), np.uint8).reshape(-1, 32))
            low, depth = ends[:-1], np.diff(ends)
            proof = np.repeat(midstate.START[None, :], len(low), axis=0)
            told = np.zeros(len(low), np.int64)
            now = digest.copy()
            for level in range(int(depth.max(initial=0))):
                on = np.flatnonzero(depth > level)
                at = low[on] + level
                slot, size = slots[at], count[at]
                state = midstate.compress(midstate.to_state(before[at]), midstate.hex_block(now[on]))
                for k in range(ARITY):
                    right = np.flatnonzero((k > slot) & (k < size))
                    state[right] = midstate.compress(state[right], blocks[first[at[right]] + k])
                    other = np.flatnonzero((k != slot) & (k < size))
                    proof[on[other]] = midstate.compress(proof[on[other]], blocks[first[at[other]] + k])
                    told[on[other]] += 1
                now[on] = midstate.finish(state, size)
            out = [batch.column(f.name) for f in kept]
            out.append(pa.array([x.tobytes().hex() for x in now], pa.string()))
            out.append(pa.array([x.tobytes().hex() for x in midstate.finish(proof, told)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*[f.name for f in kept], "folded", "proof"])

    return rows.mapInArrow(run, f"{schema}, folded string, proof string")


class Manifest:
    """The trees of a table of documents, as tables in the shared folder.

    ``leaves`` has (tree, doc_id, digest, changed, idx, n); ``changed`` is the digest
    that the caller asked for beside the document's own, or null.
    """

    def __init__(self, docs: DataFrame, changed: Column | None = None):
        """``changed`` is a text that takes the place of a row's own when its leaf is folded (null: none does)."""
        self.scratch = Scratch(docs.sparkSession)
        cols = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
        other = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf_digest(*cols, changed))
        tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree")
        hashed = docs.select(tree, F.col("doc_id").cast("bigint").alias("doc_id"),
                             F.unhex(leaf_digest(*cols, F.col("text"))).alias("digest"), F.unhex(other).alias("changed"))
        found = self.scratch.table(hashed)
        # Equal rows are told apart by the order in which they were written.
        found = found.withColumn("row", F.monotonically_increasing_id())
        self.leaves = self.scratch.table(placed(found, ["doc_id", "digest", "row"], self.scratch).drop("row"))
        self.levels, self.subroots = grow(self.leaves, self.scratch)
        tops = self.subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("lang_tree"), "digest")
        self.top_leaves = self.scratch.table(placed(tops, ["lang_tree"], self.scratch))
        self.top_levels, self.root = grow(self.top_leaves, self.scratch)

    def nodes(self) -> DataFrame:
        """(tree, level, idx, digest, before, children) of all parents; the tree of all languages has the empty name."""
        out = None
        for levels in (self.levels, self.top_levels):
            for k, level in enumerate(levels):
                level = level.select("tree", F.lit(k + 1).alias("level"), "idx", "digest", "before", "children")
                out = level if out is None else out.unionByName(level)
        return out

    def proofs(self) -> DataFrame:
        """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf."""
        own = F.concat(F.array(_step((F.col("idx") % ARITY).cast("int"), "before", "children")), "path")
        up = F.floor(F.col("idx") / ARITY)
        lowest = paths(self.top_levels, None, self.scratch)
        tops = self.top_leaves.join(F.broadcast(self.root.withColumnRenamed("digest", "root")), "tree")
        if lowest is None:
            tops = tops.withColumn("top", _nothing())
        else:
            tops = tops.withColumn("up", up).join(lowest.withColumnRenamed("idx", "up"), ["tree", "up"]).withColumn("top", own)
        above = self.scratch.table(tops.select(F.col("lang_tree").alias("tree"), "top", F.col("digest").alias("subroot"), "root"))
        path = paths(self.levels, above, self.scratch)
        columns = ["doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.coalesce("changed", "digest").alias("digest")]
        rows = self.leaves.where("n = 1").join(above, "tree").select(*columns, F.col("top").alias("path"))
        if path is not None:
            inner = self.leaves.where("n > 1").withColumn("up", up).join(path.withColumnRenamed("idx", "up"), ["tree", "up"])
            rows = rows.unionByName(inner.select(*columns, own.alias("path")))
        plain = lambda name: F.lower(F.hex(name)).alias(name)
        return _folded(rows).select("doc_id", plain("leaf"), plain("subroot"), plain("root"), F.col("proof").alias("proof_sha256"),
                                    F.col("folded").alias("folded_root"), (F.col("folded") == F.lower(F.hex("root"))).alias("verified"))


def audit(docs: DataFrame) -> DataFrame:
    """Every leaf with its proof; where 3 divides the crc32 of the id, a tampered text is folded instead of the own one."""
    tampered = F.when(crc_mod(F.col("doc_id"), 3) == 0, ascii_lower(F.col("text")))
    return Manifest(docs, tampered).proofs()
