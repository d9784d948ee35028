"""Language-model scoring by Katz backoff (words, then word pairs).

Counts are Good-Turing discounted up to ``K``, from smoothed counts of counts; larger
counts lose a fixed tenth of a count, so every context keeps mass for unseen words.  Backoff weights make each
distribution sum to one exactly; words never met in training are one event.

The word counts are a table in the shared folder.  Tokens are shuffled once, packed in
arrays, to the partition of their word, where the counts of the word and of all pairs
that end in it are complete; words that fill a partition alone are split by their
predecessor, and pairs that do by document.  The counts of these words and pairs are
lists of a bounded length and broadcast.  There each token is evaluated as far as it
can be: a seen pair by its discounted count, an unseen one by the word's own
probability.  This, the sums of each document and the followers of each context, is
a second table, partitioned by document and by context.  It is read twice: first for
the counts of counts of all pairs and the weights of the most frequent contexts, then
for the weights of all contexts.  Tokens that wait for the weight of a frequent
context go to the partition of their document, the others to that of the context.

Rules: null text counts as empty and has only its end.  Each row has its row.  Rows
that share an id and differ in text are one document, scored as a whole; rows that
are equal count each for itself.  Rows without id are one document, never trained on
differently from id ''.  Without training rows all tokens are unknown.  Other columns
are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch, small_batches

K = 5
#: What counts above K lose.
TAIL = 0.1
START, END = 1, 2
#: Tokens of a bucket, tokens packed at once, and occurrences from which a word or pair is split.
BUCKET_TOKENS = 1_500_000
FLUSH = 3_000_000
HOT = 150_000
#: Words, pairs and contexts that are broadcast, at most.
MAX_HOT = 100_000
_NULL_ID = -(1 << 63)
#: Sums of logarithms travel as whole numbers of this unit.
SCALE = 1e8


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = max(3, xxhash.xxh64_intdigest(word))
        return out


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed: small whole numbers in their smallest type, others by byte planes.

    Sorted hashes go as differences, so their upper byte planes are nearly empty.
    """
    out = []
    for a in arrays:
        step = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if step:
            a = np.concatenate((a[:1], a[1:] - a[:-1]))
        if a.dtype.kind in "ui" and len(a) and a.min() >= 0 and a.max() < 1 << 32:
            a = a.astype(np.min_scalar_type(int(a.max())))
        out.append(np.frombuffer(f"{a.dtype.str:<4}{len(a):<11}{'+' if step else '='}".encode(), np.uint8))
        out.append(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.ravel())
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(out).tobytes())


def _load(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(data))
    out, at = [], 0
    while at < len(raw):
        kind, n, step = np.dtype(raw[at : at + 4].decode().strip()), int(raw[at + 4 : at + 15]), raw[at + 15 : at + 16]
        at += 16
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        a = np.ascontiguousarray(planes.T).view(kind).ravel()
        out.append(np.cumsum(a, dtype=np.uint64) if step == b"+" else a)
        at += n * kind.itemsize
    return out


def smoothed(counts: np.ndarray) -> np.ndarray | None:
    """Counts of counts 1..K+1 on a line in the logarithms (Simple Good-Turing), if there is one.

    Each count of counts is averaged over the gap around it first.  Only counts up to
    K + 1 are fitted, as only these make ratios.
    """
    r = np.flatnonzero(counts) + 1.0
    if len(r) < 2:
        return None
    before = np.concatenate(([0.0], r[:-1]))
    after = np.concatenate((r[1:], [2 * r[-1] - before[-1]]))
    x, y = np.log(r), np.log(2 * counts[counts > 0] / (after - before))
    x0, y0 = x.mean(), y.mean()
    slope = ((x - x0) * (y - y0)).sum() / ((x - x0) ** 2).sum()
    return np.exp(y0 + slope * (np.log(np.arange(1.0, K + 2)) - x0))


def discounted(counts: np.ndarray) -> np.ndarray:
    """What counts 0..K+1 become; ``counts`` has how many events have count 1..K+1.

    Good-Turing ratios of the smoothed counts of counts: copies of documents make some
    counts frequent, and plain ratios then leave (0, 1).  A count whose fitted
    discount is still not usable (no line, or one that falls too slowly) loses half.
    """
    out = np.arange(K + 2, dtype=float)
    out[1 : K + 1] -= 0.5
    out[K + 1] -= TAIL
    n = smoothed(np.asarray(counts, float))
    if n is None:
        return out
    cut = (K + 1) * n[K] / n[0]
    for r in range(1, K + 1):
        d = ((r + 1) * n[r] / n[r - 1] / r - cut) / (1 - cut) if cut < 1 else 0.0
        if 0 < d < 1:
            out[r] = r * d
    return out


@dataclass
class Words:
    """Unigram statistics: totals, discounted counts and the words that are split."""

    tokens: int = 0
    types: int = 0
    texts: int = 0
    stars: np.ndarray = field(default_factory=lambda: np.zeros(K + 2))
    unknown: float = 1.0
    scale: float = 1.0
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    hot_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    #: Hashes of split pairs, their words, contexts and counts.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        star = np.where(counts > K, counts - TAIL, self.stars[np.minimum(counts, K)])
        return np.where(counts > 0, star * self.scale / max(1, self.tokens), self.unknown)

    def is_hot(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _found(self.hot, self.hot_counts, w)

    def is_hot_pair(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _found(self.pairs, self.pair_counts, _pair_hash(u, w))


def _found(names: np.ndarray, counts: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(names):
        return np.zeros(len(w), bool), np.zeros(len(w), np.int64)
    at = np.minimum(np.searchsorted(names, w), len(names) - 1)
    return names[at] == w, counts[at]


def _pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (u ^ (u >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) + w
    return (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)


def _token_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes, train); ``docs`` has doc_id, text and train."""
    return docs.select(
        F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"), "train")


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = _Hashes()
    parts: list[np.ndarray] = []
    size = 0

    def flush() -> pd.DataFrame:
        w, n = np.unique(np.concatenate(parts), return_counts=True)
        return pd.DataFrame({"w": w.view(np.int64), "n": n})

    for batch in batches:
        for text in batch["text"]:
            words = (text or b"").lower().split()
            parts.append(np.fromiter((known[w] for w in words), np.uint64, len(words)))
            parts.append(np.array([END], np.uint64))
            size += len(words) + 1
        if size > FLUSH:
            yield flush()
            parts, size = [], 0
    if parts:
        yield flush()


def word_table(train: DataFrame, scratch: Scratch) -> Words:
    """Unigram statistics of the training texts; only sums and split words leave Spark."""
    table = scratch.table(train.mapInPandas(_count_words, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")))
    some = [F.count_if(F.col("n") == r) for r in range(1, K + 2)]
    *counts, tokens, types, texts = table.agg(
        *some, F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("w") == END, F.col("n"))), F.lit(0))).first()
    own = Words()
    if not tokens:
        return own
    own.tokens, own.types, own.texts = tokens, types, texts
    own.stars = discounted(np.array(counts))
    left = sum((r - own.stars[r]) * counts[r - 1] for r in range(1, K + 1))
    left += TAIL * (types - sum(counts[:K]))
    own.unknown = left / tokens
    least = max(HOT, tokens // MAX_HOT)
    hot = table.where(F.col("n") > least).toPandas()  # MAX_HOT rows at most
    names, sizes = hot["w"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    if texts > least:  # the start is a context, but no token
        names, sizes = np.append(names, np.uint64(START)), np.append(sizes, texts)
    order = np.argsort(names)
    own.hot, own.hot_counts = names[order], sizes[order]
    return own


def split_pairs(rows: DataFrame, words: Words) -> Words:
    """Adds the pairs that are too frequent for one partition; both of their words are.

    Counts in the training texts and in all of them are summed per task before they
    are shuffled.
    """
    if not len(words.hot):
        return words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        parts: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            found, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
            u, w = words.hot[found[:, 0]].view(np.int64), words.hot[found[:, 1]].view(np.int64)
            return pd.DataFrame({"u": u, "w": w, "trained": np.where(found[:, 2] > 0, n, 0), "n": n})

        for batch in batches:
            for text, train in zip(batch["text"], batch["train"], strict=True):
                w = np.array([START, *(known[x] for x in (text or b"").lower().split()), END], np.uint64)
                at = np.minimum(np.searchsorted(words.hot, w), len(words.hot) - 1)
                at = np.where(words.hot[at] == w, at, -1)
                both = (at[1:] >= 0) & (at[:-1] >= 0)
                if both.any():
                    parts.append(np.stack([at[:-1][both], at[1:][both], np.full(both.sum(), int(train))], axis=1).astype(np.int32))
                    size += len(parts[-1])
            if size > FLUSH:
                yield flush()
                parts, size = [], 0
        if parts:
            yield flush()

    sums = rows.mapInPandas(run, "u long, w long, trained long, n long").groupBy("u", "w").agg(
        F.sum("trained").alias("trained"), F.sum("n").alias("n"))
    got = sums.where(F.col("n") > max(HOT, words.tokens // MAX_HOT)).toPandas()  # some MAX_HOT rows at most
    u, w = (got[c].to_numpy(np.int64).view(np.uint64) for c in ("u", "w"))
    names = _pair_hash(u, w)
    order = np.argsort(names)
    words.pairs, words.pair_contexts, words.pair_words = names[order], u[order], w[order]
    words.pair_counts = got["trained"].to_numpy(np.int64)[order]
    return words


def _packer(words: Words, buckets: int):
    """Tokens of a task, packed by the bucket of their word."""

    def flush(ids, train, w, u, sizes):
        w, u = np.concatenate(w), np.concatenate(u)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        ids, train = np.array(ids, np.int64), np.array(train, np.uint8)
        hot, _ = words.is_hot(w)
        key = np.where(hot, w ^ (u * np.uint64(0xC2B2AE3D27D4EB4F)), w)
        if len(words.pairs):
            wide, _ = words.is_hot_pair(u, w)
            key = np.where(wide, key ^ (ids[doc].view(np.uint64) * np.uint64(0x165667B19E3779F9)), key)
        bucket = _spread(key, buckets)
        order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        for b, part in enumerate(np.split(order, ends[:-1])):
            if not len(part):
                continue
            part = part[np.argsort(w[part], kind="stable")]
            names, counts = np.unique(w[part], return_counts=True)
            before, at = np.unique(u[part], return_inverse=True)
            own, place = np.unique(doc[part], return_inverse=True)
            yield b, _dump(names, counts, before, at, ids[own], train[own], place)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        state: tuple[list, ...] = ([], [], [], [], [])
        size = 0
        for batch in batches:
            for doc, text, train in zip(batch["doc_id"], batch["text"], batch["train"], strict=True):
                split = (text or b"").lower().split()
                line = np.empty(len(split) + 2, np.uint64)
                line[0], line[-1] = START, END
                line[1:-1] = np.fromiter((known[x] for x in split), np.uint64, len(split))
                for into, value in zip(state, (doc, train, line[1:], line[:-1], len(split) + 1), strict=True):
                    into.append(value)
                size += len(line)
                if size > FLUSH:
                    for b, data in flush(*state):
                        yield pd.DataFrame({"bucket": [b], "data": [data]})
                    state, size = ([], [], [], [], []), 0
        if size:
            for b, data in flush(*state):
                yield pd.DataFrame({"bucket": [b], "data": [data]})

    return run


def _by_target(target: np.ndarray, buckets: int, arrays: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(target, kind="stable")
    found, starts = np.unique(target[order], return_index=True)
    for t, part in zip(found, np.split(order, starts[1:]), strict=True):
        yield int(t), _dump(*(a[part] for a in arrays))


def _evaluate(words: Words, buckets: int):
    """What the tokens of a bucket tell: sums by document, followers by context."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, packed = 0, []
        for batch in batches:
            for bucket, data in zip(batch["bucket"], batch["data"], strict=True):
                packed.append(data)
        if packed:
            yield evaluate(int(bucket), packed)

    def evaluate(bucket: int, packed: list[bytes]) -> pd.DataFrame:
        ws, us, ds, ids, trains, offset = [], [], [], [], [], 0
        for data in packed:
            names, counts, before, at, own, train, place = _load(data)
            ws.append(np.repeat(names.astype(np.uint64), counts.astype(np.int64)))
            us.append(before.astype(np.uint64)[at])
            ds.append(place.astype(np.int64) + offset)
            ids.append(own.astype(np.int64))
            trains.append(train)
            offset += len(own)
        w, u, d = np.concatenate(ws), np.concatenate(us), np.concatenate(ds)
        docs, where = np.unique(np.concatenate(ids), return_inverse=True)
        trained = np.concatenate(trains).astype(bool)[d]
        d = where[d]
        order = np.lexsort((u, w))
        w, u, d, trained = w[order], u[order], d[order], trained[order]
        new_word = np.concatenate(([True], w[1:] != w[:-1]))
        new_pair = new_word | np.concatenate(([True], u[1:] != u[:-1]))
        word, pair = np.cumsum(new_word) - 1, np.cumsum(new_pair) - 1
        names = w[new_word]
        c = np.bincount(word, trained).astype(np.int64)
        hot, hot_counts = words.is_hot(names)
        c = np.where(hot, hot_counts, c)
        r = np.bincount(pair, trained).astype(np.int64)
        at_pair = np.flatnonzero(new_pair)
        wide, wide_counts = words.is_hot_pair(u[at_pair], w[at_pair])
        r = np.where(wide, wide_counts, r)
        p1 = words.probability(c)

        n = len(docs)
        counted = c[word]
        add = lambda x: np.bincount(d, x, minlength=n)
        fixed = lambda x: np.rint(add(x) * -SCALE).astype(np.int64)
        base = np.log10((counted + 1) / (words.tokens + words.types + 1))
        own = np.where((w != END) & (counted > 0), -np.log10(np.maximum(counted, 1)), 0.0)
        seen = r[pair]
        own += np.where(seen == 0, np.log10(p1[word]), 0.0)
        own += np.where(seen > K, np.log10(np.maximum(seen, K + 1) - TAIL), 0.0)
        low = (seen > 0) & (seen <= K)
        hist = np.bincount(d[low] * K + seen[low] - 1, minlength=n * K)
        rows = [("doc", t, data) for t, data in _by_target(
            _spread(docs.view(np.uint64), buckets), buckets,
            [docs, np.bincount(d, minlength=n), add(counted > 0).astype(np.int64), fixed(base), fixed(own),
             *hist.reshape(n, K).T])]

        # The contexts of split pairs are added once, where all is summed up.
        real = (r > 0) & ~wide
        before, count, p = u[at_pair][real], np.minimum(r[real], K + 1), p1[word[at_pair][real]]
        ctx, at = np.unique(before, return_inverse=True)
        kinds = np.bincount(at * (K + 1) + count - 1, minlength=len(ctx) * (K + 1)).reshape(len(ctx), K + 1)
        if len(ctx):
            rows += [("ctx", t, data) for t, data in _by_target(
                _spread(ctx, buckets), buckets, [ctx, np.bincount(at, p, minlength=len(ctx)), *kinds.T])]
        fresh = seen == 0
        if fresh.any():
            hot, _ = words.is_hot(u)
            target = np.where(hot, _spread(docs[d].view(np.uint64), buckets), _spread(u, buckets))
            rows += [("new", t, data) for t, data in _by_target(target[fresh], buckets, [u[fresh], docs[d[fresh]]])]
        of = np.bincount(np.minimum(r[real], K + 2), minlength=K + 3)[1 : K + 2]
        rows = [(*row, None) for row in rows]
        rows.append(("counts", bucket, None, of.astype(np.int64)))
        hot, _ = words.is_hot(ctx)
        if hot.any():
            sums = np.column_stack((np.bincount(at, p, minlength=len(ctx)), kinds))[hot]
            rows.append(("hot", bucket, _dump(ctx[hot], *sums.T), None))
        return pd.DataFrame(rows, columns=["kind", "target", "data", "counts"])

    return run


def _lost(stars: np.ndarray) -> np.ndarray:
    """What each of the counts 1..K and more gives up."""
    return np.concatenate((np.arange(1, K + 1) - stars[1 : K + 1], [TAIL]))


def _weights(p: np.ndarray, kinds: list[np.ndarray], stars: np.ndarray) -> np.ndarray:
    """Logarithms of backoff weights of contexts: the mass left, by that of words not seen."""
    left = sum(n * x for n, x in zip(kinds, _lost(stars), strict=True))
    return np.log10(np.maximum(left, 1e-300) / np.maximum(1 - p, 1e-12))


def _add_split_pairs(words: Words, names: np.ndarray, p: np.ndarray, kinds: list[np.ndarray]) -> None:
    """Adds split pairs, which no bucket has told of, to the contexts in ``names`` (sorted)."""
    of = (words.pair_counts > 0) & np.isin(words.pair_contexts, names)
    if of.any():
        at = np.searchsorted(names, words.pair_contexts[of])
        _, counts = words.is_hot(words.pair_words[of])
        np.add.at(p, at, words.probability(counts))
        count = np.minimum(words.pair_counts[of], K + 1)
        for i, kind in enumerate(kinds):
            np.add.at(kind, at[count == i + 1], 1)


def hot_weights(words: Words, told: DataFrame, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts that are split words, and their weights; their sums are made in tasks first."""
    if not len(words.hot):
        return np.zeros(0, np.uint64), np.zeros(0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(words.hot), K + 2))
        for batch in batches:
            for data in batch["data"]:
                names, *sums = _load(data)
                np.add.at(total, np.searchsorted(words.hot, names.astype(np.uint64)), np.column_stack(sums))
        at = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame({"i": at, "sums": pd.Series(list(total[at]), dtype=object)})

    sums = told.where("kind = 'hot'").select("data").mapInPandas(run, "i int, sums array<double>")
    got = sums.select("i", F.posexplode("sums").alias("k", "x")).groupBy("i", "k").agg(F.sum("x").alias("x")).toPandas()
    total = np.zeros((K + 2, len(words.hot)))  # MAX_HOT columns at most
    total[got["k"], got["i"]] = got["x"]
    p, kinds = total[0], list(total[1:])
    _add_split_pairs(words, words.hot, p, kinds)
    return words.hot, np.where(sum(kinds) > 0, _weights(p, kinds, stars), 0.0)


def _finish(words: Words, stars: np.ndarray, hot: tuple[np.ndarray, np.ndarray]):
    """Adds the weights of contexts; yields (doc, tokens, known, base, score) in parts."""
    logs = np.log10(np.maximum(stars[1 : K + 1], 1e-300))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds: dict[str, list] = {"doc": [], "ctx": [], "new": []}
        for batch in batches:
            for kind, data in zip(batch["kind"], batch["data"], strict=True):
                kinds[kind].append(_load(data))
        join = lambda k: [np.concatenate(x) for x in zip(*kinds[k], strict=True)]
        rows = lambda docs, tokens, known, base, score: pd.DataFrame({
            "doc_id": docs, "n_tokens": tokens, "n_known": known, "base_score": base, "score": score})
        if kinds["doc"]:
            ids, tokens, known, base, own, *hist = join("doc")
            base, own = base / -SCALE, own / -SCALE
            own = own + sum(h * g for h, g in zip(hist, logs, strict=True))
            docs, at = np.unique(ids.astype(np.int64), return_inverse=True)
            sums = [np.bincount(at, x) for x in (tokens, known, base, own)]
            yield rows(docs, sums[0].astype(np.int64), sums[1].astype(np.int64), *sums[2:])
        if kinds["new"]:
            u, ids = join("new")
            u = u.astype(np.uint64)
            weight = np.zeros(len(u))
            if kinds["ctx"]:
                ctx, p, *counts = join("ctx")
                names, at = np.unique(ctx.astype(np.uint64), return_inverse=True)
                per = [np.bincount(at, n) for n in counts]
                some, found = _found(names, np.arange(len(names)), u)
                weight = np.where(some, _weights(np.bincount(at, p), per, stars)[found], 0.0)
            frequent, found = _found(*hot, u)
            weight = np.where(frequent, found, weight)
            docs, at = np.unique(ids.astype(np.int64), return_inverse=True)
            zero = np.zeros(len(docs), np.int64)
            yield rows(docs, zero, zero, zero.astype(float), np.bincount(at, weight, minlength=len(docs)))

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row.

    ``docs`` has doc_id, text and train (whether the model learns from the row).
    """
    scratch = Scratch(docs.sparkSession)
    rows = _token_rows(small_batches(docs))
    words = split_pairs(rows, word_table(rows.where("train"), scratch))
    share = docs.agg(F.sum(F.char_length("text")).alias("all"),
                     F.sum(F.when(F.col("train"), F.char_length("text"))).alias("train")).first()
    total = words.tokens * (share["all"] or 1) / (share["train"] or 1)
    buckets = max(1, math.ceil(max(total, (share["all"] or 0) / 8) / BUCKET_TOKENS))
    packed = rows.mapInPandas(_packer(words, buckets), "bucket int, data binary")
    told = scratch.table(packed.repartitionById(buckets, F.col("bucket")).mapInPandas(
        _evaluate(words, buckets), "kind string, target int, data binary, counts array<bigint>"))
    counts = np.bincount(np.minimum(words.pair_counts, K + 2), minlength=K + 3)[1 : K + 2]
    for i, n in told.where("kind = 'counts'").select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col")).collect():
        counts[i] += n  # K + 1 rows
    stars = discounted(counts)
    hot = hot_weights(words, told, stars)
    parts = told.where("kind in ('doc', 'ctx', 'new')").repartitionById(buckets, F.col("target"))
    done = parts.mapInPandas(
        _finish(words, stars, hot), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    first = math.log10(words.texts) if words.texts else 0.0
    scored = done.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    key = F.coalesce("doc_id", F.lit(_NULL_ID))
    ids = docs.groupBy(key.alias("__id")).agg(
        F.when(F.min(text) == F.max(text), F.count(F.lit(1))).otherwise(1).alias("copies"), F.count(F.lit(1)).alias("rows"))
    per = ids.join(scored.withColumnRenamed("doc_id", "__id"), "__id")
    return per.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        F.when(F.col("__id") != _NULL_ID, F.col("__id")).alias("doc_id"),
        (F.col("n_tokens") / F.col("copies")).cast("bigint").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("bigint").alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        ((F.col("score") - F.col("rows") * first) / F.col("copies")).alias("score"))
