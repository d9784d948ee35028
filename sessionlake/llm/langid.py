"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts are made in tasks (a dense array per task), summed by Spark, and
turned into a log-probability matrix that is broadcast.  It has at most ``MAX_CELLS``
cells: with more labels than fit, buckets are halved until it does.  Scoring works on
batches: texts are laid end to end as code points, n-grams are hashed with numpy, and
the rows of the matrix are summed per text.

Rules: null texts and texts without a letter get ``und`` and score 0.  Other texts
get the label of the highest posterior, ties to the smaller label.  The score is
the posterior after tempering: a text counts as at most ``EVIDENCE`` characters, so
mixed texts stay below 1.  Without training rows every text is ``und``.  Very long
texts are scored piecewise.  Repeated rows each get their row.  Further columns pass
through unchanged, but those that have the names of the two results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import small_batches

BUCKETS = 1 << 15
#: Most cells (labels x buckets) of the broadcast matrix: 64 MB.
MAX_CELLS = 1 << 24
MIN_BUCKETS = 1 << 8
EVIDENCE = 16
SEGMENT = 1 << 18
_TABLE_SIZE = 0x20000
_table: np.ndarray | None = None


def _codes() -> np.ndarray:
    """Lower case of letters, a space for anything else, below ``_TABLE_SIZE``."""
    global _table
    if _table is None:
        low = [c.lower() if (c := chr(i)).isalpha() else " " for i in range(_TABLE_SIZE)]
        _table = np.array([ord(c[0]) for c in low], np.uint32)
    return _table


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], str, list[int]]]:
    """Chunks of pieces: owners, text laid end to end, lengths (2 context chars each)."""
    owners, parts, sizes, total = [], [], [], 0
    for d, text in enumerate(texts):
        padded = f" {text}  "
        for i in range(0, len(padded) - 2, SEGMENT):
            part = padded[i : i + SEGMENT + 2]
            owners.append(d)
            parts.append(part)
            sizes.append(len(part))
            total += len(part)
            if total >= SEGMENT:
                yield owners, "".join(parts), sizes
                owners, parts, sizes, total = [], [], [], 0
    if owners:
        yield owners, "".join(parts), sizes


def _hashed(text: str, sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams at each start, with starts and counts by piece."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(raw < _TABLE_SIZE, _codes()[np.minimum(raw, _TABLE_SIZE - 1)], raw)
    a, b, d = c[:-2], c[1:-1], c[2:]
    ends = np.cumsum(sizes)
    keep = np.ones(len(c), bool)
    keep[ends - 1] = keep[ends - 2] = False
    keep = np.flatnonzero(keep)
    one = a * np.uint32(0x9E3779B1)
    two = (one ^ (one >> np.uint32(13))) * np.uint32(0x85EBCA6B) + b * np.uint32(0xC2B2AE35)
    three = (two ^ (two >> np.uint32(15))) * np.uint32(0x27D4EB2F) + d * np.uint32(0x165667B1)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    mixed = [((g ^ (g >> np.uint32(16))) * np.uint32(0x7FEB352D)) >> shift for g in (one, two, three)]
    counts = np.asarray(sizes) - 2
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return [m[keep] for m in mixed], starts, counts


@dataclass
class Model:
    labels: list[str]
    matrix: np.ndarray  # buckets x labels, log-probabilities
    prior: np.ndarray

    @property
    def shift(self) -> int:
        """By how many bits the buckets of n-grams are folded."""
        return BUCKETS.bit_length() - len(self.matrix).bit_length()

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best label and its tempered posterior for each text."""
        total = np.zeros((len(texts), len(self.labels)))
        chars = np.zeros(len(texts))
        for owners, text, sizes in _pieces(texts):
            grams, starts, counts = _hashed(text, sizes)
            grams = [g >> np.uint32(self.shift) for g in grams]
            rows = self.matrix[grams[0]] + self.matrix[grams[1]] + self.matrix[grams[2]]
            np.add.at(total, owners, np.add.reduceat(rows, starts, axis=0, dtype=np.float64))
            np.add.at(chars, owners, counts)
        logits = total + self.prior
        best = logits.argmax(axis=1)
        logits *= np.minimum(1.0, EVIDENCE / np.maximum(chars, 1))[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        return best, 1.0 / np.exp(logits).sum(axis=1)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: bucket counts by label; bucket -1 counts texts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for label, part in batch.groupby("lang"):
            own = sums.setdefault(label, np.zeros(BUCKETS + 1, np.int64))
            own[BUCKETS] += len(part)
            for _, text, sizes in _pieces(part["text"].tolist()):
                for grams in _hashed(text, sizes)[0]:
                    own[:BUCKETS] += np.bincount(grams, minlength=BUCKETS)
    for label, own in sums.items():
        at = np.flatnonzero(own)
        yield pd.DataFrame({"lang": label, "bucket": np.where(at == BUCKETS, -1, at), "n": own[at]})


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Fit on all rows whose text and label are given."""
    used = small_batches(rows).select(F.col(text).alias("text"), F.col(label).alias("lang")).dropna()
    counts = (
        used.mapInPandas(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    labels = sorted(r["lang"] for r in used.select("lang").distinct().limit(MAX_CELLS // MIN_BUCKETS + 1).collect())
    if len(labels) * MIN_BUCKETS > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS // MIN_BUCKETS} labels: the matrix would not fit its bound")
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    shift = 0
    while (BUCKETS >> shift) * len(labels) > MAX_CELLS:
        shift += 1
    buckets = BUCKETS >> shift
    folded = F.when(F.col("bucket") >= 0, F.shiftright("bucket", shift)).otherwise(F.col("bucket"))
    got = counts.groupBy("lang", folded.alias("bucket")).agg(F.sum("n").alias("n")).toPandas()  # labels x (buckets + 1) rows at most
    dense = np.zeros((buckets + 1, len(labels)))
    at = {x: i for i, x in enumerate(labels)}
    dense[np.where(got["bucket"] < 0, buckets, got["bucket"]), got["lang"].map(at)] = got["n"]
    grams = dense[:buckets] + 0.5
    logp = np.log(grams) - np.log(grams.sum(axis=0))
    return Model(labels, logp.astype(np.float32), np.log(dense[buckets] / dense[buckets].sum()))


def predict(docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the columns ``label`` and ``score``."""
    if not model.labels:
        return docs.withColumns({label: F.lit("und"), score: F.lit(0.0)})
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("label string, score double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        names = np.array(own.labels, object)
        for batch in batches:
            at, share = own.score(batch.tolist())
            yield pd.DataFrame({"label": names[at], "score": share})

    column: Column = F.coalesce(F.col(text), F.lit(""))
    known = column.rlike(r"\p{L}")
    return (
        docs.withColumn("__best", best(column))
        .withColumns({
            label: F.when(known, F.col("__best.label")).otherwise("und"),
            score: F.when(known, F.col("__best.score")).otherwise(0.0),
        })
        .drop("__best")
    )
