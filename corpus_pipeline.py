"""A corpus pipeline of five stages, from documents to a mixed training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes
the result of each as Parquet and reads it again for the next.

Rules: null, empty and letterless texts go in the first stage.  Further columns
pass through all stages, whatever their names (the last adds ``domain``, ``n_tokens``
and ``copies``).  Rows without id have no near duplicates and stay if they are clean.
Repeated rows: of rows with one id, all stay or all go, but for the mixture, which
chooses each for itself.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import decontaminate, jaccard_join, langid, mixing, secrets
from sessionlake.llm.common import crc_mod, shared_dir
from sessionlake.llm.queries import PRODUCTION_WEIGHTS

#: Documents whose language is less certain than this are rejected.
MIN_LANGUAGE_SCORE = 0.4
#: Near duplicates: five-word shingles, similarity 0.8 or more.
NEAR = jaccard_join.Measure(5, 80, 100)


def _own(docs: DataFrame) -> list:
    """The columns of ``docs``, whatever their names."""
    return [F.col(f"`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    model = langid.train(docs.where(crc_mod(F.col("doc_id"), 3) != 1))
    found = langid.predict(docs, model, label="__lang", score="__sure")
    return found.where((F.col("__lang") != "und") & (F.col("__sure") >= MIN_LANGUAGE_SCORE)).select(*_own(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    groups = jaccard_join.join_components(docs, NEAR)
    # Only documents that are not the smallest of their group are looked up.
    surplus = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(surplus, "doc_id", "left_anti").select(*_own(docs))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontaminate.contamination(docs, items).where("contaminated").select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*_own(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a marker."""
    return secrets.redact(docs).select(*_own(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents chosen for the training set, with their number of passes."""
    return mixing.mix(docs, PRODUCTION_WEIGHTS)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", contamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixture),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
