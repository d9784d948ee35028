"""Continuous ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlake.operators import ledger, nested, normalize

ENVELOPES = ("envelope_id string, source_type string, source_instance_id string, artifact_id string, artifact_locator string, project_locator string, "
             "machine_id string, cursor_kind string, cursor_value string, observed_at timestamp, source_timestamp timestamp, raw_kind string, "
             "raw_payload string, content_hash string, hint_session string, hint_project string, confidence double, capabilities array<string>, line long")


#: Micro-batches after which the state is written whole again.
COMPACT = 64


class KeyedState:
    """The last value of each key, as Parquet of micro-batches in the order of their numbers.

    A batch writes the keys it touched; every :data:`COMPACT` batches all keys are
    written.  So a batch reads what was written since the last whole state, not the
    history, and a repeated batch replaces its own rows only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, compact: int = COMPACT):
        self.spark, self.path, self.schema, self.compact = spark, path, schema, compact

    def before(self, number: int) -> DataFrame:
        """Rows of the batches before ``number``, from the newest whole state on; several may have one key."""
        whole = number - 1 - (number - 1) % self.compact if number else 0
        rows = _stored(self.spark, self.path, f"{self.schema}, batch int")
        return rows.where((F.col("batch") >= whole) & (F.col("batch") < number))

    def write(self, number: int, touched: DataFrame, latest: Callable[[DataFrame], DataFrame]) -> None:
        """Stores ``touched``; ``latest`` picks the row of each key of rows with their ``batch``."""
        rows = touched.withColumn("batch", F.lit(number))
        if number and number % self.compact == 0:
            rows = latest(self.before(number).unionByName(rows)).withColumn("batch", F.lit(number))
        rows.drop("batch").write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:  # nothing stored yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ingest(spark: SparkSession, incoming: str, ledger_path: str, events_path: str, checkpoint: str,
           after_batch: Callable[[DataFrame], None] | None = None, nested_records: bool = False, compact: int = COMPACT) -> StreamingQuery:
    """Envelope files become ledger rows and events, micro-batch by micro-batch.

    A batch is numbered after the largest stored offset, and sequences of sessions and
    names of calls (with ``nested_records``) follow those of a keyed state, kept beside
    the checkpoint; no batch reads the history.  All is written under the batch's
    number, so a repeated batch replaces itself.
    """
    offsets = KeyedState(spark, f"{checkpoint}-state/offsets", "ledger_offset long", compact)
    sequences = KeyedState(spark, f"{checkpoint}-state/sequences", "session_key string, sequence long", compact)
    names = KeyedState(spark, f"{checkpoint}-state/names", "call_id string, name string", compact)
    newest = lambda rows: rows.groupBy("call_id").agg(F.max_by("name", "batch").alias("name"))

    def batch(rows: DataFrame, number: int) -> None:
        last = offsets.before(number).agg(F.max("ledger_offset")).first()[0] or 0
        numbered = ledger.append(rows, ["source_instance_id", "artifact_id", "line"], last)
        numbered.write.mode("overwrite").parquet(f"{ledger_path}/batch={number}")
        own = spark.read.parquet(f"{ledger_path}/batch={number}")
        classify = normalize.generic
        if nested_records:
            known = newest(names.before(number))
            classify = lambda x: nested.classify(x, known)
        events = normalize.normalize(own, classify, sequences.before(number))
        events.write.mode("overwrite").parquet(f"{events_path}/batch={number}")
        events = spark.read.parquet(f"{events_path}/batch={number}")
        highest = lambda x: x.groupBy("session_key").agg(F.max("sequence").alias("sequence"))
        sequences.write(number, highest(events), highest)
        if nested_records:
            names.write(number, nested.stored_names(own), newest)
        top = own.agg(F.coalesce(F.max("ledger_offset"), F.lit(last)).cast("bigint").alias("ledger_offset"))
        offsets.write(number, top, lambda x: x.agg(F.max("ledger_offset").alias("ledger_offset")))
        if after_batch is not None:
            after_batch(events)

    stream = spark.readStream.schema(ENVELOPES).parquet(incoming)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
