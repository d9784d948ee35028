"""Sinks: JSON lines, keep-latest tables, sealed objects, user-supplied delivery."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from sessionlake.operators.delivery import export_lines


def jsonl(events: DataFrame, path: str, compression: str | None = None) -> None:
    rows = export_lines(events).orderBy("ledger_offset").select("value")
    rows.write.mode("append").option("compression", compression or "none").text(path)


def stdout(events: DataFrame, rows: int = 20) -> None:
    export_lines(events).orderBy("ledger_offset").select("value").show(rows, truncate=False)


def upsert(spark: SparkSession, events: DataFrame, old: str | None, new: str) -> None:
    """Keep-latest table by event id, written as a new version beside the old one."""
    rows = events if old is None else spark.read.parquet(old).unionByName(events)
    last = F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc("ledger_offset")))
    rows.withColumn("__n", last).where("__n = 1").drop("__n").write.mode("overwrite").parquet(new)


class _ObjectWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path if "://" in path else f"file://{path}"

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.path)
        for row in rows:
            at = f"{base}/{row['object_key']}"
            own = f"{at}.{uuid.uuid4().hex}"
            store.create_dir(at.rpartition("/")[0], recursive=True)
            with store.open_output_stream(own) as out:
                out.write(row["body"])
            store.move(own, at)  # an object is there whole or not at all
        return WriterCommitMessage()


class ObjectSource(DataSource):
    """Writes rows (object_key, body) as one object each."""

    @classmethod
    def name(cls) -> str:
        return "sessionlake_objects"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ObjectWriter(self.options["path"])


def objects(sealed: DataFrame, path: str) -> None:
    """Each sealed batch as one object below ``path``, at its ``object_key``.

    Tasks write to any file system that Arrow knows; a repeated task or batch replaces
    its own objects.
    """
    sealed.sparkSession.dataSource.register(ObjectSource)
    sealed.select("object_key", F.col("payload").cast("binary").alias("body")).write.format("sessionlake_objects").mode("append").option("path", path).save()


def deliver_with(sealed: DataFrame, send: Callable[[str, str, str], tuple[str, str]]) -> DataFrame:
    """Calls ``send(sink_id, batch_id, payload)`` for each batch; returns its outcome and message."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            told = [send(*x) for x in zip(b["sink_id"], b["batch_id"], b["payload"], strict=True)]
            yield pd.DataFrame({"sink_id": b["sink_id"], "batch_id": b["batch_id"], "outcome": [t[0] for t in told], "message": [t[1] for t in told]})

    return sealed.select("sink_id", "batch_id", "payload").mapInPandas(run, "sink_id string, batch_id string, outcome string, message string")
