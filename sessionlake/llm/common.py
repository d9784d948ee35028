"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of letters, digits and everything outside ASCII, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words between ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed.

    Without this a large array expression that is used inside a lambda would be
    evaluated again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII texts take the fast built-in path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column, pattern: str = WORD) -> Column:
    """Words of a text as an array; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def crc_mod(key: Column, modulus: int) -> Column:
    """crc32 of the key's text form, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder serves a local session; on a
    cluster that is an error, as executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sessionlake-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Tables that cut the lineage, as Parquet in the shared folder, until they are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = shared_path(spark, "scratch")
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{uuid.uuid4().hex}"
        with tidy_shuffles(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that no later step reads."""
        for table in tables:
            if table is not None and id(table) in self.paths:
                delete(self.spark, self.paths.pop(id(table))[1])


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of each query that ends within."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


#: Bytes of an Arrow batch of whole texts.
BATCH_BYTES = 32 << 20


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Keeps Arrow batches of whole texts small, in rows and bytes, where the session has the defaults."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{64 << 20}b":
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting; beyond the bound Spark shuffles.

    ``df`` should be cheap to count (checkpointed or narrow).
    """
    return F.broadcast(df) if df.count() <= max_rows else df
