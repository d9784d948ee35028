"""Tables in the folder that all executors share: results that several later steps read, made once."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local session; on a cluster that is
    an error, as executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sessionlake-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again; lost executors cost nothing of it.

    The table is deleted when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
