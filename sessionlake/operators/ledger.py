"""The append-only ledger: dense offsets, scans, bounds, retention, dead letters."""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions.text import not_blank


def append(envelopes: DataFrame, order: list[str], after: int = 0) -> DataFrame:
    """Numbers rows densely from ``after`` + 1, in the order given, without a single-partition window.

    Rows are sorted by range; row numbers inside partitions are shifted by the
    sizes of the partitions before.  The sorted rows are kept on disk, so sizes and
    numbers come from the same partitioning.
    """
    sorted_rows = envelopes.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("__at", 33)
    sizes = sorted_rows.groupBy(part.alias("__part")).count()
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__start"))
    return (sorted_rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
            .withColumn("ledger_offset", F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1 + after)
            .drop("__at", "__part", "__start"))


def scan(ledger: DataFrame, after: int = 0, limit: int | None = None) -> DataFrame:
    rows = ledger.where(F.col("ledger_offset") > after)
    return rows if limit is None else rows.orderBy("ledger_offset").limit(limit)


def bounds(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.min("ledger_offset").alias("min_offset"), F.max("ledger_offset").alias("max_offset"))


def safe_offset(normalized: int, progress: DataFrame) -> DataFrame:
    """Smallest offset that all sinks have passed (sink_id, terminal_contiguous_offset, checkpoint)."""
    return progress.agg(F.least(F.lit(normalized).cast("bigint"), F.coalesce(
        F.min("terminal_contiguous_offset"), F.min("checkpoint"))).alias("safe_offset"))


def prune(ledger: DataFrame, safe: int) -> DataFrame:
    """Rows that stay; refuses to prune without progress."""
    if safe is None or safe <= 0:
        raise ValueError("no safe offset: sinks have made no progress")
    return ledger.where(F.col("ledger_offset") > safe)


def bind_machine(rows: DataFrame, configured: Column) -> tuple[DataFrame, DataFrame]:
    """(bound, dead letters): one given id wins, differing or missing ones are dead letters."""
    own = F.coalesce(not_blank(F.col("machine_id")), F.lit(""))
    given = F.coalesce(not_blank(configured), F.lit(""))
    bad = F.when((own == "") & (given == ""), "machine id is missing").when((own != "") & (given != "") & (own != given), "machine ids differ")
    marked = rows.withColumn("__bad", bad)
    good = marked.where("__bad is null").drop("__bad").withColumn("machine_id", F.when(own != "", own).otherwise(given))
    dead = marked.where("__bad is not null").select(
        F.lit("source_machine_id").alias("kind"), F.col("envelope_id").alias("reference"), F.col("__bad").alias("message"), F.col("raw_payload").alias("payload"))
    return good, dead
