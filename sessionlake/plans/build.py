"""Building, refreshing, exporting and merging the analytics tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.operators import facts, normalize
from sessionlake.plans.presets import Tables

DATASET_VERSION = "analytics-dataset/v1"
KEYS = {"envelope_facts": "global_envelope_key", "event_facts": "global_event_key", "command_rollups": "global_command_rollup_key",
        "session_rollups": "global_session_key"}


def tables(ledger: DataFrame, ledger_instance: str = "ledger-1", classify=normalize.generic, previous: Tables | None = None,
           dedupe: bool = False) -> Tables:
    """The four tables; with ``previous`` only offsets beyond its last are processed and rollups are made anew."""
    if previous is not None:
        last = previous.event_facts.agg(F.max("ledger_offset")).first()[0] or 0
        ledger = ledger.where(F.col("ledger_offset") > last)
    events = normalize.normalize(ledger, classify, None if previous is None else previous.event_facts)
    env, evt = facts.envelope_facts(ledger, ledger_instance), facts.event_facts(events, ledger_instance)
    if dedupe:
        env, evt = facts.deduplicated(env, KEYS["envelope_facts"]), facts.deduplicated(evt, KEYS["event_facts"])
    if previous is not None:
        env, evt = previous.envelope_facts.unionByName(env), previous.event_facts.unionByName(evt)
    commands = facts.command_rollups(evt)
    return Tables(env, evt, commands, facts.session_rollups(evt, commands))


def machine_binding(ledger: DataFrame, configured: str) -> DataFrame:
    """(origin, problem) of the machine ids in a ledger against the configured one."""
    given = F.when(F.trim("machine_id") != "", F.col("machine_id"))
    out = ledger.agg(F.count(given).alias("present"), F.count_if(given.isNull()).alias("missing"), F.min(given).alias("low"), F.max(given).alias("high"))
    problem = (F.when((F.col("present") > 0) & (F.col("missing") > 0), "machine ids are present and missing")
               .when(F.col("low") != F.col("high"), "machine ids conflict")
               .when((F.col("present") > 0) & (F.col("low") != configured), "machine id changed: requires a rebuild").otherwise(""))
    return out.select("present", "missing", F.when(F.col("present") > 0, "captured").otherwise("config_backfill").alias("origin"), problem.alias("problem"))


def compatible(manifest: dict, machine: str, ledger_instance: str) -> None:
    """Whether an incremental build may go on from a manifest."""
    for key, want in (("dataset_version", DATASET_VERSION), ("derivation_version", facts.DERIVATION), ("state", "ready"),
                      ("machine_id", machine), ("ledger_instance_id", ledger_instance)):
        if manifest.get(key) != want:
            raise ValueError(f"{key} is {manifest.get(key)!r}, not {want!r}: requires a rebuild")


def export(spark: SparkSession, t: Tables, path: str, machine: str, ledger_instance: str, exported_at: str) -> dict:
    """Parquet tables ordered by key, and a manifest written last: it is the commit."""
    entries = []
    for name, key in KEYS.items():
        getattr(t, name).orderBy(key).write.mode("overwrite").parquet(f"{path}/{name}")
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/{name}")
        digests = files.select(F.sha2("content", 256).alias("d")).orderBy("d")  # one row per file
        entries.append({"name": name, "primary_key": [key], "row_count": spark.read.parquet(f"{path}/{name}").count(),
                        "sha256": [r["d"] for r in digests.collect()]})
    snapshot = spark.range(1).select(F.concat(F.lit("snapshot_"), F.substring(F.sha2(F.lit(f"{ledger_instance}|{machine}|{exported_at}"), 256), 1, 16))).first()[0]
    manifest = {"dataset_version": DATASET_VERSION, "derivation_version": facts.DERIVATION, "state": "ready", "machine_id": machine,
                "ledger_instance_id": ledger_instance, "exported_at": exported_at, "snapshot_id": snapshot, "tables": entries}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def merge(snapshots: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """One table of several snapshots (exported_at, rows): the latest row of each key."""
    out = None
    for at, rows in snapshots:
        part = rows.withColumn("__at", F.lit(at))
        out = part if out is None else out.unionByName(part)
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("__at")))
    return out.withColumn("__n", last).where("__n = 1").drop("__n", "__at")
