"""A cache of the analytics tables in files, built in two phases and refreshed by what is new.

Each build writes a version beside the ones before.  Its state goes from ``building`` to
``ready``; the second is the commit.  A build that was interrupted leaves ``building``
behind, and only a rebuild goes on from there.  Fact tables grow by a part for each
version.  Rollups are made anew for sessions with new events only, all others are taken
from the version before.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.operators import facts, normalize
from sessionlake.plans import build
from sessionlake.plans.presets import Tables

FACTS, ROLLUPS = ("envelope_facts", "event_facts"), ("command_rollups", "session_rollups")


class RebuildRequired(ValueError):
    """The cache cannot be refreshed."""


def state(spark: SparkSession, path: str) -> dict | None:
    """The newest state of a cache, or none."""
    try:
        rows = spark.read.schema("value string").text(f"{path}/state/*")
        newest = rows.select(F.max(F.struct(F.get_json_object("value", "$.step").cast("bigint").alias("step"), "value")).alias("s")).first()["s"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if newest is None else json.loads(newest["value"])


def _write_state(spark: SparkSession, path: str, now: dict) -> dict:
    now = now | {"step": now.get("step", 0) + 1}
    spark.createDataFrame([(json.dumps(now),)], "value string").coalesce(1).write.text(f"{path}/state/{now['step']:012d}")
    return now


def _print(df: DataFrame) -> list:
    """(rows, fingerprint) of a table; the order of rows does not matter."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).cast("string")).first()
    return [row[0], row[1] or "0"]


def _part(spark: SparkSession, path: str, version: int, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/v{version}/{name}")


def read(spark: SparkSession, path: str, check: bool = False) -> Tables:
    """The tables of a ready cache; with ``check`` their fingerprints are compared."""
    now = state(spark, path)
    if now is None or now["state"] != "ready":
        raise RebuildRequired("the cache has no finished build")
    tables = read_version(spark, path, now)
    for name in (*FACTS, *ROLLUPS) if check else ():
        if _print(getattr(tables, name)) != now["tables"][name]:
            raise RebuildRequired(f"{name} is not what the build wrote")
    return tables


def refresh(spark: SparkSession, path: str, ledger: DataFrame, machine: str, ledger_instance: str, classify: Callable = normalize.generic,
            rebuild: bool = False) -> dict:
    """Brings the cache up to the ledger and returns its state.

    A cache of another machine, ledger or derivation, one that is still building, and one
    whose ledger holds other machine ids now, ask for a rebuild.
    """
    before = state(spark, path)
    problem = build.machine_binding(ledger, machine).first()
    if problem["problem"]:
        raise RebuildRequired(problem["problem"])
    old = None if before is None or rebuild else before
    if old is not None:
        if old["state"] != "ready":
            raise RebuildRequired("a build was interrupted: requires a rebuild")
        build.compatible(old, machine, ledger_instance)
        if old["machine_id_origin"] == "config_backfill" and problem["origin"] != "config_backfill" and old["cache_max"] is not None:
            raise RebuildRequired("the cache was filled from the configured machine id, the ledger has ids of its own: requires a rebuild")
    version = 1 + (before or {}).get("version", 0)
    base = {"dataset_version": build.DATASET_VERSION, "derivation_version": facts.DERIVATION, "machine_id": machine, "ledger_instance_id": ledger_instance,
            "machine_id_origin": problem["origin"], "version": version, "step": (before or {}).get("step", 0)}
    building = _write_state(spark, path, base | {"state": "building", "versions": (old or {}).get("versions", []), "last_clean_offset": (old or {}).get("last_clean_offset", 0)})

    new = ledger.where(F.col("ledger_offset") > building["last_clean_offset"])
    previous = None if old is None else read_version(spark, path, old)
    keys = None if previous is None else _with_sequences(previous, new)
    events = normalize.normalize(new, classify, keys)
    home = f"{path}/v{version}"
    facts.envelope_facts(new, ledger_instance).write.parquet(f"{home}/envelope_facts")
    facts.event_facts(events, ledger_instance).write.parquet(f"{home}/event_facts")
    fresh = _part(spark, path, version, "event_facts")
    touched = fresh.select("global_session_key").distinct()
    known = fresh if previous is None else previous.event_facts.join(touched, "global_session_key", "left_semi").unionByName(fresh)
    commands = facts.command_rollups(known)
    kept = lambda name: getattr(previous, name).join(touched, "global_session_key", "left_anti")
    whole = commands if previous is None else commands.unionByName(kept("command_rollups"))
    whole.write.parquet(f"{home}/command_rollups")
    sessions = facts.session_rollups(known, _part(spark, path, version, "command_rollups").join(touched, "global_session_key", "left_semi"))
    (sessions if previous is None else sessions.unionByName(kept("session_rollups"))).write.parquet(f"{home}/session_rollups")

    versions = [*building["versions"], version]
    tables = read_version(spark, path, {"versions": versions})
    covered = tables.envelope_facts.agg(F.min("ledger_offset").alias("low"), F.max("ledger_offset").alias("high")).first()
    retained = ledger.agg(F.min("ledger_offset").alias("low"), F.max("ledger_offset").alias("high")).first()
    return _write_state(spark, path, building | {
        "state": "ready", "versions": versions, "last_clean_offset": covered["high"] or 0, "cache_min": covered["low"], "cache_max": covered["high"],
        "retained_min": retained["low"], "retained_max": retained["high"], "tables": {name: _print(getattr(tables, name)) for name in (*FACTS, *ROLLUPS)}})


def read_version(spark: SparkSession, path: str, now: dict) -> Tables:
    """The tables that a ready state names."""
    return Tables(**{name: spark.read.parquet(*[f"{path}/v{v}/{name}" for v in now["versions"]]) for name in FACTS},
                  **{name: _part(spark, path, now["versions"][-1], name) for name in ROLLUPS})


def _with_sequences(previous: Tables, new: DataFrame) -> DataFrame:
    """(session_key, sequence): how far the sessions of the cache are numbered, as far as their machines and instances have new envelopes."""
    told = new.select("source_instance_id").distinct()
    return previous.event_facts.select("session_key", "sequence", "source_instance_id").join(told, "source_instance_id", "left_semi").select("session_key", "sequence")
