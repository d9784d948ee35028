"""Session artifacts in files: discovery, JSON lines, JSON documents, envelopes."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlake.functions import ids, payload, text

_SUFFIX = r"(?i)\.(json|jsonl|ndjson)$"
_LINES, _DOCUMENTS = "*.{[jJ][sS][oO][nN][lL],[nN][dD][jJ][sS][oO][nN]}", "*.[jJ][sS][oO][nN]"
#: Lines of an artifact that share a window when session and project are carried forward.
CHUNK = 100_000


def roots(spark: SparkSession, root: str) -> list[str]:
    """``root`` and all hidden folders below it, but ``.git``; Spark's own listing leaves hidden ones out.

    Two listings for each depth; only the names of hidden entries come to the driver's Python.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out, level = [root], re.sub(r"([\\\[\]{},*?])", r"\\\1", root.rstrip("/"))
    while True:
        for status in fs.globStatus(path(level + "/{.*,_*}")) or ():
            name = status.getPath().toString()
            if status.isDirectory() and "/.git/" not in f"{name}/".partition(root.rstrip("/"))[2]:
                out.append(name)
        level += "/*"
        if not len(fs.globStatus(path(level)) or ()):
            return out


def _read(spark: SparkSession, root: str, pattern: str, kind: str, **options) -> DataFrame:
    out = None
    for path in roots(spark, root):  # hidden folders, each with what is not hidden below it
        reader = spark.read.format(kind).options(recursiveFileLookup=True, pathGlobFilter=pattern, **options)
        part = reader.load(path).select("*", "_metadata")
        out = part if out is None else out.unionByName(part)
    return out


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, r"^file:/+", "/")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(artifact_id, locator, relative, size, modified, fingerprint, project_locator), in path order."""
    files = _read(spark, root, "*", "binaryFile").select(
        F.col("path").alias("locator"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    plain = _plain(F.col("locator"))
    relative = F.substring(plain, len(root.rstrip("/")) + 2, 1 << 20)
    return (files.withColumn("relative", relative)
            .where(F.col("relative").rlike(_SUFFIX) & ~F.concat(F.lit("/"), "relative").contains("/.git/"))
            .select(ids.stable_id("art", F.col("relative")).alias("artifact_id"), plain.alias("locator"), "relative", "size",
                    "modified", ids.stable_id("fp", F.col("relative"), F.col("size"), ids.rfc3339_nano(F.col("modified"))).alias("fingerprint"),
                    F.lit(root).alias("project_locator"))
            .orderBy(F.split("relative", "/")))


def numbered(raw: DataFrame) -> DataFrame:
    """(locator, line, value): physical lines from 1 on, of rows (value, _metadata) as read; blank ones are not returned.

    Lines are numbered inside each split of a file; what the splits before hold is added.
    """
    raw = raw.select("value", F.col("_metadata.file_path").alias("locator"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("at"))
    inside = raw.withColumn("line", F.row_number().over(Window.partitionBy("locator", "split").orderBy("at")))
    earlier = Window.partitionBy("locator").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sizes = raw.groupBy("locator", "split").agg(F.count(F.lit(1)).alias("n"))  # a row for each split
    sizes = sizes.select("locator", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return inside.join(sizes, ["locator", "split"]).where(F.trim("value") != "").select(
        _plain(F.col("locator")).alias("locator"), (F.col("line") + F.col("before")).cast("bigint").alias("line"), F.trim("value").alias("value"))


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """(locator, line, value): see :func:`numbered`."""
    return numbered(_read(spark, root, _LINES, "text"))


def _documents(spark: SparkSession, root: str) -> DataFrame:
    raw = _read(spark, root, _DOCUMENTS, "text", wholetext=True)
    rows = raw.select(_plain(F.col("_metadata.file_path")).alias("locator"), F.trim("value").alias("value"))
    items = F.transform(F.from_json("value", "array<variant>"), lambda v: F.to_json(v))
    array = F.col("value").startswith("[")
    return rows.withColumns({
        "items": F.when(array, items).otherwise(F.array("value")), "broken": array & F.try_parse_json("value").isNull()})


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(locator, line, value): elements of JSON arrays, or whole documents, from 1 on.

    Arrays that are no JSON are left to :func:`broken_documents`.
    """
    rows = _documents(spark, root).where(~F.col("broken"))
    return rows.select("locator", F.posexplode("items").alias("at", "value")).select("locator", (F.col("at") + 1).cast("bigint").alias("line"), "value")


def broken_documents(spark: SparkSession, root: str) -> DataFrame:
    """Dead letters (kind, reference, message, payload) of files that start an array and are no JSON."""
    return _documents(spark, root).where("broken").select(
        F.lit("source_read").alias("kind"), F.col("locator").alias("reference"), F.lit("malformed JSON array").alias("message"), F.col("value").alias("payload"))


def artifact_lines(spark: SparkSession, root: str, checkpoints: DataFrame | None = None) -> DataFrame:
    """(artifact_id, locator, project_root, line, value, cursor_kind) of all artifacts under ``root``.

    Lines and items beyond the cursor in ``checkpoints`` (artifact_id, cursor), if given.
    """
    found = discover(spark, root).select("artifact_id", "locator", F.col("project_locator").alias("project_root"))
    rows = read_lines(spark, root).withColumn("cursor_kind", F.lit("line")).unionByName(
        read_documents(spark, root).withColumn("cursor_kind", F.lit("item")))
    rows = rows.join(found, "locator")
    return rows if checkpoints is None else after_checkpoint(rows, checkpoints)


def lenient(value: Column) -> Column:
    """Valid JSON as it is; anything else wrapped as raw text."""
    return F.when(F.try_parse_json(value).isNotNull(), value).otherwise(F.to_json(F.struct(value.alias("raw_text"))))


Resolver = Callable[[Column], dict[str, Column]]


def nested_resolver(v: Column) -> dict[str, Column]:
    """Records with ``type`` and a nested ``payload``."""
    s = lambda *p: payload.string(v, *p)
    inner = F.try_variant_get(v, "$.payload", "variant")
    keys = ("timestamp", "created_at", "time")
    return {"kind": s("type"),
            "session": text.first_given(s("session_id"), s("conversation_id"), s("payload", "id"), s("payload", "session_id"), s("payload", "conversation_id")),
            "project": text.first_given(s("project"), s("workspace"), s("repo"), s("payload", "cwd"), s("payload", "project"), s("payload", "workspace"), s("payload", "repo")),
            "time": F.coalesce(payload.time(v, *keys), payload.time(inner, *keys))}


def flat_resolver(v: Column) -> dict[str, Column]:
    """Records with ``kind``, ``conversation_id`` and ``workspace``."""
    s = lambda *p: payload.string(v, *p)
    return {"kind": s("kind"), "session": text.first_given(s("conversation_id"), s("session_id")),
            "project": text.first_given(s("workspace"), s("project")), "time": payload.time(v, "created_at", "timestamp", "time")}


def envelopes(lines: DataFrame, resolver: Resolver, source_type: str, instance: str | Column, machine: str | Column,
              capabilities: list[str], observed_at: Column, cursor_kind: str = "line") -> DataFrame:
    """Raw envelopes of (artifact_id, locator, project_root, line, value).

    Session and project are carried forward inside an artifact: the last one seen,
    before that the file's name and the root.  Chunks of a large artifact's lines are
    filled each for itself, then from the last value of the chunks before.
    """
    col = lambda x: F.lit(x) if isinstance(x, str) else x
    given = lambda c: F.when(c != "", c)

    def resolved(part: DataFrame) -> DataFrame:
        part = part.withColumn("raw_payload", lenient(F.col("value"))).withColumn("__v", F.try_parse_json("raw_payload"))
        got = resolver(F.col("__v"))
        kind = text.first_given(got["kind"], payload.string(F.col("__v"), "type"), payload.string(F.col("__v"), "kind"), F.lit("unknown"))
        return part.withColumns({"__session": given(got["session"]), "__project": given(got["project"]), "__time": got["time"], "raw_kind": kind}).drop("__v")

    both = ("__session", "__project")
    # Only the sizes of artifacts are needed to tell large ones; nothing is parsed for that.
    sized = lines.join(lines.groupBy("artifact_id").agg(F.max("line").alias("__top")), "artifact_id")
    rows = resolved(sized.where(F.col("__top") <= CHUNK))
    upto = Window.partitionBy("artifact_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"{c}_seen": F.last(c, ignorenulls=True).over(upto) for c in both})
    large = resolved(sized.where(F.col("__top") > CHUNK)).withColumn("__chunk", F.floor(F.col("line") / CHUNK))
    seen = Window.partitionBy("artifact_id", "__chunk").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("artifact_id").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line"))).alias(c)
    before = large.groupBy("artifact_id", "__chunk").agg(last("__session"), last("__project"))  # a row for each chunk
    before = before.select("artifact_id", "__chunk", *[F.last(c, ignorenulls=True).over(earlier).alias(f"{c}_before") for c in both])
    large = large.join(before, ["artifact_id", "__chunk"]).withColumns(
        {f"{c}_seen": F.coalesce(F.last(c, ignorenulls=True).over(seen), F.col(f"{c}_before")) for c in both})
    rows = rows.unionByName(large.select(*rows.columns))
    carried = lambda c, default: F.coalesce(F.col(f"{c}_seen"), default)
    name = F.substring_index("locator", "/", -1)
    rows = rows.withColumns({
        "source_type": F.lit(source_type), "source_instance_id": col(instance), "machine_id": col(machine),
        "hint_session": carried("__session", name), "hint_project": carried("__project", F.col("project_root")),
        "source_timestamp": F.col("__time"),
        "cursor_kind": F.col("cursor_kind") if "cursor_kind" in lines.columns else F.lit(cursor_kind),
        "cursor_value": F.col("line").cast("string"), "observed_at": observed_at,
        "content_hash": ids.content_hash(F.col("raw_payload")), "confidence": F.lit(0.8),
        "capabilities": F.array(*[F.lit(c) for c in capabilities]),
    })
    rows = rows.withColumn("envelope_id", ids.envelope_id(*[F.col(c) for c in (
        "source_type", "source_instance_id", "artifact_id", "cursor_kind", "cursor_value", "content_hash")]))
    return rows.select(
        "envelope_id", "source_type", "source_instance_id", "artifact_id", F.col("locator").alias("artifact_locator"),
        F.col("hint_project").alias("project_locator"), "machine_id", "cursor_kind", "cursor_value", "observed_at", "source_timestamp",
        "raw_kind", "raw_payload", "content_hash", "hint_session", "hint_project", "confidence", "capabilities", "line")


def after_checkpoint(lines: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Lines beyond the cursor stored for their artifact (artifact_id, cursor)."""
    return (lines.join(checkpoints.select("artifact_id", F.col("cursor").cast("bigint").alias("__cursor")), "artifact_id", "left")
            .where(F.col("line") > F.coalesce("__cursor", F.lit(0))).drop("__cursor"))


def next_checkpoints(lines: DataFrame) -> DataFrame:
    return lines.groupBy("artifact_id").agg(F.max("line").alias("cursor"))
