"""WARC archives: write, read back, and resolve revisits.

Records are written by Spark's text writer: a record is its header lines, an empty
line and its block, and the writer's line separator is the two line ends that close
a record, so each part file is a plain WARC 1.1 file (gzip as an option).  Archives
are read with the binary file source and cut by ``Content-Length``, so payloads may
hold anything, record marks included.  Files are bounded in bytes: records are written
by classes of size, and each class has its own number of records in a file, so a file
holds ``FILE_BYTES`` of payload at most, or one record.

Payloads are deduplicated by headers: digests that occur more than once are
reduced to their original (largest page id).  Up to ``BROADCAST_ROWS`` of these are
broadcast to the pages, so payloads are not shuffled.  Beyond that, headers alone are
joined by digest, and the few fields found there to the payloads by page.

Rules: null payload counts as empty.  Null url becomes the empty URI.  Rows that
share page id and payload are all written; among records of equal payload and id
one reads back as they were written: all responses.  Null ids are written as ''
and read back as null; they sort before all others as originals.  Other columns
are ignored, whatever their names.  An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch, shared_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Date of the records written; archives are reproducible.
DATE = "2024-01-01T00:00:00Z"
#: Payloads below this many bytes are never revisits.
MIN_BYTES = 0
#: Repeated digests up to which their originals are broadcast (about 150 bytes each).
BROADCAST_ROWS = 200_000
#: Payload bytes of an archive file, and the upper ends of the classes of record size.
FILE_BYTES = 64 << 20
CLASSES = (16 << 10, 256 << 10, 4 << 20, 1 << 40)
#: Records and bytes of payload that are handed on at once when archives are read.
READ_ROWS, READ_BYTES = 1_000, 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 bytes."""
    digest = F.sha1(payload.cast("binary"))
    letters = []
    for i in range(8):  # five hex digits make four letters
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(ALPHABET), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def _uuid(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), page_id).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def headers(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, bytes, digest) of each page."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("bytes"), base32_sha1(payload).alias("digest"))


def resolve_revisits(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Adds ``original`` (page_id, url): what a record revisits, or null.

    Headers are reduced by digest before any join; a digest that a third of the
    records share is one row by then.
    """
    repeated = (
        records.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    repeated = Scratch(records.sparkSession).table(repeated)
    same = F.col("original.page_id").eqNullSafe(F.col("page_id")) | (F.col("bytes") < min_bytes)
    if repeated.count() <= BROADCAST_ROWS:
        return records.join(F.broadcast(repeated), "digest", "left").withColumn("original", F.when(~same, F.col("original")))
    heads = records.select("page_id", "digest", "bytes").join(repeated, "digest").where(~same).select("page_id", "digest", "original").distinct()
    heads = heads.select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "original")
    return records.join(
        heads, (F.col("digest") == F.col("__digest")) & F.col("page_id").eqNullSafe(F.col("__id")), "left").drop("__id", "__digest")


def records_text(resolved: DataFrame) -> DataFrame:
    """Records as text, headers made anew; responses hold an HTTP message."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    clean = lambda url: F.regexp_replace(url, r"[\r\n]", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("original").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    target = F.coalesce(F.col("original.page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _uuid(name)),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean(F.col("url"))),
        line("X-Page-ID", name),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(_PROFILE)),
            line("WARC-Refers-To", _uuid(target)),
            line("WARC-Refers-To-Target-URI", clean(F.coalesce(F.col("original.url"), F.lit("")))),
            line("WARC-Refers-To-Date", F.lit(DATE)),
            line("X-Refers-To-Page-ID", target))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return resolved.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, compression: str = "gzip") -> None:
    """Deduplicated archives of pages in a folder, one part of it for each class of size."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    resolved = resolve_revisits(headers(pages), min_bytes)
    kind = F.lit(0)
    for top in CLASSES[:-1]:
        kind = kind + (size > top).cast("int")
    present = sorted(r[0] for r in pages.select(kind.alias("kind")).distinct().collect())  # of CLASSES
    for i in present or [0]:
        low = CLASSES[i - 1] if i else -1
        part = resolved.where((F.col("bytes") > low) & (F.col("bytes") <= CLASSES[i]))
        (records_text(part).write.option("lineSep", "\r\n\r\n").option("compression", compression)
         .option("maxRecordsPerFile", max(1, FILE_BYTES // CLASSES[i])).text(f"{path}/class-{i}"))


_READ = (
    "page_id long, url string, record_id string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)


def _record(head: bytes, block: bytes) -> tuple:
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]}")
    fields = dict(x.split(": ", 1) for x in lines)
    payload = block.split(b"\r\n\r\n", 1)[1]
    number = lambda key: int(fields[key]) if fields.get(key) else None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = number("X-Payload-Length")
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        length = len(payload)
    return (number("X-Page-ID"), fields["WARC-Target-URI"], fields["WARC-Record-ID"], kind, digest, length,
            number("X-Refers-To-Page-ID"), payload if kind == "response" else None)


def _inflated(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The bytes of a file in pieces; gzip members one after another."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(data):
                raise ValueError("an archive ends inside a gzip member")
            given = data[at : at + step]
            yield member.decompress(given)
            at += len(given) - len(member.unused_data)


def _parse(data: bytes) -> Iterator[tuple]:
    """Records of an archive; no more than one of them is held beside the file."""
    held = bytearray()
    pieces = _inflated(data)

    def fill(enough) -> bool:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    at = 0
    while True:
        if not fill(lambda: held.find(b"\r\n\r\n", at) >= 0):
            if len(held) > at:
                raise ValueError("an archive ends inside a record")
            return
        end = held.find(b"\r\n\r\n", at)
        head = bytes(held[at:end])
        size = int(next(x for x in head.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
        stop = end + 4 + size + 4
        if not fill(lambda: len(held) >= stop):
            raise ValueError("an archive ends inside a record")
        yield _record(head, bytes(held[end + 4 : stop - 4]))
        at = stop
        if at > READ_BYTES:
            del held[:at]
            at = 0


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives; payloads of responses are checked against digests."""
    names = [x.split()[0] for x in _READ.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows, size = [], 0
                for row in _parse(bytes(data)):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) >= READ_ROWS or size >= READ_BYTES:
                        yield frame(rows)
                        rows, size = [], 0
                yield frame(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInPandas(run, _READ)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write deduplicated archives of ``pages`` and read them back."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write(pages, path, min_bytes)
    return read(spark, path)
