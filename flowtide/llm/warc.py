"""WARC archives: writing page captures, reading records, and putting the records of a capture together again.

A capture is a request, a response or revisit, and a metadata record; the first and the last name the middle one in
``WARC-Concurrent-To``. The reader gives one row per record, wherever it lies; ``transactions`` joins the three kinds
through that identifier, and revisits to the response they refer to, into one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .tokenfiles import _store

#: Bytes of payload after which a task begins another archive, so that no file becomes one long task.
FILE_BYTES = 32_000_000
#: A payload of at least so many bytes that another page has too is written once, and as a revisit elsewhere.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: What a reader takes from a stream at a time.
_CHUNK = 1 << 20
RECORD = ("archive string, position bigint, warc_type string, record_id string, concurrent_to string, refers_to string, "
          "target_uri string, payload_digest string, http string, block binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digest32(hexed):
    """Base32 of a SHA-1 given in hex: five hexadecimal digits are four letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = F.sequence(F.lit(0), F.lit(7))

    def letters(g):
        value = F.conv(F.substring(hexed, g * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substring(alphabet, F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)))

    return F.array_join(F.transform(groups, letters), "")


def deduplicated(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html",
                 least_bytes=LEAST_BYTES) -> DataFrame:
    """Pages with their payload (UTF-8; missing: empty), its digest, and ``refers_to``: the page whose response holds
    the same payload, null for that page itself and for payloads under ``least_bytes``.

    Of equal payloads, the largest id is the response; a missing id is the smallest. Rows that repeat the largest id
    are all responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(url_col).cast("string"),
                        F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Digest and length only: summed before the shuffle, so a payload that a third of the pages have is one row a task.
    first = rows.groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.select("digest", "kept"), "digest", "left")
    again = (F.octet_length("payload") >= least_bytes) & F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(
        F.col("kept"))
    return joined.select("id", "url", "payload", _digest32(F.col("digest")).alias("digest"),
                         F.when(again, F.col("kept")).alias("refers_to"))


def write(captures: DataFrame, path: str) -> DataFrame:
    """Write gzipped WARC archives of ``deduplicated`` rows to the shared folder ``path``; returns the list of archives
    (name, records, bytes), those of the tasks that succeeded. Every record is a gzip member of its own. No rows give no
    archive."""
    spark = captures.sparkSession
    path = common.qualified(spark, path)

    def run(batches):
        store, folder = _store(path)
        out, name, records, held = None, "", 0, 0
        for batch in common.slices(batches, "payload"):
            for row in batch.to_pylist():
                if out is None:
                    name, records, held = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                    out.write(_packed(_record("warcinfo", _urn(name), [("WARC-Filename", name)],
                                              "application/warc-fields", b"format: WARC File Format 1.1\r\n")))
                for part in _capture(row):
                    out.write(_packed(part))
                records += 3
                held += len(row["payload"])
                if held >= FILE_BYTES:
                    out.close()
                    yield _listed(name, records, held)
                    out = None
        if out is not None:
            out.close()
            yield _listed(name, records, held)

    _store(path)[0].create_dir(_store(path)[1], recursive=True)
    common.mapped(captures, run, "archive string, records bigint, bytes bigint").write.parquet(f"{path}/archives")
    return spark.read.schema("archive string, records bigint, bytes bigint").parquet(f"{path}/archives")


def _listed(name, records, held):
    return pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, records, held)], ["archive", "records", "bytes"])


def _urn(*of) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(map(str, of)))}>"


def _capture(row):
    """The three records of a page. Records of rows that are equal in every respect have equal ids."""
    page, url, payload, sha, refers = (row[k] for k in ("id", "url", "payload", "digest", "refers_to"))
    own = _urn("response", page, url, sha)
    target = ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "about:blank")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    content, shared = "application/http;msgtype=response", ("WARC-Payload-Digest", f"sha1:{sha}")
    if refers is None:
        yield _record("response", own, [target, shared], content, head.encode() + payload)
    else:
        extra = [target, shared, ("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn("page", refers, sha))]
        yield _record("revisit", own, extra, content, head.encode())
    yield _record("request", _urn("request", own), [target, ("WARC-Concurrent-To", own)],
                  "application/http;msgtype=request", f"GET {target[1]} HTTP/1.1\r\n\r\n".encode())
    fields = f"page-id: {'' if page is None else page}\r\npage: {_urn('page', page, sha)}\r\n"
    yield _record("metadata", _urn("metadata", own), [target, ("WARC-Concurrent-To", own)], "application/warc-fields",
                  fields.encode())


def _record(kind, record_id, headers, content_type, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}",
             *(f"{k}: {v}" for k, v in headers), f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _packed(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def read(spark: SparkSession, path: str, archives: DataFrame | None = None) -> DataFrame:
    """One row per record of the listed archives: its place (file and number), the headers that join records, the HTTP
    head and what follows it (for other records, the block). An archive is a task's unit and is read as a stream."""
    path = common.qualified(spark, path)
    archives = spark.read.parquet(f"{path}/archives") if archives is None else archives

    def run(batches):
        store, folder = _store(path)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    held, rows = 0, []
                    for number, record in enumerate(_members(stream)):
                        rows.append((name, number, *parsed(record)))
                        held += len(record)
                        if held > common.BATCH_BYTES:
                            yield _rows(rows)
                            held, rows = 0, []
                    if rows:
                        yield _rows(rows)

    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return common.mapped(archives.select("archive").repartition(many, "archive"), run, RECORD)


def _rows(rows):
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _members(stream):
    """The contents of the gzip members of a stream, one after another."""
    data, member = b"", None
    parts: list[bytes] = []
    while True:
        if not data:
            data = stream.read(_CHUNK)
            if not data:
                if member is not None:
                    raise ValueError("the archive ends within a record")
                return
        member = member or zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
        if member.eof:
            yield b"".join(parts)
            member, parts = None, []


def parsed(record: bytes):
    """(type, record id, concurrent-to, refers-to, target, payload digest, HTTP head, payload or block)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {}
    for line in lines:
        key, _, value = line.partition(":")
        fields.setdefault(key.strip().lower(), value.strip())
    block = rest[:int(fields["content-length"])]
    http = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, block = block.partition(b"\r\n\r\n")
        http = http.decode("utf-8", "replace")
    sha = fields.get("warc-payload-digest")
    return (fields["warc-type"], fields["warc-record-id"], fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
            fields.get("warc-target-uri"), sha and sha.removeprefix("sha1:"), http, block)


def transactions(records: DataFrame, payload=True) -> DataFrame:
    """One row per capture: ``page_id``, ``record_id``, ``target_uri``, ``record_type``, ``payload_digest``,
    ``payload_bytes``, ``refers_to`` (a page id), and the nested ``request``, ``response`` and ``metadata``.

    The digest and length of a response are those of the bytes read; those of a revisit are what its headers state of
    the full payload. Records whose partner is missing keep nulls in its place; captures that repeat in every respect
    each give their row. With ``payload`` off the nested response has no payload, and none passes through a shuffle.
    """
    stated = F.regexp_extract("http", r"(?im)^content-length:\s*(\d+)", 1)
    is_response, is_metadata = F.col("warc_type") == "response", F.col("warc_type") == "metadata"
    # The archives are parsed once: what follows reads this table, in which only responses may carry a payload.
    records = common.staged(records.select(
        "record_id", "target_uri", "warc_type", "concurrent_to", "refers_to", "http",
        F.when(is_response, _digest32(F.sha1("block"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(is_response, F.octet_length("block")).otherwise(stated.try_cast("bigint")).cast("bigint").alias(
            "payload_bytes"),
        F.when(is_metadata, F.decode("block", "utf-8")).alias("fields"),
        *([F.when(is_response | (F.col("warc_type") == "revisit"), F.col("block")).alias("block")] if payload else [])),
        "records")
    # The few hundred bytes of request and metadata records; equal ids are equal records, so one of each is enough.
    said = records.where("concurrent_to IS NOT NULL").groupBy("concurrent_to").agg(
        F.max(F.when(F.col("warc_type") == "request", F.struct("record_id", "http"))).alias("request"),
        F.max(F.when(is_metadata, F.struct("record_id", "fields"))).alias("metadata"))
    main = records.where(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", "target_uri", F.col("warc_type").alias("record_type"), F.col("refers_to").alias("__refers"),
        "payload_digest", "payload_bytes", F.struct("http", *(["block"] if payload else [])).alias("response"))
    page = F.regexp_extract("metadata.fields", r"(?m)^page-id: (\d+|-\d+)\r", 1)
    name = F.regexp_extract("metadata.fields", r"(?m)^page: (\S+)\r", 1)
    captures = main.join(said, F.col("record_id") == F.col("concurrent_to"), "left").drop("concurrent_to").withColumns(
        {"page_id": F.when(page != "", page.cast("bigint")), "__page": name})
    # Put together once: both the rows and the names below come from it.
    captures = common.staged(captures, "captures")
    # Responses by the name that revisits give: one row each, however often it is referred to.
    named = captures.where("record_type = 'response'").groupBy("__page").agg(F.max("page_id").alias("refers_to"))
    return captures.drop("__page").join(named, F.col("__refers") == F.col("__page"), "left").select(
        "page_id", "record_id", "target_uri", "record_type", "payload_digest", "payload_bytes", "refers_to", "request",
        "response", "metadata")
