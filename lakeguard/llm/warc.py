"""WARC archives: writing transactions and assembling them again.

Writing: every page becomes three records, a request, a response (or a revisit
of an equal payload) and a metadata record; request and metadata name the
response's record in ``WARC-Concurrent-To``, and a revisit names the response it
repeats in ``WARC-Refers-To``.  Every record is a gzip member of its own, so one
can be read from its offset alone.  Members go through Spark's text sink into
files of at most about CHUNK_BYTES of records (one record at least), so that a
reader holds one small file at a time.  The sink ends each value with a line
separator, a zero byte; it stands for the last byte of the member's length, which
is zero below 16 MiB (a longer record is followed by an empty member).

Reading: records are cut by their Content-Length, never by searching for marks
in payloads.  Assembly joins request and metadata records to the response or
revisit they are concurrent to and emits one nested row per capture.

Defined cases: a null payload is empty; a null url leaves out the target; a
null page id leaves out the metadata field.  Of equal payloads of at least
REVISIT_BYTES bytes the one with the largest page id is the response and the
others are revisits; rows that share that largest id and payload are all
responses (their revisits then name no record), as are rows of a payload whose
ids are all null.  Of several
requests (or metadata records) concurrent to one record the one with the
smallest record id is nested and all are counted; a request or metadata record
whose capture is missing is emitted as a capture without a main record.  An
empty table gives an empty archive and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.llm.common import materialise, scratch_path, small_batches

REVISIT_BYTES = 1000
CHUNK_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
# Fixed value: the profile the WARC 1.1 standard names for revisits of equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _record(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields,
            ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block


def member(record: bytes) -> bytes:
    """The record's gzip member without its last byte, which is zero."""
    packed = gzip.compress(record, compresslevel=6, mtime=0)
    if packed[-1]:
        packed += gzip.compress(b"", mtime=0)
    return packed[:-1]


def _transaction(page_id, url, payload: bytes, digest: str, revisit: bool, named: str | None) -> list[bytes]:
    """``named``: the record id of the one response with this payload, where there are revisits of it."""
    main, request, metadata = (f"<urn:uuid:{uuid.uuid4()}>" for _ in range(3))
    if named and not revisit:
        main = named
    target = [] if url is None else [("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))]
    stamp = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [*target, ("WARC-Payload-Digest", stamp), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        refers = [("WARC-Refers-To", named)] if named else []
        answer = _record("revisit", main, [*fields, ("WARC-Profile", PROFILE), *refers], http)
    else:
        answer = _record("response", main, fields, http + payload)
    joined = [("WARC-Concurrent-To", main), *target]
    path = _CONTROL.sub("", re.sub(r"^[^/?#]*", "", (url or "").partition("://")[2])) or "/"
    asked = _record("request", request, [*joined, ("Content-Type", "application/http; msgtype=request")],
                    f"GET {path} HTTP/1.1\r\n\r\n".encode("utf-8", "replace"))
    about = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return [asked, answer, _record("metadata", metadata, [*joined, ("Content-Type", "application/warc-fields")], about)]


def _records_of(batches):
    """(chunk, record) rows; a chunk holds about CHUNK_BYTES."""
    chunk = held = 0
    for batch in batches:
        chunks, values = [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "revisit", "named")))
        for row in rows:
            for record in _transaction(*row):
                record += END
                if held and held + len(record) > CHUNK_BYTES:
                    chunk, held = chunk + 1, 0
                held += len(record)
                chunks.append(chunk)
                values.append(member(record))
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(values, pa.binary())], names=["chunk", "value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write page_id, url, html rows as WARC files under ``path``."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    # Payloads that occur more than once, written first: usually few, so the join needs no shuffle of payloads.
    # Counted per digest and id first, so that the response of a payload is known to be one row.
    per_id = hashed.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    shared = materialise(
        per_id.groupBy("digest").agg(F.sum("n").alias("rows"), F.max(F.struct("page_id", "n")).alias("top")).where("rows > 1")
        .select(F.col("digest").alias("d"), F.col("top.page_id").alias("first"),
                F.when(F.expr("top.page_id is not null and top.n = 1"), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("named")),
        "shared_payloads")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = hashed.join(shared, hashed["digest"] == shared["d"], "left").select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"), "named")
    made = rows.mapInArrow(_records_of, "chunk int, value binary")
    (made.select("chunk", F.col("value").cast("string").alias("value"))
     .write.partitionBy("chunk").option("lineSep", "\0").text(path))


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if b":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _hex(stamp: str | None) -> str | None:
    return base64.b32decode(stamp.partition(":")[2]).hex() if stamp else None


def parse(content: bytes, payloads: bool):
    """Records of one archive file, one at a time."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line)
        head = _fields(lines)
        block = stream.read(int(head["content-length"]))
        kind, body, page_id = head.get("warc-type"), None, None
        if kind == "response":
            body = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            page_id = _fields(block.split(b"\r\n")).get("page-id")
        yield {"record_type": kind, "record_id": head.get("warc-record-id"), "concurrent_to": head.get("warc-concurrent-to"),
               "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"),
               "page_id": None if page_id is None else int(page_id),
               "payload_bytes": None if body is None else len(body),
               "payload_digest": hashlib.sha1(body).hexdigest() if body is not None else _hex(head.get("warc-payload-digest")),
               **({"payload": body} if payloads else {})}


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of all archives under ``path``.

    Payload length and digest of responses are taken from the payload itself,
    those of revisits from their header (the length is not known there).
    """
    fields = {"record_type": pa.string(), "record_id": pa.string(), "concurrent_to": pa.string(), "refers_to": pa.string(),
              "target_uri": pa.string(), "date": pa.string(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
    ddl = ("record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
           "page_id long, payload_bytes long, payload_digest string")
    if payloads:
        fields["payload"], ddl = pa.binary(), ddl + ", payload binary"
    schema = pa.schema(list(fields.items()))

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parse(content.as_py(), payloads):
                    held.append(record)
                    size += (record["payload_bytes"] or 0) if payloads else 256
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(rows, ddl)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: structs ``main`` (response or revisit), ``request`` and ``metadata``, and their counts.

    Requests and metadata are reduced to one row per capture before the joins,
    so no capture with many of them gathers in a task.
    """
    extra = ["payload"] if "payload" in records.columns else []
    main = records.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct("record_type", "record_id", "refers_to", "target_uri", "date", "payload_bytes", "payload_digest", *extra).alias("main"))

    def part(kind, *columns):
        return (records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("capture_id"))
                .agg(F.min(F.struct("record_id", *columns)).alias(kind), F.count("*").alias(f"n_{kind}")))

    request, metadata = part("request", "target_uri", "date"), part("metadata", "page_id", "date")
    joined = main.join(request, "capture_id", "full_outer").join(metadata, "capture_id", "full_outer")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_request", "n_metadata")})


def captures_of(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and assemble the captures."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return assemble(materialise(read_archives(spark, path), "records"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each capture.

    A revisit takes the length and page id of the response with its digest;
    responses are reduced to one row per digest first.
    """
    flat = materialise(captures.where("main is not null").select(
        F.col("metadata.page_id").alias("page_id"), "main.payload_bytes", "main.payload_digest", "main.record_type"), "captures")
    revisits, responses = flat.where("record_type = 'revisit'"), flat.where("record_type = 'response'")
    wanted = revisits.select("payload_digest").distinct()
    targets = (responses.join(wanted, "payload_digest", "left_semi").groupBy(F.col("payload_digest").alias("d"))
               .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("b")))
    named = revisits.join(targets, F.col("payload_digest") == F.col("d"), "left").select(
        "page_id", F.col("b").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(named)
