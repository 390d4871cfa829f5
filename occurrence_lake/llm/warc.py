"""WARC records in a content-addressed archive.

A record is exact bytes: WARC header, HTTP head, payload, two line ends.
The archive keeps them apart in two Parquet tables below the shared folder:

* ``payloads``: each distinct payload once, deflated, under its SHA-256;
* ``headers``: the exact head of every record, the digest of its payload and
  whether the record carries it.

``reconstruct`` joins them back to the original bytes and verifies SHA-256
and length of every payload; a mismatch raises.

A response stores its payload; a revisit refers to the response of the same
payload.  Of the records with equal payloads of at least ``min_bytes`` that
with the largest id is the response (rows that repeat it are responses too);
smaller payloads are all responses.

Defined results: null html is an empty payload; a null url gives no target
header; null ids come before all others; an empty table gives an empty
archive; further columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import scratch_path
from occurrence_lake.llm.common import ship

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The date of all records made from tables, which hold none.
DATE = "2000-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_head(record_id: int | None, url: str | None, sha1: str, payload_bytes: int, refers_to: int | None,
                revisit: bool) -> bytes:
    """The exact bytes of a record before its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-record:{'' if record_id is None else record_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-record:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else payload_bytes)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def parse_record(raw: bytes) -> dict:
    """Header fields (lower-case names), HTTP length and payload of a record."""
    head, _, block = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(fields["content-length"])
    if block[length:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    http, _, payload = block[:length].partition(b"\r\n\r\n")
    http_fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
    return fields | {"http": http_fields, "payload": payload}


def _ref(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:x-record:").removesuffix(">")
    return int(digits) if digits else None


def write_archive(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                  min_bytes: int = 0, level: int = 3) -> None:
    """Write one record per row to the archive at ``path``.

    Payloads are deflated before the only shuffle that moves them; equal
    ones meet in a partial aggregate first.  Which id is the response comes
    back to the heads through a join of digests alone."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                payloads = [t.encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
                     pa.array(map(sha1_base32, payloads), pa.string()), pa.array(map(len, payloads), pa.int64()),
                     pa.array([zlib.compress(p, level) for p in payloads], pa.binary())],
                    names=["id", "digest", "sha1", "payload_bytes", "deflated"])

    made = rows.select("id", "text").mapInArrow(stored, "id bigint, digest binary, sha1 string, payload_bytes bigint, deflated binary")
    (made.groupBy("digest").agg(F.max("id").alias("response_id"), F.first("sha1").alias("sha1"),
                                F.first("payload_bytes").alias("payload_bytes"), F.first("deflated").alias("deflated"))
     .write.option("compression", "none").parquet(f"{path}/payloads"))

    kept = rows.sparkSession.read.parquet(f"{path}/payloads").drop("deflated")
    joined = rows.select("id", "url", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest")).join(kept, "digest")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("response_id"))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = [record_head(*r) for r in zip(*(batch.column(n).to_pylist() for n in ("id", "url", "sha1", "payload_bytes", "response_id", "revisit")))]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("revisit"), pa.array(head, pa.binary())], names=["digest", "revisit", "head"])

    (joined.withColumn("revisit", revisit).mapInArrow(heads, "digest binary, revisit boolean, head binary")
     .write.partitionBy("revisit").parquet(f"{path}/headers"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """The exact bytes of every record (``record``), through a join of heads
    and payloads.  Revisits carry no payload and need no join."""
    heads = spark.read.schema("digest binary, head binary, revisit boolean").parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload_bytes", "deflated")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                out = []
                for digest, head, n, deflated in zip(*(c.to_pylist() for c in batch.slice(a, 256).columns)):
                    payload = b"" if deflated is None else zlib.decompress(deflated)
                    if len(payload) != n or hashlib.sha256(payload).digest() != digest:
                        raise ValueError(f"payload {digest.hex()} does not verify")
                    out.append(head + payload + b"\r\n\r\n")
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    responses = (heads.where(~F.col("revisit")).join(payloads, "digest", "left")
                 .select("digest", "head", "payload_bytes", "deflated").mapInArrow(whole, "record binary"))
    revisits = heads.where("revisit").select(F.concat("head", F.lit(b"\r\n\r\n")).alias("record"))
    return responses.unionAll(revisits)


def read_records(records: DataFrame) -> DataFrame:
    """Parse exact record bytes: ``id``, ``url``, ``record_type``,
    ``payload_bytes``, ``payload_digest``, ``refers_to``, ``payload`` (null
    for revisits).  A response whose payload differs from its digest header
    raises."""
    schema = "id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                out = []
                for raw in batch.slice(a, 256).column(0).to_pylist():
                    r = parse_record(raw)
                    kind, sha1 = r["warc-type"], r["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and sha1_base32(r["payload"]) != sha1:
                        raise ValueError(f"{r['warc-record-id']}: the payload differs from its digest")
                    out.append((_ref(r["warc-record-id"]), r.get("warc-target-uri"), kind, int(r["http"]["content-length"]), sha1,
                                _ref(r.get("warc-refers-to")), r["payload"] if kind == "response" else None))
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    return records.select("record").mapInArrow(parsed, schema)


def new_archive_path(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")


ship(__name__)
