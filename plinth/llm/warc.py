"""WARC archives, index first.

Writing: each task writes one archive into a shared folder, record by record (one gzip member each), and
returns an index row for every record: file, offset, length, URL, digest.  A file's name is new for every
attempt and the index holds only what finished tasks returned, so a task that is run again leaves at
worst a file that no index row names.

Reading: the wanted index rows are dealt by file and range, sorted by offset, and neighbouring records
are fetched by one read; every payload is checked against its digest.

Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is a response
and the others are revisits of it, found by digest; a payload that many pages share is answered by
broadcast.

Defined results: a null payload is empty; a null URL gives no target header and reads back as null; rows
repeated with one page_id are the same kind of record (all responses or all revisits); a null page_id is
smaller than any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.graph import HOT_SHARE, written
from plinth.llm.text import field
from plinth.session import scratch_path

LEAST_BYTES = 1000
#: Bytes of one range (and of one task's share), and the gap between records that is read over.
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the profile of a revisit of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a Spark path and the path within it."""
    path = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", path))
    return fs.FileSystem.from_uri(path)


def plan_records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is set for revisits."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.sha1(F.encode(payload, "UTF-8")).alias("digest"))
    large = rows.where(F.octet_length("payload") >= least)
    same = written(spark, large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), "payloads")
    total = same.agg(F.sum("n")).first()[0] or 0
    bar = max(1, int(total * HOT_SHARE))
    hot, cold = F.broadcast(same.where(F.col("n") > bar).drop("n")), same.where(F.col("n") <= bar).drop("n")
    out = rows.join(hot, "digest").unionByName(
        rows.join(hot, "digest", "left_anti").join(cold, "digest", "left"))
    return out.select("page_id", "url", "payload", "digest",
                      F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit has the response's header only."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _name(page_id), "WARC-Date": DATE,
            "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{b32}"}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$&'()*+,/:;=?@[]~")
    if page_id is not None:
        head["Page-Id"] = str(page_id)
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to), "Refers-To-Page-Id": str(refers_to)}
    head["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(text.encode() + block + b"\r\n\r\n") + packed.flush()


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records to archives in ``folder``; the index (written, one row per record)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        name, sink, at = "", None, 0
        try:
            for batch in batches:
                out: list[tuple] = []
                for x in zip(*(field(batch, c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    if sink is None:
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(path, recursive=True)
                        sink = store.open_output_stream(f"{path}/{name}", compression=None)
                    page_id, url, payload, digest, refers_to = x
                    member = record(page_id, url, payload.encode(), digest, refers_to)
                    sink.write(member)
                    out.append((name, at, len(member), url, digest, page_id, "response" if refers_to is None else "revisit", refers_to))
                    at += len(member)
                names = [c.split()[0] for c in INDEX.split(", ")]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names)
        finally:
            if sink is not None:
                sink.close()

    return written(records.sparkSession, records.mapInArrow(rows, INDEX), "warc-index")


def parse(member: bytes) -> dict:
    """The fields of one record; ``payload`` is None for a revisit."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(named["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda k: int(named[k]) if k in named else None
    return {"page_id": number("Page-Id"), "url": unquote(named["WARC-Target-URI"]) if "WARC-Target-URI" in named else None,
            "record_type": named["WARC-Type"], "refers_to": number("Refers-To-Page-Id"), "payload_bytes": length,
            "payload_digest": base64.b32decode(named["WARC-Payload-Digest"].split(":")[1]).hex(),
            "payload": payload if named["WARC-Type"] == "response" else None}


def ranges(rows: list[tuple[str, int, int]], most: int = RANGE_BYTES, gap: int = GAP_BYTES) -> Iterator[tuple[str, int, int, list]]:
    """(file, first byte, end, records) of sorted (file, offset, length): neighbours are read together."""
    held: list[tuple[str, int, int]] = []
    for row in rows:
        if held and (row[0] != held[-1][0] or row[1] - (held[-1][1] + held[-1][2]) > gap or row[1] + row[2] - held[0][1] > most):
            yield held[0][0], held[0][1], held[-1][1] + held[-1][2], held
            held = []
        held.append(row)
    if held:
        yield held[0][0], held[0][1], held[-1][1] + held[-1][2], held


def read_archives(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name, read from the archives and checked against their digests."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        source, opened = None, ""
        for batch in batches:
            wanted = list(zip(*(field(batch, c).to_pylist() for c in ("file", "offset", "length"))))
            for file, start, end, members in ranges(wanted):
                if file != opened:
                    source, opened = store.open_input_file(f"{path}/{file}"), file
                data = source.read_at(end - start, start)
                got = [parse(data[a - start : a - start + n]) for _, a, n in members]
                for r in got:
                    if r["payload"] is not None and (hashlib.sha1(r["payload"]).hexdigest() != r["payload_digest"] or len(r["payload"]) != r["payload_bytes"]):
                        raise ValueError(f"record of page {r['page_id']} does not match its digest")
                columns = [pa.array([r[n] for r in got], k) for n, k in zip(names, kinds)]
                if with_payload:
                    columns.append(pa.array([r["payload"] for r in got], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*names, *["payload"] * with_payload])

    dealt = (index.select("file", "offset", "length")
             .repartition(F.col("file"), F.floor(F.col("offset") / RANGE_BYTES)).sortWithinPartitions("file", "offset"))
    return dealt.mapInArrow(rows, RECORDS + ", payload binary" * with_payload)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    index = write_archives(plan_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    return read_archives(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.last IS NULL OR g.last = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""
