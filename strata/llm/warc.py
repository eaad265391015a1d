"""WARC archives through a chunked record table.

Writing: a page's payload is streamed as rows (record, chunk number, bytes of at most ``chunk_bytes``), each
carrying the SHA-1 of the payload so far, so the last chunk has the full digest. Each chunk
becomes one WARC record: a payload of one chunk a whole record, a longer one a segmented record (the
standard's ``continuation`` records). Nothing holds a whole record, on either side.

Files are written and read by Spark's text source (any store Spark can write): the blank line that ends a
WARC record is the line separator on writing, and its last line break with the next record's version line (``MARK``)
on reading, so archives are split and read in parallel. The longer separator, with both line breaks, would not do: where a
block ends in a line break, the separator starts inside a failed match of itself, and Hadoop's line reader, which cannot go
back past an edge of its 64 KB buffer, then misses it. A chunk is cut inside any ``MARK`` that it makes with its
neighbours in the file, hence no record contains the separator; ``Content-Length`` is checked on reading (a record may
neither lack bytes nor hold more), and so is every payload digest.

Of records with equal payloads of at least ``least_bytes`` the one with the largest page id is written as
response, the others as revisit (identical-payload-digest profile, headers only).

Reading: payloads of one chunk are digested where they are read. Only the chunks of segmented records are shuffled, by
record, sorted by number, and fed one by one to an incremental SHA-1.

Defined cases: NULL html is an empty payload. NULL page ids keep their rows (never the largest). Rows that repeat a page
each get a record; those tied at the largest page id are all responses. Line breaks in a URL
are percent-encoded. An empty table gives no archive and an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import scratch, stored, table

CHUNK_BYTES = 64 * 1024
LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: Most rows and bytes that a task hands over at once.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20

VERSION = b"WARC/1.1\r\n"
BREAK, END = b"\r\n", b"\r\n\r\n"
#: What separates records on reading. No start of it lies inside a failed partial match of it.
MARK = BREAK + VERSION
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

Chunk = tuple[int, bool, bytes, str]


def chunks(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """``(number from 1, last, bytes, SHA-1 hex of the payload up to here)``; an empty payload has one chunk.

    No chunk is longer than ``chunk_bytes`` or holds the separator between two records, also not with the line breaks that
    stand before and after it in the file."""
    sha, at, number = hashlib.sha1(), 0, 1
    view = memoryview(payload)
    while True:
        end = min(at + chunk_bytes, len(payload))
        found = (BREAK + view[at:end] + BREAK).find(MARK)
        if found >= 0:
            end = at + found + 1  # after the W
        part = bytes(view[at:end])
        sha.update(part)
        yield number, end == len(payload), part, sha.hexdigest()
        if end == len(payload):
            return
        at, number = end, number + 1


def record_id(row_id: int, page_id, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id} {page_id} {url}')}>"


def _headers(*lines: tuple[str, object]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode()


def records(row, chunk_bytes: int = CHUNK_BYTES, date: str = DATE) -> Iterator[bytes]:
    """The WARC records of one page, each without the version's and the end's separators."""
    payload = row.payload
    page = None if pd.isna(row.page_id) else int(row.page_id)
    url = row.url.replace("\r", "%0D").replace("\n", "%0A") if isinstance(row.url, str) else None
    own = record_id(row.row_id, page, url or "")
    about = [("WARC-Target-URI", url), ("WARC-Date", date), ("X-Page-ID", page)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not pd.isna(row.refers_to):
        head = _headers(
            ("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(payload).hexdigest()), ("X-Refers-To-Page-ID", int(row.refers_to)),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(http)),
        )
        yield VERSION + head + b"\r\n" + http
        return
    for number, last, part, digest in chunks(payload, chunk_bytes):
        block = http + part if number == 1 else part
        segment = None if last and number == 1 else number
        head = _headers(
            ("WARC-Type", "response" if number == 1 else "continuation"),
            ("WARC-Record-ID", own if number == 1 else record_id(row.row_id, page, f"{url or ''}#{number}")),
            *about,
            ("WARC-Segment-Number", segment),
            ("WARC-Segment-Origin-ID", own if number > 1 else None),
            ("WARC-Segment-Total-Length", len(http) + len(payload) if last and segment else None),
            ("WARC-Payload-Digest", "sha1:" + digest if last else None),
            ("Content-Type", "application/http;msgtype=response" if number == 1 else None),
            ("Content-Length", len(block)),
        )
        yield VERSION + head + b"\r\n" + block


def decisions(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages that revisit another: a table of ids, no payloads."""
    ledger = stored(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"), F.sha1(F.col("payload")).alias("digest"),
            F.octet_length("payload").alias("n"),
        ).where(F.col("n") >= least_bytes),
        "warc-digests",
    )
    best = ledger.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1")
    best = stored(best.select("digest", "refers_to"), "warc-responses")  # so that AQE can split a hot digest below
    again = ledger.join(best, "digest").where("refers_to IS NOT NULL AND NOT page_id <=> refers_to")
    return stored(again.select("page_id", "digest", "refers_to").distinct(), "warc-revisits")


def write_archives(
    pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = LEAST_BYTES, date: str = DATE
) -> None:
    """Write ``(page_id, url, html)`` as WARC files under ``path``."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )
    again = decisions(rows, least_bytes).withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.sha1("payload") == F.col("_digest"))
    marked = rows.join(again, same, "left").select(
        F.monotonically_increasing_id().alias("row_id"), "page_id", "url", "payload", "refers_to"
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                for record in records(row, chunk_bytes, date):
                    out.append(record)
                    held += len(record)
                    if len(out) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield pd.DataFrame({"record": out})
                        out, held = [], 0
        if out:
            yield pd.DataFrame({"record": out})

    encoded = marked.mapInPandas(encode, "record binary")
    encoded.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode()).text(path)


CHUNK_TABLE = (
    "record_id string, page_id long, record_type string, chunk int, last boolean, total long, digest string, refers_to long, "
    "n_bytes long, bytes binary"
)


def parse_record(raw: bytes) -> dict:
    """One WARC record to a row of the chunk table; raises if it is cut short, malformed or followed by more than line breaks."""
    raw = raw.removeprefix(VERSION)
    at = raw.find(END)
    head = dict(x.split(": ", 1) for x in raw[:at].decode().split("\r\n"))
    stop = at + len(END) + int(head["Content-Length"])
    block = raw[at + len(END) : stop]
    if at < 0 or len(block) != int(head["Content-Length"]):
        raise ValueError(f"WARC record {head.get('WARC-Record-ID')} is cut short")
    if raw[stop:] not in (b"", BREAK, END):  # MARK takes one line break of END, and none at the end of a file
        raise ValueError(f"WARC record {head.get('WARC-Record-ID')} is followed by bytes of no record")
    kind, number = head["WARC-Type"], int(head.get("WARC-Segment-Number", 1))
    length = None
    if kind != "continuation":
        stop = block.index(END)
        fields = dict(x.split(": ", 1) for x in block[:stop].decode().split("\r\n")[1:])
        block, length = block[stop + len(END) :], int(fields["Content-Length"])
    digest, page, to = (head.get(k) for k in ("WARC-Payload-Digest", "X-Page-ID", "X-Refers-To-Page-ID"))
    return {
        "record_id": head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]),
        "page_id": None if page is None else int(page),
        "record_type": kind,
        "chunk": number,
        "last": digest is not None,
        "total": length,
        "digest": None if digest is None else digest.removeprefix("sha1:"),
        "refers_to": None if to is None else int(to),
        "n_bytes": len(block),
        "bytes": block,
    }


def read_chunks(spark: SparkSession, path: str, keep_bytes: bool = False) -> DataFrame:
    """The chunk table of the archives under ``path``. Payloads of one chunk are checked here and, unless
    ``keep_bytes``, go on without their bytes."""
    lines = spark.read.option("lineSep", MARK.decode()).text(path)
    columns = [c.split()[0] for c in CHUNK_TABLE.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for raw in batch["value"]:
                row = parse_record(raw)
                if row["last"] and row["chunk"] == 1 and row["record_type"] == "response":
                    if hashlib.sha1(row["bytes"]).hexdigest() != row["digest"] or row["n_bytes"] != row["total"]:
                        raise ValueError(f"WARC payload digest differs: {row['record_id']}")
                    if not keep_bytes:
                        row["bytes"] = None
                rows.append(row)
            frame = pd.DataFrame(rows, columns=columns)
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "total": "Int64"})

    return lines.select(F.col("value").cast("binary").alias("value")).mapInPandas(parse, CHUNK_TABLE)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per page, from the archives alone."""
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    parsed = stored(read_chunks(spark, path), "warc-chunks")
    alone = (F.col("chunk") == 1) & F.col("last")
    whole = parsed.where(alone).select(
        "page_id", F.col("total").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Chunks arrive by record and number; one digest is open at a time."""
        record, sha, n, want, first = None, None, 0, 0, None
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                if row.record_id != record:
                    if record is not None:
                        raise ValueError(f"WARC record {record} lacks its last segment")
                    record, sha, n, want, first = row.record_id, hashlib.sha1(), 0, 0, row
                want += 1
                if row.chunk != want:
                    raise ValueError(f"WARC record {record} lacks segment {want}")
                sha.update(row.bytes)
                n += len(row.bytes)
                if row.last:
                    if sha.hexdigest() != row.digest or n != first.total:
                        raise ValueError(f"WARC payload digest differs: {record}")
                    done.append((first.page_id, n, row.digest, "response", None))
                    record = None
            yield pd.DataFrame(done, columns=shown).astype({"page_id": "Int64", "refers_to": "Int64"})
        if record is not None:
            raise ValueError(f"WARC record {record} lacks its last segment")

    segments = parsed.where(~alone).select("record_id", "chunk", "page_id", "last", "total", "digest", "bytes")
    streamed = segments.repartition("record_id").sortWithinPartitions("record_id", "chunk").mapInPandas(
        join_up, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
    return whole.unionByName(streamed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_records(spark, path)


ORACLE = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= {LEAST_BYTES} AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST_BYTES} AND page_id <> best THEN best END AS refers_to
FROM g
"""
