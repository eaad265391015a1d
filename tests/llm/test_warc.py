import hashlib
from types import SimpleNamespace

import pytest

from strata.llm import warc
from strata.llm.common import scratch

SCHEMA = "page_id long, url string, html string, payload string, digest string, record_id string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/", "x" * 1500),
    (2, "http://b/", "x" * 1500),
    (3, None, "x" * 999),
    (4, "http://c/\r\nEvil: 1", "x" * 999),
    (5, "http://d/", None),
    (6, "", ""),
    (7, "http://e/", "é😀" * 70_000),
    (8, "http://f/", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40),
    (9, "http://g/", "end\r\n\r\n"),
    (10, "http://h/", "\r\n\r\nWARC/1.1\r\n"),
    (None, "http://n/", "x" * 1500),
    (11, "http://r/", "rep" * 500),
    (11, "http://r/", "rep" * 500),
    (12, "http://i/", "é😀" * 70_000),
]


def test_round_trip(spark):
    path = scratch(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS).repartition(3), path, chunk_bytes=4096)
    got = warc.read_records(spark, path).collect()
    want = []
    for i, _, html in ROWS:
        raw = (html or "").encode()
        best = max((p for p, _, h in ROWS if h == html and p is not None), default=None)
        again = len(raw) >= 1000 and i != best
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_payloads_come_back_whole_and_chunks_are_small(spark):
    path = scratch(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS), path, chunk_bytes=1000)
    rows = warc.read_chunks(spark, path, keep_bytes=True).where("record_type <> 'revisit'").collect()
    assert max(r.n_bytes for r in rows) <= 1000
    payloads = {}
    for r in sorted(rows, key=lambda r: (r.record_id, r.chunk)):
        payloads[r.record_id] = payloads.get(r.record_id, b"") + bytes(r.bytes)
    held = sorted(h or "" for i, _, h in ROWS if i not in (1, 7, None))
    assert sorted(p.decode() for p in payloads.values()) == held


@pytest.mark.parametrize("size", [1, 5, 17, 64])
def test_chunks_carry_running_digests_and_hold_no_separator(size):
    payload = b"ab" + warc.END + warc.VERSION + b"cd" + warc.END + warc.VERSION
    parts = list(warc.chunks(payload, size))
    assert b"".join(p for _, _, p, _ in parts) == payload
    at = b""
    for number, (n, last, part, digest) in enumerate(parts, 1):
        at += part
        assert n == number and len(part) <= size and digest == hashlib.sha1(at).hexdigest() and last == (at == payload)
        assert warc.END + warc.VERSION not in part


def test_damage_is_noticed():
    row = next(warc.records(type("R", (), {"page_id": 1, "url": "u", "payload": b"abc", "refers_to": float("nan"), "row_id": 0})))
    with pytest.raises(ValueError, match="cut short"):
        warc.parse_record(row[:-1])


def page(payload, refers_to=float("nan")):
    return SimpleNamespace(row_id=0, page_id=1, url="u", payload=payload, refers_to=refers_to)


def record(payload, refers_to=float("nan")):
    (only,) = warc.records(page(payload, refers_to), chunk_bytes=1 << 20)
    return only


#: Blocks that end in 0, 1 and 2 line breaks.
ENDINGS = {"revisit": record(b"", 2)} | {repr(p): record(p) for p in (b"", b"x", b"x\r\n", b"x\r\n\r\n", b"x\r\n\r", b"x\r")}


@pytest.mark.parametrize("split", [None, 65536])
def test_no_record_is_lost_at_an_edge_of_the_line_reader(spark, tmp_path, split):
    """A block's end at every offset around the edge of a 64 KB buffer, and of a split."""
    bare = len(record(b"y" * 50_000)) - 50_000
    for name, target in ENDINGS.items():
        for off in range(-24, 25):
            filler = record(b"y" * (65536 + off - len(target) - len(warc.END) - bare))
            data = filler + warc.END + target + warc.END + record(b"last") + warc.END
            assert data.index(target) + len(target) == 65536 + off
            (tmp_path / f"{list(ENDINGS).index(name)}_{off}.txt").write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        rows = warc.read_chunks(spark, str(tmp_path)).select("record_type", "n_bytes").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 3 * 49 * len(ENDINGS)
    assert sum(r.record_type == "revisit" for r in rows) == 49


def test_bytes_after_a_record_are_noticed():
    one, two = record(b"abc"), record(b"")
    for end in (b"", b"\r\n", warc.END):
        assert warc.parse_record(one + end)["bytes"] == b"abc"
    for more in (b"x", warc.END + two):
        with pytest.raises(ValueError, match="followed by"):
            warc.parse_record(one + more)


def test_payloads_that_make_a_separator_with_their_neighbours(spark):
    """A version line at a payload's start follows the line break of the headers, one at its end precedes the record's."""
    line = "WARC/1.1"
    htmls = [f"{line}\r\nabc", line, f"abc\r\n{line}", f"abc\r\n\r\n{line}", f"{line}\r\n{line}\r\n", f"abc\r\n{line}\r"]
    htmls += ["a" * i + f"\r\n\r\n{line}\r\n" * 3 for i in range(20)]
    path = scratch(spark, "warc-test")
    rows = [(i, "u", h) for i, h in enumerate(htmls)]
    warc.write_archives(pages(spark, rows), path, chunk_bytes=16)
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read_records(spark, path).collect()}
    assert got == {i: (len(h), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows}


def test_empty(spark):
    path = scratch(spark, "warc-test")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_records(spark, path).collect() == []
