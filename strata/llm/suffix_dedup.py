"""Repeated passages by an enhanced suffix array over content-defined anchors.

Every ``LENGTH``-byte string has one anchor: the place of the least hash among its ``GRAM``-byte substrings, leftmost if tied.
Equal strings have equal anchors, so strings can only be equal where anchors' grams are, and a corpus of
n bytes needs about 2 n / (LENGTH - GRAM + 2) suffixes instead of n.

1. Scan. Each task reads whole texts as UTF-8 in chunks of ``CHUNK`` bytes and finds the anchors, each with the run of
   strings it stands for. Strings that repeat inside the chunk are settled there (128-bit keys); only first
   ones go on, so a passage of any frequency sends about one anchor per chunk.
2. Anchors are shuffled by gram hash, sorted, and streamed; those without a partner end here.
3. The rest are joined to their texts and cut out as contexts (the bytes of their runs' strings).
4. Per gram: the suffixes from the anchors are sorted, neighbours' common prefixes computed, and the common-prefix interval
   tree read off by a stack scan. Each interval's members are sorted by what stands left of the anchor and scanned
   likewise: where left extensions differ, a left interval ends. An interval that is diverse
   on both sides is a maximal repeat within the contexts, and carries all its occurrences.
5. All but the earliest occurrence of a repeat are spans to remove; spans are merged per document.
   A gram with more than ``BLOCK`` occurrences left is scanned in blocks; then its contexts are compared across
   blocks: equal ones by one minimum per context, what is left by strings, of which only those are made
   whose bytes around the anchor occur again.

Documents equal to an earlier one are known by digest and removed whole without steps 1 to 5.

Defined cases: NULL text is empty. Order is by id, NULL ids first, then by digest where different texts share an id; rows that
repeat id and text are one document, listed each. Texts under LENGTH bytes lose nothing. Texts longer than a chunk are scanned
in overlapping segments. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import document_order, documents, filled, stored

LENGTH = 100
GRAM = 32
CHUNK = 1 << 20
BLOCK = 4096
SLICE = 1 << 14
SIDE = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240102).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: ``place`` of an anchor: position << 16 | bytes to the first string's start << 8 | strings - 1; of a local span: -1.
ANCHORS = "gram long, doc long, place long"


# -- scanning a chunk -------------------------------------------------------------------------------------------------


def _doubled(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of 2 m bytes from those of m bytes."""
    return (h[:-m] ^ h[:-m] >> np.uint64(29)) * _MIX + h[m:]


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    m = 1
    while 2 * m <= w:
        v, m = np.minimum(v[:-m], v[m:]), 2 * m
    return np.minimum(v[: len(v) - (w - m)], v[w - m :])


def _hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of GRAM bytes at every place of a chunk, and the anchor of every LENGTH bytes. Worked out
    a slice at a time, so that what lies between stays in the processor's cache."""
    n = len(raw)
    h, anchor = np.empty(n - GRAM + 1, np.uint64), np.empty(n - LENGTH + 1, np.int64)
    for at in range(0, n - LENGTH + 1, SLICE):
        end = min(at + SLICE + LENGTH - 1, n)
        part = _BYTES[raw[at:end]]
        for m in (1, 2, 4, 8, 16):
            part = _doubled(part, m)
        h[at : end - GRAM + 1] = part
        ranked = (part * _MIX) >> np.uint64(32) << np.uint64(32) | np.arange(at, at + len(part), dtype=np.uint64)
        anchor[at : end - LENGTH + 1] = _sliding_min(ranked, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)
    return h, anchor


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges lo..hi (inclusive), and the range each is from."""
    n = hi - lo + 1
    owner = np.repeat(np.arange(len(lo)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[owner], owner


def scan_chunk(segments: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``ANCHORS`` for segments ``(doc, offset, bytes)`` of at least LENGTH bytes."""
    segments.sort(key=lambda s: s[:2])
    segments = [s for i, s in enumerate(segments) if not i or segments[i - 1][:2] != s[:2]]
    docs = np.array([s[0] for s in segments], np.int64)
    sizes = np.array([len(s[2]) for s in segments])
    starts = np.cumsum(sizes) - sizes
    shift = np.array([s[1] for s in segments]) - starts  # from places in the chunk to places in the text
    h, anchor = _hashes(np.frombuffer(b"".join(s[2] for s in segments), np.uint8))
    # A run of strings goes on until the anchor changes or the segment has no further string.
    lo = np.unique(np.concatenate((starts, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)))
    owner = np.searchsorted(starts, lo, side="right") - 1
    last = (starts + sizes - LENGTH)[owner]
    hi = np.minimum(np.append(lo[1:], len(anchor)) - 1, last)
    lo, hi, owner = (x[lo <= last] for x in (lo, hi, owner))
    anchor = anchor[lo]
    gram = h[anchor].view(np.int64)

    # Strings that repeat inside the chunk.
    order = np.argsort(gram, kind="stable")
    same = gram[order][1:] == gram[order][:-1]
    again = np.zeros(len(gram), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    runs = np.flatnonzero(again)
    spans = np.empty((0, 3), np.int64)
    alive = np.ones(len(gram), bool)
    if len(runs):
        s, run = _expand(lo[runs], hi[runs])
        # The hashes of the first and of the last 64 bytes; together they cover the string.
        key_a, key_b = ((h[x] ^ h[x] >> np.uint64(29)) * _MIX + h[x + GRAM] for x in (s, s + LENGTH - 2 * GRAM))
        order = np.argsort(key_a * _MIX ^ key_b, kind="stable")  # stable: earlier strings first
        key_a, key_b = key_a[order], key_b[order]
        repeat = np.zeros(len(s), bool)
        repeat[order[1:]] = (key_a[1:] == key_a[:-1]) & (key_b[1:] == key_b[:-1])
        dup, of = s[repeat], owner[runs][run[repeat]]
        if len(dup):
            first = np.concatenate(([True], (dup[1:] != dup[:-1] + 1) | (of[1:] != of[:-1])))
            ends = dup[np.append(np.flatnonzero(first)[1:], len(dup)) - 1] + LENGTH
            of = of[first]
            spans = np.column_stack((docs[of], dup[first] + shift[of], ends + shift[of]))
            # Anchors keep the range of their strings that are first here; without any they end here.
            heads = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
            lo[runs] = np.minimum.reduceat(np.where(repeat, np.iinfo(np.int64).max, s), heads)
            hi[runs] = np.maximum.reduceat(np.where(repeat, -1, s), heads)
            alive[runs] = hi[runs] >= 0
    lo, hi, anchor, owner, gram = (x[alive] for x in (lo, hi, anchor, owner, gram))
    packed = (anchor + shift[owner]) << 16 | (anchor - lo) << 8 & 0xFFFF | hi - lo
    # A first string after the anchor cannot be: anchor - lo >= 0 for the run's strings.
    return (
        np.concatenate((gram, spans[:, 1] << 31 | spans[:, 2] - spans[:, 1])),
        np.concatenate((docs[owner], spans[:, 0])),
        np.concatenate((packed, np.full(len(spans), -1))),
    )


def anchors(df: DataFrame) -> DataFrame:
    """Anchors and local spans of ``df(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in scan_chunk(held)], ["gram", "doc", "place"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                for at in range(0, max(len(raw) - LENGTH + 1, 0), CHUNK):
                    part = raw[at : at + CHUNK + LENGTH - 1]
                    if held and size + len(part) > CHUNK:
                        yield flush()
                        held, size = [], 0
                    held.append((doc, at, part))
                    size += len(part)
        if held:
            yield flush()

    return df.select("doc", "text").mapInArrow(run, ANCHORS)


def partnered(rows: DataFrame) -> DataFrame:
    """Anchors whose gram occurs again, numbered into blocks, and all local spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram; one row and a number are carried from batch to batch."""
        last, number, pending = None, 0, None
        for batch in batches:
            gram, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            local = place == -1
            if local.any():
                yield _numbered(gram[local], doc[local], place[local], np.zeros(local.sum(), np.int64))
                gram, doc, place = gram[~local], doc[~local], place[~local]
            if pending is not None:
                gram, doc, place = (np.concatenate((p, x)) for p, x in zip(pending, (gram, doc, place), strict=True))
            if not len(gram):
                continue
            new = np.concatenate(([last is None or gram[0] != last], gram[1:] != gram[:-1]))
            heads = np.flatnonzero(new)
            index = np.arange(len(gram)) - (np.repeat(heads, np.diff(np.append(heads, len(gram)))) if new[0] else _since(heads, len(gram), number))
            follow = np.append(~new[1:], False)
            keep = (~new | follow)[:-1]
            yield _numbered(gram[:-1][keep], doc[:-1][keep], place[:-1][keep], index[:-1][keep] // BLOCK)
            # The last row waits for the next batch to show whether it has a partner.
            pending = tuple(x[-1:] for x in (gram, doc, place))
            last, number = (gram[-1], int(index[-1])) if not new[-1] else (None, 0)
        if pending is not None and last is not None:
            yield _numbered(*pending, np.array([number // BLOCK]))

    by_gram = rows.repartition("gram").sortWithinPartitions("gram")
    return by_gram.mapInArrow(run, ANCHORS + ", block long")


def _since(heads: np.ndarray, n: int, number: int) -> np.ndarray:
    """Where each row's gram began, if the first rows go on with a gram of which ``number`` rows came before."""
    heads = np.concatenate(([-number], heads))
    return np.repeat(heads, np.diff(np.concatenate(([0], heads[1:], [n]))))


def _numbered(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["gram", "doc", "place", "block"])


# -- the interval tree ------------------------------------------------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return ((x & -x).bit_length() - 1) // 8


def intervals(keys: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals of sorted ``keys``: ``(prefix length, first, last)``, length >= least.

    One scan with a stack of open intervals; an interval closes where the common prefix gets shorter."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(keys) + 1):
        now = common(keys[i - 1], keys[i]) if i < len(keys) else -1
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(right: list[bytes], left: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``length`` bytes through aligned anchors: ``(bytes left, bytes right, members)``.

    ``right[i]`` is the text from anchor i on, ``left[i]`` the text before it, reversed."""
    reach = max(map(len, left))
    by_right = sorted(range(len(right)), key=right.__getitem__)
    for ahead, i, j in intervals([right[x] for x in by_right], length - reach):
        members = sorted(by_right[i : j + 1], key=left.__getitem__)
        rank = {x: n for n, x in enumerate(by_right[i : j + 1])}
        for back, p, q in intervals([left[x] for x in members], max(length - ahead, 0)):
            group = members[p : q + 1]
            low, high = min(group, key=rank.__getitem__), max(group, key=rank.__getitem__)
            if len(group) == j - i + 1 or common(right[low], right[high]) == ahead:  # else a longer repeat has them
                yield back, ahead, group


CONTEXTS = "gram long, block long, doc long, at long, first long, bytes binary"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one gram and block at a time. Rows of one (doc, at), which a repeated document has and an anchor whose
    run goes on in the next segment of a long text, become one context."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            if held and held[-1][2:4] == row[2:4]:
                *same, first, known = held[-1]
                held[-1] = (*same, first, known + row[5][max(len(known) - (row[4] - first), 0) :])
            else:
                held.append(row)
    if held:
        yield held


def _longs(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * len(names))], names)


def repeat_groups(contexts: DataFrame) -> DataFrame:
    """Maximal repeats with all their occurrences: ``(gram, repeat, length, doc, start)``. Rows with equal
    (gram, repeat) are one group; a repeat that runs past the contexts is reported by each anchor on its way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches):
            if len(rows) > 1:
                for n, (back, ahead, group) in enumerate(_repeats(rows)):
                    out += [(rows[0][0], rows[0][1] << 32 | n, back + ahead, rows[x][2], rows[x][3] - back) for x in group]
            if len(out) > 10_000:
                yield _longs(out, names)
                out = []
        yield _longs(out, names)

    names = ["gram", "repeat", "length", "doc", "start"]
    ordered = contexts.repartition("gram", "block").sortWithinPartitions("gram", "block", "doc", "at", "first")
    return ordered.mapInArrow(run, "gram long, repeat long, length long, doc long, start long")


def _repeats(rows: list[tuple]) -> Iterator[tuple[int, int, list[int]]]:
    cut = [at - first for _, _, _, at, first, _ in rows]
    return maximal_repeats([r[5][c:] for r, c in zip(rows, cut, strict=True)], [r[5][:c][::-1] for r, c in zip(rows, cut, strict=True)])


def repeated_spans(contexts: DataFrame) -> DataFrame:
    """Spans ``(doc, start, end)`` of all but the earliest occurrence of each maximal repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches):
            if len(rows) > 1:
                heads: dict[tuple[int, bytes], tuple] = {}  # equal contexts are one leaf of the trees, held by the earliest
                for row in rows:  # in document order
                    if heads.setdefault((row[3] - row[4], row[5]), row) is not row:
                        out.append((row[2], row[4], row[4] + len(row[5])))
                rows = list(heads.values())
            if len(rows) > 1:
                found = set()
                for back, ahead, group in _repeats(rows):
                    earliest = min(group)
                    found.update((x, back, ahead) for x in group if x != earliest)
                out += [(rows[x][2], rows[x][3] - back, rows[x][3] + ahead) for x, back, ahead in found]
            if len(out) > 10_000:
                yield _longs(out, ["doc", "start", "end"])
                out = []
        yield _longs(out, ["doc", "start", "end"])

    ordered = contexts.repartition("gram", "block").sortWithinPartitions("gram", "block", "doc", "at", "first")
    return ordered.mapInArrow(run, "doc long, start long, end long")


def spans_across_blocks(contexts: DataFrame) -> DataFrame:
    """The like for the contexts of grams with several blocks, across them: every string against the earliest equal one."""
    back = F.col("at") - F.col("first")
    ours = stored(contexts.select("gram", back.alias("back"), "bytes", F.struct("doc", "at").alias("where")), "hot-contexts")
    # Equal contexts: the earliest one stands for all.
    heads = stored(ours.groupBy("gram", "back", "bytes").agg(F.min("where").alias("earliest")), "hot-heads")
    start = F.col("where.at") - F.col("back")
    again = ours.join(heads, ["gram", "back", "bytes"]).where("where <> earliest")
    again = again.select("where.doc", start.alias("start"), (start + F.octet_length("bytes")).alias("end"))
    # A string with b bytes before the anchor holds all bytes from ``side * SIDE`` before it to ``LENGTH - (side + 1) * SIDE`` after
    # it, side being b // SIDE. Only where these occur again can the string.
    least = F.col("back") - F.octet_length("bytes") + LENGTH
    sides = F.sequence(F.floor(F.greatest(least, F.lit(0)) / SIDE), F.floor(F.col("back") / SIDE))
    sided = heads.select(F.col("earliest").alias("where"), "gram", "back", "bytes", least.alias("least"), F.explode(sides).alias("side"))
    shared = F.substring(F.col("bytes"), (F.col("back") - F.col("side") * SIDE + 1).cast("int"), F.lit(LENGTH - SIDE + 1))
    sided = sided.withColumn("shared", F.xxhash64("gram", "side", shared))
    met = stored(sided.groupBy("shared").count().where("count > 1").select("shared"), "hot-shared")
    most = F.least(F.col("back"), F.col("side") * SIDE + SIDE - 1)
    strings = sided.join(met, "shared", "left_semi").select(
        "where", "back", "bytes", F.explode(F.sequence(F.greatest(F.col("least"), F.col("side") * SIDE), most)).alias("b")
    ).select(
        F.struct("where.doc", (F.col("where.at") - F.col("b")).alias("start")).alias("where"),
        F.sha2(F.substring(F.col("bytes"), (F.col("back") - F.col("b") + 1).cast("int"), F.lit(LENGTH)), 256).alias("string"),
    )
    first = strings.groupBy("string").agg(F.min("where").alias("earliest"))
    later = strings.join(first, "string").where("where <> earliest")
    return again.unionByName(later.select("where.doc", "where.start", (F.col("where.start") + LENGTH).alias("end")))


# -- the operator -----------------------------------------------------------------------------------------------------


def _numbered_documents(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(doc, text)`` and the ledger ``(doc, doc_id, n_bytes, digest)`` per row; ``doc`` orders documents and names one text."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(F.col(text_col)).alias("text"))
    ledger = stored(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest")), "texts-ledger")
    clash = ledger.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("doc_id IS NULL OR a <> b")
    if not clash.take(1):
        return rows.withColumnRenamed("doc_id", "doc"), ledger.withColumn("doc", F.col("doc_id"))
    order = document_order(ledger).withColumnRenamed("at", "doc")
    mine = F.col("doc_id").eqNullSafe(F.col("_id"))
    texts = rows.join(order, mine & (F.sha2("text", 256) == F.col("_digest"))).select("doc", "text")
    return texts, ledger.join(order, mine & (F.col("digest") == F.col("_digest"))).select("doc", "doc_id", "n_bytes", "digest")


def first_documents(ledger: DataFrame) -> DataFrame:
    """``(_digest, first)``: the earliest document of each text. Stored, so that AQE can split a hot digest in joins with it."""
    return stored(ledger.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc").alias("first")), "first-documents")


def contexts_of(texts: DataFrame, hot_only: bool = False) -> DataFrame:
    """The contexts of the texts' ``anchors``, or of those whose gram has several blocks. Texts are cut in tasks of their own: an
    expression over the exploded anchors would copy the whole text for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        cut: list[bytes] = []

        def flush() -> pa.RecordBatch:
            longs = np.concatenate(held, axis=1) if held else np.empty((5, 0), np.int64)
            return pa.RecordBatch.from_arrays([*map(pa.array, longs), pa.array(cut, pa.binary())], names)

        for batch in batches:
            for doc, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                gram, block, place, _ = (c.to_numpy(zero_copy_only=False) for c in found.values.flatten())
                raw = text.as_buffer().to_pybytes()
                at = place >> 16
                first = at - (place >> 8 & 255)
                cut += [raw[i:j] for i, j in zip(first.tolist(), (first + (place & 255) + LENGTH).tolist(), strict=True)]
                held.append(np.stack((gram, block, np.full(len(gram), doc), at, first)))
                if len(cut) > 20_000:
                    yield flush()
                    held, cut = [], []
        yield flush()

    names = ["gram", "block", "doc", "at", "first", "bytes"]
    wanted = F.filter("anchors", lambda a: a["hot"]) if hot_only else F.col("anchors")
    return texts.select("doc", "text", wanted.alias("anchors")).where("size(anchors) > 0").mapInArrow(run, CONTEXTS)


def candidate_contexts(df: DataFrame, ledger: DataFrame, first: DataFrame) -> tuple[DataFrame, bool]:
    """Steps 1 to 3 but for the cutting: the texts with anything to look at, ``(doc, text, anchors, spans)``, and whether a gram has
    several blocks. Documents equal to an earlier one are left out."""
    copies = ledger.join(first, F.col("digest") == F.col("_digest")).where("doc <> first").select("doc").distinct()
    found = stored(partnered(anchors(df.join(stored(copies, "copies"), "doc", "left_anti"))), "anchors")
    hot = stored(found.where("place >= 0 AND block > 0").select("gram").distinct(), "hot-grams")
    several = bool(hot.take(1))
    if several:
        found = found.join(hot.withColumn("hot", F.lit(True)), "gram", "left")
    anchor = F.struct("gram", "block", "place", F.coalesce("hot", F.lit(False)).alias("hot") if several else F.lit(False).alias("hot"))
    anchor = F.when(F.col("place") >= 0, anchor)
    span = F.when(
        F.col("place") < 0,
        F.struct(F.shiftright("gram", 31).alias("start"), (F.shiftright("gram", 31) + F.col("gram").bitwiseAND(2**31 - 1)).alias("end")),
    )
    touched = found.groupBy("doc").agg(F.collect_list(anchor).alias("anchors"), F.collect_list(span).alias("spans"))
    texts = df.join(touched, "doc").dropDuplicates(["doc"]).select("doc", "text", "anchors", "spans")
    return stored(texts, "touched-texts"), several


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    kept, at, removed, runs, reach = [], 0, 0, 0, -1
    for start, end in sorted(spans):
        if start > reach:
            runs += 1
            kept.append(raw[at:start])
        if end > reach:
            removed += end - max(start, reach)
            reach = at = end
    kept.append(raw[max(at, 0) :])
    return removed, runs, b"".join(kept)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``; with ``keep_text`` also the remaining bytes,
    ``kept`` (NULL: the whole text stays)."""
    rows, ledger = _numbered_documents(df, id_col, text_col)
    first = first_documents(ledger)
    texts, several = candidate_contexts(rows, ledger, first)
    spans = repeated_spans(contexts_of(texts))
    if several:
        spans = spans.unionByName(spans_across_blocks(contexts_of(texts, hot_only=True)))
    per_doc = stored(spans.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("more")), "spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, own, more in batch.itertuples(index=False, name=None):
                both = [(s["start"], s["end"]) for part in (own, more) if part is not None for s in part]
                removed, runs, kept = cut_spans(text.encode("utf-8", "surrogatepass"), both)
                out.append((doc, removed, runs, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            yield pd.DataFrame(out, columns=["doc", "n_removed", "n_spans", "sha", "kept"])

    done = texts.select("doc", "text", "spans").join(per_doc, "doc", "left").where("size(spans) > 0 OR more IS NOT NULL")
    done = done.mapInPandas(cut, "doc long, n_removed long, n_spans long, sha string, kept binary")
    whole = (F.col("doc") != F.col("first")) & (F.col("n_bytes") >= LENGTH)
    out = ledger.join(first, F.col("digest") == F.col("_digest")).join(done, "doc", "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("sha", "digest")).alias("kept_sha256"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
    return out if keep_text else out.drop("kept")


def maximal_repeat_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Steps 1 to 4 as a table: ``(gram, repeat, length, doc_id, start)``, every occurrence of every maximal repeat among the
    texts' first strings (copies of whole documents and repeats inside a chunk are settled before)."""
    rows, ledger = _numbered_documents(df, id_col, text_col)
    texts, _ = candidate_contexts(rows, ledger, first_documents(ledger))
    names = ledger.select("doc", "doc_id").distinct()
    return repeat_groups(contexts_of(texts)).join(names, "doc").select("gram", "repeat", "length", "doc_id", "start")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (
  SELECT doc_id, i, md5(substring(h, 2 * i + 1, {2 * LENGTH})) AS string
  FROM d, LATERAL (SELECT unnest(generate_series(0, n - {LENGTH})) AS i) WHERE n >= {LENGTH}),
dup AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY string ORDER BY doc_id, i) AS place FROM s) WHERE place > 1),
edge AS (
  SELECT *, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH}, -1) AS opens FROM dup),
run AS (
  SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b
  FROM (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge) GROUP BY doc_id, r),
before AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM run),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS reach,
         string_agg(substring(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS kept
  FROM before JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(reach, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
