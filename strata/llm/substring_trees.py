"""Repeated word passages by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window over it also starts in a document with a smaller id.

1. Scan. One pass hashes the words of every whole text. Each window is served by one suffix: that at the least hash among its
   ``GRAM``-word grams, leftmost if tied. Equal windows are served at equal places, so a text of n words needs
   about 2 n / (WINDOW - GRAM + 2) suffixes instead of n. Texts of equal words are one class; its least document goes on.
2. Prefixes. Suffixes are counted by their first ``GRAM`` words (partial sums before the shuffle); a prefix that only one document has
   ends here. The others are cut out of their texts with the words of the windows they serve.
3. Variable length. Suffixes of a prefix with more than ``MOST`` of them are folded: of those that have the same words around them all but
   the least document's lose these words at once (a partial minimum finds it), and only that one goes on. Groups that now fit go to
   step 4; the prefixes of the others grow: a suffix that serves w window starts is split into some that serve ceil(w / SHRINK)
   neighbouring starts each, and then has ``WINDOW - w + 1`` words that all of its windows share, its new prefix. They are
   folded again, and so on. At w = 1 a prefix is one whole window, and folding ends it however hot it is.
4. Subtrees. A task takes one group after another, at most ``MOST`` suffixes, and builds its suffix tree top down (a node's edge is
   its members' common prefix; the next word names the child). At each internal node a second tree over what stands left of the
   members is built alike. A right node of r words and a left node of l words with r + l >= WINDOW are a maximal
   repeat among the group's words, with all its occurrences; those in later documents than the least are removed.
5. Spans are merged per document and cut from its words.

Words are compared as bytes in the trees (a hash only groups suffixes), and by SHA-256 where suffixes are folded.

Defined cases: NULL text has no words. Texts of fewer words than a window lose nothing. Rows that share an id, repeated or with
different texts, take nothing from each other, and a comparison with a NULL id is never true: such rows lose and take nothing.
A text of equal words to one with a smaller id goes whole. Texts of any length are scanned whole. An empty table gives an empty
result. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, filled, own_shuffle, stored

WINDOW = 50
#: Words of the shortest prefix; a power of two.
GRAM = 8
#: Suffixes in one subtree.
MOST = 16384
#: Parts into which a growing prefix splits the window starts of a suffix.
SHRINK = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = hashlib.sha256(b"").hexdigest()
#: A suffix that starts at word ``at``: ``words`` are those of the ``n`` windows it serves, from word ``first`` on, joined by blanks.
SUFFIX = "key long, doc_id long, tid long, at long, first long, n long, words binary"
_NAMES = ["key", "doc_id", "tid", "at", "first", "n", "words"]
#: Rows that a task holds before it hands them on.
BATCH = 4096


# -- the scan ---------------------------------------------------------------------------------------------------------


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, from minima of 1, 2, 4, ... neighbours."""
    reach = 1
    while 2 * reach <= w:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    return np.minimum(v[: len(v) - (w - reach)], v[w - reach :]) if w > reach else v


def sparse_suffixes(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the prefixes of the suffixes that serve the windows, and their places:
    ``at << 16 | words from the first window's start to at << 8 | windows - 1``."""
    gram = min(GRAM, 1 << window.bit_length() - 1)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    reach = 1
    while reach < gram:
        h = (h[:-reach] ^ h[:-reach] >> np.uint64(29)) * _MIX + h[reach:]
        reach *= 2
    order = (h * _MIX) >> np.uint64(32) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
    at = (_least(order, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    at, count = at[first], np.diff(np.append(first, len(at)))
    return h[at].view(np.int64), at << 16 | at - first << 8 | count - 1


LEDGER = "doc_id long, raw string, n_words long, digest string, keys array<long>, places array<long>"


def scan(df: DataFrame, window: int) -> DataFrame:
    """``LEDGER``, a row per row of ``df(doc_id, text)``: the digests of the text and of its words, and its suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = pa.list_(pa.int64())
        kinds = [pa.string(), pa.int64(), pa.string(), numbers, numbers]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_buffer().to_pybytes()
                words = raw.split()  # at ASCII spaces only
                keys, places = sparse_suffixes(words, window) if len(words) >= window and doc_id is not None else (None, None)
                rows.append((hashlib.sha256(raw).hexdigest(), len(words), hashlib.sha256(b" ".join(words)).hexdigest(), keys, places))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "raw", "n_words", "digest", "keys", "places"])

    return df.mapInArrow(run, LEDGER)


# -- suffixes and their prefixes --------------------------------------------------------------------------------------


def suffixes(texts: DataFrame, window: int) -> DataFrame:
    """``SUFFIX`` rows of ``texts(doc_id, tid, text, hits)``, ``hits`` an array of ``(key, place)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, tid, text, hits in batch.itertuples(index=False, name=None):
                words = text.encode("utf-8", "surrogatepass").split()
                for hit in hits:
                    at, n = hit["place"] >> 16, (hit["place"] & 255) + 1
                    first = at - (hit["place"] >> 8 & 255)
                    out.append((hit["key"], doc_id, tid, at, first, n, b" ".join(words[first : first + n - 1 + window])))
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=_NAMES)
                    out = []
            yield pd.DataFrame(out, columns=_NAMES)

    return texts.where(F.size("hits") > 0).select("doc_id", "tid", "text", "hits").mapInPandas(run, SUFFIX)


def grown(rows: DataFrame, width: int, narrow: int, window: int) -> DataFrame:
    """The suffixes, which serve at most ``width`` window starts each, split into some that serve at most ``narrow``, under
    longer prefixes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prefix = window - narrow + 1
        for batch in batches:
            out: list[tuple] = []
            for _, doc_id, tid, at, first, n, joined in batch.itertuples(index=False, name=None):
                words, last = joined.split(b" "), first + n - 1
                for start in range(at, at - width, -narrow):
                    low, high = max(first, start - narrow + 1), min(last, start)
                    if low <= high:
                        key = xxhash.xxh3_64_intdigest(b" ".join(words[start - first : start - first + prefix])) - (1 << 63)
                        out.append((key, doc_id, tid, start, low, high - low + 1, b" ".join(words[low - first : high - first + window])))
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=_NAMES)
                    out = []
            yield pd.DataFrame(out, columns=_NAMES)

    return rows.mapInPandas(run, SUFFIX)


# -- subtrees ---------------------------------------------------------------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    """Bytes of the common prefix of two strings of equal length."""
    if a == b:
        return len(a)
    x = int.from_bytes(a, "little") ^ int.from_bytes(b, "little")
    return ((x & -x).bit_length() - 1) // 8


def inner_nodes(strings: list[bytes], members: list[int], above: int = 0) -> Iterator[tuple[int, int, list[int]]]:
    """Internal nodes of the tree of some of the strings, top down: ``(words of the parent, words, members)``. Every word of a
    string ends in a blank. ``above`` stands for the root's missing parent."""
    stack = [(above, 0, 0, members)]
    while stack:
        above, depth, at, group = stack.pop()
        head = strings[group[0]]
        end = len(head)
        for x in group[1:]:  # the node's edge: what all members share
            other = strings[x]
            end = min(end, len(other))
            if end > at:
                end = at + _common(head[at:end], other[at:end])
        end = max(at, head.rfind(b" ", at, end) + 1)
        depth += head.count(b" ", at, end)
        yield above, depth, group
        children: dict[bytes, list[int]] = {}
        for x in group:
            word = strings[x][end : strings[x].find(b" ", end) + 1]
            if word:  # else the string ends at the node
                children.setdefault(word, []).append(x)
        stack += [(depth, depth, end, child) for child in children.values() if len(child) > 1]


def repeats(right: list[bytes], left: list[bytes], window: int) -> Iterator[tuple[int, int, list[int]]]:
    """``(a, b, members)``: the members' windows that start a to b words before their suffix are equal, and no other's are."""
    for above, words, group in inner_nodes(right, list(range(len(right)))):
        low, high = max(window - words, 0), window - above - 1  # words on the left that complete a window
        if low > high:
            continue
        for least, before, members in inner_nodes(left, group, -1):
            a, b = max(low, least + 1), min(high, before)
            if a <= b:
                yield a, b, members


def _spans(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    right, left = [], []
    for _, _, _, at, first, _, joined in rows:
        words = joined.split(b" ")
        right.append(b" ".join(words[at - first :]) + b" ")
        left.append(b"".join(w + b" " for w in reversed(words[: at - first])))
    for a, b, members in repeats(right, left, window):
        least = min(rows[m][1] for m in members)
        for m in members:
            doc_id, tid, at = rows[m][1:4]
            if doc_id > least:
                yield doc_id, tid, at - b, at - a + window


SPANS = "doc_id long, tid long, start long, end long"


def subtree_spans(rows: DataFrame, window: int) -> DataFrame:
    """The words ``start`` to ``end`` that later documents lose, from the subtrees of groups of at most ``MOST`` suffixes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "tid", "start", "end"]
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.itertuples(index=False, name=None):
                if held and held[0][0] != row[0]:
                    out += _spans(held, window) if len(held) > 1 else ()
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=names)
        if len(held) > 1:
            yield pd.DataFrame(list(_spans(held, window)), columns=names)

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, SPANS)


def _by_prefix(rows: DataFrame, most: int) -> DataFrame:
    """``(_key, small)`` of the prefixes that several documents have."""
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    return counts.where("a < b").select(own_shuffle(F.col("key")).alias("_key"), (F.col("n") <= most).alias("small"))


def _folded(rows: DataFrame) -> DataFrame:
    """The suffixes with the least document, ``least``, among those with the same words at the same places around them."""
    same = [F.col("key"), (F.col("at") - F.col("first")).alias("before"), F.sha2("words", 256).alias("same")]
    least = rows.select(*same, "doc_id").groupBy("key", "before", "same").agg(F.min("doc_id").alias("least"))
    least = stored(least.select(F.col("key").alias("_key"), F.col("before").alias("_before"), F.col("same").alias("_same"), "least"), "folds")
    named = rows.withColumns({"before": same[1], "same": same[2]})
    return named.join(least, F.expr("same = _same AND key = _key AND before = _before")).select(*_NAMES, "least")


def hot_spans(rows: DataFrame, window: int, most: int) -> list[DataFrame]:
    """Spans from the suffixes of prefixes that are too frequent for one subtree: they are folded, and the prefixes grow until they are not."""
    spans = []
    width = window - min(GRAM, 1 << window.bit_length() - 1) + 1
    while True:
        rows = stored(_folded(stored(rows, f"suffixes-{width}")), f"folded-{width}")
        spans.append(rows.where("doc_id > least").select("doc_id", "tid", F.col("first").alias("start"), (F.col("first") + F.col("n") - 1 + window).alias("end")))
        if width == 1:
            return spans
        rows = rows.where("doc_id = least").drop("least")
        known = stored(_by_prefix(rows, most), "prefix-counts")
        rows = stored(rows.join(known, F.col("key") == F.col("_key")).drop("_key"), f"grouped-{width}")
        spans.append(subtree_spans(rows.where("small").drop("small"), window))
        rows = rows.where("NOT small").drop("small")
        if not rows.take(1):
            return spans
        narrow = -(-width // SHRINK)
        rows, width = grown(rows, width, narrow, window), narrow


# -- the operator -----------------------------------------------------------------------------------------------------


def cut_words(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, bytes]:
    """Words removed, and the others joined by one blank."""
    kept, reach = [], 0
    for start, end in sorted(spans):
        kept += words[reach:start] if start > reach else ()
        reach = max(reach, end)
    kept += words[reach:]
    return len(words) - len(kept), b" ".join(kept)


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, most: int = MOST, keep_text: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``; with ``keep_text`` also ``kept``, the words that stay
    (NULL: all of them)."""
    if not 2 <= window <= 255:
        raise ValueError("a window has 2 to 255 words")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(F.col(text_col)).alias("text"))
    ledger = stored(scan(rows, window), "words-ledger")
    # The least document of each class of equal words; copies of a hot class are folded before the shuffle.
    first = ledger.where("keys IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "raw", "keys", "places")).alias("x"))
    first = stored(first.select("digest", F.xxhash64("digest").alias("tid"), "x.*"), "word-classes")

    every = first.select("doc_id", "tid", F.explode(F.arrays_zip("keys", "places")).alias("x")).select("doc_id", "tid", "x.keys", "x.places")
    every = every.withColumnsRenamed({"keys": "key", "places": "place"})
    known = stored(_by_prefix(every, most), "shared-prefixes")
    hits = every.join(known, F.col("key") == F.col("_key"))
    hit = F.struct("key", "place")
    hits = hits.groupBy("doc_id", "tid").agg(
        F.collect_list(F.when(F.col("small"), hit)).alias("cool"), F.collect_list(F.when(~F.col("small"), hit)).alias("hot")
    )
    classes = first.select("digest", F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), F.col("raw").alias("_raw"))
    wanted = hits.join(classes, F.expr("doc_id = _id AND tid = _tid")).select("digest", "_id", "_tid", "_raw", "cool", "hot")
    # Rows that repeat id and text are folded before the shuffle.
    texts = rows.where("doc_id IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("raw"), "text")
    texts = texts.groupBy("doc_id", "raw").agg(F.min("text").alias("text"))
    touched = texts.join(wanted, F.expr("doc_id = _id AND raw = _raw")).select("digest", "doc_id", F.col("_tid").alias("tid"), "text", "cool", "hot")
    touched = stored(touched, "touched-words")

    parts = [subtree_spans(suffixes(touched.withColumnRenamed("cool", "hits"), window), window)]
    hot = touched.where("size(hot) > 0")
    if hot.take(1):
        parts += hot_spans(suffixes(hot.withColumnRenamed("hot", "hits"), window), window, most)
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    spans = stored(spans.groupBy("doc_id", "tid").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "word-spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for digest, text, found in batch.itertuples(index=False, name=None):
                removed, kept = cut_words(text.encode("utf-8", "surrogatepass").split(), [(s["start"], s["end"]) for s in found])
                out.append((digest, removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if keep_text else None))
            yield pd.DataFrame(out, columns=["digest", "removed", "sha", "text"])

    done = touched.select("digest", "doc_id", "tid", "text").join(spans, ["doc_id", "tid"]).select("digest", "text", "spans")
    done = done.mapInPandas(cut, "digest string, removed long, sha string, text string")
    classes = first.select(F.col("digest").alias("_digest"), F.col("doc_id").alias("first"))
    named = stored(classes.join(done, F.col("_digest") == F.col("digest"), "left").drop("digest"), "word-verdicts")
    whole = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    mine = F.coalesce(F.col("doc_id") == F.col("first"), F.lit(False))
    out = ledger.join(named, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).when(mine, F.coalesce("removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY)).when(mine, F.coalesce("sha", "digest")).otherwise(F.col("digest")).alias("kept_sha256"),
        F.when(whole, F.lit("")).when(mine, F.col("text")).alias("kept"),
    )
    return out if keep_text else out.drop("kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


ORACLE = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + {WINDOW - 1}], ' ')) AS x
  FROM w, LATERAL (SELECT unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i) WHERE len(ws) >= {WINDOW}),
f AS (SELECT x, min(doc_id) AS least FROM s GROUP BY x),
gone AS (SELECT DISTINCT doc_id, i + j AS place FROM s JOIN f USING (x), range({WINDOW}) AS t(j) WHERE doc_id > least),
every AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM every ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
