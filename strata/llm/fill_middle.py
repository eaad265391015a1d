"""Fill-in-the-middle rewriting of whole texts, cut at token ends found with SIMD-within-a-register arithmetic.

A text is cut into units ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``. Its UTF-8 bytes are viewed as uint64 words.
Eight bytes at a time, additions that cannot carry from byte to byte mark the spaces; a byte ends a unit if it is no space
and a space (or the end) follows, and a last byte that is a space ends one too. No character is decoded: bytes of
multi-byte characters are never spaces. ``bitwise_count`` of the marks gives the units per word; the end of unit i is found
by a search in their running sum and a select inside the one word. Code points are counted alike (bytes that continue none).

The document's id decides the form and the two cuts (``decisions``), so reruns, other partitionings and lost executors give the
same output. ``restore`` rebuilds the text from output and form.

Defined cases: NULL text is empty; an empty text, or one that holds a sentinel, stays plain. A NULL id counts as the empty
string in the hash. Rows that repeat an id get the same draws, each on its own text. A text of any length is one array of its
bytes and marks (about four times its bytes). An empty table gives an empty result. Only the id and text columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = (b"<P>", b"<S>", b"<M>")
_ONES = np.uint64(0x0101010101010101)
_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
_BLANKS = _ONES * np.uint64(0x20)
_NINE, _FOURTEEN = _ONES * np.uint64(0x80 - 9), _ONES * np.uint64(0x80 - 14)
_ONE, _SEVEN, _EIGHT, _UP = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Rates:
    """Percent of the texts that are rewritten, and percent of those in suffix-prefix-middle order."""

    seed: int = 42
    rewritten: int = 50
    suffix_first: int = 80


def decisions(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit draws: the leading digits of the SHA-256 of ``seed:id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def spaces(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte of ``words`` that is 0x20 or 0x09 to 0x0D."""
    low = words & _LOW  # sums stay below 256 in each byte, so none carries into the next
    control = (low + _NINE) & ~(low + _FOURTEEN)
    blank = ~((low ^ _BLANKS) + _LOW)
    return (control | blank) & ~words & _HIGH


def continuations(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that continues a code point (10xxxxxx)."""
    return words & ~(words << _ONE) & _HIGH


class Units:
    """The unit ends of a text's bytes, as marks in uint64 words."""

    def __init__(self, raw: bytes):
        self.size = len(raw)
        # Blanks fill the last word: a space follows the last byte, and no blank is an end.
        self.words = np.frombuffer(raw + b" " * (-len(raw) % 8), "<u8")
        blank = spaces(self.words)
        following = blank >> _EIGHT
        following[:-1] |= blank[1:] << _UP
        if len(following):
            following[-1] |= np.uint64(0x80) << _UP
        self.marks = ~blank & _HIGH & following
        if raw and raw[-1] in b" \t\n\x0b\x0c\r":
            last = self.size - 1
            self.marks[last // 8] |= np.uint64(0x80) << np.uint64(last % 8 * 8)
        self.ends = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def offset(self, units: int) -> int:
        """Bytes of the first ``units`` units: select of their last one's mark."""
        if not units:
            return 0
        at = int(np.searchsorted(self.ends, units))
        word = int(self.marks[at])
        for _ in range(units - (int(self.ends[at - 1]) if at else 0) - 1):
            word &= word - 1  # at most 7 marks stand before it in its word
        return at * 8 + (word & -word).bit_length() // 8

    def code_points(self, start: int, end: int) -> int:
        """Code points of the bytes ``start`` to ``end``, which are unit ends."""
        first, last = start // 8, -(-end // 8)
        if first >= last:
            return 0
        inside = continuations(self.words[first:last])
        inside[0] &= np.uint64((1 << 64) - (1 << start % 8 * 8))
        if end % 8:
            inside[-1] &= np.uint64((1 << end % 8 * 8) - 1)
        return end - start - int(np.bitwise_count(inside).sum(dtype=np.int64))


def rewrite(raw: bytes, doc_id: int | None, rates: Rates) -> tuple[int, str, int | None, int | None, bytes]:
    """``(units, form, prefix code points, middle code points, output)`` of one text."""
    units = Units(raw)
    n = len(units)
    one, two, rewritten, order = decisions(doc_id, rates.seed)
    if not raw or rewritten % 100 >= rates.rewritten or any(s in raw for s in _SENTINELS):
        return n, "plain", None, None, raw
    cuts = sorted((one % (n + 1), two % (n + 1)))
    a, b = (units.offset(c) for c in cuts)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if order % 100 < rates.suffix_first:
        form, out = "spm", b"".join((b"<S>", suffix, b"<P>", prefix, b"<M>", middle))
    else:
        form, out = "psm", b"".join((b"<P>", prefix, b"<S>", suffix, b"<M>", middle))
    return n, form, units.code_points(0, a), units.code_points(a, b), out


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rates: Rates = Rates()) -> DataFrame:
    """One row per input row, ``OUTPUT``; ``output`` is the rewritten text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows.append((doc_id, *rewrite(raw, doc_id, rates)))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            columns[5] = [out.decode("utf-8", "surrogatepass") if isinstance(out, bytes) else out for out in columns[5]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, OUTPUT)


def restore(output: Column, form: Column) -> Column:
    """The text before the rewriting. No part holds a sentinel, so the three found are the three written."""
    parts = F.split(output, "<[PSM]>", -1)
    part = [F.get(parts, F.lit(i)) for i in range(4)]
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u
  FROM documents),
r AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substring(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substring(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substring(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substring(h, 25, 8) AS BIGINT) AS h4
  FROM d),
f AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, u,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM r),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS s
  FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM p
"""
