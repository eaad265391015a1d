"""Quality rules as a bitmask ledger.

Each document is measured once. Every rule is a comparison of measurements, evaluated once and stored as one failure bit
beside the measurements. A policy is a versioned set of rules: applying one, or any number, to the ledger is a
bitwise AND, with no second look at the texts. Ablations (what each rule rejects, alone and only it) come from
counts per distinct mask, at most 2 ** rules groups however large the corpus.

Measurements (words are runs of ``[^\\x20\\x09-\\x0D]``): see ``MEASURES``. Repeated words are words inside an 8-word
window that occurs twice or more in the document; windows are compared by a 64-bit hash of
their words' 64-bit hashes.

Defined cases: NULL text has no words and fails ``few_words``. Empty tables give empty ledgers. Repeated rows are
measured each. Texts of any length are measured whole, one at a time. Only the id and text columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = {
    "n_words": "words",
    "word_chars": "code points in words",
    "n_symbols": f"characters of {SYMBOLS}",
    "n_lines": "lines with a word",
    "n_dup_lines": "lines with a word that equal an earlier line",
    "n_repeat_words": "words in 8-word windows found twice or more",
    "n_letters": "letters in words",
}
SPACES = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Rule:
    """Bit ``bit`` is set where ``fails``, a SQL condition on the measurements, holds."""

    name: str
    bit: int
    fails: str


#: Bits are for ever: a changed rule gets a new name and bit. All comparisons are in integers.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    # A line repeated once or twice, such as a heading at both ends of a short text, is no fault.
    Rule("duplicate_lines", 3, "n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("long_words", 4, "word_chars > 20 * n_words"),
    Rule("short_words", 5, "word_chars < 2 * n_words"),
    Rule("few_letters", 6, "100 * n_letters < 60 * word_chars"),
)
#: Versioned policies: the rules that reject.
POLICIES = {
    "base@1": ("few_words", "repeated_windows"),
    "full@1": tuple(r.name for r in RULES),
}
POLICY = "full@1"


def policy_mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[n] for n in names)


def repeated(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for i in range(window):  # overflow wraps, as it should
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        mixed ^= mixed >> np.uint64(29)
    _, back, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(counts[back] > 1)
    edges[starts] += 1  # starts are distinct
    edges[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # splits at just the six ASCII spaces
    seen: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if line and not SPACES.fullmatch(line):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    n_spaces = sum(text.count(c) for c in " \t\n\v\f\r")
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    if text.isascii():
        n_letters = sum(map(text.count, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    else:
        n_letters = sum(map(str.isalpha, text))
    return len(words), len(text) - n_spaces, n_symbols, n_lines, n_dup, repeated(hashes), n_letters


def ledger(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per row of ``df``: the id, all measurements and ``failed``, the mask of failed rules."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measure(t) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=list(MEASURES), dtype="int64")
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    # Ids travel as text, so that NULL ids of any type come through as they are.
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    measured = rows.mapInPandas(run, "id string, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select(F.col("id").cast(kind).alias(id_col), *MEASURES, failed.cast("long").alias("failed"))


def passes(policy: str, failed: str = "failed") -> Column:
    """Whether a ledger row passes the policy."""
    return F.col(failed).bitwiseAND(F.lit(policy_mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str = POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: ``rule, n_fail, n_only`` (rows that only this rule of the policy rejects) and
    ``n_kept_without`` (rows kept if the rule were taken out), from the counts per mask."""
    whole = policy_mask(POLICIES[policy], rules)
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("mask")).agg(F.count("*").alias("n"))
    own = [r for r in rules if r.name in POLICIES[policy]]
    total = lambda where: F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))
    mask = F.col("mask")
    per_rule = [
        F.struct(
            F.lit(r.name).alias("rule"),
            total(mask.bitwiseAND(F.lit(1 << r.bit)) != 0).alias("n_fail"),
            total(mask == (1 << r.bit)).alias("n_only"),
            total(mask.bitwiseAND(F.lit(whole & ~(1 << r.bit))) == 0).alias("n_kept_without"),
        )
        for r in own
    ]
    return masks.agg(F.array(*per_rule).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base@1")).alias("base_failed"), passes(POLICY).alias("kept"), "n_lines", "n_letters", "failed",
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 7], ' ')) AS h
  FROM d, LATERAL (SELECT unnest(generate_series(1, len(words) - 7)) AS i)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n FROM w),
r AS (
  SELECT doc_id, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 7)) AS at FROM c WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(length(regexp_replace(t, '[^\\p{L}]', '', 'g')) AS BIGINT) AS n_letters
  FROM d LEFT JOIN r USING (doc_id)),
b AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
       + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
       + CASE WHEN n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
       + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
       + CASE WHEN 100 * n_letters < 60 * word_chars THEN 64 ELSE 0 END AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, n_lines, n_letters, CAST(failed AS BIGINT) AS failed
FROM b
"""
