"""Training-order materialisation of token ids as fixed-stride binary shards.

A document's ids, closed by ``END``, are cut into sequences of ``LENGTH``. Sequence ``chunk`` of document number d
has index d * C + chunk (C: a bound on a document's sequences, from its bytes), and a keyed Feistel permutation of
[0, M), M = D * C, walked along its cycles until it falls below M, gives it a position of its own: the training order.
The index needs no count of tokens, so each text is tokenised once.

Positions are spread evenly, so range partition p holds positions [p * M / P, (p + 1) * M / P) and about
as many sequences as any other; no sampling of ranges, no hot range. A task sorts its range
and writes one shard file of records of ``stride(length)`` bytes; the shards' counts make positions global slots without gaps.
Record i of a shard stands at byte i * stride: a reader resumes anywhere by arithmetic, and files split by records.

Files are written by Spark's text writer, whose line separator is the record's last byte, so any store that Spark
writes will do. A lost task is run again from the texts and gives the same bytes.

Defined cases: NULL or empty text is the one sequence ``[END]``. Rows that repeat id and text are written once. NULL ids,
different texts under one id, and ids too far apart for a compact index are numbered by a sort of (id, digest) first.
Texts of any length are tokenised whole; the longest sets C, so one very long text widens the index of all (gaps cost nothing, but
D * C of 2**62 or more raises). An empty table writes nothing and returns no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from strata.llm.common import document_order, documents, filled, scratch, stored
from strata.sources.storage import empty_frame

LENGTH = 512
#: The one id the vocabulary leaves free; ends every document. ``PAD`` fills a last sequence.
END, PAD = 50256, 65535
SHARD_TEXT_BYTES = 64 << 20
SEED = "order-1"
#: Index in the shard, position, document id, chunk, tokens.
HEADER = "<qqqii"
HEADER_BYTES = struct.calcsize(HEADER)
#: Stands for a NULL id in a record.
NO_ID = -(2**63)
ROUNDS = 6


def vocabulary() -> tuple[str, str]:
    """Path of the byte-level BPE ranks and the pattern that splits texts before the merges; the defaults."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(2)
def encoding(ranks: bytes, pattern: str):
    """The tokenizer of a rank file's content, once per process."""
    import tiktoken

    pairs = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=pairs, special_tokens={})


# -- the permutation ----------------------------------------------------------------------------------------------------


class Permutation:
    """A keyed permutation of [0, size), size below 2**62, over numpy arrays."""

    def __init__(self, size: int, seed: str = SEED):
        self.size = size
        self.half = max(1, -(-(size - 1).bit_length() // 2))
        digests = (hashlib.sha256(f"{seed}/{r}".encode()).digest() for r in range(ROUNDS))
        self.keys = [int.from_bytes(d[:8], "little") for d in digests]
        self.mask = np.uint64((1 << self.half) - 1)

    def _round(self, x: np.ndarray, key: int) -> np.ndarray:
        x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)  # overflow wraps, as it should
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ x >> np.uint64(32)) & self.mask

    def _walk(self, x: np.ndarray, once) -> np.ndarray:
        x = once(x.astype(np.uint64))
        while (outside := x >= np.uint64(self.size)).any():  # at most 4 x size values, so few steps
            x[outside] = once(x[outside])
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        def once(x):
            a, b = x >> np.uint64(self.half), x & self.mask
            for key in self.keys:
                a, b = b, a ^ self._round(b, key)
            return a << np.uint64(self.half) | b

        return self._walk(x, once)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        def once(x):
            a, b = x >> np.uint64(self.half), x & self.mask
            for key in reversed(self.keys):
                a, b = b ^ self._round(a, key), a
            return a << np.uint64(self.half) | b

        return self._walk(x, once)


@dataclass(frozen=True)
class Shards:
    """Written shards: positions of shard s are [s * width, (s + 1) * width); ``per_doc`` is C."""

    path: str
    order: Permutation
    per_doc: int
    width: int
    length: int


# -- writing --------------------------------------------------------------------------------------------------------------


def stride(length: int = LENGTH) -> int:
    return HEADER_BYTES + 2 * length + 1


def numbered(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int, int]:
    """``(number, doc_id, text)``, one row per document, with numbers in [0, D); D; the most bytes of a text; all bytes."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), filled(F.col(text_col)).alias("text"))
    facts = rows.agg(
        F.min("doc_id"), F.max("doc_id"), F.count("*"), F.count("doc_id"), F.max(F.octet_length("text")), F.sum(F.octet_length("text").cast("long"))
    ).first()
    low, high, n, with_id, most, total = facts
    if n == 0:
        return rows.select(F.col("doc_id").alias("number"), "doc_id", "text"), 0, 0, 0
    near = with_id == n and high - low + 1 <= 16 * n
    if near and not rows.groupBy("doc_id").count().where("count > 1").take(1):
        return rows.select((F.col("doc_id") - low).alias("number"), "doc_id", "text"), high - low + 1, most, total
    key = document_order(rows.select("doc_id", F.sha2("text", 256).alias("digest"))).withColumn("part", F.shiftright("at", 33))
    sizes = key.groupBy("part").count()  # one row per sorted partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    key = key.join(sizes.select("part", before.alias("before")), "part")
    key = stored(key.select("_id", "_digest", number.alias("number")), "document-numbers")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.sha2("text", 256) == F.col("_digest"))
    once = rows.join(key, same).dropDuplicates(["number"]).select("number", "doc_id", "text")
    return once, key.count(), most, total


def write_shards(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: str = SEED,
    shard_text_bytes: int = SHARD_TEXT_BYTES, ranks_path: str | None = None, pattern: str | None = None,
) -> Shards:
    """Write the shards under ``path``."""
    path_of_ranks, pattern = (ranks_path, pattern) if ranks_path else vocabulary()
    with open(path_of_ranks, "rb") as file:
        ranks = df.sparkSession.sparkContext.broadcast(file.read())  # the vocabulary, of fixed size
    rows, n_docs, most, total = numbered(df, id_col, text_col)
    per_doc = -(-(most + 1) // length)  # a token has a byte at least
    if n_docs * per_doc >= 1 << 62:
        raise ValueError(f"{n_docs} documents of up to {per_doc} sequences are more than 2**62 slots")
    order = Permutation(n_docs * per_doc, seed)
    n_shards = max(1, -(-total // shard_text_bytes))
    width = max(1, -(-order.size // n_shards))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pack = encoding(ranks.value, pattern).encode_to_numpy, zstandard.ZstdCompressor(1).compress
        for batch in batches:
            out: list[list] = [[], [], [], []]
            index: list[int] = []
            for number, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encode(text, disallowed_special=()), END).astype("<u2").tobytes()
                for chunk, at in enumerate(range(0, len(ids), 2 * length)):
                    part = ids[at : at + 2 * length]
                    index.append(number * per_doc + chunk)
                    for column, value in zip(out, (doc, chunk, len(part) // 2, pack(part)), strict=True):
                        column.append(value)
            position = order.forward(np.array(index, np.int64))
            columns = [pa.array(position // width, pa.int32()), pa.array(position), pa.array(out[0], pa.int64())]
            columns += [pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "position", "doc_id", "chunk", "n", "ids"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, blank, at = zstandard.ZstdDecompressor().decompress, np.array([PAD], "<u2").tobytes(), 0
        for batch in batches:
            records = []
            for position, doc, chunk, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                head = struct.pack(HEADER, at, position, NO_ID if doc is None else doc, chunk, n)
                records.append(head + unpack(ids) + blank * (length - n))
                at += 1
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    placed = rows.mapInArrow(tokenise, "shard int, position long, doc_id long, chunk int, n int, ids binary")
    ranges = placed.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("position").drop("shard")
    records = ranges.mapInArrow(fill, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\n").text(path)
    return Shards(path, order, per_doc, width, length)


# -- reading --------------------------------------------------------------------------------------------------------------


def read_shards(spark: SparkSession, shards: Shards) -> DataFrame:
    """``(shard, index, position, doc_id, chunk, n_tokens, ids)`` of all records; ``ids`` are little-endian uint16."""
    length, width = shards.length, shards.width

    def parse(records: Iterator[bytes]) -> Iterator[tuple]:
        for record in records:
            at, position, doc, chunk, n = struct.unpack_from(HEADER, record)
            ids = record[HEADER_BYTES : HEADER_BYTES + 2 * n]
            yield position // width, at, position, None if doc == NO_ID else doc, chunk, n, ids

    schema = "shard int, index long, position long, doc_id long, chunk int, n_tokens int, ids binary"
    if not shards.order.size:
        return empty_frame(spark, StructType.fromDDL(schema))
    records = spark.sparkContext.binaryRecords(shards.path, stride(length))
    return spark.createDataFrame(records.mapPartitions(parse), schema, verifySchema=False)


def slots(records: DataFrame) -> DataFrame:
    """``records`` with ``slot``, the place in training order over all shards, from 0 and without gaps."""
    counts = records.groupBy("shard").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("shard"), before.alias("_before"))  # one row per shard
    return records.join(starts, "shard").withColumn("slot", F.col("_before") + F.col("index")).drop("_before")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write_shards(documents(spark, sf_dir), scratch(spark, "token-shards"))
    records = read_shards(spark, shards).withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")
    return slots(stored(records, "token-index")).select("slot", "shard", "index", "position", "doc_id", "chunk", "n_tokens", "ids_sha256")
