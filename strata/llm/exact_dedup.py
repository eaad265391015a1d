"""Exact dedup by a heavy-hitter split (DataFrame functions only).

1. One scan stores ``(id, SHA-256 digest)``; texts are never shuffled.
2. Misra-Gries: ``approx_top_k`` (Spark's frequent-items sketch, a Misra-Gries counter table
   that merges map-side) runs per digest bucket, so a digest's whole stream meets one
   sketch and no single task merges everything. It names a bounded list of candidates.
3. Candidates are verified by an exact count of their rows (partial sums before the
   shuffle). Verified winners, at most ``BUCKETS * PER_BUCKET`` rows, are broadcast and their
   copies are settled map-side, however many rows one digest holds.
4. The remaining digests, all below the sketch's error bound, use an ordinary shuffle.

Defined cases: NULL text equals empty text. NULL ids rank lowest. The row with the largest id
stays. Rows that repeat both id and text are listed once each, count in ``group_size``,
and exactly one of them is kept. Texts of any length are hashed whole in the scan and go no further. An empty table gives an empty
result. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import documents, filled, packed, stored

#: Digest buckets, each with its own sketch, and the most winners a bucket may name.
BUCKETS = 64
PER_BUCKET = 32
#: Counters per sketch: a digest with over 1/768 of its bucket's rows is always named.
TRACKED = 1024
#: Rows from which a digest counts as heavy; smaller groups are cheap to shuffle.
MIN_HEAVY = 32


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.sha2(filled(F.col(text_col)), 256).alias("digest")
    )


def heavy_digests(ledger: DataFrame, min_heavy: int = MIN_HEAVY) -> DataFrame:
    """Verified winners ``(digest, keep_id, group_size, keep_rows)``, at most BUCKETS * PER_BUCKET rows."""
    candidates = (
        ledger.groupBy(F.pmod(F.hash("digest"), F.lit(BUCKETS)).alias("bucket"))
        .agg(F.expr(f"approx_top_k(digest, {PER_BUCKET}, {TRACKED})").alias("top"))
        .select(F.explode("top").alias("c"))
        .where(F.col("c.count") >= min_heavy)
        .select(F.col("c.item").alias("digest"))
    )
    per_id = ledger.join(F.broadcast(candidates), "digest").groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    best = F.struct(F.col("doc_id"), F.col("n"))
    return (
        per_id.groupBy("digest")
        .agg(F.max(best).alias("best"), F.sum("n").alias("group_size"))
        .where(F.col("group_size") >= min_heavy)
        .select("digest", F.col("best.doc_id").alias("keep_id"), "group_size", F.col("best.n").alias("keep_rows"))
    )


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_heavy: int = MIN_HEAVY
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    ledger = stored(digests(df, id_col, text_col), "digests")
    heavy = stored(heavy_digests(ledger, min_heavy).coalesce(1), "heavy-digests")
    out = ["doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")]

    marked = ledger.join(F.broadcast(heavy), "digest", "left")
    hot = marked.where(F.col("group_size").isNotNull())
    losers = hot.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.lit(False))
    winners = heavy.select(
        "*", F.col("keep_id").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.col("keep_rows"))).alias("copy")
    ).withColumn("kept", F.col("copy") == 1)

    of_digest = Window.partitionBy("digest")
    cold = (
        marked.where(F.col("group_size").isNull())
        .select("doc_id", "digest")
        .select(
            "doc_id",
            "digest",
            F.max("doc_id").over(of_digest).alias("keep_id"),
            F.count("*").over(of_digest).alias("group_size"),
            (F.row_number().over(of_digest.orderBy(F.desc_nulls_last("doc_id"))) == 1).alias("kept"),
        )
    )
    return cold.select(*out).unionByName(losers.select(*out)).unionByName(winners.select(*out))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    verdict = stored(exact_dedup(df, id_col, text_col), "exact-verdict")
    sha = F.sha2(filled(F.col(text_col)), 256)
    rows = df.select(packed(df), F.col(id_col).cast("long").alias("id"), sha.alias("sha"))
    key = F.expr("id <=> doc_id AND sha = text_sha256")
    gone = verdict.where("NOT doc_id <=> keep_id").select("doc_id", "text_sha256").distinct()
    left = rows.join(gone, key, "left_anti")
    winners = verdict.where("doc_id <=> keep_id").groupBy("doc_id", "text_sha256").count()
    repeated = winners.where("count > 1").select("doc_id", "text_sha256")
    if repeated.take(1):
        once = left.join(repeated, key, "left_semi").dropDuplicates(["id", "sha"])
        left = left.join(repeated, key, "left_anti").unionByName(once)
    return left.select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
