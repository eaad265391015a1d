"""Helpers shared by the training-data operators: table reads and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import storage_root

#: Characters that separate words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


_WRITTEN: list[list[str]] = []


@contextmanager
def written() -> Iterator[list[str]]:
    """The folders that ``stored`` writes inside the block, in order."""
    _WRITTEN.append([])
    try:
        yield _WRITTEN[-1]
    finally:
        _WRITTEN.pop()


def release(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders of ``stored`` whose readers have committed their own results."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never reused by another run)."""
    return f"{storage_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the work, several
    readers share one computation, and the planner sees the table's true size before it
    decides whether a join side may be broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    for folders in _WRITTEN:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one, ``row``, so that an operator's own columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def own_shuffle(number: Column) -> Column:
    """The same number under an expression of its own. A join on it shuffles this side anew instead of building on an
    aggregate's partitioning, which is what lets AQE split a hot key of the other side."""
    return F.bitwise_not(F.bitwise_not(number))


def document_order(texts: DataFrame) -> DataFrame:
    """``(_id, _digest, at)`` of the distinct ``(doc_id, digest)``: numbers that rise with id (NULL first) and digest, with gaps.

    Names documents where ids are NULL or shared by different texts. The sort is spread over range partitions."""
    order = texts.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    order = order.orderBy(F.asc_nulls_first("_id"), "_digest")
    return stored(order.withColumn("at", F.monotonically_increasing_id()), "document-order")


def filled(text: Column) -> Column:
    """Text with NULL as empty."""
    return F.coalesce(text, F.lit(""))
