"""SentencePiece encoding and decoding on Spark, by the transducer in :mod:`strata.llm.piece_model`.

The model file is read once, on the driver, and sent to the executors (it is the vocabulary, of fixed size); each worker process
compiles it once. Texts are encoded whole, where they are: no shuffle.

Ids are binary columns, little-endian uint16 (uint32 for over 65,536 pieces). Defined cases: NULL and empty texts have no ids
and decode to the empty text. Texts that hold U+2581 themselves decode with a space in its place, as the model cannot tell the two
apart; all other texts come back exactly. Repeated rows are encoded each; an empty table gives an empty result. Added
columns replace columns of the same name; no other is touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, packed
from strata.llm.piece_model import load


def model_file() -> str:
    """Path of the 32,000-piece model; the default of every ``model_path``."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _shared(spark: SparkSession, model_path: str | None):
    with open(model_path or model_file(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder(spark: SparkSession, model_path: str | None = None) -> Callable[[Column], Column]:
    """A function from a text column to its column of ids."""
    model = _shared(spark, model_path)

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = load(model.value)
        for texts in batches:
            yield pd.Series([m.encode(t or "") for t in texts], dtype=object)

    return encode


def decoder(spark: SparkSession, model_path: str | None = None) -> Callable[[Column], Column]:
    """A function from a column of ids to its text column."""
    model = _shared(spark, model_path)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        run = load(model.value).decode
        return pd.Series([run(x or b"") for x in ids], dtype=object)

    return decode


FACTS = "ids binary, n_tokens long, n_byte_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def encode_and_check(df: DataFrame, text_col: str = "text", model_path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``df`` with the columns of ``FACTS`` added: the ids, their number and how many of them are bytes, digests of the ids and
    of the text decoded from them, and whether that is the text."""
    model = _shared(df.sparkSession, model_path)

    @F.pandas_udf(FACTS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = load(model.value)
        is_byte = np.zeros(len(m.spec.pieces), bool)
        is_byte[list(m.byte_ids.values())] = True
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                ids = m.encode(text)
                back = m.decode(ids)
                n_bytes = int(np.count_nonzero(is_byte[np.frombuffer(ids, f"<u{m.width}")]))
                rows.append((
                    ids if keep_ids else None, m.count(ids), n_bytes, hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text,
                ))
            yield pd.DataFrame(rows, columns=["ids", "n_tokens", "n_byte_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    names = [c.split()[0] for c in FACTS.split(", ") if keep_ids or not c.startswith("ids ")]
    rest = [f"row.`{c}`" for c in df.columns if c not in names]
    return df.select(packed(df), run(F.col(text_col)).alias("codec")).select(*rest, *[f"codec.{n}" for n in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return encode_and_check(rows, keep_ids=False).drop("text")
