"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: runs of non-letters become one space, letters are lower-cased, and all n-grams of 1 to 3 characters are hashed to
``BUCKETS``; weight (1 + log tf) * idf, scaled to length 1. Document frequencies are counted over all training
documents (partial counts per task, summed per bucket). The classifier is fitted on a bounded
sample: about ``PER_LANG`` documents of each language, ``MAX_SAMPLE`` in all (a hash of their ids chooses, so the number is that in the
mean; twice that is the bound), in one task. More than ``MAX_SAMPLE`` languages raise.
Follow-the-regularised-leader updates (proximal form, per-coordinate rates) with elastic-net
penalties leave most weights at zero. A temperature, fitted on a held-back part of the sample, calibrates the scores.

Learning uses text and language only of documents whose crc32(id) mod 4 is not 2; predictions use the text only.

Defined cases: NULL text, and text without a letter, is ``und`` with score 0. NULL languages are not learned; a table with
none to learn from is all ``und`` with score 0; a single language is predicted with score 1. NULL ids are
never learned from nor held out. Texts are read whole. Repeated rows are predicted each. Other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, packed

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Bounds of the fitting sample.
PER_LANG, MAX_SAMPLE = 600, 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
#: Documents below this score are rejected by :func:`keep_known`.
LEAST_SCORE = 0.35


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur and how often; both empty if the text has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0)
    points = np.where(letter, points, 32).astype(np.uint64)
    points = points[letter | np.concatenate(([True], letter[:-1]))]
    points = np.concatenate((np.array([32], np.uint64), points, np.array([32], np.uint64)))
    mix = np.uint64(0x9E3779B97F4A7C15)  # overflow wraps, as it should
    shift = np.uint64(64 - BUCKET_BITS)
    pairs = points[:-1] << np.uint64(21) | points[1:]
    triples = pairs[:-1] * mix + points[2:]
    buckets = np.concatenate([((x + np.uint64(n)) * mix) >> shift for n, x in enumerate((points, pairs, triples * mix))])
    counts = np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(float)


def features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's TF-IDF vector, of length 1, as buckets and weights."""
    found, counts = ngram_counts(text)
    weights = (1 + np.log(counts)) * idf[found] if len(found) else counts
    return found, weights / (np.sqrt(weights @ weights) or 1.0)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets + 1 (bias) x langs
    temperature: float

    def logits(self, found: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[found] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        found, x = features(text, self.idf)
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found, x) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(min(max(p[best], 0.0), 1.0))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by follow-the-regularised-leader; ``rows`` are (buckets, values, label)."""
    z, n = np.zeros((BUCKETS + 1, n_langs)), np.zeros((BUCKETS + 1, n_langs))

    def weights(i):
        free = np.abs(z[i]) > L1
        return np.where(free, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for found, x, label in rows:
            i, v = np.append(found, BUCKETS), np.append(x, 1.0)
            w = weights(i)
            error = softmax(v @ w)
            error[label] -= 1
            g = v[:, None] * error
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature in [0.05, 20] with the least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(texts: list[str], labels: list[str], langs: list[str], idf: np.ndarray) -> Model:
    """Every fifth row of the sample is held back for the temperature."""
    rows = [(*features(t, idf), langs.index(label)) for t, label in zip(texts, labels, strict=True)]
    rows = [r for r in rows if len(r[0])]
    weights = fit_ftrl([r for i, r in enumerate(rows) if i % 5 or len(rows) < 10], len(langs))
    model = Model(langs, idf, weights, 1.0)
    back = rows[::5]
    logits = np.array([model.logits(found, x) for found, x, _ in back]).reshape(len(back), len(langs))
    model.temperature = fit_temperature(logits, np.array([r[2] for r in back], int))
    return model


def remainder(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 4


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with a letter, and per bucket how many have it, over all rows of ``texts(text)``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found, _ = ngram_counts(text)
                df[found] += 1
                n += len(found) > 0
        df[-1] = n
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": at.astype("int32"), "n": df[at]})

    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in texts.mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n  # at most BUCKETS + 1 rows
    return int(out[-1]), out[:-1]


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    learn = df.where((remainder(id_col) != 2) & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("at")
    )
    per_lang = learn.where(F.col("text").isNotNull()).groupBy("lang").count().orderBy(F.desc("count"), "lang")
    counts = per_lang.limit(MAX_SAMPLE + 1).collect()
    if len(counts) > MAX_SAMPLE:
        raise ValueError(f"more than {MAX_SAMPLE} languages: the sample has no row for each")
    langs = sorted(r["lang"] for r in counts)
    n, df_counts = document_frequencies(learn.select("text"))
    idf = np.log((1 + n) / (1 + df_counts)) + 1
    if not langs:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    # A hash below the language's bound puts a row into the sample; its expected share is exact.
    share = max(1, min(PER_LANG, MAX_SAMPLE // len(langs)))
    bounds = df.sparkSession.createDataFrame(
        [(r["lang"], int(-(2**63) + min(1.0, share / r["count"]) * (2**64 - 2048))) for r in counts], "lang string, bound long"
    )
    sample = (
        learn.join(F.broadcast(bounds), "lang")
        .where(F.col("at") <= F.col("bound"))
        .orderBy("at", "lang", "text")
        .limit(2 * share * len(langs))
        .select("text", "lang")
    )

    def learn_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "lang": []}), *batches])
        if len(rows):
            model = fit(rows["text"].tolist(), rows["lang"].tolist(), langs, idf)
            at = np.flatnonzero(model.weights.any(axis=1))
            yield pd.DataFrame(
                {"at": [at.astype("<i4").tobytes()], "w": [model.weights[at].astype("<f8").tobytes()], "t": [model.temperature]}
            )

    got = sample.coalesce(1).mapInPandas(learn_one, "at binary, w binary, t double").collect()
    weights = np.zeros((BUCKETS + 1, len(langs)))
    weights[np.frombuffer(got[0]["at"], "<i4")] = np.frombuffer(got[0]["w"], "<f8").reshape(-1, len(langs))
    return Model(langs, idf, weights, got[0]["t"])


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` added (replacing columns of these names)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    rest = [f"row.`{c}`" for c in df.columns if c not in ("lang_pred", "score")]
    return df.select(packed(df), predict(F.col(text_col)).alias("found")).select(*rest, "found.*")


def keep_known(df: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``df`` whose text has a known language, with all their columns."""
    found = identify(df.select(packed(df), "text"), train(df))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "text")
    return identify(rows, train(docs)).select("doc_id", "held_out", "lang_pred", "score")
