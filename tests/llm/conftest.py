import random

import pytest

from tests.conftest import SF001

#: Names that the operators use inside; a table may hold them too.
EXTRA = "digest kept n id row copy taken size component_id rep sha text_sha256 ids score bits target a b doc bucket words codec found".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(n))


def odd_rows(seed: int = 1) -> list[tuple]:
    """NULLs in any column, empty and long texts, ties, near and exact copies, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, 60) for _ in range(6)]
    near = base[0].rsplit(" ", 1)[0] + " other"
    rows = [(i + 1, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None])) for i, t in enumerate(base)]
    rows += [(10, base[0], "en", "s1"), (11, base[0], "en", "s2"), (12, near, None, "s1"), (13, near + " more", "de", None)]
    rows += [(20, None, "en", "s1"), (21, "", None, None), (22, " \t\n ", "en", "s2"), (23, "one two", "de", "s1"), (24, "ONE two", "de", "s1")]
    rows += [(None, "no id here but words", "en", "s1"), (None, None, None, None), (25, "12345 !!", "en", "s2")]
    rows += [(30, words(rng, 9000) + "\n" + base[1] + " tail", "en", "s1"), (30, base[2] + " same id, other text", "de", "s2")]
    rows += [(31, base[3], "en", "s1"), (31, base[3], "en", "s1"), (32, "été ñandú 日本 😀 " * 30, "de", "s3"), (33, "a" * 5000, "en", "s3")]
    rows += [(34, ("x y z " * 40).strip(), "en", "s3"), (35, "line one of the text\n" * 9, "en", "s3"), (36, "\r\n\x0b\x0c", "en", "s1")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["x"] * len(EXTRA)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    df = frame(spark, odd_rows())
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
