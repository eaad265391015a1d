import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm import fill_middle as fm
from tests.llm.conftest import EXTRA

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rates=fm.Rates()):
    """The contract by regular expression and slices."""
    text = text or ""
    units = UNITS.findall(text)
    n, digest = len(units), hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rates.rewritten:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < rates.suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_every_byte_is_marked_as_the_space_class_says():
    every = np.arange(256, dtype=np.uint8)
    for shift in range(8):  # at each place in a word, next to every other byte
        got = fm.spaces(np.frombuffer(np.roll(every, shift).tobytes(), "<u8")).view(np.uint8) >> 7
        assert np.array_equal(np.roll(got, -shift), np.isin(every, [32, 9, 10, 11, 12, 13]))
        more = fm.continuations(np.frombuffer(np.roll(every, shift).tobytes(), "<u8")).view(np.uint8) >> 7
        assert np.array_equal(np.roll(more, -shift), (every & 0xC0) == 0x80)


def test_units_of_random_texts_equal_the_regular_expression():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("ab \t\n\x0b\x0c\ré日😀\xa0 \x85\x1f\x0e<") for _ in range(rng.randint(0, 40)))
        units, found = fm.Units(text.encode()), UNITS.findall(text)
        assert len(units) == len(found)
        at = [units.offset(i) for i in range(len(found) + 1)]
        assert at == [len("".join(found[:i]).encode()) for i in range(len(found) + 1)]
        i, j = sorted((rng.randint(0, len(found)), rng.randint(0, len(found))))
        assert units.code_points(at[i], at[j]) == len("".join(found[i:j]))


@pytest.mark.parametrize("rates", [fm.Rates(), fm.Rates(7, 100, 0), fm.Rates(7, 100, 100), fm.Rates(1, 0, 50)])
def test_rewrite_equals_slices(rates):
    rng = random.Random(rates.seed)
    for i in range(500):
        text = "".join(rng.choice(["word", " ", "\n", "é", "<", "P>", "<S>" if i % 9 == 0 else "S>", "  \t", "😀x"]) for _ in range(rng.randint(0, 60)))
        n, form, prefix, middle, out = fm.rewrite(text.encode(), i, rates)
        assert (n, form, prefix, middle, out.decode()) == plain(i, text, rates)


def test_odd_rows_and_round_trip(odd):
    out = fm.fill_in_middle(odd, rates=fm.Rates(3, 100, 50))
    got = sorted(map(tuple, out.collect()), key=str)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got == sorted(((i, *plain(i, t, fm.Rates(3, 100, 50))) for i, t in rows), key=str)
    back = out.select("doc_id", fm.restore(out["output"], out["form"]).alias("text")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"} and "digest" in EXTRA


def test_texts_with_sentinels_stay_plain(spark):
    df = spark.createDataFrame([(i, f"some {s} text of words") for i, s in enumerate(["<P>", "<S>", "<M>", "<p>"])], "doc_id long, text string")
    out = {r.doc_id: r.form for r in fm.fill_in_middle(df, rates=fm.Rates(42, 100, 80)).collect()}
    assert [out[i] for i in range(3)] == ["plain"] * 3 and out[3] != "plain"


def test_empty_table(empty):
    out = fm.fill_in_middle(empty)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and out.count() == 0
