import random

import pytest

from strata.llm import quality_rules as Q
from tests.llm.conftest import frame, odd_rows, words

SPACE = " \t\n\v\f\r"


def brute(text):
    text = text or ""
    for c in SPACE:
        flat = text.replace(c, " ") if c == SPACE[0] else flat.replace(c, " ")
    ws = [w for w in flat.split(" ") if w]
    windows = {}
    for i in range(len(ws) - 7):
        windows.setdefault(tuple(ws[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    n_symbols = sum(c in Q.SYMBOLS for c in text)
    return len(ws), sum(map(len, ws)), n_symbols, len(lines), len(lines) - len(set(lines)), len(covered), sum(c.isalpha() for c in text)


def rows():
    rng = random.Random(5)
    few = [" ".join(rng.choice("ab") for _ in range(80)) for _ in range(5)]
    own = ["## | <a> & b% $5 * " * 10, "é日ñ " * 30, "same line\nother\nsame line\n  \nsame line \nother", words(rng, 20_000)]
    return odd_rows() + [(300 + i, t, "en", "s") for i, t in enumerate(few + own)]


def test_measurements_against_brute_force(spark):
    got = Q.ledger(frame(spark, rows())).collect()
    assert sorted((repr(r.doc_id), *[r[m] for m in Q.MEASURES]) for r in got) == sorted((repr(i), *brute(t)) for i, t, *_ in rows())


def test_masks_policies_and_ablations(spark):
    ledger = Q.ledger(frame(spark, rows())).cache()
    got = ledger.withColumn("base", Q.passes("base@1")).withColumn("full", Q.passes("full@1")).collect()
    names = list(Q.MEASURES)
    failed = []
    for r in got:
        m = {n: r[n] for n in names}
        fails = {
            "few_words": m["n_words"] < 20,
            "repeated_windows": 100 * m["n_repeat_words"] > 30 * m["n_words"],
            "symbols": 10 * m["n_symbols"] > m["n_words"],
            "duplicate_lines": m["n_dup_lines"] >= 4 and 100 * m["n_dup_lines"] > 30 * m["n_lines"],
            "long_words": m["word_chars"] > 20 * m["n_words"],
            "short_words": m["word_chars"] < 2 * m["n_words"],
            "few_letters": 100 * m["n_letters"] < 60 * m["word_chars"],
        }
        assert r.failed == sum(1 << rule.bit for rule in Q.RULES if fails[rule.name])
        assert r.base == (not fails["few_words"] and not fails["repeated_windows"]) and r.full == (not any(fails.values()))
        failed.append({n for n, bad in fails.items() if bad})
    out = {r["rule"]: (r.n_fail, r.n_only, r.n_kept_without) for r in Q.ablations(ledger).collect()}
    assert out == {
        n: (sum(n in f for f in failed), sum(f == {n} for f in failed), sum(f <= {n} for f in failed)) for n in out
    } and len(out) == len(Q.RULES)


def test_string_ids_and_empty(spark, empty):
    df = spark.createDataFrame([("x", "a b"), (None, None)], "doc_id string, text string")
    assert sorted((repr(r.doc_id), r.n_words) for r in Q.ledger(df).collect()) == [("'x'", 2), ("None", 0)]
    assert Q.ledger(empty).collect() == []
    assert all(r.n_fail == 0 for r in Q.ablations(Q.ledger(empty)).collect())


def test_bits_are_distinct():
    assert len({r.bit for r in Q.RULES}) == len(Q.RULES) == len({r.name for r in Q.RULES})
    with pytest.raises(KeyError):
        Q.policy_mask(("unknown",))
