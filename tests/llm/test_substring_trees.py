import hashlib
import random

import pytest

from strata.llm import substring_trees as st
from tests.llm.conftest import frame


def brute(rows, window):
    """``(doc_id, n_words, n_removed, sha)`` per ``(doc_id, text)``, from every window of every document."""
    least = {}
    split = [(doc_id, (text or "").encode("utf-8", "surrogatepass").split()) for doc_id, text in rows]
    for doc_id, words in split:
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            key = tuple(words[i : i + window])
            least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        gone = set()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            if least[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(map(tuple, st.remove_repeats(df, **kw).collect()), key=str)


def corpus(seed, n, window):
    """Texts of few different words with shared passages of about a window's length at random places."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4)] + ["é", "日本", "a\xa0b", "\x85", "<x>"]
    some = lambda k: [rng.choice(words) + str(rng.randint(0, 30)) for _ in range(k)]
    shared = [some(rng.randint(window - 2, 3 * window)) for _ in range(4)]
    out = []
    for i in range(n):
        text = some(rng.randint(0, window))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a = rng.randint(0, len(passage) - window + 2)
            text += passage[a : a + rng.randint(window - 2, 2 * window)] + some(rng.randint(0, 5))
        out.append((rng.randint(1, n), "".join(w + rng.choice([" ", "\n", "  \t"]) for w in text)))
    return out


@pytest.mark.parametrize("most", [4096, 8, 2, 1])
@pytest.mark.parametrize("window", [50, 12, 5])
def test_equals_brute_force_for_any_group_size(spark, window, most):
    rows = corpus(window + most, 60, window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, window=window, most=most) == brute(rows, window)


def test_few_words_repeat_within_and_across_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b"]) if i % 3 else "a" for _ in range(rng.randint(40, 160)))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for window, most in ((9, 4096), (9, 3), (50, 2)):
        assert run(df, window=window, most=most) == brute(rows, window)


@pytest.mark.parametrize("most", [4096, 2])
def test_a_hot_passage_between_own_words(spark, most):
    rng = random.Random(9)
    hot = [f"h{i}" for i in range(70)]
    own = lambda: [f"o{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))]
    rows = [(i, " ".join(own() + hot[rng.randint(0, 15) : rng.randint(55, 70)] + own())) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = run(df, most=most)
    assert got == brute(rows, 50) and sum(r[2] > 0 for r in got) > 60


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    shared = " ".join(f"p{i}" for i in range(80))
    more = [(50, shared, None, "s"), (40, f"x y {shared} z", "en", None), (40, f"{shared} other tail", None, "s"), (None, shared, None, None)]
    more += [(51, shared, None, "s"), (51, shared, None, "s"), (None, f"{shared} {shared}", None, None), (52, f"q {shared} {shared}", None, "s")]
    df = odd.unionByName(frame(spark, more))
    assert run(df) == brute(rows + [r[:2] for r in more], 50)


def test_kept_text_and_edges(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "\n".join(words[:50]) + "  end"), (3, " ".join(words[:49])), (4, "\t".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_removed, r.kept) for r in st.remove_repeats(df, keep_text=True).collect()}
    assert out == {1: (0, None), 2: (50, "end"), 3: (0, None), 4: (60, "")}
    with pytest.raises(ValueError):
        st.remove_repeats(df, window=256)


def test_empty_table(empty):
    out = st.remove_repeats(empty)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


def test_nodes_of_a_tree():
    strings = [b"a b c d ", b"a b c e ", b"a b x ", b"a b ", b"q "]
    nodes = {(above, words, tuple(sorted(group))) for above, words, group in st.inner_nodes(strings, list(range(5)), -1)}
    assert nodes == {(-1, 0, (0, 1, 2, 3, 4)), (0, 2, (0, 1, 2, 3)), (2, 3, (0, 1))}
