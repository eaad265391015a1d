import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import piece_model
from strata.llm import sentencepiece_codec as codec
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=codec.model_file())


@pytest.fixture(scope="module")
def model():
    with open(codec.model_file(), "rb") as file:
        return piece_model.load(file.read())


def ids(model, text):
    return np.frombuffer(model.encode(text), f"<u{model.width}").tolist()


CASES = [
    "", " ", "  ", "\n", "\n\n a", "a\nb  c", " x ", " " * 40, "the" * 40, "=" * 50, "tttttttttt aaaaaaa", "\t\r\n", "ab\x00c",
    "日本語テキスト 😀", "▁x ▁ ▁▁", "internationalization of the unbelievable", "........ ---- ____",
]


@pytest.mark.parametrize("text", CASES)
def test_ids_equal_the_library(model, library, text):
    assert ids(model, text) == library.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abeinorst  \n.,éñ日😀0123=-_AB"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_and_round_trip_on_random_texts(model, library, text):
    text = text.replace("▁", "")
    assert ids(model, text) == library.encode(text)
    assert model.decode(model.encode(text)) == text


def test_documents_equal_the_library(model, library, docs):
    texts = [r.text for r in docs.select("text").collect()]
    assert all(ids(model, t) == library.encode(t) for t in texts)


def test_long_word_without_spaces(model, library):
    text = "".join(random.Random(1).choice("abcdefgé") for _ in range(50_000))
    assert ids(model, text) == library.encode(text)


def test_unigram_weights_take_the_least_path():
    pieces = (("<unk>", 0.0, 2), ("a", -1.0, 1), ("b", -1.0, 1), ("ab", -2.5, 1), ("abc", -3.0, 1), ("c", -4.0, 1), ("▁", -1.0, 1))
    model = piece_model.PieceModel(piece_model.Spec(pieces, piece_model.UNIGRAM, False, True))
    assert model.shortest_path("▁abc") == ["▁", "abc"] and model.shortest_path("ab") == ["a", "b"]
    assert ids(model, "ab?") == [6, 1, 2, 0]


def test_spark_encode_and_decode(spark, odd):
    encode, decode = codec.encoder(spark), codec.decoder(spark)
    back = odd.select("text", decode(encode(odd.text)).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in back)
    out = codec.encode_and_check(odd)
    assert set(out.columns) == {*odd.columns, "n_tokens", "n_byte_tokens", "ids_sha256", "decoded_sha256", "round_trip"}
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and all(r.round_trip and 2 * r.n_tokens == len(r.ids) for r in rows)


def test_empty(spark, empty):
    assert codec.encode_and_check(empty).collect() == []
