"""Encoding against the tokenizer's own library."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataline.llm.encoding import TOKENIZERS, decode_texts, encode_texts, encoder

FILE = f"{TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no tokenizer files here")


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(blacklist_categories=("Cs", "Cn")), st.sampled_from(" \n\t'sabe.  ")), max_size=60))
def test_equals_library(theirs, t):
    ids = encoder(FILE).encode([t])[0]
    assert ids == theirs(t) and encoder(FILE).decode([ids, None]) == [t, ""]


def test_long_and_special(theirs):
    for t in ("a" * 3000, "<|endoftext|> x", "=" * 500 + "\n" * 40, "土壤样品" * 300, "don't  'll x", "  x　y"):
        assert encoder(FILE).encode([t])[0] == theirs(t)


def test_rows(spark, theirs):
    rows = [(1, "One text.", 5), (2, None, 6), (3, "", 7), (4, "One text.", None)]
    got = {r.doc_id: list(r.ids) for r in encode_texts(spark.createDataFrame(rows, "doc_id long, text string, ids int")).collect()}
    assert got == {1: theirs("One text."), 2: [], 3: [], 4: theirs("One text.")}
    assert encode_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    back = decode_texts(encode_texts(spark.createDataFrame(rows, "doc_id long, text string, ids int")))
    assert {r.doc_id: r.text for r in back.collect()} == {1: "One text.", 2: "", 3: "", 4: "One text."}
