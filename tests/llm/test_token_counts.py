import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from actlens.llm import token_counts as C
from actlens.llm.queries import count_file

PATH, PATTERN = count_file()
PROVEN = C.prove(PATH, PATTERN)
OWN = C.TokenCounter(PATH, PATTERN, PROVEN, memo=500)
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", "\n", " ", " a", "a ", "a\n\nb", "a  b\t c ", "don't we'll 12 34.5 ²½ é", "\x1c b\x85c\xa0d", " x y", "x" * 20000, "the" * 5000,
         "日本語 テキスト", "<|endoftext|> a", "a<|endoftext|><|endoftext|>  b <|endoftext", "a\r\nb", "é \U0001f600‍", " \n \n",
         "A.B,c. d, e.", "᠎ a", "՘౜ x", "\U00010940a b", "word. word, word; (word) \"word\" word!"]


def library_count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_library(text):
    assert OWN.count(text) == library_count(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    assert OWN.count(text) == library_count(text)


def test_every_early_character_is_cut_as_the_library_cuts_it():
    for start in range(0, 0x530, 16):
        text = "".join(f"a{chr(c)}1{chr(c)}  b{chr(c)}{chr(c)} " for c in range(start, start + 16))
        assert OWN.count(text) == library_count(text)


def test_proof_by_the_library():
    """Every proven string is one token of the library, and no other
    vocabulary string that is text of its own is."""
    texts = [t for t in map(C.merges(PATH).text_of, C.merges(PATH).vocabulary) if t]
    alone = {t for t, e in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1}
    assert set(PROVEN) == alone and len(PROVEN) > 49_000


def test_long_pieces_merge_alike():
    rng, own = random.Random(3), C.merges(PATH)
    for n in (65, 300, 2000):
        piece = "".join(rng.choices("abcdehilnorst", k=n))
        assert own.count(piece) == library_count(piece)


def test_query_on_rows(spark):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(99, None, "en"), (None, "no id", "x"), (3, "twice", "x"), (3, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = C.count_tokens(docs, PATH, PATTERN, limit=5).collect()
    want = [(i, len((t or "").encode()), library_count(t or ""), library_count(t or "") > 5) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert C.count_tokens(docs.limit(0), PATH, PATTERN).collect() == []


def test_other_kinds_of_file_are_refused():
    with pytest.raises((ValueError, KeyError)):
        C.Merges(public_tokenizers.path("word_bpe_49k.json"))
