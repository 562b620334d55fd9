import random
from hashlib import sha256

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from actlens.llm import bpe
from actlens.llm.queries import tokenizer_file

PATH, PATTERN = tokenizer_file()
OWN = bpe.tokenizer(PATH, PATTERN)
OTHER = tiktoken.Encoding("other", pat_str=PATTERN, mergeable_ranks=OWN.rank, special_tokens={})
TEXTS = ["", "\n", " ", " a", "a ", "a\n\nb", "a  b\t c ", "don't we'll 12 34.5 ²½ é", "\x1c b\x85c\xa0d", " x y", "x" * 20000,
         "日本語 テキスト", "<|endoftext|> a", "a\r\nb", "a \nb", "é \U0001f600‍", " \n \n", "A.B,c. d, e.", "᠎ a"]


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_reference_library(text):
    ids = OWN.encode(text).tolist()
    assert ids == OTHER.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    assert OWN.encode(text).tolist() == OTHER.encode_ordinary(text)


def test_any_bytes_as_one_piece():
    rng = random.Random(2)
    tokens = list(OWN.rank)
    for i in range(4000):
        piece = (bytes(rng.choices(b"abcdehilnorst e", k=rng.randint(1, 40))) if i % 2
                 else b"".join(rng.choices(tokens, k=rng.randint(1, 5))))
        assert OWN.encode_piece(piece) == OTHER._core_bpe.encode_single_piece(piece)


def test_query_on_rows(spark):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(99, None, "en"), (3, "twice", "x"), (3, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = sorted(map(tuple, bpe.digests(docs, PATH, PATTERN).collect()))
    want = []
    for i, t, _ in rows:
        ids = OTHER.encode_ordinary(t or "")
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(docs.limit(0), PATH, PATTERN).collect() == []
    encoded = bpe.encode(docs, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "token_ids"]
    back = encoded.select("doc_id", bpe.decode(encoded["token_ids"], PATH, PATTERN).alias("b")).collect()
    assert sorted((r.doc_id, bytes(r.b).decode()) for r in back) == sorted((i, t or "") for i, t, _ in rows)


@pytest.mark.parametrize("text", [*TEXTS, "camelCaseWord HTMLParser fooBar. isNull, 3rdParty\nnewLine upperLOWER"])
def test_another_pattern(text):
    """A pattern that cuts words at capitals: what is proved for the usual one is not used."""
    camel = r"\p{Lu}+(?!\p{Ll})| ?\p{Lu}?\p{Ll}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\p{L}|\s+"
    own = bpe.ByteBPE(PATH, camel, memo=50)
    other = tiktoken.Encoding("camel", pat_str=camel, mergeable_ranks=OWN.rank, special_tokens={})
    assert own.encode(text).tolist() == other.encode_ordinary(text)


def test_small_memo_gives_the_same():
    small = bpe.ByteBPE(PATH, PATTERN, memo=3)
    words = ["Hello", "word.", "words,", "naïve", "x1", "(a)", "Hello", "zürich!", "end"]
    text = " ".join(random.Random(1).choices(words, k=300))
    assert small.encode(text).tolist() == OTHER.encode_ordinary(text)
    assert bpe.WORD_PATTERN == PATTERN
