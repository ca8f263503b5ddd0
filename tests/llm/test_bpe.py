import brute
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from landroll.llm import bpe, queries

PATH = public_tokenizers.path(queries.TOKENIZER)
TEXTS = [None, "", "Hello world", "  two  spaces \n\n tabs\t", "<|endoftext|> and <|endof", "naïve café 漢字 😀é",
         "it's we'll I'd 12345 !!??", "a" * 5000, "\x1c\x85 　 x", "same", "same"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeé漢😀 \n\t'sl1２.!<|endoftext>\x1c\x85"), max_size=60))
def test_ids_equal_the_library(reference, codec, text):
    want = reference.encode(text, add_special_tokens=False).ids
    assert list(codec.encode(text)) == want
    assert codec.decode(codec.encode(text)) == reference.decode(want, skip_special_tokens=False)


def test_memo_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    own = bpe.Codec(bpe.load(PATH))
    own.encode("one two three four five six seven")
    assert len(own.memo) <= 3
    assert own.encode("one two three") == codec.encode("one two three")


def test_query_columns(spark, reference, tmp_path):
    brute.documents(spark, list(enumerate(TEXTS)), extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op2_bpe_encode_decode(spark, str(tmp_path)).collect()}
    for i, t in enumerate(TEXTS):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == brute.sha(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == brute.sha(reference.decode(ids, skip_special_tokens=False))


def test_decode_from_ids_alone_and_empty_table(spark):
    coded = bpe.encode_decode(brute.documents(spark, list(enumerate(TEXTS))), PATH)
    texts = {r.doc_id: r.decoded for r in bpe.decode_ids(coded, PATH).collect()}
    assert texts == {i: t or "" for i, t in enumerate(TEXTS)}
    assert bpe.encode_decode(brute.documents(spark, []), PATH).count() == 0


def test_every_code_point_is_classed_as_in_the_library(reference, codec):
    """A letter, number, blank or other character before 's and after a letter and a digit."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 100_000):
        texts = [f"{c}'s a{c}1{c} " for c in points[k:k + 100_000]]
        for text, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
            assert list(codec.encode(text)) == want.ids, hex(ord(text[0]))
        codec.memo.clear()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab's!,1 \n\t\x1c\x85\xa0 　é漢\U000125ed\U0001e5d0"), max_size=12),
                max_size=6))
def test_ids_do_not_depend_on_what_is_remembered(reference, codec, texts):
    """Chunks cut at blanks, before and after their pre-tokens are remembered."""
    codec.memo.clear()
    for text in [*texts, " ".join(texts), *texts]:
        assert list(codec.encode(text)) == reference.encode(text, add_special_tokens=False).ids


def test_a_word_that_is_known_is_not_split_again(codec):
    once = list(codec.encode(" word été"))
    pieces, codec.pieces = codec.pieces, None
    try:
        assert list(codec.encode(" word été" * 3)) == once * 3
    finally:
        codec.pieces = pieces
