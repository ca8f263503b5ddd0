import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from landroll.llm import pieces, queries

PATH = public_tokenizers.path(queries.PIECE_MODEL)
TEXTS = [None, "", "Hello world", "  two  spaces \n\n tabs\t", "</s> and <0x0A> ▁", "naïve café 漢字 😀é\U000125ed",
         "aaaaaaaaaaaaaaaaaaaaa", " " * 5000, "ab" * 4000, "\x00\x1c\x85 　 x", "same", "same"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.load(PATH))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorst é漢😀 \n\t▁0.<s>{}"), max_size=80))
def test_ids_equal_the_library(library, codec, text):
    want = library.encode(text, add_eos=True)
    got = codec.encode([text])[0]
    assert got.tolist() == want
    assert codec.decode(got) == library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 258)), max_size=8))
def test_any_ids_decode_as_in_the_library(library, codec, ids):
    assert codec.decode(np.array(ids, np.int32)) == library.decode(ids)


@pytest.mark.parametrize("slow", [1, 10 ** 9])
def test_rounds_and_queue_agree(library, slow, monkeypatch):
    monkeypatch.setattr(pieces, "SLOW_ROUND", slow)  # 1: the queue takes over after the first round; the other: never
    own = pieces.Codec(pieces.load(PATH))
    for text in ("the inside of internationalisation", " " * 77 + "x", "abababaabbaab", "aaaa aaa"):
        assert own.encode([text])[0].tolist() == library.encode(text, add_eos=True)


def test_new_pairs_of_better_rank_come_first():
    """ab is worse than aba: the second ab must not merge before the first has become aba."""
    def table(*entries):
        entries = sorted(entries)
        return pieces.Pairs({"keys": np.array([k for k, _, _ in entries] + [pieces._NONE]),
                             "ranks": np.array([r for _, r, _ in entries] + [pieces._NONE]),
                             "joined": np.array([j for _, _, j in entries] + [-1])})

    a, b, ab, aba = 1, 2, 3, 4
    pairs = table((a << 22 | b, 7, ab), (ab << 22 | a, 5, aba))
    symbols, sizes = pieces.merge_words(np.array([a, b, a, b, a, b, b]), np.array([6, 1]), pairs)
    assert symbols.tolist() == [aba, b, ab, b] and sizes.tolist() == [3, 1]
    assert pieces._by_queue([a, b, a, b, a, b], pairs) == [aba, b, ab]


def test_long_words_take_linear_time(codec, library):
    for text in (" " * 60_000, "xq" * 40_000, "漢字" * 20_000):
        assert codec.encode([text])[0].tolist() == library.encode(text, add_eos=True)


def test_memo_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_ENTRIES", 2)
    own = pieces.Codec(pieces.load(PATH))
    for text in ("one two three", "four five", "one six"):
        assert own.encode([text])[0].tolist() == codec.encode([text])[0].tolist()
    assert len(own.memo) <= 4


def test_query_columns(spark, library, tmp_path):
    brute.documents(spark, list(enumerate(TEXTS)), extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op11_sentencepiece_encode_decode(spark, str(tmp_path)).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert got[i].decoded_sha256 == brute.sha(library.decode(ids))


def test_decode_from_ids_alone_and_empty_table(spark):
    coded = pieces.encode_decode(brute.documents(spark, list(enumerate(TEXTS))), PATH)
    texts = {r.doc_id: r.decoded for r in pieces.decode_ids(coded, PATH).collect()}
    assert texts == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}
    assert pieces.encode_decode(brute.documents(spark, []), PATH).count() == 0


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as f:
        data = bytearray(f.read())
    at = data.rindex(b"identity") + len(b"identity")
    assert data[at:at + 6] == b"\x12\x00\x18\x01\x20\x00"
    data[at + 5] = 1  # remove_extra_whitespaces
    (tmp_path / "m.model").write_bytes(data)
    with pytest.raises(ValueError):
        pieces.load(str(tmp_path / "m.model"))
