import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landroll.llm import quality

LABELS = "doc_id long, quality int, toxic int"
rng = random.Random(4)


def prose(n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Epsilon", "zeta,", "eta."]) + rng.choice("abcdefg")
                    for _ in range(n))


def junk(n):
    return " ".join(f"word{rng.randrange(99)}###" if k % 2 else "x|y<z>" for k in range(n))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é漢😀#|<\n\t\x1c\x85 "), max_size=80))
def test_base_counts(text):
    n, chars, symbols, dups, repeats, failed = brute.base_quality(text)
    assert quality.base_counts(text.encode()) == (n, chars, symbols, dups, repeats)
    assert failed == (n < 10 or 100 * repeats > 20 * n)


def test_base_counts_of_repeats():
    for text in ("a b c d e a b c d e f g", "x " * 400, "l\nl\n\n \nl", "one two " * 3 + "three four five six"):
        assert quality.base_counts(text.encode()) == brute.base_quality(text)[:5]


@pytest.fixture(scope="module")
def rows():
    good = [(i, prose(rng.randint(40, 120))) for i in range(80)]
    bad = [(100 + i, junk(rng.randint(40, 120))) for i in range(20)]
    odd = [(200, None), (201, ""), (202, "\n \t"), (203, "same words " * 60), (204, prose(30000)), (205, "short text")]
    return good + bad + odd


def test_verdicts_scores_and_counts(spark, rows):
    docs = brute.documents(spark, rows + [(1, "short"), (None, prose(50))], extra=True)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 2)] + [(0, 1, 1), (100, 0, 0), (None, 1, 0)], LABELS)
    got = quality.judge(docs.drop("score"), labels).collect()
    assert len(got) == len(rows) + 2
    by_id = {(r.doc_id, r.n_words): r for r in got}
    for i, t in rows:
        want = brute.base_quality(t)
        r = by_id[i, want[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)
    assert all(by_id[i, len(t.split())].kept for i, t in rows if i < 80 and len(t.split()) >= 10)
    assert not any(by_id[i, len(t.split())].kept for i, t in rows if 100 <= i < 200)


def test_score_is_the_length_normalised_log_ratio(spark):
    docs = [(1, "aaa Bbb 12"), (2, "x#y"), (3, "aaa")]
    trusted = {1}
    n = {False: np.zeros(quality.N_BUCKETS), True: np.zeros(quality.N_BUCKETS)}
    grams = {i: [int(b) for part in quality._buckets(t.encode()) for b in part] for i, t in docs}
    for i, g in grams.items():
        for b in g:
            n[False][b] += 1
            n[True][b] += i in trusted
    p = {k: np.log((v + 1) / (v.sum() + (n[False] > 0).sum())) for k, v in n.items()}
    got = quality.judge(brute.documents(spark, docs), spark.createDataFrame([(1, 1, 0)], LABELS)).collect()
    for r in got:
        assert r.score == pytest.approx(np.mean([p[True][b] - p[False][b] for b in grams[r.doc_id]]))


def test_pieces_of_a_long_text_join_without_a_gap(monkeypatch):
    text = prose(500).encode()
    whole = np.concatenate(list(quality._buckets(text)))
    monkeypatch.setattr(quality, "_PIECE", 7)
    assert (np.concatenate(list(quality._buckets(text))) == whole).all()


def test_no_labels_and_empty_table(spark, rows):
    none = spark.createDataFrame([], LABELS)
    got = quality.judge(brute.documents(spark, rows[:5]), none).collect()
    assert all(r.score == 0 and r.kept for r in got)
    assert quality.judge(brute.documents(spark, []), none).count() == 0
