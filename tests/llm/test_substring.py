import random

import brute
import numpy as np
import pytest

from landroll.llm import substring

rng = random.Random(6)


def some(n, vocab=60):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def make():
    passages = [some(rng.randint(20, 60)) for _ in range(5)]
    rows = []
    for i in range(80):
        parts = [some(rng.randint(0, 50))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            parts += [p, some(rng.randint(0, 25), 1000)]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200 + i, passages[0]) for i in range(30)]                 # copies of one passage
    rows += [(300, None), (301, ""), (302, "x " * 500), (303, some(19)), (304, rows[0][1]), (-5, rows[3][1]),
             (305, "é漢 " * 30), (306, some(5000, 5))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, bucket", [(8 << 20, 8 << 20), (2000, 3000)])
def test_matches_brute_force(spark, monkeypatch, chunk, bucket):
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substring, "BUCKET_BYTES", bucket)
    rows = make()
    got = {r.doc_id: r for r in substring.remove_repeats(brute.documents(spark, rows, extra=True)).collect()}
    for i, kept in brute.keep_windows(rows).items():
        n = len(brute.words(dict(rows)[i]))
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (n, n - len(kept), " ".join(kept))
    assert len(got) == len(rows)


def test_other_window_lengths(spark):
    rows = make()
    got = {r.doc_id: r.kept for r in substring.remove_repeats(brute.documents(spark, rows), window=7, mer=3).collect()}
    assert got == {i: " ".join(k) for i, k in brute.keep_windows(rows, 7).items()}


def test_rows_that_share_an_id(spark):
    p, q = some(40, 10_000), some(30, 10_000)
    rows = [(1, p), (1, p), (1, q), (2, p), (None, q), (None, p)]
    got = sorted(((r.doc_id or 99), r.n_removed, r.n_words)
                 for r in substring.remove_repeats(brute.documents(spark, rows)).collect())
    assert got == [(1, 0, 30), (1, 0, 40), (1, 0, 40), (2, 40, 40), (99, 30, 30), (99, 40, 40)]


def test_empty_table(spark):
    assert substring.remove_repeats(brute.documents(spark, [])).count() == 0


def test_runs_cover_every_window_once_with_its_minimiser():
    words = some(300, 60).encode().split()
    grams = substring._grams(substring._word_hashes(words), substring.MER)
    first, last, least = substring.runs(words, np.empty(0, np.uint64))
    assert first[0] == 0 and last[-1] == 280 and (first[1:] == last[:-1] + 1).all()
    for a, b, m in zip(first, last, least):
        for w in range(a, b + 1):
            assert m == min(grams[w:w + 21 - substring.MER] >> np.uint64(1))
    # A frequent gram is a minimiser only where every gram of the window is frequent.
    hot = np.sort(np.unique(grams[:150]))
    _, _, ranked = substring.runs(words, hot)
    assert (ranked >> np.uint64(63)).any() and not (ranked >> np.uint64(63)).all()


def test_windows_whose_hashes_collide_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring, "_word_hashes", lambda w: np.zeros(len(w), np.uint64))
    a, b = [some(25, 10_000).encode() for _ in range(2)]
    places = np.array([[1, 2, 3, 4], [0, 0, 0, 0], [0, 0, 0, 0], [25] * 4], np.int64)
    doc, _, start, end = substring.repeated_windows([a, b, a, b], places)
    assert list(zip(doc, start, end)) == [(3, 0, 25), (4, 0, 25)]


def test_texts_of_one_32_bit_hash_and_many_null_ids(spark):
    """Rows without an id whose texts share a 32-bit hash are still told apart."""
    from pyspark.sql import functions as F
    long_text = F.concat(F.lit("w " * 25), F.col("id"))
    texts = (spark.range(150_000).select(F.col("id").cast("string").alias("t"))
             .unionByName(spark.range(150_000).select(long_text.alias("t"))))
    same = texts.groupBy(F.hash("t")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").limit(40).collect()
    rows = [(None, t) for r in same for t in r.ts] + [(None, f"only {i}") for i in range(300)]
    assert len(same) > 3
    got = sorted((r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(brute.documents(spark, rows)).collect())
    texts = sorted(t for _, t in rows)
    assert len(got) == len(rows) and sum(n for n, _, _ in got) == sum(len(t.split()) for t in texts)
    # One text keeps the common passage; every other long one loses the windows that are not its own.
    long_ones = [t for t in texts if t.startswith("w ")]
    assert sum(r > 0 for _, r, _ in got) >= len(long_ones) - 1
    short = sorted(t for t in texts if not t.startswith("w "))
    assert sorted(k for n, r, k in got if n < 20) == short
