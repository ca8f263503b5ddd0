import random

import brute
import pytest

from landroll.llm import mixing

rng = random.Random(9)


def corpus():
    rows, k = [], 0
    for source, n in (("b", 300), ("a", 40), ("é", 15), (None, 60), ("A", 1), ("zero", 2), ("c", 120)):
        for _ in range(n):
            rows.append((k, "" if source == "zero" else "w " * rng.choice([0, 1, 7, 40, 90, 400]), "en", source))
            k += 1
    rows += [(k, None, "en", "a"), (k + 1, "x " * 20000, "en", "c"), (3, "again and again", "en", "b"),
             (None, "no id here", "en", "c")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_targets_sizes_and_bounds(spark, rows, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_SHARD", 50)
    got = mixing.mix(brute.documents(spark, rows, extra=True), docs_per_shard=50).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = brute.mix_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        ranges = [(x.start, x.end) for x in r.extra]
        assert all(0 <= a < b <= r.size for a, b in ranges)
        assert all(b <= c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        assert r.taken == r.passes * r.size + sum(b - a for a, b in ranges)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 2 * mixing.BLOCK_WORDS), s
    again = mixing.mix(brute.documents(spark, rows).repartition(7), docs_per_shard=50).collect()
    key = lambda r: (r.doc_id if r.doc_id is not None else -1, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_apportion_is_highest_quotients(spark):
    r = random.Random(5)
    rows = []
    for g in range(12):
        votes = {i: float(r.choice([0, 1, 3, r.randrange(1, 2000), 5, 5])) for i in range(r.randint(1, 14))}
        seats = r.randrange(0, 200) if any(votes.values()) else 0
        rows += [(g, i, v, seats) for i, v in votes.items()]
    got = mixing.apportion(spark.createDataFrame(rows, "g long, i long, votes double, seats long"),
                           ["g"], "i", "votes", "seats").collect()
    for g in range(12):
        votes = {i: v for k, i, v, _ in rows if k == g}
        seats = next(s for k, _, _, s in rows if k == g)
        assert {x.i: x.quota for x in got if x.g == g} == brute.sainte_lague(votes, seats), g


def test_taken_texts_hold_the_taken_words(spark, rows):
    docs = brute.documents(spark, [r for r in rows if r[0] not in (None, 3)], extra=True)
    plan = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.taken_texts(docs)
    assert out.columns == docs.columns
    words = dict.fromkeys(plan, 0)
    for r in out.collect():
        words[r.doc_id] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert words == plan


def test_single_source_empty_texts_and_empty_table(spark):
    one = mixing.mix(brute.documents(spark, [(1, "a b c", "en", "s")])).collect()
    assert [(r.size, r.target, r.taken) for r in one] == [(3, 4.5, one[0].taken)] and one[0].taken in (3, 6)
    nothing = mixing.mix(brute.documents(spark, [(1, None, "en", "s"), (2, "", "en", None)])).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(brute.documents(spark, [])).count() == 0


def test_many_sources_without_a_window_of_all(spark, monkeypatch):
    # 3,000 sources, one of them most of the documents, and joins that split keys of over 20 rows.
    monkeypatch.setattr("landroll.operators.joins.ROWS_PER_SALT", 20)
    r = random.Random(2)
    rows = [(i, "w " * r.randrange(60), "en", f"s{i}") for i in range(3000)]
    rows += [(10_000 + i, "w " * r.randrange(60), "en", "hot") for i in range(3000)]
    docs = brute.documents(spark, rows)
    mixed = mixing.mix(docs, docs_per_shard=20)
    got = mixed.collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = brute.mix_targets(sizes)
    assert len(got) == len(rows) and all(x.target == pytest.approx(want[x.source]) for x in got)
    assert sum(x.taken for x in got) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)
    assert sum(x.taken for x in got if x.source == "hot") == pytest.approx(want["hot"], rel=0.02)
    # Words of one shard's documents are ordered in a window; no other window is left in the plan.
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "CartesianProduct" not in plan


def test_part_of_equal_shards_is_taken(spark):
    rows = [(i, "w " * 32, "en", "s") for i in range(2000)] + [(5000, "w " * 90_000, "en", "t")]
    got = mixing.mix(brute.documents(spark, rows), weights=(1, 5), share=1.0, docs_per_shard=100).collect()
    of_s = [x for x in got if x.source == "s"]
    assert 0 < sum(x.taken for x in of_s) < sum(x.size for x in of_s)
    assert all(x.taken <= 2 * x.size for x in got)
