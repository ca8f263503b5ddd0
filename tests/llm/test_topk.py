import math

import numpy as np

from landroll.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in good:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)}
    return out


def run(spark, rows):
    v = topk.quantised(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))
    return topk.top_k(v, v.where("vec_id % 50 = 0"), 5)


def test_matches_brute_force_with_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 5)
    g = np.random.default_rng(1)
    rows = [(i, [float(x) for x in g.normal(0, 0.2, 8)]) for i in range(700)]
    same = rows[3][1]
    rows = [(i, same if i % 3 == 0 else v) for i, v in rows]    # a third of the vectors is one
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (None, same)]
    got = run(spark, rows).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_fewer_candidates_than_k_and_short_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5]), (2, [])]
    assert {tuple(r) for r in run(spark, rows).collect()} == {(0, 1, 1, 256 * 128), (0, 2, 2, 0)}


def test_empty_table_and_no_query(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [(7, [1.0])]).count() == 0


def test_pruning_skips_blocks_whose_bound_is_below_the_kth_score():
    g = np.random.default_rng(0)
    blocks = []
    for b in range(20):
        w = g.integers(0, 10, (32, 16)) + (100 if b == 5 else 0)
        blocks.append((np.arange(b * 32, b * 32 + 32), w, w.max(axis=0), w.min(axis=0)))
    q = g.integers(1, 5, (3, 16))
    _, vec, score, scored = topk.search_shard(np.array([-1, -2, -3]), q, blocks, 5)
    assert scored == 3                                   # one block per query was enough
    assert set(vec // 32) == {5}
    every = q @ np.concatenate([b[1] for b in blocks]).T
    assert sorted(score, reverse=True)[:1] == [every.max()]


def test_large_components_stay_exact():
    big = 1 << 30
    x = np.array([[big, 1], [big, 2], [big, 0]])
    blocks = [(np.array([1, 2, 3]), x, x.max(axis=0), x.min(axis=0))]
    _, vec, score, _ = topk.search_shard(np.array([0]), np.array([[big, 1]]), blocks, 2)
    assert list(vec) == [2, 1] and list(score) == [big * big + 2, big * big + 1]


def test_rows_that_repeat_the_querys_id_take_no_candidates_place(spark):
    # Ten high rows of the query's id stand in one block with the 6 candidates.
    rows = [(i, [float(i)]) for i in range(1, 7)] + [(50, [9.0])] * 10
    got = run(spark, rows).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 6), (2, 5), (3, 4), (4, 3), (5, 2)]


def test_repeated_ids_with_different_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    g = np.random.default_rng(2)
    v = topk.quantised(spark.createDataFrame(
        [(i // 8, [float(x) for x in g.normal(0, 0.2, 4)], 1) for i in range(600)], SCHEMA))
    rows = [(r.vec_id, r.v) for r in v.collect()]
    want = set()
    for q, a in rows:
        if q == 50:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:5]
            want |= {(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)}
    got = topk.top_k(v, v.where("vec_id = 50"), 5).collect()
    assert {tuple(r) for r in got} == want and len(got) == 40
