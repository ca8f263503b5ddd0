import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from landroll.llm import simhash

rng = random.Random(3)
VOCAB = [f"w{i}" for i in range(400)]


def text(n=80):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def near(t):
    w = t.split()
    w[rng.randrange(len(w))] = "Changed"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    base = text(300)
    out = [base] * 5 + [near(base) for _ in range(25)] + [text(rng.randint(1, 60)) for _ in range(40)]
    out += ["", None, "   \n", "one", "One", "two words", "A b C", "a  b\tc", "é x y", "É x y", text(20000)]
    rng.shuffle(out)
    return list(enumerate(out, 7))


def test_fingerprint_is_the_majority_of_shingle_hashes(rows):
    for _, t in rows:
        assert simhash.fingerprint((t or "").encode()) == brute.simhash(t)


def test_components_match_brute_force(spark, rows):
    got = simhash.near_duplicates(brute.documents(spark, rows, extra=True)).collect()
    want = brute.components(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{brute.simhash(t):016x}" for i, t in rows}
    assert len(got) == len(rows)


def test_links_of_random_close_fingerprints(spark):
    r = random.Random(1)
    fps = []
    for _ in range(60):
        f = r.getrandbits(64)
        for _ in range(r.randint(1, 6)):
            fps.append(f)
            for _ in range(r.randint(0, 3)):
                f ^= 1 << r.randrange(64)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    root = {x.node: x.root for x in simhash.components(simhash.links(df)).collect()}
    same = {f: root.get(f, f) for f in signed}
    parent = {f: f for f in signed}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, x in zip(fps, signed):
        for b, y in zip(fps, signed):
            if (a ^ b).bit_count() <= 2 and find(x) != find(y):
                parent[find(x)] = find(y)
    groups = {}
    for f in signed:
        groups.setdefault(find(f), set()).add(f)
    for g in groups.values():
        assert {same[f] for f in g} == {min(g)}


def test_large_listing_finds_neighbours_without_pairs():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 16, 3000).astype(np.uint64))
    flips = simhash._flips(list(range(16)), 2)
    member, root = simhash._listing_links(values, flips, 2)
    small = simhash._PAIRWISE
    try:
        simhash._PAIRWISE = 1 << 20
        again = simhash._listing_links(values, flips, 2)
    finally:
        simhash._PAIRWISE = small
    assert (member == again[0]).all() and (root == again[1]).all()


def test_chain_of_many_nodes_is_one_component(spark):
    edges = [(i, i + 1) for i in range(-40, 40)]
    random.Random(2).shuffle(edges)
    got = simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.root for r in got} == {-40} and len(got) == 80


def test_one_of_each_keeps_the_named_row(spark, rows):
    df = brute.documents(spark, rows + [(500, "x y z q"), (500, "x y z q"), (None, "x y z q")], extra=True)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    got = [r.doc_id for r in kept.collect()]
    want = brute.components(rows)
    assert sorted(got) == sorted({*want.values(), 500})


def test_one_of_each_with_repeated_and_missing_ids(spark, monkeypatch):
    monkeypatch.setattr("landroll.operators.joins.ROWS_PER_SALT", 10)
    texts = [" ".join(f"{c}{i}{j}" for i in range(30)) for j, c in enumerate("abcde")]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[1]), (None, texts[2]), (None, texts[3])]
    rows += [(None, texts[2])] * 95 + [(7, texts[4])] * 120 + [(3, texts[0]), (8, None), (9, ""), (8, "")]
    random.Random(4).shuffle(rows)
    got = simhash.one_of_each(brute.documents(spark, rows, extra=True).repartition(9)).collect()
    # Two texts of id 1, one row of each text without id, one of the empty texts.
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        [(1, texts[0]), (1, texts[1]), (0, texts[2]), (0, texts[3]), (7, texts[4]), (8, "")])


def test_empty_table_and_null_ids(spark):
    assert simhash.near_duplicates(brute.documents(spark, [])).count() == 0
    got = simhash.near_duplicates(brute.documents(spark, [(None, "a b c"), (4, "a b c"), (None, "q r s t")])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(None, 4), (4, 4), (None, None)}


def test_no_collect_of_documents_in_the_plan(spark, rows):
    plan = simhash.near_duplicates(brute.documents(spark, rows))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert F is not None
