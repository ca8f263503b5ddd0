import random

import brute
import numpy as np
import pytest

from landroll.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
rng = random.Random(8)
BAD = ["idiot", "Scum", "worthless", "moron"]


def text(n_bad):
    w = [rng.choice(["sun", "moon", "tree", "river", "stone", "cloud", "über"]) for _ in range(60)]
    for _ in range(n_bad):
        w.insert(rng.randrange(len(w)), rng.choice(BAD) + rng.choice(["", ".", "###"]))
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    return [(i, text(0 if i % 4 else 2 + i % 3 * 4)) for i in range(400)]


@pytest.fixture(scope="module")
def labels(spark, rows):
    known = [(i, 1, int(i % 4 == 0)) for i, _ in rows if i % 2 == 0 or i % 5 == 0]
    return spark.createDataFrame(known + [(4, 1, 0), (None, 1, 1), (9999, 1, 1)], LABELS)


def test_held_out_documents_and_severity(spark, rows, labels):
    odd = [(900, None), (901, ""), (902, "Idiot " * 5000), (903, "no letters 123"), (1, "IDIOT scum!! worthless")]
    docs = brute.documents(spark, rows + odd, extra=True)
    model = toxicity.fit(docs, labels)
    assert list(model["thresholds"]) == sorted(model["thresholds"])
    got = toxicity.severity(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    seen = {}
    for r in got:
        assert 0 <= r.severity <= toxicity.GRADES and 0 <= r.grade <= toxicity.GRADES
        seen.setdefault(r.doc_id, []).append(r)
    assert all(seen[i][0].toxic == (i % 4 == 0) for i, _ in rows if i != 1)
    assert {r.toxic for r in seen[1]} == {True, False}
    assert not seen[900][0].toxic and seen[900][0].severity == seen[901][0].severity
    assert seen[902][0].toxic
    few = np.mean([seen[i][0].severity for i, t in rows if i % 4 == 0 and i % 3 == 0])
    many = np.mean([seen[i][0].severity for i, t in rows if i % 4 == 0 and i % 3 == 2])
    assert many > few


def test_gradient_is_that_of_the_likelihood():
    """One Adam-free check: the fitted model beats every small change of one threshold or weight."""
    g = np.random.default_rng(0)
    x = g.normal(0, 1, (200, 3))
    grade = np.clip(np.digitize(x @ [1.0, -0.5, 0.2] + g.logistic(0, 1, 200), [-0.5, 0.5, 1.5]), 0, 3)
    row, column = np.repeat(np.arange(200), 3), np.tile(np.arange(3), 200)
    w, theta = toxicity.fit_ordinal(row, column, x.ravel(), grade, 3, 3, l2=0.0, rounds=3000)

    def loss(w, theta):
        above = 1 / (1 + np.exp(-((x @ w)[:, None] - theta)))
        edge = np.hstack([np.ones((200, 1)), above, np.zeros((200, 1))])
        return -np.log(edge[np.arange(200), grade] - edge[np.arange(200), grade + 1]).mean()

    best = loss(w, theta)
    for k in range(3):
        for d in (-0.05, 0.05):
            assert loss(w + d * np.eye(3)[k], theta) > best - 1e-6
            assert loss(w, theta + d * np.eye(3)[k]) > best - 1e-6


def test_nothing_to_learn_and_empty_tables(spark, rows):
    docs = brute.documents(spark, rows[:6])
    for known in ([], [(0, 1, 1)], [(1, 1, 0)]):
        model = toxicity.fit(docs, spark.createDataFrame(known, LABELS))
        assert model == {}
        assert {(r.severity, r.toxic) for r in toxicity.severity(docs, model).collect()} == {(0.0, False)}
    empty = brute.documents(spark, [])
    assert toxicity.fit(empty, spark.createDataFrame([(1, 1, 1)], LABELS)) == {}
    assert toxicity.severity(empty, {}).count() == 0


def test_sample_is_bounded(spark, rows, labels):
    assert toxicity._sample(brute.documents(spark, rows), labels, 50).count() <= 50
