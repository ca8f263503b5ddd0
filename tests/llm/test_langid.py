import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from landroll.llm import langid

rng = random.Random(2)
# Frequent words of three languages.
WORDS = {"en": "the and of that with this from have which there".split(),
         "de": "der und nicht sich auch eine werden haben über schön".split(),
         "fr": "les des une dans pour avec être même était où".split()}


def text(lang, n=30):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    return [(i, text(("en", "de", "fr")[i % 3]), ("en", "de", "fr")[i % 3]) for i in range(240)]


def run(spark, docs):
    model = langid.fit(docs, langid.remainder() != 1)
    return model, langid.predict(docs, model).collect()


def test_held_out_accuracy_and_odd_texts(spark, rows):
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 ... !", "de"), (903, text("de", 20000), None),
           (904, "Ä", "de"), (None, text("fr"), "fr"), (5, text("fr"), "fr")]
    _, got = run(spark, brute.documents(spark, rows + odd, extra=True))
    assert len(got) == len(rows) + len(odd)
    by_id = {}
    for r in got:
        assert 0 <= r.score <= 1
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(by_id[i][0].lang_pred == lang for i, _, lang in rows if i != 5)
    assert all((by_id[i][0].lang_pred, by_id[i][0].score) == ("und", 0.0) for i in (900, 901, 902))
    assert by_id[903][0].lang_pred == "de" and by_id[904][0].lang_pred in WORDS and by_id[None][0].lang_pred == "fr"


def test_learning_never_sees_held_out_or_unlabelled_rows(spark, rows):
    docs = brute.documents(spark, rows)
    wrong = docs.withColumn("lang", F.when(langid.remainder() == 1, "xx").otherwise(F.col("lang")))
    model, _ = run(spark, wrong)
    same, _ = run(spark, docs)
    assert np.array_equal(model["families"]["weights"], same["families"]["weights"])
    assert "xx" not in model["langs"]


def test_family_first_then_one_versus_one(spark, rows):
    model, _ = run(spark, brute.documents(spark, rows))
    assert model["families"]["classes"] == ["germanic", "romance"]
    assert model["langs"]["germanic"]["classes"] == ["de", "en"] and model["langs"]["romance"]["classes"] == ["fr"]
    assert langid.family_of("pt-BR") == "romance" and langid.family_of("tlh") == "tlh"


def test_one_or_no_language_and_empty_table(spark, rows):
    _, got = run(spark, brute.documents(spark, [r for r in rows if r[2] == "en"]))
    assert {r.lang_pred for r in got} == {"en"}
    model, got = run(spark, brute.documents(spark, [(i, t, None) for i, t, _ in rows[:5]]))
    assert model == {} and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert run(spark, brute.documents(spark, []))[1] == []


def test_svm_separates_and_votes_are_deterministic():
    g = np.random.default_rng(0)
    x = g.normal(0, 1, (90, 20)).astype(np.float32)
    names = np.array(["a", "b", "c"] * 30, object)
    for k in range(3):
        x[names == "abc"[k], k] += 8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    machines = langid.fit_pairs(x, names)
    best, score = langid.vote(machines, x)
    assert (np.array(machines["classes"], object)[best] == names).mean() > 0.98
    assert ((score >= 0) & (score <= 1)).all()
