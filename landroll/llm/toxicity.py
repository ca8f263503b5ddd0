"""Toxicity by cumulative-link ordinal regression on sparse term features.

P(severity > k) = sigmoid(w . x - theta_k) for the ordered thresholds
theta_0 < theta_1 < ..., all sharing the weights w; the output is the
expected severity, the sum of these probabilities.  x holds log(1 + count) of
the terms (runs of letters, lower-cased).

Labels only say toxic or not, so grades are derived: 0 for a clean document;
toxic ones are cut at the quantiles of how many strongly toxic terms (log-odds
of document frequency above ``STRONG``) they hold into ``GRADES`` grades.

The model is fitted on a bounded sample: the ``sample_docs`` labelled ids that
come first by a seeded hash (their list is broadcast), and the ``vocabulary``
terms of it that tell the classes apart best.  The driver sees the sample's
features of those terms only.  Prediction is one pass over all whole texts
without a shuffle.

Defined results: a null or empty text has no features and the severity of the
bare thresholds; a document labelled twice is toxic if any label says so;
without toxic or without clean labelled documents nothing can be learned and
all severities are 0; repeated rows are each scored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty

GRADES = 3
SAMPLE_DOCS = 12_000
VOCABULARY = 4_096
MIN_DOCS = 5            # labelled documents that hold a term of the vocabulary
STRONG = 2.0
L2 = 2e-5
ROUNDS = 400
SEED = 11

TERM = re.compile(r"[^\W\d_]+")


def _terms(text: str) -> Counter:
    return Counter(TERM.findall(text.lower()))


def _sample(docs: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame:
    """(toxic, terms: array<struct<term, n>>) of the labelled sample."""
    picked = (labels.where("doc_id is not null and toxic is not null")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int32())]))
        for batch in batches:
            lists = [[{"term": t, "n": n} for t, n in sorted(_terms(x.as_py()).items())] for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()),
                                              pa.array(lists, kind)], ["doc_id", "toxic", "terms"])

    return staged(docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
                  .select("doc_id", "toxic", "text")
                  .mapInArrow(run, "doc_id long, toxic int, terms array<struct<term: string, n: int>>"),
                  "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, vocabulary: int = VOCABULARY,
        grades: int = GRADES) -> dict:
    """{"weights": {term: w}, "thresholds": [theta_0, ...]}; empty if nothing can be learned."""
    sample = _sample(docs, labels, sample_docs)
    n_clean, n_toxic = sample.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not n_clean or not n_toxic:
        return {}
    in_toxic, in_clean = F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)
    odds = F.log((F.col("in_toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("in_clean") + 0.5) / (n_clean + 1))
    chosen = (sample.select("toxic", F.explode("terms.term").alias("term"))
              .groupBy("term").agg(in_toxic.alias("in_toxic"), in_clean.alias("in_clean"))
              .where(F.col("in_toxic") + F.col("in_clean") >= MIN_DOCS)
              .select("term", odds.alias("odds"),
                      (F.abs(odds) * F.sqrt(F.col("in_toxic") + F.col("in_clean"))).alias("gain"))
              .orderBy(F.col("gain").desc(), "term").limit(vocabulary))
    terms = {r.term: (i, r.odds) for i, r in enumerate(sorted(chosen.collect()))}
    if not terms:
        return {}
    number = {t: i for t, (i, _) in terms.items()}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [[(known[t["term"]], t["n"]) for t in row if t["term"] in known]
                     for row in batch.column(2).to_pylist()]
            cells = [np.array(f, np.int32).reshape(-1, 2).T.tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.binary())],
                                             ["doc_id", "toxic", "features"])

    # Packed (term number, count) pairs: a few MB for the whole sample, one row per id however often it repeats.
    rows = sorted(sample.select("doc_id", "toxic", "terms")
                  .mapInArrow(packed, "doc_id long, toxic int, features binary")
                  .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("features").alias("features")).collect())
    features = [np.frombuffer(r.features, np.int32).reshape(2, -1) for r in rows]
    is_strong = np.zeros(len(terms), bool)
    is_strong[[i for i, odds in terms.values() if odds > STRONG]] = True
    row_of = np.repeat(np.arange(len(rows)), [f.shape[1] for f in features])
    column, count = np.concatenate(features, axis=1)
    strong = np.bincount(row_of, count * is_strong[column], len(rows))
    toxic = np.array([r.toxic for r in rows]) == 1
    cuts = np.quantile(strong[toxic], [k / grades for k in range(1, grades)], method="lower")
    grade = np.where(toxic, 1 + np.searchsorted(cuts, strong, side="left"), 0)
    weights, thresholds = fit_ordinal(row_of, column, np.log1p(count), grade, len(terms), grades)
    return {"weights": {t: float(weights[i]) for t, (i, _) in terms.items()}, "thresholds": list(map(float, thresholds))}


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, n_terms: int,
                grades: int = GRADES, l2: float = L2, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model, by Adam.

    The thresholds are theta_0 and theta_0 plus sums of exp(gap), so they stay in order.
    """
    n = len(grade)
    p = np.zeros(n_terms + grades)
    p[n_terms] = 2.0
    mean, spread = np.zeros_like(p), np.zeros_like(p)
    ends = np.arange(n)
    for k in range(1, rounds + 1):
        w, gaps = p[:n_terms], np.exp(p[n_terms + 1:])
        theta = p[n_terms] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, value * w[column], n)
        above = 1 / (1 + np.exp(-np.clip(eta[:, None] - theta, -30, 30)))   # P(severity > k)
        edge = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        high, low = edge[ends, grade], edge[ends, grade + 1]
        prob = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high) / prob, low * (1 - low) / prob
        d_eta = (slope_low - slope_high) / n
        d_theta = np.zeros(grades + 2)
        np.add.at(d_theta, grade, slope_high / n)
        np.add.at(d_theta, grade + 1, -slope_low / n)
        d_theta = d_theta[1:-1]
        later = np.cumsum(d_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(column, value * d_eta[row], n_terms) + l2 * w, [later[0]], later[1:] * gaps])
        mean = 0.9 * mean + 0.1 * g
        spread = 0.99 * spread + 0.01 * g * g
        p = p - 0.08 * (mean / (1 - 0.9 ** k)) / (np.sqrt(spread / (1 - 0.99 ** k)) + 1e-8)
    return p[:n_terms], p[n_terms] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_terms + 1:]))])


def severity(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document with expected severity, grade and toxic.

    grade is the most probable one, toxic whether P(severity > 0) is at least a half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name in keep]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value.get("weights", {})
        theta = np.array(shared.value.get("thresholds", []))
        for batch in batches:
            eta = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(0)):
                found = Counter(filter(weight.__contains__, TERM.findall(text.as_py().lower())))
                eta[i] = sum(weight[t] * math.log1p(n) for t, n in found.items())
            above = 1 / (1 + np.exp(-np.clip(eta[:, None] - theta, -30, 30)))
            edge = np.hstack([np.ones((len(eta), 1)), above, np.zeros((len(eta), 1))])
            grade = np.argmax(edge[:, :-1] - edge[:, 1:], axis=1)
            toxic = above[:, 0] >= 0.5 if len(theta) else np.zeros(len(eta), bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(above.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(toxic)],
                [*[f.name for f in kept], "severity", "grade", "toxic"])

    return (docs.select(text_or_empty().alias("__text"), *[F.col(f.name) for f in kept])
            .mapInArrow(run, f"{fields}severity double, grade int, toxic boolean"))
