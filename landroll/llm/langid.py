"""Language identification: the family first, then one-versus-one linear SVMs.

A text is a vector of hashed byte trigrams (letters lower-cased, other ASCII
characters as blanks), square-rooted and scaled to length 1.  Linear support
vector machines between each two families vote for the family; machines
between each two languages of that family vote for the language.

Learning uses a bounded sample: the ``docs_per_lang`` documents of each
language that come first by a seeded hash among those the caller allows.  It
is picked from ids alone, its vectors (``DIMENSIONS`` floats a document) are
all that reaches the driver, and the machines are broadcast.  Prediction is
one pass without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score
0, and so is everything if nothing could be learned; with one language learned
all other texts are that language; rows that repeat are each predicted; a null
doc_id is not held out and not learned from; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

DIMENSIONS = 4096
DOCS_PER_LANG = 300
SEED = 29
UNKNOWN = "und"

# Families of ISO 639-1 languages; any other language is a
# family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nb nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "indo-aryan": "bn gu hi mr ne pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg mi ms su tl",
}

_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE = 1 << 20
_ROWS = 256


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def vector(text: bytes) -> np.ndarray:
    counts = np.zeros(DIMENSIONS, np.int64)
    padded = b" " + text.translate(_LETTERS) + b" "
    for at in range(0, len(padded) - 2, _PIECE):
        a = np.frombuffer(padded, np.uint8, min(_PIECE + 2, len(padded) - at), at).astype(np.uint32)
        code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
        code = code[(a[:-2] != 32) | (a[1:-1] != 32)]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    v = np.sqrt(counts, dtype=np.float32)
    return v / max(1e-9, float(np.linalg.norm(v)))


def _vectors(column: pa.Array) -> np.ndarray:
    return np.stack([vector(t.as_py().encode("utf-8", "surrogatepass")) for t in column])


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear SVM (squared hinge, accelerated gradient); y is +1 or -1.

    The weights stay combinations of the rows, so the steps are made on the
    rows' coefficients with their matrix of inner products.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    inner = x @ x.T
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    y = y.astype(np.float32)
    step = 1 / (4 + l2)  # rows have length sqrt(2) and the shares sum to 1
    a = momentum = np.zeros(len(x), np.float32)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (inner @ momentum))
        new = momentum - step * (l2 * momentum - 2 * share * slack * y)
        momentum = new + k / (k + 3) * (new - a)
        a = new
    w = a @ x
    return w[:-1].astype(np.float32), float(w[-1])


def fit_pairs(x: np.ndarray, names: np.ndarray) -> dict:
    """One machine for each two of the names."""
    classes = sorted(set(names))
    pairs = list(combinations(range(len(classes)), 2))
    weights, offsets = np.zeros((len(pairs), x.shape[1]), np.float32), np.zeros(len(pairs), np.float32)
    for k, (a, b) in enumerate(pairs):
        own = (names == classes[a]) | (names == classes[b])
        weights[k], offsets[k] = fit_svm(x[own], np.where(names[own] == classes[a], 1.0, -1.0))
    return {"classes": classes, "pairs": pairs, "weights": weights, "offsets": offsets}


def vote(machines: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winning class number and confidence (0 to 1) per row; ties go to the larger sum of margins."""
    n, classes = len(x), machines["classes"]
    if len(classes) == 1:
        return np.zeros(n, int), np.ones(n)
    margins = x @ machines["weights"].T + machines["offsets"]
    votes, sums = np.zeros((n, len(classes))), np.zeros((n, len(classes)))
    weakest = np.full((n, len(classes)), np.inf)
    for k, (a, b) in enumerate(machines["pairs"]):
        m = margins[:, k]
        votes[:, a] += m >= 0
        votes[:, b] += m < 0
        for c, own in ((a, m), (b, -m)):
            sums[:, c] += own
            weakest[:, c] = np.minimum(weakest[:, c], own)
    best = np.argmax(votes + 0.5 * (1 + np.tanh(sums / len(classes))) * 0.999, axis=1)
    return best, 1 / (1 + np.exp(-3 * weakest[np.arange(n), best]))


def fit(docs: DataFrame, allowed: Column, docs_per_lang: int = DOCS_PER_LANG, seed: int = SEED) -> dict:
    """Machines of the families and of the languages within each."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    picked = (docs.where(allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
              .select("lang", "doc_id", F.xxhash64(F.lit(seed), "doc_id").alias("h"))
              .withColumn("rank", rank).where(F.col("rank") <= docs_per_lang)
              .select("lang", "doc_id").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                packed = [v.tobytes() for v in _vectors(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(packed, pa.binary())],
                                                 ["lang", "doc_id", "v"])

    # The picked ids are at most docs_per_lang a language; rows that repeat one count once.
    rows = (docs.select("lang", F.col("doc_id").cast("string").alias("id"), "doc_id", text_or_empty().alias("text"))
            .where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(picked), ["lang", "doc_id"])
            .select("lang", "text", "id").mapInArrow(run, "lang string, doc_id string, v binary")
            .groupBy("lang", "doc_id").agg(F.min("v").alias("v")).select("lang", "v").collect())
    if not rows:
        return {}
    rows.sort(key=lambda r: (r.lang, bytes(r.v)))
    x = np.stack([np.frombuffer(r.v, np.float32) for r in rows])
    langs = np.array([r.lang for r in rows], object)
    families = np.array([family_of(x) for x in langs], object)
    return {"families": fit_pairs(x, families),
            "langs": {f: fit_pairs(x[families == f], langs[families == f]) for f in sorted(set(families))}}


def predict(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name in keep]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def predicted(column: pa.Array) -> tuple[list[str], list[float]]:
        machines = shared.value
        x = _vectors(column)
        family, sure = vote(machines["families"], x)
        names, scores = np.empty(len(x), object), np.zeros(len(x))
        for k, f in enumerate(machines["families"]["classes"]):
            own = np.flatnonzero(family == k)
            if len(own):
                inner = machines["langs"][f]
                best, confidence = vote(inner, x[own])
                names[own] = np.array(inner["classes"], object)[best]
                scores[own] = sure[own] * confidence
        return list(names), [float(s) for s in scores]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
                lettered = [i for i, x in enumerate(batch.column(1).to_pylist()) if x]
                if lettered and shared.value:
                    for i, name, score in zip(lettered, *predicted(batch.column(0).take(pa.array(lettered)))):
                        names[i], scores[i] = name, score
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[2:], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*[f.name for f in kept], "lang_pred", "score"])

    return (docs.select(text_or_empty().alias("__text"), text_or_empty().rlike(r"\p{L}").alias("__lettered"),
                        *[F.col(f.name) for f in kept])
            .mapInArrow(run, f"{fields}lang_pred string, score double"))


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo 3; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
