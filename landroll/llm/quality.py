"""Quality rules: simple counts, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed character-shape 4-grams are estimated: one of the
whole raw corpus (every document, whole texts) and one of trusted documents.
The shape of a text writes a for small and non-ASCII letters, A for capitals,
0 for digits and a blank for white space; other ASCII characters stay.  So the
ratio speaks of form (symbol noise, tabular debris, shouting) in any language,
also one that the trusted sample lacks.  A document scores the mean over its
4-grams of log p_trusted - log p_raw; it is kept if the base rules pass it and
the score is at least ``threshold``.  Text of the trusted kind scores near
zero; what trusted text lacks falls far below.

The trusted multinomial is fitted on a bounded sample of labelled rows: the
``trusted_docs`` documents of label quality = 1 that come first by a seeded
hash.  Everything else covers all documents.  The bounded list of trusted ids
is broadcast; per-task bucket counts are the only thing shuffled.

Defined results: a null text has no words and fails the base rules; rows that
repeat a doc_id are each judged by their own text and never multiply; without
a single trusted document both multinomials are the raw one (score 0, kept if
the base rules pass); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

N_BUCKETS = 1 << 16
THRESHOLD = -0.5        # nats per 4-gram
TRUSTED_DOCS = 20_000   # bound of the labelled sample
SMOOTHING = 1.0
SEED = 17
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5

_PIECE = 1 << 20        # bytes hashed at a time, so that memory stays bounded
_SHAPE = bytes(ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57
               else ord(" ") if b in b" \t\n\r\f\v" else b for b in range(256))


def _buckets(text: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of the shape 4-grams of a text (with a blank at both ends)."""
    padded = b" " + text.translate(_SHAPE) + b"  "
    for at in range(0, len(padded) - 3, _PIECE):
        a = np.frombuffer(padded, np.uint8, min(_PIECE + 3, len(padded) - at), at).astype(np.uint32)
        yield ((((a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:]) * np.uint32(2654435761))
               >> np.uint32(16))


def _encoded(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield (value.as_py() or "").encode("utf-8", "surrogatepass")


def corpus_counts(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(bucket, raw, trusted) 4-gram counts over all documents."""
    flagged = (docs.select("doc_id", text_or_empty().alias("text"))
               .join(F.broadcast(trusted_ids.select("doc_id", F.lit(True).alias("trusted"))), "doc_id", "left")
               .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, N_BUCKETS), np.int64)
        for batch in batches:
            for text, trusted in zip(_encoded(batch.column(0)), batch.column(1).to_pylist()):
                for buckets in _buckets(text):
                    found = np.bincount(buckets, minlength=N_BUCKETS)
                    counts[0] += found
                    if trusted:
                        counts[1] += found
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[0, seen]),
                                          pa.array(counts[1, seen])], ["bucket", "raw", "trusted"])

    return (flagged.mapInArrow(count, "bucket int, raw long, trusted long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")))


def log_ratio(counts: DataFrame, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_trusted - log p_raw per bucket; at most ``N_BUCKETS`` rows reach the driver."""
    raw, trusted = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    for row in counts.collect():
        raw[row.bucket], trusted[row.bucket] = row.raw, row.trusted
    if not trusted.any():
        return np.zeros(N_BUCKETS)

    seen = np.count_nonzero(raw)  # every document to judge was counted, so no other bucket occurs

    def log_p(n: np.ndarray) -> np.ndarray:
        return np.log(n + smoothing) - np.log(n.sum() + smoothing * seen)

    return log_p(trusted) - log_p(raw)


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.split()
    n = len(words)
    # Code points are the bytes that do not continue a character.
    packed = np.frombuffer(b"".join(words), np.uint8)
    chars = int(np.count_nonzero((packed & 0xC0) != 0x80))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split()]
    repeated = 0
    if n >= REPEAT_WINDOW:
        windows = list(zip(*(words[i:] for i in range(REPEAT_WINDOW))))
        times = Counter(windows)
        if len(times) < len(windows):
            covered = np.zeros(n, bool)
            twice = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
            for i in range(REPEAT_WINDOW):
                covered[i:i + len(windows)] |= twice
            repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, trusted_docs: int = TRUSTED_DOCS,
          smoothing: float = SMOOTHING, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document with its counts, score and verdict."""
    spark = docs.sparkSession
    # An identifier labelled twice counts once; the broadcast list has at most trusted_docs ids.
    trusted = (labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
               .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(trusted_docs))
    shared = spark.sparkContext.broadcast(log_ratio(corpus_counts(docs, trusted), smoothing))
    kept = [f for f in docs.schema.fields if f.name in keep]
    source = docs.select(text_or_empty().alias("__text"), *[F.col(f.name) for f in kept])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = f"{fields}, {', '.join(f'{x} long' for x in numbers)}, base_failed boolean, score double, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            rows = []
            for text in _encoded(batch.column(0)):
                n, chars, symbols, dup_lines, repeated = base_counts(text)
                failed = n < 10 or 100 * repeated > 20 * n
                sums = [(float(ratio[b].sum()), len(b)) for b in _buckets(text)]
                score = sum(s for s, _ in sums) / max(1, sum(k for _, k in sums))
                rows.append((n, chars, symbols, dup_lines, repeated, failed, score,
                             not failed and score >= threshold))
            made = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array(c, k) for c, k in zip(made, kinds)]],
                [*[f.name for f in kept], *numbers, "base_failed", "score", "kept"])

    return source.mapInArrow(run, schema)
