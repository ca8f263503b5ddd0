"""Exact substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  The minimiser of a
window is the smallest hash of its word ``MER``-grams; consecutive windows
with one minimiser travel as one string (a super-k-mer) to the bucket of that
minimiser, so equal windows always meet and words are sent about three times
instead of twenty.  In a bucket the windows are sorted by a hash of their
words; equal neighbours are compared word for word, and every one but those
that start earliest (smaller doc_id, then earlier start) is repeated.

Skew: equal super-k-mers of a map task's chunk are sent once, for their
earliest place, and the others are known to be repeated on the spot, so a
passage that a third of all documents share costs one row per chunk.  MER-grams
that are frequent in a bounded sample of documents rank after all others as
minimisers, so that common phrases with changing surroundings gather no hot
bucket; this changes where windows meet, never the result.  The number of
buckets follows the size of the corpus; the strings of a chunk for one bucket
are one compressed row.

Defined results: a null text has no words; a document of fewer words than a
window loses nothing; rows with equal doc_id and start (repeated rows) are
equally early and keep each other; a null doc_id comes after all others; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

WINDOW = 20
MER = 3
BUCKET_BYTES = 8 << 20      # of super-k-mers in a bucket, about
CHUNK_BYTES = 8 << 20       # of text whose super-k-mers are packed together
SAMPLE_DOCS = 1_000         # documents in which frequent MER-grams are looked for
HOT_SHARE = 0.005           # of the sample's documents that hold a frequent MER-gram
HOT_MERS = 4_096
SEED = 5

_LAST = (1 << 63) - 1       # stands for a null doc_id
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 200_000          # words of a document handled at a time


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total = total * _STEP + h[i:len(h) - n + 1 + i]
    return _mixed(total)


def _sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def runs(words: list[bytes], hot: np.ndarray, window: int = WINDOW, mer: int = MER) -> tuple[np.ndarray, ...]:
    """(first window, last window, minimiser) of the super-k-mers of a sequence of at least ``window`` words."""
    grams = _grams(_word_hashes(words), mer)
    frequent = np.zeros(len(grams), bool)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        frequent = hot[at] == grams
    ranked = (grams >> np.uint64(1)) | (frequent.astype(np.uint64) << np.uint64(63))
    least = _sliding_min(ranked, window - mer + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return first, np.append(first[1:], len(least)) - 1, least[first]


class _Chunk:
    """Super-k-mers of a map task, packed by bucket."""

    def __init__(self, n_buckets: int, window: int):
        self.n_buckets, self.window = n_buckets, window
        self.clear()

    def clear(self) -> None:
        self.bytes = 0
        self.places: dict[bytes, tuple[int, int, int, int]] = {}  # text -> (doc, start, mark, words)
        self.buckets: dict[bytes, int] = {}
        self.equal: list[tuple[bytes, int, tuple[int, int, int, int]]] = []
        self.repeated: list[tuple[int, int, int, int]] = []       # (doc, mark, start, end)

    def add(self, text: bytes, bucket: int, doc: int, start: int, mark: int, n_words: int) -> None:
        place = (doc, start, mark, n_words)
        known = self.places.get(text)
        if known is None:
            self.places[text] = place
            self.buckets[text] = bucket
        elif known[:2] == place[:2]:
            # Rows of one doc_id: equally early.  Ranges belong to (doc, mark), so equal rows need no second place.
            if known[2] != mark:
                self.equal.append((text, bucket, place))
        else:
            early, late = (known, place) if known[:2] < place[:2] else (place, known)
            self.places[text] = early
            self.repeated.append((late[0], late[2], late[1], late[1] + late[3]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[tuple[bytes, tuple[int, int, int, int]]]] = {}
        for text, bucket in self.buckets.items():
            by_bucket.setdefault(bucket, []).append((text, self.places[text]))
        for text, bucket, place in self.equal:
            by_bucket.setdefault(bucket, []).append((text, place))
        pack = zstandard.ZstdCompressor(level=3).compress

        def packed(rows: list[tuple[int, int, int, int]]) -> bytes:
            return pack(np.array(rows, np.int64).T.tobytes())

        out = [(b, pack(b"\n".join([t for t, _ in found])), packed([x for _, x in found]))
               for b, found in by_bucket.items()]
        if self.repeated:  # nothing left to compare: they only pass through, evenly dealt
            out.append((-1 - min(self.repeated)[0] % self.n_buckets, None, packed(self.repeated)))
        for at in range(0, len(out), 256):
            part = list(zip(*out[at:at + 256]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in
                                              zip(part, (pa.int64(), pa.binary(), pa.binary()))],
                                             ["bucket", "texts", "places"])
        self.clear()


def _chunks(docs: DataFrame, n_buckets: int, hot: np.ndarray, window: int, mer: int) -> DataFrame:
    """(bucket, texts, places): packed super-k-mers; without texts, ranges already known to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(n_buckets, window)
        for batch in batches:
            for doc, mark, text in zip(*batch.columns):
                doc, mark = doc.as_py(), mark.as_py()
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                for at in range(0, max(0, len(words) - window + 1), _SEGMENT):
                    part = words[at:at + _SEGMENT + window - 1]
                    joined = b" ".join(part)
                    lengths = np.fromiter(map(len, part), np.int64, len(part))
                    ends = np.cumsum(lengths + 1) - 1
                    starts = ends - lengths
                    first, last, minimiser = runs(part, hot, window, mer)
                    bucket = (_mixed(minimiser) % np.uint64(n_buckets)).tolist()
                    for b, s, e, x, y in zip(bucket, first.tolist(), last.tolist(), starts[first].tolist(),
                                             ends[last + window - 1].tolist()):
                        chunk.add(joined[x:y], b, doc, at + s, mark, e - s + window)
                    chunk.bytes += len(joined)
                    if chunk.bytes >= CHUNK_BYTES:
                        yield from chunk.rows()
        yield from chunk.rows()

    return docs.mapInArrow(run, "bucket long, texts binary, places binary")


def repeated_windows(texts: list[bytes], places: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """(doc, mark, start, end) of the word ranges of a bucket covered by repeated windows.

    ``places`` has doc, start, mark and number of words of each super-k-mer.
    """
    words = b" ".join(texts).split()
    counts = places[3]
    h = _word_hashes(words)
    n = len(words)
    hashes = _grams(h, window)
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = owner[:n - window + 1] == owner[window - 1:]
    at = np.flatnonzero(inside)                                    # first word of each window
    own = owner[at]
    offset = at - (np.cumsum(counts) - counts)[own]
    doc, start = places[0][own], places[1][own] + offset
    order = np.lexsort((start, doc, hashes[at]))
    sorted_hashes = hashes[at][order]
    new = np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]])
    leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]        # earliest window of the same hash
    later = (doc[order] != doc[leader]) | (start[order] != start[leader])
    members, leaders = order[later], leader[later]
    late = np.zeros(len(at), bool)
    unlike = []
    for m, i, j in zip(members.tolist(), at[members].tolist(), at[leaders].tolist()):
        if words[i:i + window] == words[j:j + window]:
            late[m] = True
        else:
            unlike.append(m)
    if unlike:  # hashes that agree by chance: compare those windows among themselves
        clash = np.flatnonzero(np.isin(hashes[at], hashes[at][unlike]))
        clash = clash[np.lexsort((start[clash], doc[clash]))]
        earliest: dict[tuple[bytes, ...], tuple[int, int]] = {}
        for m in clash.tolist():
            place = (int(doc[m]), int(start[m]))
            late[m] = earliest.setdefault(tuple(words[at[m]:at[m] + window]), place) != place
    hit = np.flatnonzero(late)
    if not len(hit):
        return [np.empty(0, np.int64)] * 4
    begins = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (own[hit[1:]] != own[hit[:-1]])])
    ends = np.append(begins[1:], True)
    a, b = hit[begins], hit[ends]
    return [doc[a], places[2][own[a]], start[a], start[b] + window]


def repeated_ranges(docs: DataFrame, window: int = WINDOW, mer: int = MER) -> DataFrame:
    """(doc, mark, start, end): word ranges of repeated windows of ``docs`` (doc, mark, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A super-k-mer run is (w + 1) / 2 windows of w = window - mer + 1 candidate MER-grams on average.
    spread = (window - 1 + (window - mer + 2) / 2) / ((window - mer + 2) / 2)
    n_buckets = max(1, round(size * spread / BUCKET_BYTES))

    def count(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        places = np.concatenate([np.frombuffer(unpack(p), np.int64).reshape(4, -1)
                                 for p in table.column("places").to_pylist()], axis=1)
        if table.column("bucket")[0].as_py() < 0:
            found = list(places)
        else:
            texts = [t for packed in table.column("texts").to_pylist() for t in unpack(packed).split(b"\n")]
            found = repeated_windows(texts, places, window)
        return pa.table(dict(zip(("doc", "mark", "start", "end"), found)))

    return (_chunks(docs, n_buckets, _frequent_mers(docs, mer), window, mer)
            .groupBy("bucket").applyInArrow(count, "doc long, mark long, start long, end long"))


def _frequent_mers(docs: DataFrame, mer: int) -> np.ndarray:
    """Sorted hashes of the MER-grams that many documents of a bounded sample hold."""
    picked = (docs.select("doc", "mark").distinct()
              .orderBy(F.xxhash64(F.lit(SEED), "doc"), "doc", "mark").limit(SAMPLE_DOCS))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                found = np.unique(_grams(_word_hashes(words), mer))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["gram"])

    least = max(3, round(SAMPLE_DOCS * HOT_SHARE))
    rows = (docs.join(F.broadcast(picked), ["doc", "mark"]).select("text").mapInArrow(grams, "gram long")
            .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
            .orderBy(F.col("n").desc(), "gram").limit(HOT_MERS).collect())
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, window: int = WINDOW, mer: int = MER) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document; kept words are joined by one blank."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # The mark tells rows of one doc_id with different texts apart.
    keyed = named.withColumn("doc", F.coalesce("doc_id", F.lit(_LAST))).withColumn("mark", F.xxhash64("text"))
    ranges = (repeated_ranges(keyed.select("doc", "mark", "text"), window, mer)
              .groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "end")).alias("ranges")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                totals, removed, kept = [], [], []
                for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
                    words = text.as_py().encode("utf-8", "surrogatepass").split()
                    n = len(words)
                    if found:
                        gone = np.zeros(n + 1, np.int64)
                        for r in found:
                            gone[r["start"]] += 1
                            gone[r["end"]] -= 1
                        stay = np.cumsum(gone[:-1]) == 0
                        words = [w for w, s in zip(words, stay.tolist()) if s]
                    totals.append(n)
                    removed.append(n - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return (keyed.join(ranges.hint("merge"), ["doc", "mark"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string"))
