"""Phrase collocations by best-first branch-and-bound growth.

A phrase is a run of words inside a piece of text; ``f`` counts its
occurrences in a language.  A candidate has 2 to ``LONGEST`` words and at
least ``MIN_COUNT`` occurrences; its score is that of its worst cut into two
parts.  :func:`top_phrases` finds each language's best phrases that no longer
candidate covers, without counting all longer phrases:

1. words are counted, then pairs of frequent words, which gives the scores of
   all candidates of two words;
2. a prefix p with first word w bounds every phrase that grows from it: such a
   phrase occurs a <= f(p) times, cut after w it has l = f(w) and r >= a, so
   its score is at most 2,000,000 f(p) / (f(w) + f(p)), and the bounds of
   longer prefixes are no larger;
3. each language starts with a threshold near the score of its
   ``FIRST``-th best pair.  Prefixes are grown by a word if their bound
   reaches the threshold; phrases whose score reaches it are also extended on
   both sides, to see whether a longer candidate covers them.  So every
   candidate at or above the threshold is known, with its fate;
4. if as many survive there as are asked for, the language is settled, ties
   included: everything that was not grown is below.  Otherwise its threshold
   falls to the score of the pair ``STEP`` times as far down, finally to 0.

A phrase that covers another one contains a phrase, one word longer than that,
that covers it as well: one word is enough for the test.

*Passes.*  A pass over the texts counts phrases of one length.  Each task turns
words into numbers and counts about ``CHUNK`` bytes of text at a time with numpy,
and sends (language, phrase, count).  What a pass may count is given to the
tasks as bit tables of phrase hashes, of a fixed ``2 ** BITS`` bits whatever the
input: a false hit adds a phrase that is counted rightly and not needed, a phrase
in the table is never missed.  Counts, joins and scores are on the phrases themselves.

Defined results: a null language is ``und``; a null or empty text has no words;
repeated rows count each; a language with fewer phrases has fewer rows, an empty
table none; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landroll.operators.joins import salted_join

from .common import staged, text_or_empty

# Fixed values of the task.
MIN_COUNT = 30
LONGEST = 4
SCALE = 2_000_000
COVERED = (100, 80)  # a phrase is covered if 100 f(longer) >= 80 f(phrase)

FIRST, STEP = 4, 4       # pairs down to the first threshold, in units of the rows asked for; factor of the next one
BITS = 26                # bits of a table of phrase hashes: 8 MB
CHUNK = 12 << 20         # bytes of text that a task counts at a time
_ROWS = 50_000
_BREAK = 2
_KIND = np.zeros(256, np.uint8)  # kind of each byte: of a word, blank between words, end of a piece
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\v\f\r")] = _BREAK
_KEY = ["lang", "phrase"]


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and of that word."""
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right
    return mixed ^ (mixed >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


class Bits:
    """A set of phrase hashes in a table of fixed size; it may hold more, never less."""

    def __init__(self, words: np.ndarray | None = None):
        self.words = np.zeros(1 << (BITS - 6), np.uint64) if words is None else words

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ((hashes >> np.uint64(6)) & np.uint64(len(self.words) - 1)).astype(np.int64), hashes & np.uint64(63)

    def add(self, hashes: np.ndarray) -> None:
        at, bit = self._place(hashes)
        np.bitwise_or.at(self.words, at, np.uint64(1) << bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at, bit = self._place(hashes)
        return (self.words[at] >> bit) & np.uint64(1) != 0


def _bits(phrases: DataFrame) -> Broadcast:
    """Table of the hashes of (lang, phrase): made in parts by the tasks, which send their words that are not 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Bits()
        for batch in batches:
            groups = defaultdict(list)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups[lang].append(phrase.encode().split(b" "))
            for lang, rows in groups.items():
                columns = [_word_hashes(lang, list(c)) for c in zip(*rows)]
                hashes = columns[0]
                for c in columns[1:]:
                    hashes = _mix(hashes, c)
                table.add(hashes)
        at = np.flatnonzero(table.words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table.words[at].view(np.int64))], ["at", "bits"])

    parts = phrases.select(*_KEY).mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    rows = parts.toArrow()
    table = Bits()
    table.words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(table.words)


@dataclass
class Want:
    """Which phrases of ``order`` words a pass counts.

    Pairs: both words are in the table ``within``.  Longer phrases: all their
    pairs are in ``within``, and the phrase without its last word is in
    ``first`` or the phrase without its first word in ``last``.
    """

    order: int
    within: Broadcast | None = None
    first: Broadcast | None = None
    last: Broadcast | None = None

    def parts(self) -> list[tuple[int, np.ndarray]]:
        """Places inside a phrase whose word or pair must be in ``within``."""
        return [(k, self.within.value) for k in range(2 if self.order == 2 else self.order - 1)]


class _Words:
    """The words of one language in a chunk of text, as numbers in text order."""

    def __init__(self, lang: str, texts: list[bytes]):
        data = np.frombuffer(b".".join([*texts, b""]).lower(), np.uint8)
        kind = _KIND[data]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]).dictionary_encode()
        opens = np.zeros(len(starts) + 1, np.int32)
        opens[np.searchsorted(starts, np.flatnonzero(kind == _BREAK))] = 1
        self.lang = lang
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.cumsum(opens[:-1])
        self.words = coded.dictionary.to_pylist()

    @cached_property
    def hashes(self) -> np.ndarray:
        return _word_hashes(self.lang, self.words)

    def _hash(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases of ``length`` words that start at ``at``."""
        h = self.hashes[self.ids[at]]
        for k in range(1, length):
            h = _mix(h, self.hashes[self.ids[at + k]])
        return h

    def _places(self, want: Want) -> np.ndarray:
        """Where a phrase stands that ``want`` admits."""
        last = want.order - 1
        at = np.flatnonzero(self.piece[:len(self.piece) - last] == self.piece[last:])
        for k, table in want.parts():
            if want.order == 2:
                at = at[Bits(table).has(self.hashes)[self.ids[at + k]]]
            else:
                at = at[Bits(table).has(self._hash(at + k, 2))]
        if want.first is not None:
            admitted = Bits(want.first.value).has(self._hash(at, last))
            if want.last is not None:
                admitted |= Bits(want.last.value).has(self._hash(at + 1, last))
            at = at[admitted]
        return at

    def counts(self, want: Want) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Phrases that ``want`` admits and how often they occur, ``_ROWS`` at a time."""
        size = len(self.words)
        if want.order == 1:
            yield [*self.words, b""], np.append(np.bincount(self.ids, minlength=size), len(self.ids))
            return
        at = self._places(want)
        if want.order == 2:
            pairs, counts = np.unique(self.ids[at] * size + self.ids[at + 1], return_counts=True)
            columns = [pairs // size, pairs % size]
        else:
            code = self.ids[at]
            for k in range(1, want.order):
                _, first, code, counts = np.unique(code * size + self.ids[at + k], return_index=True,
                                                   return_inverse=True, return_counts=True)
            columns = [self.ids[at[first] + k] for k in range(want.order)]
        for k in range(0, len(counts), _ROWS):
            parts = [map(self.words.__getitem__, c[k:k + _ROWS].tolist()) for c in columns]
            yield list(map(b" ".join, zip(*parts))), counts[k:k + _ROWS]


def count_phrases(docs: DataFrame, *wants: Want) -> DataFrame:
    """lang, phrase, a of the phrases that a want admits and that occur ``MIN_COUNT`` times.

    A pass over single words also gives every language's number of words, as the count of the empty phrase.
    """
    def flush(texts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang in list(texts):
            words = _Words(lang, texts.pop(lang))
            for want in wants:
                for phrases, counts in words.counts(want):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                         pa.array(counts.astype(np.int64))], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: defaultdict[str, list[bytes]] = defaultdict(list)
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                pending[lang].append(text)
                size += len(text)
                if size >= CHUNK:
                    yield from flush(pending)
                    size = 0
        yield from flush(pending)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().cast("binary").alias("text"))
    return (rows.mapInArrow(run, "lang string, phrase string, n long").groupBy(*_KEY)
            .agg(F.sum("n").alias("a")).where((F.col("a") >= MIN_COUNT) | (F.col("phrase") == "")))


def _ratio(a: Column, l: Column, r: Column) -> Column:
    """floor(SCALE * a / (l + r)), exactly."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                           l.cast("decimal(20,0)") + r.cast("decimal(20,0)"))


def _part(first: int, length: int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first + 1, length), " ")


def _scored(rows: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``rows`` (lang, phrase, a) with the score, l and r of the worst cut, and the bound of what grows from them.

    ``counts`` has the counts of all parts; a phrase with a part that it lacks is left out.
    """
    cuts = range(1, order)
    parts = F.array(*[F.struct(F.lit(2 * k + side).alias("which"), part.alias("part")) for k in cuts
                      for side, part in ((0, _part(0, k)), (1, _part(k, order - k)))])
    asked = rows.select(*_KEY, "a", F.inline(parts))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    found = salted_join(asked, known, ["lang", "part"], "inner", salt_cols=["phrase", "which"])
    wide = found.groupBy(*_KEY, "a").agg(*[F.max(F.when(F.col("which") == 2 * k + side, F.col("f"))).alias(f"{name}{k}")
                                           for k in cuts for side, name in ((0, "l"), (1, "r"))])
    worst = F.array_min(F.array(*[F.struct(_ratio(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"),
                                           F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
                                  for k in cuts]))
    whole = [F.col(f"{name}{k}").isNotNull() for k in cuts for name in "lr"]
    for c in whole:
        wide = wide.where(c)
    return (wide.withColumn("w", worst)
            .select(*_KEY, "a", "w.l", "w.r", "w.score", _ratio(F.col("a"), F.col("l1"), F.col("a")).alias("bound")))


def _thresholds(pairs: DataFrame, rank: int) -> DataFrame:
    """lang and the score of its ``rank``-th best pair, 0 if it has fewer."""
    totals = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    upto = totals.withColumn("n", F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("score").desc())))
    return upto.groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("n") >= rank, F.col("score"))), F.lit(0)).alias("threshold"))


def _at_least(rows: DataFrame, thresholds: DataFrame, column: str) -> DataFrame:
    """``rows`` of the languages in ``thresholds`` whose ``column`` reaches the threshold."""
    return salted_join(rows, thresholds, ["lang"], "inner", salt_cols=["phrase"]).where(F.col(column) >= F.col("threshold"))


def _uncovered(candidates: DataFrame, longer: DataFrame, order: int) -> DataFrame:
    """``candidates`` of ``order`` words that no phrase of one word more covers."""
    inside = longer.select("lang", F.explode(F.array(_part(0, order), _part(1, order))).alias("phrase"), "a")
    most = inside.groupBy(*_KEY).agg(F.max("a").alias("_most"))
    scale, share = COVERED
    covered = (F.col("_most").cast("decimal(20,0)") * scale) >= F.col("a").cast("decimal(20,0)") * share
    return (candidates.join(most, _KEY, "left").where(~F.coalesce(covered, F.lit(False))).drop("_most"))


def _candidates(docs: DataFrame, words: DataFrame, pairs: DataFrame, all_pairs: Broadcast,
                thresholds: DataFrame) -> DataFrame:
    """Every candidate at or above its language's threshold that no longer one covers."""
    def frontier(rows: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
        """Rows whose bound reaches the threshold, and those whose score does."""
        growing = staged(_at_least(rows, thresholds, "bound"), f"phrases-{order}-growing")
        return growing, growing.where("score >= threshold")  # no score is above the bound

    growing, two = frontier(pairs, 2)
    triples = staged(count_phrases(docs, Want(3, all_pairs, _bits(growing), _bits(two))), "phrases-3")
    parts = words.unionByName(pairs.select(*_KEY, "a"))
    growing, three = frontier(staged(_scored(triples, parts, 3), "phrases-3-scored"), 3)
    # The cut of four words after the first needs the last three, which may not be counted yet: they begin with
    # the last two of a triple that grows.
    begins = growing.select("lang", _part(1, 2).alias("phrase")).distinct()
    more = staged(count_phrases(docs, Want(4, all_pairs, _bits(growing), _bits(three)), Want(3, all_pairs, _bits(begins))),
                  "phrases-4")
    quads = more.where(F.size(F.split("phrase", " ")) == 4)
    all_triples = more.where(F.size(F.split("phrase", " ")) == 3).unionByName(triples).distinct()
    four = _at_least(_scored(quads, parts.unionByName(all_triples), 4), thresholds, "score")
    found = _uncovered(two, triples, 2).unionByName(_uncovered(three, quads, 3)).unionByName(four.select(*two.columns))
    return found.select(*_KEY, "a", "l", "r", "score", "threshold")


def top_phrases(docs: DataFrame, limit: int = 2000) -> DataFrame:
    """Each language's ``limit`` best phrases: lang, rank, phrase, a, l, r, n, score."""
    counted = staged(count_phrases(docs, Want(1)), "phrases-1")
    words, totals = counted.where("phrase <> ''"), counted.where("phrase = ''").select("lang", F.col("a").alias("n"))
    pairs = staged(count_phrases(docs, Want(2, _bits(words))), "phrases-2")
    pairs = staged(_scored(pairs, words, 2), "phrases-2-scored")
    all_pairs = _bits(pairs)
    rank = FIRST * limit
    open_langs = staged(_thresholds(pairs, rank), "phrases-thresholds")
    done = None
    while not open_langs.isEmpty():
        found = staged(_candidates(docs, words, pairs, all_pairs, open_langs), "phrases-found")
        survivors = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        settled = (open_langs.join(survivors, "lang", "left")
                   .where((F.col("threshold") == 0) | (F.col("n") >= limit)).select("lang"))
        best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        top = (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
               .withColumn("rank", F.col("rank").cast("long")).join(settled, "lang", "left_semi").drop("threshold"))
        done = staged(top if done is None else done.unionByName(top), "phrases-done")
        rank *= STEP
        open_langs = staged(_thresholds(pairs, rank).join(open_langs.join(settled, "lang", "left_anti").select("lang"),
                                                         "lang", "left_semi"), "phrases-thresholds")
    if done is None:
        return totals.limit(0).selectExpr("lang", "n as rank", "'' as phrase", "n as a", "n as l", "n as r", "n",
                                          "n as score")
    return done.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
