"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text gets the model's leading blank mark, blanks become marks, and it is cut
into words at places that no piece of the vocabulary spans.  All words of a
batch that are not remembered yet are merged together (:func:`merge_words`):
their symbols lie in one flat array, a round finds the best pair rank of every
word by a segmented minimum, merges its occurrences from the left at once, and
closes the gaps; words without a pair leave.  Decoding joins the strings of
the ids; byte pieces are read as UTF-8.

Merging at once equals merging one by one unless a merge makes a new pair of
the same or a better rank with one of its neighbours: it would come before the
occurrences to its right.  Each round looks at those pairs, and a word with
one merges only up to it in that round.

A word whose rounds merge less than one symbol in ``SLOW_ROUND`` (runs of
thousands of blanks, very long words without a blank) is finished by a
priority queue with the same order of merges, so that the time for any text
is near linear in its length.

The model (a fixed file) is read on the driver and broadcast.  One pass over
the texts, no shuffle.  Defined results: a null or empty text has the end id
alone and decodes to an empty text; repeated rows are each encoded; an empty
table gives an empty result; a character that the vocabulary lacks becomes its
UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MARK = "▁"  # fixed value: the character that stands for a blank
NORMAL, CONTROL, BYTE = 1, 3, 6  # fixed values: kinds of pieces in a model file
OTHER = 1 << 21          # symbols from here on are characters that are no piece
MEMO_ENTRIES = 500_000   # words whose ids a worker remembers
SLOW_ROUND = 256
_NONE = np.iinfo(np.int64).max
_ROWS = 256              # documents per output batch


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


def load(model_path: str) -> dict:
    """Pieces, kinds and the table of mergeable pairs of a SentencePiece BPE model with byte fallback."""
    with open(model_path, "rb") as f:
        parts = list(_fields(f.read()))
    pieces, scores, kinds = [], [], []
    for entry in (dict(_fields(v)) for n, v in parts if n == 1):
        pieces.append(entry[1].decode())
        scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
        kinds.append(entry.get(3, NORMAL))
    training = dict(_fields(next(v for n, v in parts if n == 2)))
    normalizer = dict(_fields(next(v for n, v in parts if n == 3)))
    if (training.get(3, 1), training.get(35, 0), training.get(24, 0)) != (2, 1, 0):
        raise ValueError("not a BPE model with byte fallback and blanks in front of words")
    if normalizer.get(2) or (normalizer.get(3, 1), normalizer.get(4, 1), normalizer.get(5, 1)) != (1, 0, 1):
        raise ValueError("the model normalises texts beyond marking blanks")
    if set(kinds) - {NORMAL, 2, CONTROL, BYTE}:
        raise ValueError("the model has user-defined or unused pieces")

    normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}

    def symbol(s: str) -> int | None:
        return normal.get(s, OTHER + ord(s) if len(s) == 1 else None)

    places = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
    keys, ranks, joined = [], [], []
    for p, i in normal.items():
        for cut in range(1, len(p)):
            left, right = symbol(p[:cut]), symbol(p[cut:])
            if left is not None and right is not None:
                keys.append(left << 22 | right)
                ranks.append(places[scores[i]])
                joined.append(i)
    order = np.argsort(keys)
    return {"pieces": pieces, "kinds": kinds, "normal": normal, "end": pieces.index(training.get(47, b"</s>").decode()),
            "bytes": [pieces.index(f"<0x{b:02X}>") for b in range(256)],
            "keys": np.array([*np.array(keys, np.int64)[order], _NONE]),
            "ranks": np.array([*np.array(ranks, np.int64)[order], _NONE]),
            "joined": np.array([*np.array(joined, np.int64)[order], -1])}


class Pairs:
    """Which pairs of symbols merge, into what, and in which order."""

    def __init__(self, model: dict):
        self.keys, self.ranks, self.joined = model["keys"], model["ranks"], model["joined"]
        self.missing = len(self.keys) - 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the table for each pair; the last row if it is no piece."""
        key = left << 22 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, self.missing)

    @cache
    def table(self) -> dict[int, tuple[int, int]]:
        """Rank and merged symbol by pair."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.joined.tolist())))


def _cut_at_hazards(chosen: np.ndarray, word: np.ndarray, hazard: np.ndarray) -> np.ndarray:
    """The chosen positions of each word up to and with its first hazard."""
    before = np.cumsum(hazard) - hazard
    owner = word[chosen]
    first = np.maximum.accumulate(np.where(np.r_[True, owner[1:] != owner[:-1]], np.arange(len(owner)), 0))
    return chosen[before == before[first]]


def merge_words(symbols: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merge the words that lie one after another in ``symbols``; (symbols, lengths) after their last merge."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    which = np.full(len(symbols), pairs.missing)
    inner = np.flatnonzero(word[1:] == word[:-1])
    which[inner] = pairs.find(symbols[inner], symbols[inner + 1])
    ready: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(word)])
        rank = pairs.ranks[which]
        best = np.minimum.reduceat(rank, starts)
        over = np.repeat(best == _NONE, sizes)
        if over.any():
            ready.append((word[over], symbols[over]))
            best = np.repeat(best, sizes)[~over]
            word, symbols, which, rank = word[~over], symbols[~over], which[~over], rank[~over]
            if not len(symbols):
                break
        else:
            best = np.repeat(best, sizes)
        # From the left, occurrences that share a symbol with the one before are passed over.
        at = np.flatnonzero(rank == best)
        place = np.arange(len(at))
        run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], place, 0))
        at = at[(place - run) % 2 == 0]
        new = pairs.joined[which[at]]
        # New pairs with the neighbours, as they are when the merges are made one by one.
        left = symbols[at - 1]
        touching = np.flatnonzero(np.diff(at) == 2) + 1
        left[touching] = np.where(word[at[touching] - 1] == word[at[touching]], new[touching - 1], left[touching])
        after = np.minimum(at + 2, len(word) - 1)
        has_left = (at > 0) & (word[at - 1] == word[at])
        has_right = (at + 2 < len(word)) & (word[after] == word[at])
        hazard = (has_left & (pairs.ranks[pairs.find(left, new)] <= best[at])
                  | has_right & (pairs.ranks[pairs.find(new, symbols[after])] <= best[at]))
        if hazard.any():
            at = _cut_at_hazards(at, word, hazard)
            new = pairs.joined[which[at]]
        slow = len(at) * SLOW_ROUND < len(symbols)
        symbols[at] = new
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols, word, which = symbols[kept], word[kept], which[kept]
        changed = at - np.arange(len(at))
        changed = np.unique(np.r_[changed, changed[changed > 0] - 1])
        last = (changed + 1 == len(word)) | (word[changed] != word[np.minimum(changed + 1, len(word) - 1)])
        which[changed[last]] = pairs.missing
        changed = changed[~last]
        which[changed] = pairs.find(symbols[changed], symbols[changed + 1])
        if slow:
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for part, owner in zip(np.split(symbols, starts[1:]), word[starts]):
                done = np.array(_by_queue(part.tolist(), pairs), np.int64)
                ready.append((np.full(len(done), owner), done))
            break
    words = np.concatenate([w for w, _ in ready]) if ready else np.empty(0, np.int64)
    out = np.concatenate([s for _, s in ready]) if ready else np.empty(0, np.int64)
    return out[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))


def _by_queue(symbols: list[int], pairs: Pairs) -> list[int]:
    """The merges of one word, one by one: best rank first, then leftmost."""
    table = pairs.table()
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int, k: int) -> None:
        found = table.get(symbols[i] << 22 | symbols[k])
        if found:
            heapq.heappush(queue, (found[0], i, symbols[i], symbols[k]))

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, i, left, right = heapq.heappop(queue)
        k = after[i]
        if symbols[i] != left or k >= n or symbols[k] != right:
            continue
        symbols[i] = table[left << 22 | right][1]
        symbols[k] = -1
        after[i] = after[k]
        if after[i] < n:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: dict):
        self.pairs, self.end = Pairs(model), model["end"]
        self.bytes, self.kinds, self.pieces = model["bytes"], model["kinds"], model["pieces"]
        normal = model["normal"]
        self.symbol = np.arange(0x110000, dtype=np.int64) + OTHER
        joining = set()
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
            else:
                joining.update(p)
        # No piece goes on over a mark, and characters of no longer piece stand alone.
        if any(MARK in p.lstrip(MARK) for p in normal):
            self.cut = re.compile(r"(?s).+")
        else:
            letters = "".join(map(re.escape, sorted(joining - {MARK})))
            self.cut = re.compile(f"{MARK}*[{letters}]+|{MARK}+|[^{MARK}{letters}]+")
        self.memo: dict[str, bytes] = {}
        # Control pieces have no text; the unknown piece is never made with byte fallback, but can be decoded.
        self.strings = [p.replace(MARK, " ").encode() if k == NORMAL else b"" if k == CONTROL else b" \xe2\x81\x87 "
                        for p, k in zip(self.pieces, self.kinds)]
        for b, i in enumerate(self.bytes):
            self.strings[i] = bytes([b])
        self.control = np.array(self.kinds) == CONTROL

    def learn(self, words: list[str]) -> None:
        """Remember the ids of ``words``."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols, sizes = merge_words(self.symbol[points], lengths, self.pairs)
        ends = np.cumsum(sizes).tolist()
        odd = set(np.repeat(np.arange(len(words)), sizes)[symbols >= OTHER].tolist())
        flat = symbols.astype(np.int32)
        start = 0
        for k, (w, end) in enumerate(zip(words, ends)):
            if k in odd:
                ids = array("i")
                for s in symbols[start:end].tolist():
                    ids.extend([s] if s < OTHER else [self.bytes[b] for b in chr(s - OTHER).encode()])
                self.memo[w] = ids.tobytes()
            else:
                self.memo[w] = flat[start:end].tobytes()
            start = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, the end id last."""
        cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        unknown = {w for words in cut for w in words if w not in self.memo}
        if unknown:
            self.learn(sorted(unknown))
        ids_of, end = self.memo.__getitem__, np.int32(self.end).tobytes()
        return [np.frombuffer(b"".join(map(ids_of, words)) + end, np.int32) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        split = self.control[ids[:-1]].any()  # a control piece between bytes ends their run
        ids = ids.tolist()
        try:
            text = self._decode_runs(ids) if split else b"".join(map(self.strings.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        return text[1:] if first is not None and self.pieces[first].startswith(MARK) else text

    def _decode_runs(self, ids: list[int]) -> str:
        """As :meth:`decode`, with a replacement character for every byte that is no part of a character."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                run += self.strings[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if _one_character(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                del run[:size or 1]
            if i is not None:
                out.append(self.strings[i].decode())
        return "".join(out)


def _one_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def encode_decode(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document with ``ids`` (array<int>, the end id last) and ``decoded``.

    ``decoded`` is made from the ids alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model_path))
    kept = [f for f in docs.schema.fields if f.name in keep]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A reused worker keeps its broadcast values, and so this codec and its memo.
        codec = shared.value.get("codec") or shared.value.setdefault("codec", Codec(shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                ids = codec.encode(batch.column(0).to_pylist())
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                decoded = pa.array([codec.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists, decoded],
                                                 [*[f.name for f in kept], "ids", "decoded"])

    return (docs.select(text_or_empty().alias("__text"), *[F.col(f.name) for f in kept])
            .mapInArrow(run, f"{fields}ids array<int>, decoded string"))


def decode_ids(rows: DataFrame, model_path: str) -> DataFrame:
    """``rows`` (doc_id, ids) as doc_id and the decoded text; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = [codec.decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")
