"""Byte-level BPE encoding and decoding.

A text is cut at the tokenizer's added tokens, at blanks into chunks, and each
of these into pre-tokens unless it is a known one; the bytes of a pre-token form
a doubly linked list of symbols, and a priority queue of (merge rank, position)
yields the next merge, entries that no longer match their symbols being skipped
(:func:`merge`).  Decoding concatenates the byte strings of the ids.  Encodings
of pre-tokens are remembered in a bounded table, and a worker process keeps it
for its next tasks.

The vocabulary (tens of thousands of entries, a fixed file) is read on the
driver from ``tokenizer_path`` and broadcast.  The job is one pass over the
texts without a shuffle; very long texts are bounded by their own length only.

Defined results: a null text is empty and has no ids; repeated rows are each
encoded; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Fixed value: the pre-token pattern of byte-level BPE tokenizers.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

# Characters with the property White_Space, as a class of re (whose own \s has four more).
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A text cut where PRE_TOKEN always cuts too: before a blank and, but for one space, after it.
CHUNK = rf" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"

# Letters and numbers of Unicode 16, the version of the tokenizers library, that Python's tables lack.
UNICODE_16 = """1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d40-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e
    11390-113b5 113b7 113d1 113d3 116d0-116e3 11bc0-11be0 11bf0-11bf9 13460-143fa 16100-1611d 16130-16139 16d40-16d6c
    16d70-16d79 18cff 1ccf0-1ccf9 1e5d0-1e5ed 1e5f0-1e5fa"""

MEMO_ENTRIES = 500_000  # pre-tokens whose encodings a worker remembers
PAIR_BITS = 20          # more bits than the largest id has
_ROWS = 256             # documents per output batch


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, inverted.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def later_letters() -> str:
    """Letters and numbers of the regex package that the tokenizers library does not know yet, being newer."""
    known = set()
    for item in UNICODE_16.split():
        first, _, last = item.partition("-")
        known.update(range(int(first, 16), int(last or first, 16) + 1))
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn" and ord(c) not in known)


def without(pattern: str, letters: str) -> str:
    """``pattern`` with the classes of letters and numbers less ``letters``."""
    if not letters:
        return pattern
    points = sorted(map(ord, letters))
    starts = [c for k, c in enumerate(points) if k == 0 or points[k - 1] != c - 1]
    ends = [c for k, c in enumerate(points) if k + 1 == len(points) or points[k + 1] != c + 1]
    ranges = "".join(f"{chr(first)}-{chr(last)}" for first, last in zip(starts, ends))
    other, letter, number = r"[^\p{White_Space}\p{L}\p{N}]", r"\p{L}+", r"\p{N}+"
    return (pattern.replace(other, f"(?:{other}|[{ranges}])").replace(f"{letter}|", f"(?:(?![{ranges}])\\p{{L}})+|")
            .replace(f"{number}|", f"(?:(?![{ranges}])\\p{{N}})+|"))


def load(tokenizer_path: str) -> dict:
    """Vocabulary, merge ranks and added tokens of a byte-level BPE file."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    ids = {raw(token): i for token, i in spec["model"]["vocab"].items()}
    ranks, joined = {}, []
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
        ranks.setdefault(ids[left] << PAIR_BITS | ids[right], rank)
        joined.append(ids[left + right])
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [b""] * (1 + max([*ids.values(), *added.values()]))
    for token, i in [*ids.items(), *((t.encode(), i) for t, i in added.items())]:
        strings[i] = token
    return {"later": later_letters(), "first": [ids[bytes([b])] for b in range(256)], "ranks": ranks, "joined": joined, "added": added,
            "strings": strings}


def merge(piece: bytes, first: list[int], ranks: dict[int, int], joined: list[int]) -> tuple[int, ...]:
    """The ids of one pre-token.

    A queue entry is the rank and, in its low bits, the position of the left
    symbol.  ``pairs`` has the rank of the pair that now starts at a position;
    an entry of another rank is stale and skipped.  The symbol after the last,
    and one that was merged into its left neighbour, is -1, which no pair has.
    """
    symbols = [first[b] for b in piece]
    n = len(symbols)
    rank_of = ranks.get
    pairs = [rank_of(left << PAIR_BITS | right) for left, right in zip(symbols, symbols[1:])]
    bits = n.bit_length()  # short pieces have small entries
    queue = [rank << bits | i for i, rank in enumerate(pairs) if rank is not None]
    if not queue:
        return tuple(symbols)
    symbols.append(-1)
    pairs.append(None)
    before, after = list(range(-1, n)), list(range(1, n + 2))
    push, pop, low = heapq.heappush, heapq.heappop, (1 << bits) - 1
    heapq.heapify(queue)
    while queue:
        entry = pop(queue)
        left, rank = entry & low, entry >> bits
        if pairs[left] != rank:
            continue
        right = after[left]
        new = symbols[left] = joined[rank]
        symbols[right] = -1
        pairs[right] = None
        following = after[left] = after[right]
        before[following] = left
        rank = pairs[left] = rank_of(new << PAIR_BITS | symbols[following])
        if rank is not None:
            push(queue, rank << bits | left)
        previous = before[left]
        if previous >= 0:
            rank = pairs[previous] = rank_of(symbols[previous] << PAIR_BITS | new)
            if rank is not None:
                push(queue, rank << bits | previous)
    return tuple([s for s in symbols if s >= 0])


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, vocabulary: dict):
        self.tables = vocabulary["first"], vocabulary["ranks"], vocabulary["joined"]
        self.added, self.strings = vocabulary["added"], vocabulary["strings"]
        self.pieces = regex.compile(PRE_TOKEN)
        self.chunks = re.compile(CHUNK)
        # Only a chunk with a letter or number that is too new takes the classes without those.
        self.newer = set(vocabulary["later"])
        self.pinned = regex.compile(without(PRE_TOKEN, vocabulary["later"]))
        # The longest added token wins where several start.
        names = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.memo: dict[str, tuple[int, ...]] = {}

    def learn(self, piece: str) -> tuple[int, ...]:
        ids = merge(piece.encode("utf-8"), *self.tables)
        if len(piece) <= 64:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[piece] = ids
        return ids

    def unknown(self, chunk: str) -> tuple[int, ...] | list[int]:
        """The ids of a chunk that is no known pre-token."""
        if chunk.removeprefix(" ").isalpha():
            return self.learn(chunk)
        pieces = self.pieces if chunk.isascii() or self.newer.isdisjoint(chunk) else self.pinned
        out: list[int] = []
        for piece in pieces.findall(chunk):
            out.extend(self.memo.get(piece) or self.learn(piece))
        return out

    def encode(self, text: str) -> array:
        out: list[int] = []
        extend, known, unknown = out.extend, self.memo.get, self.unknown
        parts = self.cut.split(text) if self.cut else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
                continue
            for chunk in self.chunks.findall(part):
                extend(known(chunk) or unknown(chunk))
        return array("i", out)

    def decode(self, ids: array) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document with ``ids`` (array<int>) and ``decoded``.

    ``decoded`` is made from the ids alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))
    kept = [f for f in docs.schema.fields if f.name in keep]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A reused worker keeps its broadcast values, and so this codec and its memo.
        codec = shared.value.get("codec") or shared.value.setdefault("codec", Codec(shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                flat, ends, decoded = array("i"), [0], []
                for text in batch.column(0):
                    ids = codec.encode(text.as_py())
                    flat.extend(ids)
                    ends.append(len(flat))
                    decoded.append(codec.decode(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                 pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists, pa.array(decoded, pa.string())],
                                                 [*[f.name for f in kept], "ids", "decoded"])

    return (docs.select(text_or_empty().alias("__text"), *[F.col(f.name) for f in kept])
            .mapInArrow(run, f"{fields}ids array<int>, decoded string"))


def decode_ids(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """``rows`` (doc_id, ids) as doc_id and the decoded text; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(load(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = [codec.decode(array("i", ids.as_py() or [])) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")
