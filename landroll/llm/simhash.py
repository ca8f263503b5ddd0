"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has bit b set if more than half of its shingle hashes
(XXH64, seed 42) have it set.  Two fingerprints that differ in at most d bits
agree on at least k - d of k equal blocks, so each fingerprint is listed under
every choice of k - d blocks and only fingerprints that share a listing are
compared; their true distance decides.

With k = 8 and d = 2 a listing fixes 48 of 64 bits: it holds at most 65,536
different fingerprints however many documents there are, so no listing grows
without bound.  Inside one, neighbours are looked up by flipping at most d of
the 16 free bits (never all pairs), and what leaves it is a spanning forest of
its links.  Equal fingerprints are one node from the start, so a group of
copies that holds a third of all documents is a single row here.  Components
of the links are found by alternating large and small stars; every round is a
table in the shared checkpoint folder.

Defined results: a null or empty text has no words and fingerprint zero; a
text of fewer words than a shingle is one shingle; rows that repeat a doc_id
are nodes of their own with the same id; a null doc_id is linked but never
names a component (a component of null ids only has a null component_id); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landroll.operators.joins import hot_keys, salted_join

from .common import staged, text_or_empty

SHINGLE = 3
MAX_BITS = 2
N_BLOCKS = 8
HASH_SEED = 42

_PIECE = 1 << 15        # shingles hashed at a time
_PAIRWISE = 128         # listings up to this size are compared as a matrix


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # on bytes, lower() changes A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - shingle + 1)
    last = starts[min(shingle, len(words)):]  # one past the blank that ends each shingle
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b - 1], HASH_SEED)
                         for a, b in zip(starts[at:min(at + _PIECE, n)], last[at:at + _PIECE])), np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, mark): the fingerprint as a signed long, and the text's 64-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py().encode("utf-8", "surrogatepass"), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), batch.column(2)],
                ["doc_id", "fp", "mark"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                        F.xxhash64(text_or_empty()).alias("mark"))
            .mapInArrow(run, "doc_id long, fp long, mark long"))


def _flips(bits: list[int], most: int) -> np.ndarray:
    """Every mask with 1 to ``most`` of the given bits set."""
    masks = [sum(1 << b for b in chosen) for n in range(1, most + 1) for chosen in combinations(bits, n)]
    return np.array(masks, np.uint64)


def _listing_links(values: np.ndarray, flips: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for members linked, directly or not, to a smaller one.

    ``values``: the different fingerprints of one listing, sorted.
    """
    n = len(values)
    if n <= _PAIRWISE:
        differ = np.bitwise_count(values[:, None] ^ values[None, :])
        left, right = np.nonzero(np.triu(differ <= most, 1))
    else:
        found = []
        for mask in flips:
            other = values ^ mask
            at = np.minimum(np.searchsorted(values, other), n - 1)
            hit = np.flatnonzero((values[at] == other) & (values < other))
            found.append((hit, at[hit]))
        left, right = (np.concatenate(x) for x in zip(*found))
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    linked = np.flatnonzero(root != np.arange(n))
    return values[linked], values[root[linked]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, n_blocks: int = N_BLOCKS) -> DataFrame:
    """(u, v): links whose closure is that of all pairs at ``max_bits`` or fewer bits.

    ``fps`` has a column fp of different fingerprints.
    """
    width = 64 // n_blocks
    blocks = [range(i * width, 64 if i == n_blocks - 1 else (i + 1) * width) for i in range(n_blocks)]
    choices = list(combinations(range(n_blocks), max_bits))  # the blocks left free
    free = [[b for i in chosen for b in blocks[i]] for chosen in choices]

    def fixed(bits: list[int]) -> Column:
        mask = ~sum(1 << b for b in bits) & (1 << 64) - 1
        return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))

    listed = fps.select("fp", F.posexplode(F.array(*[fixed(bits) for bits in free])).alias("choice", "block"))
    shared = (listed.groupBy("choice", "block").agg(F.collect_list("fp").alias("fps"))
              .where(F.size("fps") > 1).select("choice", "fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, np.ndarray] = {}
        for batch in batches:
            members, roots = [], []
            for choice, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                if choice not in flips:
                    flips[choice] = _flips(free[choice], max_bits)
                unsigned = np.sort(values.values.to_numpy(zero_copy_only=False).view(np.uint64))
                member, root = _listing_links(unsigned, flips[choice], max_bits)
                members.append(member)
                roots.append(root)
            if members:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (roots, members)], ["u", "v"])

    return shared.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots.

    The root is the smallest node of the component (as a signed long).
    """
    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]

    current = staged(edges.where("u <> v").select(*ordered("u", "v")).distinct(), "links")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(lowest, "u")
                 .select(F.col("m").alias("u"), "v").distinct())
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(lowest, "v")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("v").alias("v")),
                                           F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        current = staged(small, "links")
        state = tuple(current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            return current.select(F.col("v").alias("node"), F.col("u").alias("root"))
        seen = state


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (fp, ..., one row per fingerprint) with the root of its component."""
    roots = components(links(nodes.select("fp"), max_bits))
    return staged(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                  .select(*[nodes[c] for c in nodes.columns], F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document.

    component_id is the smallest doc_id that is reachable over fingerprints at
    ``max_bits`` or fewer differing bits.
    """
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes"), max_bits)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return (marked.join(by_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component: the smallest by (doc_id, fingerprint, text hash), no doc_id last.

    Rows of one doc_id with different texts are documents of their own, and so
    are rows without a doc_id.  Of rows that are alike in doc_id and text, the
    smallest by a hash of all columns stays.
    """
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("__no_id"), F.coalesce("doc_id", F.lit(0)).alias("__id"),
                     "fp", F.col("mark").alias("__mark"))
    nodes = staged(marked.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "nodes")
    first = F.min(F.struct("first", "n")).alias("kept")
    kept = staged(_rooted(nodes, max_bits).groupBy("root").agg(first)
                  .select("kept.first.__no_id", "kept.first.__id", "kept.first.__mark", F.col("kept.n").alias("_n")),
                  "kept")
    keys, columns = ["__no_id", "__id", "__mark"], list(docs.columns)
    keyed = docs.select("*", F.col("doc_id").isNull().alias("__no_id"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
                        F.xxhash64(text_or_empty()).alias("__mark"))
    # Texts meet ids by a merge join whatever the size: the ids are not broadcast.
    alone = keyed.join(kept.where("_n = 1").select(*keys).hint("merge"), keys, "left_semi").select(*columns)
    # A fingerprint of several rows may be that of equal ones.  Equal rows can be dealt to salts only by where they lie.
    copied = kept.where("_n > 1")
    found = salted_join(keyed.withColumn("__part", F.spark_partition_id()), copied.select(*keys), keys, "inner",
                        hot=hot_keys(copied, keys, "_n"), salt_cols=["__part"])
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    smallest = F.min_by(F.struct(*columns), F.xxhash64(*hashed)).alias("__row")
    return alone.unionByName(found.groupBy(*keys).agg(smallest).select("__row.*"))
