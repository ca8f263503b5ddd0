"""Prefix trie of conversations, with subtree totals by depth bands.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  :func:`rebuilt` gives every conversation
the head of its group's first conversation, :func:`prefixes` names the node of
every prefix, and :func:`trie` gives one row per node.

*Names.*  A node's name is its depth and two 52-bit sums, modulo 2^52, of
hashes of (role, text, position) over its turns: sums can be built in blocks
of a conversation, so a conversation of any length is never one group.  Among n
prefixes two different ones share a name with a chance below n^2 / 2^105.

*Totals.*  Depths are cut into bands of ``BAND``.  Every node adds its own
value to its ancestors inside its band, at most ``BAND`` of them.  The bands'
roots form a smaller trie (depths divided by ``BAND``), whose totals are found
in the same way first; the total of a root then counts as value of the node
just above it.  So a value is copied at most ``BAND`` times a level, and a
trie of depth d needs log_BAND(d) levels.

*Hot keys.*  A group of conversations with more than ``GROUP_ROWS`` turns is
numbered by range partitions instead of a window over the group.  Nodes are
counted map-side, parents with very many children are salted.  The ids of the
conversations that end at a node are packed map-side into strings of up to
``IDS`` ids; a SHA-256 can only be computed in one stream, so each node's
strings pass in order through one hash of constant memory.

Defined results: rows without conv_id belong to no conversation and are left
out; null roles and texts are empty; turns of equal number (null comes first)
are ordered by a hash of role and text, repeated rows are turns of their own;
an empty table has no node, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landroll.operators.joins import hot_keys, salted_join
from landroll.operators.keys import assign_ids

from .common import staged, text_or_empty, word_count

EVERY = 20            # conversations of a group share the head of its first
BAND = 8
BLOCK = 1024          # turns of a conversation that are summed up in one window
GROUP_ROWS = 100_000  # turns of a group that one task may number
IDS = 1024
_MASK = (1 << 52) - 1
_NODE = "struct<depth:bigint,x:bigint,y:bigint>"


def _node(depth: Column, x: Column, y: Column) -> Column:
    return F.struct(depth.alias("depth"), x.alias("x"), y.alias("y"))


def _root() -> Column:
    return _node(*[F.lit(0).cast("long")] * 3)


def _turns(conversations: DataFrame) -> DataFrame:
    """group, conv_id, turn, two hashes of role and text, and the text's words."""
    role, text = text_or_empty("role"), text_or_empty()
    conv = F.col("conv_id").cast("long")
    return conversations.where("conv_id is not null").select(
        (conv - conv % EVERY).alias("group"), conv.alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"), word_count(text).alias("words"))


_ORDER = ("turn", "a", "b")  # ascending, null first
_HEAD = "transform(slice(heads, 1, h), (t, i) -> struct(i + 1L as depth, t.a as a, t.b as b, t.words as words))"


def _numbered(turns: DataFrame) -> DataFrame:
    """``turns`` of groups of bounded size with position, number of turns and the group's first turns."""
    one = Window.partitionBy("group", "conv_id")
    head = F.when((F.col("conv_id") == F.col("group")) & (F.col("position") < 3),
                  F.struct("position", "a", "b", "words"))
    return (turns.repartition("group")
            .withColumn("position", F.row_number().over(one.orderBy(*_ORDER)).cast("long") - 1)
            .withColumn("n", F.count(F.lit(1)).over(one))
            .withColumn("heads", F.sort_array(F.collect_list(head).over(Window.partitionBy("group")))))


def _numbered_large(turns: DataFrame) -> DataFrame:
    """As :func:`_numbered`, for groups of any size: ids by range partitions, heads by joins."""
    ranked = staged(assign_ids(turns, ["conv_id", *_ORDER], id_col="id", materialize=staged), "trie-ranked")
    convs = ranked.groupBy("group", "conv_id").agg(F.min("id").alias("start"), F.count(F.lit(1)).alias("n"))
    first = convs.where(F.col("conv_id") == F.col("group")).select(
        "start", F.explode(F.sequence("start", F.col("start") + F.least("n", F.lit(3)) - 1)).alias("id"))
    heads = (ranked.join(first, "id").groupBy("group")
             .agg(F.sort_array(F.collect_list(F.struct((F.col("id") - F.col("start")).alias("position"), "a", "b",
                                                       "words"))).alias("heads")))
    none = F.array().cast("array<struct<position:bigint,a:bigint,b:bigint,words:bigint>>")
    convs = convs.join(heads, "group", "left").withColumn("heads", F.coalesce("heads", none)).drop("group")
    return (salted_join(ranked, convs, ["conv_id"], "inner", hot=hot_keys(convs, ["conv_id"], "n"), salt_cols=["id"])
            .withColumn("position", F.col("id") - F.col("start")).drop("id", "start"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, int]:
    """The turns of every rebuilt conversation, and a bound of their depth.

    Columns group, conv_id, depth (0: the root, once per conversation), a, b,
    words, and whether it is the conversation's last.
    """
    turns = _turns(conversations)
    sizes = turns.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest > GROUP_ROWS:
        large = staged(sizes.where(F.col("n") > GROUP_ROWS).select("group"), "trie-large")
        columns = ["group", "conv_id", "a", "b", "words", "position", "n", "heads"]
        rows = (_numbered(turns.join(large, "group", "left_anti")).select(*columns)
                .unionByName(_numbered_large(turns.join(large, "group", "left_semi")).select(*columns)))
    else:
        rows = _numbered(turns)
    decimal = F.col("conv_id").cast("string").cast("binary")
    zero = "struct(0L as depth, 0L as a, 0L as b, 0L as words)"
    out = (rows.withColumn("h", (F.crc32(decimal) % 4).cast("int"))
           .withColumn("k", F.least("h", F.size("heads")).cast("long"))
           .withColumn("turns", F.expr(f"""concat(
               if(position = 0, concat(array({zero}), {_HEAD}), array()),
               if(position >= h, array(struct(k + position - h + 1 as depth, a, b, words)), array()))"""))
           .withColumn("length", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
           .select("group", "conv_id", "length", F.inline("turns"))
           .withColumn("last", F.col("depth") == F.col("length")).drop("length"))
    return out, largest + 3


def _sums(rows: DataFrame, deepest: int, keys: list[str]) -> DataFrame:
    """``rows`` (keys, depth, x, y) with the sums of x and y up to each depth as sx and sy, modulo 2^52."""
    block = F.floor(F.col("depth") / BLOCK)
    upto = Window.partitionBy(*keys, block).orderBy("depth")
    sums = [(F.sum(c).over(upto).bitwiseAND(F.lit(_MASK))).alias(f"s{c}") for c in "xy"]
    inside = rows.select("*", *sums)
    if deepest < BLOCK:
        return inside
    totals = (rows.groupBy(*keys, (block + 1).alias("depth"))
              .agg(*[F.sum(c).bitwiseAND(F.lit(_MASK)).alias(c) for c in "xy"]))
    before = _sums(totals, deepest // BLOCK + 1, keys).select(
        *keys, F.col("depth").alias("_block"), *[F.col(f"s{c}").alias(f"_{c}") for c in "xy"])
    joined = inside.withColumn("_block", block).join(before, [*keys, "_block"], "left")
    added = {f"s{c}": (F.col(f"s{c}") + F.coalesce(f"_{c}", F.lit(0))).bitwiseAND(F.lit(_MASK)) for c in "xy"}
    return joined.withColumns(added).select(*rows.columns, "sx", "sy")


def prefixes(turns: DataFrame, deepest: int) -> DataFrame:
    """Node and parent of every prefix of every rebuilt conversation, with the node's line of ancestors.

    ``line`` holds the nodes from the root of its band down to itself.
    """
    def lane(*salt) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(
            F.xxhash64(*salt, "depth").bitwiseAND(F.lit(_MASK)))

    keys = ["group", "conv_id"]
    summed = _sums(turns.withColumns({"x": lane("a", "b"), "y": lane("b", "a")}).drop("a", "b"), deepest, keys)
    parent = F.when(F.col("depth") > 0, _node(F.col("depth") - 1, *[
        (F.col(f"s{c}") - F.col(c)).bitwiseAND(F.lit(_MASK)) for c in "xy"]))
    band = Window.partitionBy(*keys, F.floor(F.col("depth") / BLOCK), F.floor(F.col("depth") / BAND)).orderBy("depth")
    return (summed.withColumn("node", _node(F.col("depth"), F.col("sx"), F.col("sy")))
            .select("conv_id", "node", parent.alias("parent"), "words", "last",
                    F.collect_list("node").over(band).alias("line")))


def _band_roots(members: DataFrame, level: int) -> DataFrame:
    """Nodes at depths that ``BAND ** level`` divides, but the root: their line among such nodes, and the node
    of the level below that comes right above."""
    step, depth = BAND ** level, F.col("node.depth")
    spaced = members.where((depth > 0) & (depth % (step // BAND) == 0)).select("conv_id", "node", "parent")
    if level == 1:
        rows = spaced.where(depth % step == 0).withColumn("above", F.col("parent"))
    else:
        span = Window.partitionBy("conv_id", F.floor((depth - 1) / step)).orderBy(depth)
        rows = (spaced.withColumn("above", F.coalesce(F.lag("node").over(span), _root()))
                .where(depth % step == 0))
    band = Window.partitionBy("conv_id", F.floor(depth / (step * BAND))).orderBy(depth)
    line = F.collect_list("node").over(band)
    first = depth < step * BAND
    return (rows.withColumn("line", F.when(first, F.concat(F.array(_root()), line)).otherwise(line))
            .groupBy("node").agg(F.any_value("line").alias("line"), F.any_value("above").alias("above")))


def _totals(values: DataFrame, members: DataFrame, deepest: int, sums: list[str], level: int = 0) -> DataFrame:
    """Subtree sums of the nodes of one level; ``values`` has node, line and the nodes' own ``sums``."""
    if deepest >= BAND ** (level + 1):
        bands = values.groupBy(F.col("line")[0].alias("node")).agg(*[F.sum(c).alias(c) for c in sums])
        roots = staged(bands.join(_band_roots(members, level + 1), "node", "left")
                       .withColumn("line", F.coalesce("line", F.array(_root()))), "trie-band-roots")
        done = _totals(roots.drop("above"), members, deepest, sums, level + 1)
        below = (done.join(roots.where("above is not null").select("node", "above"), "node")
                 .groupBy(F.col("above").alias("node")).agg(*[F.sum(c).alias(f"_{c}") for c in sums]))
        values = values.join(below, "node", "left").withColumns(
            {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in sums})
    return (values.select(F.explode("line").alias("node"), *sums)
            .groupBy("node").agg(*[F.sum(c).alias(c) for c in sums]))


def _digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end at a node."""
    packed = (members.where("last").groupBy("node", F.floor(F.col("conv_id") / IDS).alias("slice"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != current:
                    if current is not None:
                        nodes.append(current)
                        digests.append(state.hexdigest())
                    current, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digest_batch(nodes, digests)
        if current is not None:
            yield _digest_batch([current], [state.hexdigest()])

    return (packed.repartition("node").sortWithinPartitions("node", "slice").select("node", "ids")
            .mapInArrow(run, f"node {_NODE}, ends_sha256 string"))


def _digest_batch(nodes: list, digests: list) -> pa.RecordBatch:
    kind = pa.struct([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(digests, pa.string())], ["node", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is told from the others of its depth by ``conv_id``, its smallest member.
    """
    turns, deepest = rebuilt(conversations)
    members = staged(prefixes(turns, deepest), "trie-members")
    nodes = staged(members.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.any_value("parent").alias("parent"), F.any_value("line").alias("line")), "trie-nodes")
    deepest = nodes.agg(F.max("node.depth")).first()[0] or 0
    children = (nodes.where("parent is not null").groupBy(F.col("parent").alias("node"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = staged(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                   "trie-nodes")
    values = nodes.select("node", "line", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = _totals(values, members, deepest, ["n_leaves", "saved_tokens"])
    hot = hot_keys(nodes.select(F.col("node").alias("parent"), "n_children"), ["parent"], "n_children")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = salted_join(nodes.where("parent is not null").select("node", "parent"), parents, ["parent"], "left",
                        hot=hot, salt_cols=["node"]).select("node", "parent_conv_id")
    none = F.lit(hashlib.sha256().hexdigest())
    return (nodes.join(totals, "node").join(below, "node", "left").join(_digests(members), "node", "left")
            .select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))
