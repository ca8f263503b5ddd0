"""Mix sources to target weights by Sainte-Lague apportionment of token blocks.

1. Every source's target is its weighted share of the whole mix, stopped at
   ``max_passes`` times the source's size; what a stopped source cannot take
   is shared out again by weight (:func:`targets`).
2. Documents of a source are dealt to shards of about ``docs_per_shard``
   documents by a seeded hash.  A shard's documents, in seeded order, form one
   line of words that is cut into equal blocks of about ``block_words`` words.
3. Blocks are seats: :func:`apportion` gives sources, and then each source's
   shards, integer numbers of seats by highest quotients votes / (2 a - 1).
4. A shard with quota q and n blocks takes each block q div n times and
   q mod n seeded blocks once more; a document takes its words in them.

Only ids, sources and word counts are shuffled, never texts.  A hot source is
many shards, each a bounded group.  The tables of sources and shards hold one
row per source and per shard and may be large as well: sources are numbered and
quotients ranked by range partitions, levels and totals are aggregates, and what
a source's shards are told reaches them by salted joins.

Defined results: a null text has size 0 and takes 0; a null source is a source
of its own, last in order; rows that repeat a doc_id are documents of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landroll.operators.joins import hot_keys, salted_join
from landroll.operators.keys import assign_ids

from .common import WORD, staged, text_or_empty, word_count

WEIGHTS = (3, 1, 2)     # of the sources in code point order, repeating
SHARE = 1.5             # words of the mix per word of the corpus
MAX_PASSES = 2          # times a document may be taken
BLOCK_WORDS = 32
DOCS_PER_SHARD = 1024
SEED = 20240917

# Larger than any number of blocks of one shard and prime, so that
# i -> (i * STRIDE + offset) mod n is a permutation of 0 .. n - 1.  Where that of
# the first is a mere shift or its mirror image, the second is taken.
STRIDES = (2_147_483_647, 2_147_483_629)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            max_passes: int = MAX_PASSES) -> DataFrame:
    """``sources`` (key, source, source_size) with weight and target.

    The fixed point of "give by weight, stop at the cap, share the excess
    again" is target = min(cap, level * weight).  A round gives what stopped
    sources leave to the others by weight; it takes one aggregate, and rounds
    end when the raised level stops no further source.
    """
    position = assign_ids(sources, [F.col("source").asc_nulls_last()], id_col="position", materialize=staged)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    capped = staged(position.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_passes)
                    .drop("position"), "mix-weights")
    mix_size = capped.agg(F.sum("source_size")).first()[0] or 0
    level, n_stopped = 0.0, -1
    while True:
        stops = F.col("cap") < F.lit(level) * F.col("weight")
        now = capped.agg(F.count(F.when(stops, 1)).alias("n"), F.sum(F.when(stops, F.col("cap"))).alias("caps"),
                         F.sum(F.when(~stops, F.col("weight"))).alias("open")).first()
        if now.n <= n_stopped or not now.open:
            break
        # The sums are of whole numbers, so levels do not depend on the order of rows.
        n_stopped, level = now.n, (mix_size * share - (now.caps or 0)) / now.open
    return (capped.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")))
            .select("key", "source", "source_size", F.col("weight").cast("double").alias("weight"), "target"))


def apportion(items: DataFrame, group: Sequence[str], item: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Lague: ``items`` plus ``quota``, ``seats`` seats per group.

    Seat a of an item has the quotient votes / (2 a - 1); the highest
    ``seats`` quotients of the group win, ties to the smaller ``item``.  With
    V votes over n items, every seat whose quotient beats the divisor
    V / (seats - n/2) is sure to win and none below V / (seats + n/2) can, so
    only about two seats per item are listed and ranked.  A quotient's rank
    in its group is its rank among all, less that of the group's first: no
    group meets in one task.
    """
    group, keys = list(group), [*group, item]
    totals = staged(items.groupBy(*group).agg(F.sum(votes).alias("_votes"), F.count(F.lit(1)).alias("_n")),
                    "seats-totals")
    hot = hot_keys(totals, group, "_n")
    n = F.col("_n")
    per = F.when(F.col("_votes") > 0, F.col(votes) / F.col("_votes")).otherwise(0.0)

    def rounded(shift: Column) -> Column:
        return F.floor(per * shift + 0.5).cast("long")

    bounded = staged(
        salted_join(items, totals, group, "inner", hot=hot, salt_cols=[item])
        .withColumn("_sure", F.greatest(F.lit(0).cast("long"), rounded(F.col(seats) - n / 2.0) - 1))
        .withColumn("_most", F.when(F.col(votes) > 0, rounded(F.col(seats) + n / 2.0) + 1)
                    .otherwise(F.lit(0).cast("long"))).drop("_votes", "_n"), "seats-bounds")
    listed = (bounded.where(F.col("_most") > F.col("_sure"))
              .select(*keys, votes, F.explode(F.expr("sequence(_sure + 1, _most)")).alias("_seat"))
              .withColumn("_quotient", F.col(votes) / (F.col("_seat") * 2 - 1)))
    ranked = assign_ids(listed, [*group, F.col("_quotient").desc(), item, "_seat"], id_col="_rank",
                        materialize=staged)
    first = ranked.groupBy(*group).agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n"))
    left = bounded.groupBy(*group).agg((F.first(seats) - F.sum("_sure")).alias("_left"))
    limits = staged(first.join(left, group).select(*group, "_n", (F.col("_first") + F.col("_left")).alias("_end")),
                    "seats-limits")
    won = (salted_join(ranked, limits.drop("_n"), group, "inner", hot=hot_keys(limits, group, "_n"),
                       salt_cols=[item, "_seat"])
           .where(F.col("_rank") < F.col("_end"))
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("_won")))
    return (bounded.join(won, keys, "left")
            .withColumn("quota", F.col("_sure") + F.coalesce(F.col("_won"), F.lit(0)))
            .drop("_sure", "_most", "_won"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
        block_words: int = BLOCK_WORDS, docs_per_shard: int = DOCS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """One row per document: what the mix takes of it.

    Columns: doc_id, source, size, source_size, target (of its source),
    passes (times the whole text is taken), extra (word ranges [start, end) of
    the text taken once more) and taken (words, repeats counted).
    """
    sizes = staged(docs.select(
        "doc_id", "source",
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("key"),
        word_count(text_or_empty()).alias("size")), "mix-sizes")

    sources = staged(sizes.groupBy("key").agg(F.first("source", ignorenulls=True).alias("source"),
                                              F.sum("size").alias("source_size"),
                                              F.count(F.lit(1)).alias("n_docs")), "mix-sources")
    goal = targets(sources, weights, share, max_passes)

    dealt = (salted_join(sizes, sources.select("key", F.ceil(F.col("n_docs") / docs_per_shard).alias("n_shards")),
                         ["key"], "inner", hot=hot_keys(sources, ["key"], "n_docs"), salt_cols=["doc_id", "size"])
             .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("n_shards"))))
    shards = staged(dealt.groupBy("key", "shard").agg(F.sum("size").alias("words"))
                    .withColumn("blocks", F.when(F.col("words") > 0, F.greatest(
                        F.lit(1), F.round(F.col("words") / block_words).cast("long"))).otherwise(0).cast("long")),
                    "mix-shards")

    in_blocks = staged(
        shards.groupBy("key").agg(F.sum("blocks").alias("n_blocks"), F.count(F.lit(1)).alias("n_shards"))
        .join(goal, "key")
        .withColumn("votes", F.when(F.col("source_size") > 0,
                                    F.col("target") / F.col("source_size") * F.col("n_blocks")).otherwise(0.0))
        .withColumn("all", F.lit(0)), "mix-blocks")
    # Summed as decimals: the same in any order.
    seats = in_blocks.agg(F.coalesce(F.round(F.sum(F.col("votes").cast("decimal(38,12)"))), F.lit(0))
                          .cast("long")).first()[0]
    source_quota = staged(
        apportion(in_blocks.withColumn("seats", F.lit(seats).cast("long")), ["all"], "key", "votes", "seats")
        .select("key", "source_size", "target", "n_shards",
                F.least("quota", F.col("n_blocks") * max_passes).alias("seats")), "mix-source-quota")
    of_source = salted_join(shards, source_quota.drop("n_shards"), ["key"], "inner",
                            hot=hot_keys(source_quota, ["key"], "n_shards"), salt_cols=["shard"])
    shard_quota = (apportion(of_source.withColumn("votes", F.col("blocks").cast("double")),
                             ["key"], "shard", "votes", "seats")
                   .select("key", "shard", "words", "blocks", "source_size", "target",
                           F.least("quota", F.col("blocks") * max_passes).alias("quota")))

    line = Window.partitionBy("key", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "doc_id", "size"), "doc_id", "size")
    stride = (F.when((F.lit(STRIDES[0]) % F.col("blocks")).isin(F.lit(1), F.col("blocks") - 1), F.lit(STRIDES[1]))
              .otherwise(F.lit(STRIDES[0])))
    placed = (dealt.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("end") - F.col("size"))
              .join(staged(shard_quota, "mix-shard-quota"), ["key", "shard"])
              .withColumn("stride", F.when(F.col("blocks") > 0, stride).otherwise(F.lit(1)).cast("long"))
              .withColumn("offset", F.when(F.col("blocks") > 0, F.pmod(
                  F.xxhash64(F.lit(seed + 2), "key", "shard"), F.col("blocks"))).otherwise(F.lit(0))))
    # Block i is the words [i * words div blocks, (i + 1) * words div blocks)
    # of the shard's line.
    picked = F.expr(
        "transform(filter(sequence((start * blocks) div words, least(blocks - 1, (end * blocks) div words + 1)),"
        " i -> pmod(i * stride + offset, blocks) < quota % blocks"
        "      and (i * words) div blocks < end and ((i + 1) * words) div blocks > start),"
        " i -> named_struct('start', greatest(start, (i * words) div blocks) - start,"
        "                   'end', least(end, ((i + 1) * words) div blocks) - start))")
    return (placed
            .withColumn("passes", F.when(F.col("size") > 0, F.floor(F.col("quota") / F.col("blocks")))
                        .otherwise(0).cast("long"))
            .withColumn("extra", F.when(F.col("size") > 0, picked)
                        .otherwise(F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")))
            .withColumn("taken", F.col("passes") * F.col("size") + F.expr(
                "aggregate(extra, 0L, (a, r) -> a + r.end - r.start)"))
            .select("doc_id", "source", "size", "source_size", "target", "passes", "extra", "taken"))


def taken_texts(docs: DataFrame) -> DataFrame:
    """The mix as documents: the columns of ``docs`` with what is taken as text.

    A document gives one row for each pass over its whole text and one row for
    its extra blocks: their words, each range joined by blanks, the ranges by
    line feeds (the whole text as it is if they cover it).  n_chars, where it
    is a column, is the new text's.  Texts are joined to the plan by doc_id;
    rows that repeat a doc_id and have as many words share one plan.
    """
    plan = staged(mix(docs).where("taken > 0")
                  .groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__size"))
                  .agg(F.max_by(F.struct("passes", "extra"), "taken").alias("__plan")), "mix-plan")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    whole = F.expr("size(__plan.extra) > 0 and __covered = __size")
    ranged = F.expr("array_join(transform(__plan.extra, r -> array_join(slice(__words, cast(r.start + 1 as int),"
                    " cast(r.end - r.start as int)), ' ')), '\\n')")
    joined = (docs.withColumn("__size", word_count(text_or_empty()))
              .join(plan.withColumnRenamed("__size", "__n").hint("merge"),
                    F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__n")))
              .withColumn("__covered", F.expr("aggregate(__plan.extra, 0L, (a, r) -> a + r.end - r.start)"))
              .withColumn("__words", F.when(F.expr("size(__plan.extra) > 0") & ~whole, words)))
    extra = F.when(whole, F.array("text")).when(F.expr("size(__plan.extra) > 0"), F.array(ranged)) \
        .otherwise(F.expr("cast(array() as array<string>)"))
    taken = F.concat(F.expr("array_repeat(text, cast(__plan.passes as int))"), extra)
    out = joined.withColumn("__taken", F.explode(taken))
    made = {"text": F.col("__taken"), "n_chars": F.length("__taken").cast("long")}
    return out.select(*[made.get(c, F.col(c)).alias(c) for c in docs.columns])
