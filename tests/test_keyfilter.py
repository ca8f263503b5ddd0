"""The state reduced to the delta's keys before it is shuffled."""

from __future__ import annotations

from pyspark.sql import functions as F

from landroll.operators.joins import first_match, lookup_first
from landroll.operators.keyfilter import key_bits, matching, may_match
from test_buckets import columns_of, plan_nodes, plain_plans  # noqa: F401  (fixture)


def frames(spark, n=40_000):
    state = spark.range(n).select("id", F.concat(F.lit("k"), F.col("id") % 30_000).alias("a"),
                                  (F.col("id") % 3).cast("int").alias("b"))
    delta = spark.range(500).select(F.col("id").alias("pk"), F.concat(F.lit("k"), F.col("id") * 7 % 31_000).alias("a"),
                                    (F.col("id") % 3).alias("b"))  # a long: the types differ
    return state, delta


def test_no_matching_row_is_lost(spark):
    state, delta = frames(spark)
    exact = state.join(delta.select("a", "b").distinct(), ["a", "b"], "left_semi")
    for bits in (8, 12, 26):  # even a table that is far too small loses nothing
        kept = matching(state, delta, ["a", "b"], bits=bits)
        assert kept.columns == state.columns
        assert exact.join(kept, ["id"], "left_anti").count() == 0
    kept = matching(state, delta, ["a", "b"])
    assert kept.count() <= exact.count() + 20
    assert key_bits(delta, ["a", "b"], like=state, bits=8).count() <= 4
    nothing = spark.createDataFrame([], delta.schema)
    assert matching(state, nothing, ["a", "b"]).count() == 0
    with_null = delta.unionByName(spark.createDataFrame([(1, None, 2)], delta.schema))
    assert matching(state, with_null, ["a", "b"]).count() >= exact.count()


def test_lookup_equals_the_full_one(spark):
    state, delta = frames(spark)
    full = lookup_first(delta, state, ["a", "b"], out_col="x", salt_cols=["pk"])
    pruned = lookup_first(delta, state, ["a", "b"], out_col="x", salt_cols=["pk"], prune=True)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, pruned.select(*full.columns).collect()))


def test_state_is_filtered_below_its_shuffle(spark, plain_plans):  # noqa: F811
    state, delta = frames(spark)
    path = __import__("landroll.session", fromlist=["stage_path"]).stage_path(spark, "keyfilter")
    state.write.parquet(path)
    state = spark.read.parquet(path)
    nodes = plan_nodes(first_match(may_match(state, ["a", "b"], key_bits(delta, ["a", "b"], like=state)), ["a", "b"]))
    scans = [above for n, above in nodes if n.nodeName().startswith("Scan parquet")]
    assert len(scans) == 1
    # From the root down to the scan: the state's shuffle, and below it the filter's join.
    names = list(scans[0])
    assert names.index("Exchange") < names.index("BroadcastHashJoin")
    assert "Exchange" not in names[names.index("BroadcastHashJoin"):]
