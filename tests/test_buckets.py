"""State bucketed through the catalog: plans without a shuffle of the state, and the same months as without."""

from __future__ import annotations

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from landroll.operators.merge import mark_deleted, upsert
from landroll.plans.cycle import run_cycle
from landroll.session import stage_path
from landroll.sources.buckets import Buckets, attach, detach, planned_for, table_name, write_bucketed
from landroll.sources.state import StateStore
from test_cycle import month  # noqa: F401  (fixture)

BUCKETS = Buckets("admid", 4)


@pytest.fixture()
def plain_plans(spark):
    """Plans as they are for tables too large to broadcast, before any run-time change."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_nodes(df):
    """(node, names of its ancestors) of the physical plan."""
    out, todo = [], [(df._jdf.queryExecution().executedPlan(), ())]
    while todo:
        node, above = todo.pop()
        out.append((node, above))
        children = node.children()
        todo += [(children.apply(i), (*above, node.nodeName())) for i in range(children.size())]
    return out


def columns_of(node):
    return {re.sub("#.*", "", node.output().apply(i).toString()) for i in range(node.output().size())}


def tables(spark):
    state = spark.range(1, 60).select(F.col("id").alias("id"), (F.col("id") * 3).alias("admid"), F.lit("s").alias("v"),
                                      F.lit(1).cast("long").alias("fk"))
    path = stage_path(spark, "bucketed_test")
    write_bucketed(state, path, BUCKETS)
    delta = spark.range(100, 300).select(F.col("id").alias("admid"), F.concat(F.lit("d"), F.col("id")).alias("v"))
    fks = spark.range(100, 300).select(F.col("id").alias("admid"), (F.col("id") + 7).alias("fk"))
    deletes = spark.range(0, 400, 11).select(F.col("id").alias("admid"))
    return state, attach(spark, path, state.schema, BUCKETS), delta, fks, deletes


def test_upsert_shuffles_no_state_and_the_delta_once(spark, plain_plans):
    state, bucketed, delta, fks, deletes = tables(spark)
    merged = upsert(bucketed, delta, "admid", ["v", "fk"], attached=fks, deletes=deletes, partitions=BUCKETS.count,
                    checked=True)
    with planned_for(spark, BUCKETS):  # four buckets, eight shuffle partitions
        nodes = plan_nodes(merged)
    scans = [(n, above) for n, above in nodes if ".landroll_" in n.nodeName()]
    wide = [above for n, above in scans if {"id", "v"} <= columns_of(n)]
    assert wide and all("Exchange" not in above for above in wide)
    dealt = [n for n, _ in nodes if n.nodeName() == "Exchange" and "_d_v" in columns_of(n)]
    assert len(dealt) == 1
    kept = mark_deleted(bucketed, deletes, "admid", partitions=BUCKETS.count)
    with planned_for(spark, BUCKETS):
        nodes = plan_nodes(kept)
    assert all("Exchange" not in above for n, above in nodes if ".landroll_" in n.nodeName())
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_upsert_on_buckets_equals_plain(spark):
    state, bucketed, delta, fks, deletes = tables(spark)
    plain = upsert(state, delta.join(fks, "admid"), "admid", ["v", "fk"], deletes=deletes)
    dealt = upsert(bucketed, delta, "admid", ["v", "fk"], attached=fks, deletes=deletes, partitions=BUCKETS.count)
    assert sorted(map(tuple, dealt.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    gone = {r.admid for r in plain.where("gone").collect()}
    assert gone == {k for k in range(0, 400, 11) if k in range(100, 300) or (k % 3 == 0 and 0 < k < 180)}


def test_null_and_repeated_delta_keys(spark):
    state = spark.createDataFrame([(1, 10, "a"), (5, None, "b")], "id long, k long, v string")
    delta = spark.createDataFrame([(None, "n"), (11, "c"), (None, "m"), (10, "x"), (9, "d"), (None, "m")], "k long, v string")
    got = sorted(map(tuple, upsert(state, delta, "k").collect()), key=repr)
    assert got == sorted([(1, 10, "x", "update"), (5, None, "b", "keep"), (6, 9, "d", "insert"), (7, 11, "c", "insert"),
                          (8, None, "m", "insert"), (9, None, "m", "insert"), (10, None, "n", "insert")], key=repr)
    only = spark.createDataFrame([(None, "n")], "k long, v string")
    marked = upsert(state, only, "k", deletes=spark.createDataFrame([(10,), (None,), (10,)], "k long"))
    assert sorted((r.id, r.op, r.gone) for r in marked.collect()) == [(1, "keep", True), (5, "keep", False),
                                                                     (6, "insert", False)]
    with pytest.raises(ValueError, match="2 rows of k 11"):
        upsert(state, spark.createDataFrame([(11, "c"), (11, "d")], "k long, v string"), "k")


def test_months_on_a_bucketed_store(spark, month, workdir):  # noqa: F811
    """Two months, one of them deletes alone, give the tables of a plain store; the manifest names the table."""
    store, feed, std, deletes = month
    bucketed = StateStore(spark, os.path.join(workdir, "bucketed"), {"parcel": BUCKETS})
    bucketed.publish(store.snapshot(), "000")
    expected, got = {}, {}
    for s, out in ((store, expected), (bucketed, got)):
        res = run_cycle(spark, s, "001", feed, std, deletes)
        run_cycle(spark, s, "002", delete_path=deletes, phases=("delete", "sweep"))
        out.update({t: sorted(map(tuple, s.read(t).collect()), key=repr) for t in s.paths()}, counts=res.counts)
    assert got == expected
    manifests = {r.version: json.loads(r.tables) for r in bucketed._manifests().collect()}
    for version in ("000", "001", "002"):
        entry = manifests[version]["parcel"]
        assert entry["key"] == "admid" and entry["buckets"] == 4 and entry["table"] == table_name(entry["path"])
        assert isinstance(manifests[version]["entity"], str)
    # One file a bucket at most: the merged parcels were written where the join left them.
    for version in ("001", "002"):
        files = os.listdir(manifests[version]["parcel"]["path"].replace("file:", ""))
        numbers = [f.split("_")[-1].split(".")[0] for f in files if f.startswith("part-")]
        assert len(numbers) == len(set(numbers)) <= 4
    # A session that has not seen the table registers it again.
    path = bucketed.paths()["parcel"]
    bucketed.forget("002")
    assert not spark.catalog.tableExists(table_name(path))
    plan = bucketed.read("parcel")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan or "bucket" in plan.lower()
    assert bucketed.read("parcel").count() == len(got["parcel"])
    # A store of other buckets reads what was written, and writes its own.
    other = StateStore(spark, os.path.join(workdir, "bucketed"), {"parcel": Buckets("admid", 3)})
    run_cycle(spark, other, "003", delete_path=deletes, phases=("delete", "sweep"))
    assert other.stored()["parcel"].buckets.count == 3
    assert sorted(map(tuple, other.read("parcel").collect()), key=repr) == got["parcel"]


def test_every_parcel_deleted(spark, month, workdir):  # noqa: F811
    from filegen import write_deletes
    store, _, _, _ = month
    everything = write_deletes(os.path.join(workdir, "in", "all.txt"), [1001, 1002, 1003, 1004])
    for s in (store, StateStore(spark, os.path.join(workdir, "b2"), {"parcel": BUCKETS})):
        if s is not store:
            s.publish(store.snapshot("000"), "000")
        res = run_cycle(spark, s, "001", delete_path=everything, phases=("delete", "sweep"))
        assert res.counts == {"parcels": 0, "deleted": 4}
        assert s.read("parcel").count() == 0 and s.read("entity").count() == 0
        run_cycle(spark, s, "002", delete_path=everything, phases=("delete", "sweep"))
        assert s.read("parcel").count() == 0


def test_attach_and_detach(spark):
    state, bucketed, *_ = tables(spark)
    path = stage_path(spark, "again")
    write_bucketed(state, path, BUCKETS)
    assert attach(spark, path, state.schema, BUCKETS).count() == attach(spark, path, state.schema, BUCKETS).count() == 59
    detach(spark, path)
    detach(spark, path)
    assert attach(spark, path, state.schema, BUCKETS).count() == 59
