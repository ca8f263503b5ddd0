"""Reference counts moved by signed changes, and the sweep of the touched parents alone."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filegen import write_deletes, write_feed, write_std
from landroll.operators import keyfilter
from landroll.operators.refcounts import (apply_changes, childless, count_references, drop_listed, flag_listed, held,
                                          reference_changes)
from landroll.plans import cycle
from landroll.plans.cycle import run_cycle
from landroll.sources.buckets import Buckets
from landroll.sources.state import StateStore
from test_buckets import columns_of, plan_nodes, plain_plans  # noqa: F401  (fixture)
from test_cycle import _feed, _std, month  # noqa: F401  (fixture)

FKS = {"a": "x", "b": "y"}
CHILD = "k long, x long, y int"


def counted(rows):
    return Counter([("a", x) for _, x, _ in rows if x is not None] + [("b", y) for _, _, y in rows if y is not None])


def test_counts_after_random_months_equal_a_full_count(spark):
    rnd = random.Random(11)
    children = {k: (k, rnd.choice([None, 1, 1, 1, rnd.randrange(30)]), rnd.randrange(12)) for k in range(300)}
    refs = count_references(spark.createDataFrame(list(children.values()), CHILD), FKS)
    assert {(r.parent, r.id): r.n for r in refs.collect()} == counted(children.values())
    for _ in range(3):
        delta = {k: (k, rnd.choice([None, 1, rnd.randrange(40)]), rnd.randrange(14)) for k in rnd.sample(range(400), 90)}
        deletes = set(rnd.sample(range(450), 60))
        old = [children[k] for k in children if k in delta or k in deletes]
        new = spark.createDataFrame([(*r, r[0] in deletes) for r in delta.values()], CHILD + ", gone boolean")
        before = set(counted(children.values()))
        children.update(delta)
        children = {k: r for k, r in children.items() if k not in deletes}
        after = counted(children.values())
        moved = apply_changes(refs, reference_changes(spark.createDataFrame(old, CHILD), new, FKS, F.col("gone")))
        refs = spark.createDataFrame(held(moved).collect(), "parent string, id long, n long")
        assert {(r.parent, r.id): r.n for r in refs.collect()} == after
        for parent in FKS:
            lost = {r.id for r in childless(moved, parent).collect()}
            gone = {i for p, i in before if p == parent} - {i for p, i in after if p == parent}
            unused = {i for p, i in counted([r for r in delta.values() if r[0] in deletes]) if p == parent}
            assert lost == gone | (unused - {i for p, i in after if p == parent})


def test_counts_that_do_not_fit_are_refused(spark):
    refs = spark.createDataFrame([("a", 1, 1)], "parent string, id long, n long")
    changes = spark.createDataFrame([("a", 1, -2)], "parent string, id long, change long")
    with pytest.raises(Exception, match="below 0: a 1"):
        apply_changes(refs, changes).collect()


def test_listed_parents(spark):
    parents = spark.createDataFrame([(1, None), (2, True), (3, False), (None, None)], "id long, inactive boolean")
    ids = spark.createDataFrame([(1,), (2,), (9,)], "id long")
    flagged = flag_listed(parents, ids).collect()
    assert {r.id: r.inactive for r in flagged} == {1: True, 2: True, 3: False, None: None} and len(flagged) == 4
    assert sorted((r.id for r in drop_listed(parents, ids).collect()), key=repr) == [3, None]


def _months(workdir):
    """Feeds and delete lists that move, delete, revive and delete again in the month of the insert."""
    def files(n, owners, deletes):
        feed = write_feed(os.path.join(workdir, "in", f"f{n}.txt"), [_feed(a, o) for a, o, _ in owners])
        std = write_std(os.path.join(workdir, "in", f"s{n}.tsv"), [_std(a, street, "OGDEN") for a, _, street in owners])
        return feed, std, write_deletes(os.path.join(workdir, "in", f"d{n}.txt"), deletes)

    return [files(1, [(1002, "BOB", "2 OAK AVE"), (5001, "NEW", "1 A ST"), (5002, "NEW", "2 B ST")], [5002, 1004]),
            files(2, [(1002, "BOB", "1 A ST"), (5001, "ELSE", "9 Z ST"), (5003, "SHORT", "3 C ST")], [5003, 9999]),
            files(3, [(5004, "BOB", "2 B ST"), (5001, "NEW", "1 A ST")], [1002, 1002])]


@pytest.mark.parametrize("buckets", [None, {"parcel": Buckets("admid", 3)}])
def test_months_in_a_row_equal_the_full_sweep(spark, month, workdir, monkeypatch, buckets):  # noqa: F811
    store, *_ = month
    monkeypatch.setattr(keyfilter, "LEAST_BYTES", 0)  # and every state is filtered by the delta's keys
    whole, moved = [StateStore(spark, os.path.join(workdir, n), buckets) for n in ("whole", "moved")]
    looked_at = []
    real = cycle.moved_references

    def watched(*args):
        out = real(*args)
        looked_at.append(out.where("touched").count())
        return out

    monkeypatch.setattr(cycle, "moved_references", watched)
    for s in (whole, moved):
        s.publish(store.snapshot(), "000")
    for n, (feed, std, deletes) in enumerate(_months(workdir), 1):
        for s in (whole, moved):
            if s is whole:  # a publish without counts drops them: the next sweep counts all parcels
                s.publish({}, f"forget-{n}")
                assert "references" not in s.paths()
            run_cycle(spark, s, f"{n:03}", feed, std, deletes)
        for t in ("identity", "entity", "parcel", "postcard"):
            assert sorted(map(tuple, moved.read(t).collect()), key=repr) == sorted(map(tuple, whole.read(t).collect()), key=repr)
        both = [sorted(map(tuple, spark.read.parquet(s.paths()["references"]).collect())) for s in (whole, moved)]
        assert both[0] == both[1]
    assert len(looked_at) == 2 and all(n > 0 for n in looked_at)  # all months of ``moved`` but the first
    # A month without a sweep leaves no counts behind.
    feed, std, deletes = _months(workdir)[0]
    run_cycle(spark, moved, "004", feed, std, deletes, phases=("load", "merge", "delete"))
    assert "references" not in moved.paths()


def test_untouched_parcels_are_read_in_three_columns(spark, month, plain_plans):  # noqa: F811
    store, *_ = month
    before = spark.createDataFrame([("identity", 1, 1)], "parent string, id long, n long")
    foreign = spark.createDataFrame([(1001, 1, 2)], "admid long, identity_id long, entity_id long")
    plans = []
    staged, cycle.stage = cycle.stage, lambda df, name: plans.append(df) or df
    try:
        cycle.moved_references(before, store.read("parcel"), foreign, None)
    finally:
        cycle.stage = staged
    scans = [columns_of(n) for n, _ in plan_nodes(plans[0]) if n.nodeName().startswith("Scan parquet")]
    assert scans == [{"admid", "identity_id", "entity_id"}]
