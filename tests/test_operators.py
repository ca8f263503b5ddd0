"""Operators against brute-force Python results on small inputs."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landroll.operators.dedup import distinct_rows, keep_first
from landroll.operators.joins import hot_keys, lookup_first, multi_match_report, salted_join
from landroll.operators.keys import assign_ids, max_id, next_id
from landroll.operators.merge import get_or_insert, reactivate, upsert
from landroll.operators.prune import (delete_by_keys, deleted_rows, drop_orphans, flag_orphans, null_references,
                                      orphans)
from landroll.operators.quality import (ConstraintViolation, cascade_delete, check_fk, check_lengths,
                                        check_not_null, check_rows, check_unique, enforce, fit_lengths, violations)


def _skewed_rows(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of the rows share one key, as a structurally hot key would
        k = ("", "") if i % 3 == 0 else (f"a{rnd.randint(0, 40)}", f"b{rnd.randint(0, 3)}")
        rows.append((i, k[0], k[1], rnd.randint(0, 9)))
    return rows


def test_assign_ids_is_global_rank(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "pk long, a string, b string, v int").repartition(7)
    out = assign_ids(df, ["a", "b", "pk"], base=40, num_partitions=5)
    got = {r["pk"]: r["id"] for r in out.collect()}
    expected = {r[0]: 41 + i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2], r[0])))}
    assert got == expected


def test_assign_ids_ignores_input_order(spark):
    rows = _skewed_rows()
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    a = assign_ids(spark.createDataFrame(rows, "pk long, a string, b string, v int"), ["pk"])
    b = assign_ids(spark.createDataFrame(shuffled, "pk long, a string, b string, v int").repartition(3), ["pk"])
    assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("initial", [None, "13"])
def test_assign_ids_in_a_session_that_sets_no_shuffle_partitions(spark, initial):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        spark.conf.unset(names[0])
        if initial:
            spark.conf.set(names[1], initial)
        out = assign_ids(spark.range(3000).repartition(4), [(-F.col("id")).alias("k")], id_col="n")
        assert {r["id"]: r["n"] for r in out.collect()} == {i: 3000 - i for i in range(3000)}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_assign_ids_base_from_table_and_empty(spark):
    state = spark.createDataFrame([(5,), (9,)], "id long")
    empty = spark.createDataFrame([], "id long")
    new = spark.createDataFrame([("x",), ("y",)], "k string")
    assert [r.id for r in assign_ids(new, ["k"], base=max_id(state)).orderBy("k").collect()] == [10, 11]
    assert [r.id for r in assign_ids(new, ["k"], base=max_id(empty)).orderBy("k").collect()] == [1, 2]
    assert spark.range(1).select(next_id(empty).alias("n")).first().n == 1


def test_keep_first_survivor_and_counts(spark):
    rows = [("k1", 3, "z"), ("k1", 1, "y"), ("k1", 1, "x"), ("k2", None, "q"), ("k2", 0, "p")]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v int, w string").repartition(4)
    got = {r.k: (r.v, r.w, r.n) for r in keep_first(df, ["k"], count_col="n").collect()}
    assert got == {"k1": (1, "x", 3), "k2": (None, "q", 2)}  # NULLs sort first
    assert distinct_rows(df, ["k"]).count() == 2


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    rows = _skewed_rows()
    big = spark.createDataFrame(rows + [(999, None, "b0", 1)], "pk long, a string, b string, v int")
    dim_rows = [(f"a{i}", f"b{j}", i * 10 + j) for i in range(0, 40, 2) for j in range(4)] + [("", "", -1)]
    dim = spark.createDataFrame(dim_rows, "a string, b string, d int")
    hot = hot_keys(big, ["a", "b"], rows_per_salt=50)
    assert hot.count() == 1  # only the blank key holds 50+ rows
    salted = salted_join(big, dim, ["a", "b"], how, hot=hot, salt_cols=["pk"], rows_per_salt=20)
    plain = big.join(dim, ["a", "b"], how)
    assert sorted(salted.collect(), key=repr) == sorted(plain.select(*salted.columns).collect(), key=repr)


def test_lookup_first_takes_lowest_id(spark):
    big = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "pk long, k string")
    dim = spark.createDataFrame([(7, "x"), (4, "x"), (5, "y")], "id long, k string")
    got = {r.pk: r.ident for r in lookup_first(big, dim, ["k"], out_col="ident").collect()}
    assert got == {1: 4, 2: 5, 3: None}
    assert [tuple(r) for r in multi_match_report(dim, ["k"]).collect()] == [("x", 2)]


def test_get_or_insert(spark):
    state = spark.createDataFrame([(1, "a", "old", None), (3, "b", "old", None)],
                                  "id long, k string, attr string, extra int")
    cands = spark.createDataFrame([("b", "new"), ("d", "new"), ("c", "new")], "k string, attr string")
    new_state, inserted = get_or_insert(state, cands, ["k"], defaults={"extra": F.lit(0)})
    assert sorted(map(tuple, inserted.collect())) == [(4, "c", "new", 0), (5, "d", "new", 0)]
    assert {r.k: r.attr for r in new_state.collect()} == {"a": "old", "b": "old", "c": "new", "d": "new"}


def test_upsert_labels_and_values(spark):
    state = spark.createDataFrame([(10, 1, "s1", True), (11, 2, "s2", True), (12, 3, "s3", False)],
                                  "id long, admid long, v string, flag boolean")
    delta = spark.createDataFrame([(2, "d2", None), (4, "d4", None), (5, None, None)],
                                  "admid long, v string, flag boolean")
    got = {r.admid: (r.id, r.v, r.flag, r.op) for r in upsert(state, delta, "admid").collect()}
    assert got == {1: (10, "s1", True, "keep"), 2: (11, "d2", None, "update"), 3: (12, "s3", False, "keep"),
                   4: (13, "d4", None, "insert"), 5: (14, None, None, "insert")}
    kept = {r.admid: r.flag for r in upsert(state, delta, "admid", overwrite_nulls=False).collect()}
    assert kept[2] is True


def test_reactivate_and_sweeps(spark):
    ident = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", None), (4, "d", False)],
                                  "id long, k string, inactive boolean")
    matched = spark.createDataFrame([(1,), (1,), (3,), (4,)], "id long")
    assert {r.id: r.inactive for r in reactivate(ident, matched).collect()} == {1: None, 2: True, 3: None, 4: False}
    parcel = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "id long, identity_id long")
    flagged = {r.id: r.inactive for r in flag_orphans(ident, parcel, "identity_id").collect()}
    assert flagged == {1: True, 2: True, 3: True, 4: True}  # 1 keeps its own True flag
    assert [r.id for r in drop_orphans(ident, parcel, "identity_id").collect()] == [1]
    assert sorted(r.id for r in orphans(ident, parcel, "identity_id").collect()) == [2, 3, 4]


def test_deletes_and_references(spark):
    parcel = spark.createDataFrame([(100, 1), (101, 2), (102, 3)], "id long, admid long")
    dele = spark.createDataFrame([(2,), (2,), (9,)], "admid long")
    assert sorted(r.admid for r in delete_by_keys(parcel, dele, "admid").collect()) == [1, 3]
    gone = deleted_rows(parcel, dele, "admid")
    cards = spark.createDataFrame([(1, 101), (2, 101), (3, 100), (4, None)], "id long, parcel_id long")
    got = {r.id: r.parcel_id for r in null_references(cards, gone, "parcel_id").collect()}
    assert got == {1: None, 2: None, 3: 100, 4: None}
    assert sorted(r.id for r in cascade_delete(cards, gone, "parcel_id").collect()) == [3, 4]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "abc", None, 5), (1, "abcdef", "x", 9), (2, None, None, None)],
                               "k long, s string, t string, fk long")
    assert [tuple(r) for r in check_unique(df, ["k"]).collect()] == [(1, 2)]
    assert sorted(map(tuple, check_unique(df, ["fk"]).collect()), key=repr) == [(None, 1)]
    assert check_unique(df, ["fk"], null_keys=False).count() == 0
    nulls = sorted(map(tuple, check_not_null(df, ["s", "t"], "k").collect()))
    assert nulls == [(1, "t"), (2, "s"), (2, "t")]
    assert [tuple(r) for r in check_lengths(df, {"s": 4}, "k").collect()] == [(1, "s", 6)]
    blank = spark.createDataFrame([(1, "abcd   "), (2, "abcd  x")], "k long, s string")
    assert [tuple(r) for r in check_lengths(blank, {"s": 4}, "k").collect()] == [(2, "s", 7)]
    assert [r.s for r in fit_lengths(blank, {"s": 4}).orderBy("k").collect()] == ["abcd", "abcd  x"]
    parent = spark.createDataFrame([(5,)], "id long")
    assert [r.fk for r in check_fk(df, parent, "fk").collect()] == [9]
    found = violations("t", "unique", check_unique(df, ["k"]), ["k"], ["n"])
    with pytest.raises(ConstraintViolation):
        enforce(found, "strict")
    assert enforce(found, "quarantine").count() == 1


@settings(max_examples=8, deadline=None)
@given(keys=st.lists(st.tuples(st.sampled_from(["", "a", "b", "zz"]), st.integers(-5, 50)), unique=True,
                     min_size=0, max_size=60),
       parts=st.integers(1, 9), base=st.integers(0, 1000))
def test_assign_ids_property(spark, keys, parts, base):
    df = spark.createDataFrame(keys, "k string, n int").repartition(parts)
    got = sorted((r.k, r.n, r.id) for r in assign_ids(df, ["k", "n"], base=base, num_partitions=parts).collect())
    assert got == [(k, n, base + i + 1) for i, (k, n) in enumerate(sorted(keys))]


def _nulls_first(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["", "k1", "k2"]), st.one_of(st.none(), st.integers(-3, 3)),
                               st.one_of(st.none(), st.integers(0, 5))), min_size=1, max_size=40))
def test_keep_first_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w int").repartition(3)
    got = {r.k: (r.v, r.w, r.n) for r in keep_first(df, ["k"], count_col="n").collect()}
    expected = {}
    for k in {r[0] for r in rows}:
        group = [r[1:] for r in rows if r[0] == k]
        expected[k] = (*min(group, key=_nulls_first), len(group))
    assert got == expected


@settings(max_examples=6, deadline=None)
@given(state_keys=st.sets(st.integers(0, 30), max_size=15), delta_keys=st.sets(st.integers(0, 30), max_size=15))
def test_upsert_property(spark, state_keys, delta_keys):
    state_rows = [(100 + i, k, f"s{k}") for i, k in enumerate(sorted(state_keys))]
    state = spark.createDataFrame(state_rows, "id long, admid long, v string")
    delta = spark.createDataFrame([(k, f"d{k}") for k in sorted(delta_keys)], "admid long, v string")
    got = {r.admid: (r.id, r.v, r.op) for r in upsert(state, delta, "admid").collect()}
    ids = {k: i for i, k, _ in state_rows}
    top = max(ids.values(), default=0)
    fresh = sorted(delta_keys - state_keys)
    expected = {k: (ids[k], f"d{k}" if k in delta_keys else f"s{k}", "update" if k in delta_keys else "keep")
                for k in state_keys}
    expected.update({k: (top + 1 + i, f"d{k}", "insert") for i, k in enumerate(fresh)})
    assert got == expected


def test_a_key_of_more_than_512_salts(spark):
    """No cap on salts or heavy keys: 1,500 keys are heavy and one needs 700 salts."""
    big = spark.range(700).selectExpr("id as pk", "0 as k").unionByName(
        spark.range(3000).selectExpr("id + 1000 as pk", "cast(id % 1500 + 1 as int) as k"))
    dim = spark.range(1501).selectExpr("cast(id as int) as k", "id * 2 as d")
    hot = hot_keys(big, ["k"], rows_per_salt=1)
    assert hot.count() == 1501
    got = salted_join(big, dim, ["k"], "left", hot=hot, salt_cols=["pk"], rows_per_salt=1)
    assert sorted(map(tuple, got.select("pk", "k", "d").collect())) == \
        sorted(map(tuple, big.join(dim, "k", "left").select("pk", "k", "d").collect()))
    from landroll.operators import joins
    assert not hasattr(joins, "MAX_SALTS") and not hasattr(joins, "MAX_HOT")


def test_replicas_of_finely_salted_keys_are_never_broadcast(spark, workdir):
    """A dimension of three rows has 3,001 replicas here, but Spark's size estimate counts the three rows."""
    big = spark.range(3000).selectExpr("id as pk", "cast(id % 3 as int) as k").unionByName(
        spark.range(1).selectExpr("9000 as pk", "7 as k"))
    counted = f"{workdir}/counted"
    big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("d", F.col("k") * 2).write.parquet(counted)
    dim = spark.read.parquet(counted)
    hot = hot_keys(dim, ["k"], count_col="n", rows_per_salt=0)
    out = salted_join(big, dim.select("k", "d"), ["k"], "left", hot=hot, salt_cols=["pk"], rows_per_salt=1)
    assert sorted(map(tuple, out.select("pk", "d").collect())) == [(i, i % 3 * 2) for i in range(3000)] + [(9000, 14)]
    # The joins with the table of salts may be broadcast, that with the replicas is merged.
    joins = [x for x in out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "Join" in x]
    assert "_salt#" in joins[0] and "SortMergeJoin" in joins[0]


def test_replicas_in_runs(spark, monkeypatch):
    """Every salt once, also where a run ends just before, at or just after the last salt."""
    from landroll.operators import joins
    monkeypatch.setattr(joins, "_RUN", 4)
    dim = spark.createDataFrame([(k, None if k == 0 else k) for k in range(14)], "k int, _salts int")
    got = joins._many_replicas(dim, ["k"]).collect()
    assert sorted(map(tuple, got)) == [(k, salt) for k in range(14) for salt in range(max(k, 1))]


def test_id_plan_does_not_grow_with_partitions(spark):
    df = spark.range(500).selectExpr("cast(id * 7 % 500 as int) as k")
    sizes = {}
    for n in (2, 64):
        out = assign_ids(df, ["k"], num_partitions=n)
        assert sorted(r.id - r.k for r in out.collect()) == [1] * 500
        sizes[n] = len(out._jdf.queryExecution().optimizedPlan().toString())
    assert abs(sizes[64] - sizes[2]) < 200


def test_id_offsets_across_groups_of_partitions(spark, monkeypatch):
    from landroll.operators import keys
    monkeypatch.setattr(keys, "_GROUP", 3)
    out = assign_ids(spark.range(300).selectExpr("id as k"), ["k"], base=10, num_partitions=16)
    assert sorted(r.id - r.k for r in out.collect()) == [11] * 300


def test_enrichment_never_multiplies_rows(spark):
    from landroll.operators.enrich import left_enrich
    df = spark.createDataFrame([(1, 5), (2, 6)], "k long, fk long")
    std = spark.createDataFrame([(5, "b"), (5, "a"), (7, "c")], "id long, v string")
    got = sorted(map(tuple, left_enrich(df, std, "fk", "id", {"v": "v"}).collect()))
    assert got == [(1, 5, "a", True), (2, 6, None, False)]


def test_all_row_rules_in_one_scan(spark, workdir):
    """The same violations as one check after the other, from a single scan with a single shuffle."""
    rows = [(1, "ab", None, "x" * 9), (1, None, "q", "ok"), (2, "abc   ", "q", "x" * 5), (None, None, None, None),
            (None, None, None, None), (3, "abcd", "r", ""), (4, "ab", "s", "t")]
    path = f"{workdir}/rows"
    spark.createDataFrame(rows, "k long, a string, b string, c string").write.parquet(path)
    df = spark.read.parquet(path)
    got = check_rows(df, "k", {"t": ["a", "b"]}, {"t": {"a": 3}, "u": {"c": 4}}, {"t": ["k"]})
    parts = [violations("t", "not_null", check_not_null(df, ["a", "b"], "k"), ["k"], ["col"]),
             violations("t", "length", check_lengths(df, {"a": 3}, "k"), ["k"], ["col", "len"]),
             violations("u", "length", check_lengths(df, {"c": 4}, "k"), ["k"], ["col", "len"]),
             violations("t", "unique_k", check_unique(df, ["k"]), ["k"], ["n"])]
    want = sorted((tuple(r) for p in parts for r in p.collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) == 11
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1


def test_delta_is_checked_in_one_scan(spark, workdir):
    from landroll.plans.relate import (ENTITY_SOURCE, IDENTITY_SOURCE, PARCEL_SOURCE, check_delta, identity_survivors)
    names = list(dict.fromkeys([*IDENTITY_SOURCE, *ENTITY_SOURCE, *PARCEL_SOURCE]))
    values = {"admid": F.col("id"), "mail_address": F.lit("1 A ST"), "parcel_fips": F.lit("123456"),
              "mail_state": F.when(F.col("id") % 2 == 0, "UT"), "owner": F.lit("x" * 200)}
    path = f"{workdir}/delta"
    spark.range(6).select(*[values.get(n, F.lit("v")).alias(n) for n in names]).write.parquet(path)
    delta = spark.read.parquet(path)
    survivors_path = f"{workdir}/survivors"
    identity_survivors(delta).write.parquet(survivors_path)
    found, bad = check_delta(delta, spark.read.parquet(survivors_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("/delta]") == 1 and plan.count("/survivors]") == 1
    by_rule = {}
    for r in found.collect():
        by_rule.setdefault((r.table, r.rule, r.detail), []).append(r.key)
    assert sorted(by_rule) == [("entity", "length", "owner|200"), ("identity", "not_null", "mail_state"),
                               ("parcel", "length", "parcel_fips|6")]
    assert [tuple(r) for r in bad.collect()] == [("1 A ST", "v", None)]
