"""Every registered query against its DuckDB statement (as the driver checks it), at sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from landroll.plans import fixture_files
from landroll.plans.fixture import QUERY_FUNCS
from oracle_compare import compare, duck

SF_DIR = os.environ.get("LANDROLL_ORACLE_SF", "/root/testdata/sf0.001")
KEYS = sorted(set(QUERY_FUNCS))


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def one_month():
    """The five queries on the file-based month run it once: their tables are those of one published version."""
    done = {}

    def applied(s, prepared):
        if s.sf_dir not in done:
            done[s.sf_dir] = run(s, prepared)
        return done[s.sf_dir]

    run, prepare = fixture_files.apply_month, fixture_files.prepare_month
    fixture_files.apply_month = applied
    fixture_files.prepare_month = lambda s: None if s.sf_dir in done else prepare(s)
    yield
    fixture_files.apply_month, fixture_files.prepare_month = run, prepare


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    problems, _, _ = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_DIR)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["admid", "price", "identity_id", "entity_id", "owner", "a", "ci", "st", "attr"]
    assert df.count() > 0


def test_entry_in_a_session_that_sets_no_shuffle_partitions(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        problems, rows, _ = compare(spark, duck(entry.SMOKE_DIR), "full_cycle", lambda s, _: entry.entry(s),
                                    entry.oracle_sql()["full_cycle"], entry.SMOKE_DIR)
        assert not problems, problems
        assert rows > 0
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
