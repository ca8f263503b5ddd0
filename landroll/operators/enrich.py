"""Address standardisation as an enrichment step.

The standardiser is an external service in the original flow.  Here it is a
join: feed rows are left-joined to a table of standardised addresses (which
a separate job may have produced), with a flag telling whether a row was
matched.  For a standardiser that is a Python callable, ``standardize_batches``
runs it once per Arrow batch inside the executors (``mapInPandas``); the
callable must be a small per-batch function, not a service call per row.

A standardisation depends on the address alone, and addresses repeat within
and between months: ``standardize_once`` asks the callable for each distinct
address that a memo table does not know, and joins the answers back, salted
where one address (the blank one) has a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landroll.operators.dedup import keep_first
from landroll.operators.joins import hot_keys, salted_join
from landroll.operators.keyfilter import matching, worth_it


def left_enrich(df: DataFrame, std: DataFrame, left_on: str, right_on: str,
                columns: dict[str, str], matched_col: str = "matched") -> DataFrame:
    """``df`` plus ``columns`` (std name -> output name) from ``std``; unmatched rows get NULLs.

    Rows are never multiplied: of several ``std`` rows with one key the
    smallest (by the picked columns, NULLs first) is taken.
    """
    picked = keep_first(std.select(F.col(right_on).alias("_std_key"),
                                   *[F.col(src).alias(dst) for src, dst in columns.items()],
                                   F.lit(True).alias("_std_hit")), ["_std_key"])
    out = df.join(picked, df[left_on] == picked["_std_key"], "left")
    return out.withColumn(matched_col, F.coalesce(F.col("_std_hit"), F.lit(False))).drop("_std_key", "_std_hit")


def standardize_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Apply a pandas DataFrame -> pandas DataFrame standardiser per Arrow batch."""
    def run(batches: Iterator):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema=schema)


def memo_key(column: str) -> str:
    """Name that a memo gives the column of an address."""
    return f"asked_{column}"


def standardize_once(rows: DataFrame, ask: Callable[[DataFrame], DataFrame], key: str, address: Sequence[str],
                     memo: DataFrame | None = None,
                     materialize: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Standardise ``rows`` (``key`` and text columns ``address``) through their distinct addresses.

    ``ask`` maps a frame of ``key`` and ``address``, one row per address that
    ``memo`` lacks, named by its smallest key, to answers that carry the key.
    Returns every row's key with its address's answer, and the new memo
    entries: the answers under the address they were asked for (see
    :func:`memo_key`), the ``memo`` of later calls once added to it.  Empty and
    NULL parts of an address are the same.  An address without an answer has
    no rows in either, and is asked again; with several answers its rows are
    multiplied, and it is not remembered.
    """
    if materialize is None:
        from landroll.session import stage as materialize
    names = [memo_key(c) for c in address]
    asked = rows.select(key, *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in zip(address, names)])
    distinct = materialize(asked.groupBy(*names).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("_rows")), "addresses")
    known = None
    unseen = distinct
    if memo is not None:
        known = matching(memo, distinct, names) if worth_it(memo) else memo
        unseen = distinct.join(known.select(*names), names, "left_anti")
    answers = ask(unseen.select(key, *[F.col(n).alias(c) for c, n in zip(address, names)]))
    fresh = materialize(answers.join(unseen.select(F.col(key).alias("_key"), *names), F.col(key) == F.col("_key"))
                        .drop("_key", key), "answers")
    every = fresh if known is None else fresh.unionByName(known.select(*fresh.columns))
    out = salted_join(asked, every, names, "inner", hot=hot_keys(distinct, names, "_rows"), salt_cols=[key]).drop(*names)
    once = fresh.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    return out, fresh.join(once, names, "left_semi")
