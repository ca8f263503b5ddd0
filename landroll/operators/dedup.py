"""Distinct rows and deterministic keep-first per key.

A unique index plus "insert, skip on conflict" keeps whichever row comes
first, in no set order.  Here the survivor of each key is the row with the
smallest tuple of the remaining columns (NULLs first), so reruns and other
engines agree.  Both operators aggregate map-side before the shuffle, so a
key holding a large share of the rows is reduced to one row per task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
               count_col: str | None = None) -> DataFrame:
    """One row per ``keys``; the survivor has the smallest ``order_by`` tuple.

    ``order_by`` defaults to all non-key columns in their order; any
    non-key column not named is appended as a tie-break so the order is
    total.  ``count_col`` optionally keeps the number of input rows per key
    (used to find hot keys without another pass).
    """
    values = [c for c in df.columns if c not in keys]
    order = list(order_by or values)
    order += [c for c in values if c not in order]
    if not order:
        out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col or "_n"))
        return out if count_col else out.drop("_n")
    aggs = [F.min(F.struct(*order)).alias("_first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_first.{c}").alias(c) for c in values]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)
