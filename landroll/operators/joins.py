"""Key-resolution joins that stay fast when one key holds a large share of rows.

Feeds have structurally hot keys: every unstandardised row carries the blank
address ('', '', ''), every row without co-owners carries blank names.  A
plain shuffle join sends all rows of such a key to one task.

``salted_join`` spreads each heavy key over ceil(rows / ROWS_PER_SALT) tasks:
rows of the big side get a salt from a hash of their own content
(deterministic, so a retried task routes every row the same way), and the
dimension row of such a key is replicated once per salt.  The number of salts
is a column of both sides, 1 for every other key: there is one plan for all
sizes, no limit on heavy keys or salts, nothing is collected and nothing is
marked for broadcast.  The table of heavy keys has at most one row per
ROWS_PER_SALT rows of the big side; Spark joins it like any other table.  The
result equals the plain join.  AQE's skew-join split stays enabled as a second
line.

Beside its own rows the replicated dimension has at most two rows per
``rows_per_salt`` rows of the big side.  Spark's size estimate leaves replicas
out, so a dimension of a few keys can be broadcast with all of theirs.  Salts
finer than ROWS_PER_SALT make up to as many replicas as the big side has rows:
these are made in runs dealt over all tasks and always merged, never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landroll.operators.keyfilter import matching

# Rows of one key that a task of the big side should get.
ROWS_PER_SALT = 100_000

# Replicas that one row makes at once where there may be as many as rows of the big side.
_RUN = 1024


def hot_keys(df: DataFrame, keys: Sequence[str], count_col: str | None = None,
             rows_per_salt: int | None = None) -> DataFrame:
    """``keys`` + ``_n`` of every key with more than ``rows_per_salt`` rows.

    With ``count_col`` the rows of ``df`` are already per-key counts (for
    example from :func:`landroll.operators.dedup.keep_first`); otherwise the
    keys of ``df`` are counted with a map-side-combined aggregate.
    """
    keys = list(keys)
    rows_per_salt = ROWS_PER_SALT if rows_per_salt is None else rows_per_salt
    if count_col:
        counts = df.select(*keys, F.col(count_col).cast("long").alias("_n"))
    else:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_salt)


def salted_join(big: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left",
                hot: DataFrame | None = None, salt_cols: Sequence[str] | None = None,
                rows_per_salt: int | None = None) -> DataFrame:
    """``big.join(dim, on, how)`` for ``how`` in inner/left, heavy keys spread by salt.

    ``hot`` holds ``on`` + ``_n`` (see :func:`hot_keys`); when omitted it is
    computed from ``big``.  ``salt_cols`` are hashed to salt a big-side row
    (default: all of its columns).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    on = list(on)
    rows_per_salt = ROWS_PER_SALT if rows_per_salt is None else rows_per_salt
    if hot is None:
        hot = hot_keys(big, on, rows_per_salt=rows_per_salt)
    salts = hot.select(*on, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts"))
    row_hash = F.xxhash64(*[F.col(c) for c in (salt_cols or big.columns)])
    one = F.coalesce(F.col("_salts"), F.lit(1))
    big_s = big.join(salts, on, "left").withColumn("_salt", F.pmod(row_hash, one).cast("int")).drop("_salts")
    dim_s = dim.join(salts, on, "left")
    if rows_per_salt < ROWS_PER_SALT:
        dim_s = _many_replicas(dim_s, on).hint("merge")
    else:
        dim_s = dim_s.withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_salts")
    return big_s.join(dim_s, on + ["_salt"], how).drop("_salt")


def _many_replicas(dim: DataFrame, on: list[str]) -> DataFrame:
    """Each row of ``dim`` once per salt 0 to ``_salts`` - 1 (0 if NULL), in runs that are dealt out before they are spelt out."""
    one = F.coalesce(F.col("_salts"), F.lit(1))
    runs = dim.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((one - 1) / _RUN).cast("int"))))
    # A number of partitions keeps AQE from merging them by the size of the runs.
    dealt = runs.repartition(int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on, "_run")
    first = F.col("_run") * _RUN
    return dealt.withColumn("_salt", F.explode(F.sequence(first, F.least(one, first + _RUN) - 1))).drop("_salts", "_run")


def first_match(dim: DataFrame, keys: Sequence[str], id_col: str = "id", count_col: str | None = None) -> DataFrame:
    """Reduce ``dim`` to its lowest ``id_col`` per key (first match wins).

    ``count_col`` also keeps how many rows of ``dim`` have the key.
    """
    aggs = [F.min(id_col).alias(id_col)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return dim.groupBy(*keys).agg(*aggs)


def lookup_first(big: DataFrame, dim: DataFrame, keys: Sequence[str], id_col: str = "id",
                 out_col: str | None = None, hot: DataFrame | None = None,
                 salt_cols: Sequence[str] | None = None, prune: bool = False) -> DataFrame:
    """Left-join ``big`` to the lowest ``dim.id_col`` with equal ``keys`` (NULL if none).

    ``prune``: rows of ``dim`` whose key ``big`` lacks are left out before
    they are grouped (for a ``dim`` much larger than ``big``, which is read twice).
    """
    first = first_match(matching(dim, big, keys) if prune else dim, keys, id_col)
    if out_col and out_col != id_col:
        first = first.withColumnRenamed(id_col, out_col)
    return salted_join(big, first, keys, "left", hot=hot, salt_cols=salt_cols)


def multi_match_report(dim: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys that match more than one row of ``dim`` (the 'multiple matched' report)."""
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))
