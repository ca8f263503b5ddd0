"""Surrogate keys.

``next_id`` is the "largest id plus one, or 1 when empty" continuation value.
``assign_ids`` numbers rows 1..n in a total order, on top of a base, without
moving all rows into one task:

1. rows are range-partitioned on the order columns and sorted inside each
   partition; ``monotonically_increasing_id`` then encodes (range partition,
   position in partition) in one long;
2. that ranked copy is materialised once (a staged table), so the counting
   and the numbering read the very same partition assignment (two
   separately planned range exchanges may sample different bounds);
3. the rows per range partition are counted, and each partition's offset is
   the running sum of the counts before it.  If there are at most ``_GROUP``
   partitions the offsets are one array, a scalar subquery, and numbering is a
   projection of the ranked copy.  Beyond, they are a small frame joined to
   the rows by partition number, summed up within groups of ``_GROUP``
   partitions and over the groups' totals.  The plan does not grow with the
   number of partitions, and nothing larger than ``_GROUP`` numbers is one value.

Because an id equals the row's global rank in the given total order, the ids
do not depend on partitioning, and a rerun over the same rows gives the same
ids.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_GROUP = 4096  # partitions whose counts are summed up in one window

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row index
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def next_id(df: DataFrame, id_col: str = "id") -> Column:
    """Scalar subquery: coalesce(max(id), 0) + 1 over ``df``."""
    return df.select((F.coalesce(F.max(id_col), F.lit(0)) + F.lit(1)).cast("long")).scalar()


def max_id(df: DataFrame, id_col: str = "id") -> Column:
    """Scalar subquery: coalesce(max(id), 0) over ``df``."""
    return df.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()


def assign_ids(df: DataFrame, order_by: Sequence[str | Column], base: int | Column = 0,
               id_col: str = "id", num_partitions: int | None = None,
               materialize: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Add ``id_col`` = base + row number of each row under ``order_by``.

    ``order_by`` must be a total order over the rows (unique keys).  ``base``
    may be a literal or a scalar subquery such as :func:`max_id` of the
    current table.  ``materialize(df, name)`` stores the ranked rows
    (default: :func:`landroll.session.stage`).  Without ``num_partitions``
    AQE may merge neighbouring range partitions, which keeps the order.
    """
    if materialize is None:
        from landroll.session import stage as materialize
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    parted = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ranked = materialize(parted.sortWithinPartitions(*order_cols)
                         .withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    base_col = base if isinstance(base, Column) else F.lit(base)
    counts = ranked.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    most = num_partitions or _range_partitions(df.sparkSession)
    if most <= _GROUP:
        # Past the array's end would be an error, not a NULL: element_at checks.
        numbered = ranked.withColumn("_offset", F.element_at(_offset_array(counts, most), (pid + 1).cast("int")))
    else:
        numbered = ranked.withColumn("_pid", pid).join(_offsets(counts), "_pid")
    new_id = (base_col.cast("long") + F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)) + 1)
    return numbered.withColumn(id_col, new_id.cast("long")).select(*df.columns, id_col)


def _range_partitions(spark: SparkSession) -> int:
    """How many partitions ``repartitionByRange`` makes at most if it is not told."""
    # Unset, the first has Spark's default and the second no value.
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(n) for n in (shuffle, initial) if n is not None)


def _offset_array(counts: DataFrame, most: int) -> Column:
    """Scalar subquery: the offsets of partitions 0 to ``most`` - 1."""
    every = counts.sparkSession.range(most).select(F.col("id").alias("_pid"), F.lit(0).cast("long").alias("_n"))
    rows = every.unionByName(counts).groupBy("_pid").agg(F.sum("_n").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    upto = rows.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    listed = F.array_sort(F.collect_list(F.struct("_pid", "_offset")))
    return upto.agg(F.transform(listed, lambda x: x["_offset"]).alias("_offsets")).scalar()


def _offsets(counts: DataFrame) -> DataFrame:
    """(_pid, _offset): rows in all partitions of a smaller number; ``counts`` has _pid and its rows _n."""
    counts = counts.withColumn("_group", F.floor(F.col("_pid") / _GROUP))
    totals = counts.groupBy("_group").agg(F.sum("_n").alias("_total"))
    groups = totals.select("_group", F.coalesce(F.sum("_total").over(
        Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_group").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
            .join(groups, "_group").select("_pid", (F.col("_start") + F.col("_inside")).alias("_offset")))
