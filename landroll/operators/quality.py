"""Constraint rules evaluated as DataFrames of violations.

Uniqueness, NOT NULL, foreign keys and length limits are checked after the
tables are built (not row by row while building them).  Each check returns
the offending rows; :func:`violations` stacks any number of them into one
``(table, rule, key, detail)`` frame, and :func:`enforce` either raises
(strict) or returns it for quarantine.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landroll.session import checkpoint_dir


_REST = 1 << 30  # more characters than a string has


class ConstraintViolation(Exception):
    """A strict check failed; ``path`` is the Parquet table of every reject."""

    def __init__(self, message: str, path: str | None = None):
        super().__init__(message)
        self.path = path


def check_unique(df: DataFrame, keys: Sequence[str], count_col: str = "n", null_keys: bool = True) -> DataFrame:
    """Keys that occur more than once or, for a primary key, hold NULL (``keys`` + ``count_col``)."""
    bad = F.col(count_col) > 1
    if null_keys:
        for k in keys:
            bad = bad | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(bad)


def check_not_null(df: DataFrame, cols: Sequence[str], key: str | Sequence[str],
                   col_name: str = "col") -> DataFrame:
    """One row per (row, column) holding NULL in any of ``cols``; a single pass over ``df``."""
    keys = [key] if isinstance(key, str) else list(key)
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (df.select(*keys, F.filter(names, lambda x: x.isNotNull()).alias("_nulls"))
            .where(F.size("_nulls") > 0)
            .select(*keys, F.explode("_nulls").alias(col_name)))


def check_rows(df: DataFrame, key: str | Sequence[str], required: Mapping[str, Sequence[str]] | None = None,
               limits: Mapping[str, Mapping[str, int]] | None = None,
               unique: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """All rules on single rows and unique columns, in one scan: (table, rule, key, detail).

    Each argument maps the name of a table to its columns: ``required`` must
    not be NULL, ``limits`` are lengths, ``unique`` columns must neither repeat
    nor be NULL.  A row lists what it breaks, and names its unique columns;
    counting the names is the only shuffle.  As :func:`violations` of
    :func:`check_not_null`, :func:`check_lengths` and :func:`check_unique`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    row = F.monotonically_increasing_id()  # keeps the violations of different rows apart

    def item(table: str, rule: str, own: Column, detail: Column, mark: Column, null: Column) -> Column:
        return F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), own.alias("key"), detail.alias("detail"),
                        mark.alias("row"), null.alias("null"))

    no, none = F.lit(False), F.lit(None).cast("string")
    items = [F.when(F.col(c).isNull(), item(t, "not_null", _as_key(keys), F.lit(c), F.col("_row"), no))
             for t, cols in (required or {}).items() for c in cols]
    items += [F.when(F.rtrim(F.substring(c, n + 1, _REST)) != "",
                     item(t, "length", _as_key(keys), F.concat(F.lit(f"{c}|"), F.length(c)), F.col("_row"), no))
              for t, cols in (limits or {}).items() for c, n in cols.items()]
    items += [item(t, f"unique_{c}", _as_key([c]), none, F.lit(None).cast("long"), F.col(c).isNull())
              for t, cols in (unique or {}).items() for c in cols]
    listed = df.withColumn("_row", row).select(F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("v"))
    counted = listed.select("v.*").groupBy("table", "rule", "key", "detail", "row", "null").agg(F.count(F.lit(1)).alias("n"))
    of_row = F.col("row").isNotNull()
    return (counted.where(of_row | (F.col("n") > 1) | F.col("null"))
            .select("table", "rule", "key", F.when(of_row, F.col("detail")).otherwise(F.col("n").cast("string")).alias("detail")))


def check_fk(child: DataFrame, parent: DataFrame, fk: str, parent_key: str = "id") -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent."""
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def check_lengths(df: DataFrame, limits: Mapping[str, int], key: str | Sequence[str],
                  col_name: str = "col", len_name: str = "len") -> DataFrame:
    """One row per (row, column) whose string is longer than its limit; blanks over the limit do not count."""
    keys = [key] if isinstance(key, str) else list(key)
    items = [F.when(F.rtrim(F.substring(c, n + 1, _REST)) != "", F.struct(F.lit(c).alias("c"), F.length(F.col(c)).cast("long").alias("l")))
             for c, n in limits.items()]
    return (df.select(*keys, F.filter(F.array(*items), lambda x: x.isNotNull()).alias("_long"))
            .where(F.size("_long") > 0)
            .select(*keys, F.explode("_long").alias("_v"))
            .select(*keys, F.col("_v.c").alias(col_name), F.col("_v.l").alias(len_name)))


def fit_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Strings that exceed their limit by blanks alone lose these blanks."""
    return df.withColumns({c: F.when((F.length(c) > n) & (F.rtrim(F.substring(c, n + 1, _REST)) == ""),
                                     F.substring(c, 1, n)).otherwise(F.col(c)) for c, n in limits.items()})


def cascade_delete(child: DataFrame, removed_parents: DataFrame, fk: str, parent_key: str = "id") -> DataFrame:
    """Children left after their parents in ``removed_parents`` are deleted with cascade."""
    gone = removed_parents.select(F.col(parent_key).alias("_gone")).distinct()
    return child.join(gone, F.col(fk) == F.col("_gone"), "left_anti")


def _as_key(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def violations(table: str, rule: str, df: DataFrame, key: Sequence[str],
               detail: Sequence[str] = ()) -> DataFrame:
    """Normalise a check result into ``table, rule, key, detail`` strings."""
    det = _as_key(detail) if detail else F.lit(None).cast("string")
    return df.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"),
                     _as_key(key).alias("key"), det.alias("detail"))


def enforce(found: DataFrame, mode: str = "strict", name: str = "constraints") -> DataFrame:
    """The violations, written once.  Strict: raise if there is any. Quarantine: return them."""
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    path = reject_path(found.sparkSession, name)
    found.write.mode("error").parquet(path)
    found = found.sparkSession.read.schema(found.schema).parquet(path)
    if mode == "strict":
        raise_if_any(found, name, path)
    return found


def reject_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for rejects in the shared checkpoint folder; it outlives the run's staging folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rejects/{name}-{uuid.uuid4().hex}"


def raise_if_any(rejects: DataFrame, name: str, path: str) -> None:
    """Raise with an example if the table of rejects at ``path`` has rows."""
    example = rejects.first()
    if example is not None:
        raise ConstraintViolation(f"{name}: rejected rows, e.g. {tuple(example)}; all are in {path}", path)
