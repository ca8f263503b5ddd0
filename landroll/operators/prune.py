"""Deletes and referential clean-up, all as semi/anti joins.

Every "does any child point at me" test reduces the child side to its
distinct foreign keys first (a map-side-combined aggregate), so a parent
referenced by a large share of the children costs one row per task, and the
join never multiplies parent rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _distinct_refs(child: DataFrame, fk: str, as_col: str) -> DataFrame:
    return child.where(F.col(fk).isNotNull()).select(F.col(fk).alias(as_col)).distinct()


def delete_by_keys(df: DataFrame, doomed: DataFrame, key: str, doomed_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not listed in ``doomed`` (unknown or repeated ids are harmless)."""
    keys = _distinct_refs(doomed, doomed_key or key, key)
    return df.join(keys, key, "left_anti")


def deleted_rows(df: DataFrame, doomed: DataFrame, key: str, doomed_key: str | None = None) -> DataFrame:
    """Rows of ``df`` that ``delete_by_keys`` removes."""
    keys = _distinct_refs(doomed, doomed_key or key, key)
    return df.join(keys, key, "left_semi")


def null_references(child: DataFrame, removed_parents: DataFrame, fk: str, parent_key: str = "id") -> DataFrame:
    """Set ``child.fk`` to NULL where it points at a removed parent; keeps every child row."""
    gone = _distinct_refs(removed_parents, parent_key, "_gone").withColumn("_hit", F.lit(True))
    joined = child.join(gone, child[fk] == gone["_gone"], "left")
    fk_type = child.schema[fk].dataType
    return (joined.withColumn(fk, F.when(F.col("_hit"), F.lit(None).cast(fk_type)).otherwise(F.col(fk)))
            .select(*child.columns))


def flag_orphans(parent: DataFrame, child: DataFrame, fk: str, parent_key: str = "id",
                 flag_col: str = "inactive") -> DataFrame:
    """Soft delete: parents without any child get ``flag_col`` = true; others unchanged."""
    used = _distinct_refs(child, fk, "_used").withColumn("_has_child", F.lit(True))
    joined = parent.join(used, parent[parent_key] == used["_used"], "left")
    return (joined.withColumn(flag_col, F.when(F.col("_has_child").isNull(), F.lit(True))
                              .otherwise(F.col(flag_col)))
            .select(*parent.columns))


def drop_orphans(parent: DataFrame, child: DataFrame, fk: str, parent_key: str = "id") -> DataFrame:
    """Hard delete: keep only parents referenced by at least one child."""
    used = _distinct_refs(child, fk, "_used")
    return parent.join(used, parent[parent_key] == used["_used"], "left_semi")


def orphans(parent: DataFrame, child: DataFrame, fk: str, parent_key: str = "id") -> DataFrame:
    """Parents that no child references (the rows a sweep acts on)."""
    used = _distinct_refs(child, fk, "_used")
    return parent.join(used, parent[parent_key] == used["_used"], "left_anti")
