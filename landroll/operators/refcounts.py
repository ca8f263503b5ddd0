"""Reference counts of parents, kept as a narrow table and moved by signed changes.

A sweep acts on parents that no child refers to.  Instead of reducing all
children to their distinct references each month, the number of children per
parent is kept as ``(parent, id, n)``, ``parent`` naming the table.  A month takes
one from the parents that its touched children had and adds one to those they
have now; only parents in those changes can have lost their last child, or be
new without one.  The sweep then joins the parents with a list of ids that is
bounded by the month, and reads no child that the month did not touch.

The changes are aggregated map-side, so a parent of a third of the children
costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["parent", "id"]


def _references(children: DataFrame, fks: Mapping[str, str], weight: Column) -> DataFrame:
    """parent, id and ``weight`` (as n) of every reference of ``children``; NULL refers to nothing."""
    refs = F.array(*[F.struct(F.lit(parent).alias("parent"), F.col(fk).cast("long").alias("id")) for parent, fk in fks.items()])
    return (children.select(F.explode(refs).alias("r"), weight.cast("long").alias("n"))
            .select("r.parent", "r.id", "n").where("id is not null"))


def count_references(children: DataFrame, fks: Mapping[str, str]) -> DataFrame:
    """(parent, id, n) from all children; ``fks`` maps a parent's name to the children's column."""
    return _references(children, fks, F.lit(1)).groupBy(*KEY).agg(F.sum("n").alias("n"))


def reference_changes(old: DataFrame, new: DataFrame, fks: Mapping[str, str], gone: Column | None = None) -> DataFrame:
    """(parent, id, change) of the touched children: ``old`` as they were, ``new`` as they are.

    Rows of ``new`` for which ``gone`` is true were deleted again: their
    parents are listed with no change, as they may be new and without a child.
    """
    weight = F.lit(1) if gone is None else F.when(gone, 0).otherwise(1)
    both = _references(old, fks, F.lit(-1)).unionByName(_references(new, fks, weight))
    return both.groupBy(*KEY).agg(F.sum("n").alias("change"))


def apply_changes(references: DataFrame, changes: DataFrame) -> DataFrame:
    """(parent, id, n, touched) after the changes; n is 0 for parents that have no child now.

    A count below 0 means that ``references`` were not those of ``old``: it is an error.
    """
    n = F.coalesce("n", F.lit(0)) + F.coalesce("change", F.lit(0))
    checked = F.when(n < 0, F.raise_error(F.concat(F.lit("reference count below 0: "), F.col("parent"), F.lit(" "),
                                                   F.col("id")))).otherwise(n)
    return (references.join(changes, KEY, "full_outer")
            .select(*KEY, checked.cast("long").alias("n"), F.col("change").isNotNull().alias("touched")))


def held(counted: DataFrame) -> DataFrame:
    """The references to keep: parents with a child."""
    return counted.where("n > 0").select(*KEY, "n")


def childless(counted: DataFrame, parent: str) -> DataFrame:
    """Ids of the touched parents of one table that have no child (as ``id``)."""
    return counted.where((F.col("parent") == parent) & F.col("touched") & (F.col("n") == 0)).select("id")


def flag_listed(parents: DataFrame, ids: DataFrame, parent_key: str = "id", flag_col: str = "inactive") -> DataFrame:
    """Soft delete of the listed parents; the others stay as they are."""
    gone = ids.select(F.col("id").alias("_gone"))
    return (parents.join(gone, F.col(parent_key) == F.col("_gone"), "left")
            .withColumn(flag_col, F.when(F.col("_gone").isNotNull(), F.lit(True)).otherwise(F.col(flag_col)))
            .select(*parents.columns))


def drop_listed(parents: DataFrame, ids: DataFrame, parent_key: str = "id") -> DataFrame:
    """Hard delete of the listed parents."""
    gone = ids.select(F.col("id").alias("_gone"))
    return parents.join(gone, F.col(parent_key) == F.col("_gone"), "left_anti")
