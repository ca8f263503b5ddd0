"""Set-based merge of a delta into the current state.

Row-at-a-time "select, then insert or update" becomes joins:

* get-or-insert: delta keys not present in the state get new ids after the
  state's largest id; existing rows keep every attribute.
* reactivation: the first match of a key, if flagged inactive, gets the flag
  set to NULL; other rows of the same key stay as they are.
* upsert: one full outer join on the business key labels every row update,
  keep or insert, and marks what a delete list names.  Only the keys that are
  to be inserted are numbered, in a narrow table of their own, so the state's
  rows are shuffled once, or not at all if they are bucketed by the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landroll.operators.keys import assign_ids, max_id

INSERT, UPDATE, KEEP = "insert", "update", "keep"


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` from ``df`` (cast), NULL where missing."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def get_or_insert(state: DataFrame, candidates: DataFrame, keys: Sequence[str],
                  id_col: str = "id", defaults: Mapping[str, Column] | None = None,
                  order_by: Sequence[str] | None = None,
                  existing_keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert the ``candidates`` whose ``keys`` are not in ``state``.

    ``candidates`` must be unique on ``keys`` (see ``keep_first``).  New ids
    continue after ``max(state.id)`` in the order of ``order_by`` (default
    ``keys``).  ``defaults`` fill state columns the candidates lack.
    Returns ``(new_state, inserted)``; both have ``state``'s columns.
    ``existing_keys`` may pass an already distinct key set of ``state`` (for
    example its first-match table) to save another aggregation of it.
    """
    keys = list(keys)
    known = (existing_keys if existing_keys is not None else state).select(*keys)
    if existing_keys is None:
        known = known.distinct()
    new = candidates.join(known, keys, "left_anti")
    for name, value in (defaults or {}).items():
        new = new.withColumn(name, value)
    inserted = conform(assign_ids(new, order_by or keys, base=max_id(state, id_col), id_col=id_col), state.schema)
    return state.unionByName(inserted), inserted


def reactivate(state: DataFrame, matched: DataFrame, id_col: str = "id", flag_col: str = "inactive") -> DataFrame:
    """Rows of ``state`` whose id is in ``matched`` and that are flagged inactive get NULL.

    NULL and false both mean active; an inactive row is set to NULL, not
    false.  ``matched`` holds the ids of first matches (see
    :func:`landroll.operators.joins.first_match`), so of several rows with
    one key only the first is reactivated.
    """
    touched = matched.select(id_col).distinct().withColumn("_touched", F.lit(True))
    joined = state.join(touched, id_col, "left")
    hit = F.col("_touched").isNotNull() & F.coalesce(F.col(flag_col), F.lit(False))
    flag_type = state.schema[flag_col].dataType
    return (joined.withColumn(flag_col, F.when(hit, F.lit(None).cast(flag_type)).otherwise(F.col(flag_col)))
            .select(*state.columns))


def existing_keys(state: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Keys of ``delta`` that ``state`` has: the update set."""
    return delta.select(key).join(state.select(key), key, "left_semi")


def missing_keys(state: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Keys of ``delta`` that ``state`` lacks: the insert set."""
    return delta.select(key).join(state.select(key), key, "left_anti")


def count_ops(merged: DataFrame, op_col: str = "op") -> DataFrame:
    """Rows per label of an upserted table."""
    return merged.groupBy(op_col).agg(F.count(F.lit(1)).alias("n"))


def check_delta_keys(keys: DataFrame, key: str) -> None:
    """Refuse a delta in which a key (other than NULL) is repeated: it would multiply rows."""
    repeated = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if repeated is not None:
        raise ValueError(f"the delta has {repeated['n']} rows of {key} {repeated[key]!r}")


def upsert(state: DataFrame, delta: DataFrame, key: str, columns: Sequence[str] | None = None,
           id_col: str | None = "id", op_col: str = "op", overwrite_nulls: bool = True,
           keep_state_cols: Sequence[str] = (), delta_keys: DataFrame | None = None,
           attached: DataFrame | None = None, deletes: DataFrame | None = None, gone_col: str = "gone",
           partitions: int | None = None, checked: bool = False) -> DataFrame:
    """Merge ``delta`` into ``state`` on the unique ``key``, labelling each row.

    ``update`` (key in both): ``columns`` (default: delta columns besides the
    key) come from the delta, other state columns and the id are kept; with
    ``overwrite_nulls=False`` (or for ``keep_state_cols``) a NULL delta value
    keeps the state value.  ``keep`` (only in state): unchanged.  ``insert``
    (only in delta): delta values, other state columns NULL, ``id_col``
    numbered after the state's largest id in ``key`` order.  A NULL key
    matches nothing: such delta rows are inserts, numbered after the others in
    the order of their values, such state rows are kept.  A repeated key is
    refused (``checked``: the caller has seen to the keys, none is NULL or repeated).

    ``delta_keys`` may pass the delta's keys by a plan that is cheaper than
    ``delta``'s.  ``attached`` (key and further columns, at most one row per
    key) is joined to the delta where its rows are dealt by key anyway.
    ``deletes`` (key, repeats allowed) adds the flag ``gone_col``: rows whose
    key is listed, inserts of this delta included.

    Everything is joined on the key alone.  ``partitions`` deals every side
    but the state into so many partitions by key: a state bucketed that way is
    not shuffled, and the delta's rows are shuffled once in full width.
    """
    extra = [c for c in (attached.columns if attached is not None else []) if c != key]
    columns = [c for c in (columns or [*delta.columns, *extra]) if c != key and c != id_col]
    state_types = {f.name: f.dataType for f in state.schema.fields}
    keys = (delta if delta_keys is None else delta_keys).select(key)
    numbered = bool(id_col) and id_col in state_types
    without_key = False
    if not checked:
        check_delta_keys(keys, key)
        without_key = not keys.where(F.col(key).isNull()).isEmpty()

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(partitions, "_key") if partitions else df

    def keyed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
        return dealt(df.select(F.col(key).alias("_key"), *[F.col(c).alias(n) for c, n in names.items()]))

    own = [c for c in columns if c in delta.columns]
    fresh = (keyed(delta.where(F.col(key).isNotNull()) if without_key else delta, {c: f"_d_{c}" for c in own})
             .withColumn("_in_delta", F.lit(True)))
    if attached is not None:
        fresh = fresh.join(keyed(attached, {c: f"_d_{c}" for c in extra}), "_key", "left")
    if numbered:
        missing = missing_keys(state, keys.where(F.col(key).isNotNull()) if without_key else keys, key)
        ids = assign_ids(missing, [key], base=max_id(state, id_col), id_col="_new_id")
        fresh = fresh.join(keyed(ids, {"_new_id": "_new_id"}), "_key", "left")
    held = state.withColumn("_in_state", F.lit(True))
    if deletes is not None:
        listed = keyed(deletes.where(F.col(key).isNotNull()).select(key).distinct(), {})
        held = held.join(listed.select(F.col("_key").alias("_listed")), F.col(key) == F.col("_listed"), "left")
        fresh = fresh.join(listed.select("_key", F.col("_key").alias("_listed_d")), "_key", "left")
    joined = held.join(fresh, F.col(key) == F.col("_key"), "full_outer")
    in_delta, in_state = F.col("_in_delta").isNotNull(), F.col("_in_state").isNotNull()
    out = {key: F.coalesce(F.col(key), F.col("_key").cast(state_types[key]))}
    for c in columns:
        new = F.col(f"_d_{c}")
        if c in state_types:
            if not overwrite_nulls or c in keep_state_cols:
                new = F.coalesce(new, F.col(c))
            out[c] = F.when(in_delta, new.cast(state_types[c])).otherwise(F.col(c))
        else:
            out[c] = new
    if numbered:
        out[id_col] = F.when(in_state, F.col(id_col)).otherwise(F.col("_new_id").cast(state_types[id_col]))
    out[op_col] = (F.when(in_delta & in_state, F.lit(UPDATE)).when(in_delta, F.lit(INSERT))
                   .otherwise(F.lit(KEEP)))
    names = list(dict.fromkeys([*state.columns, *columns, op_col]))
    if deletes is not None:
        out[gone_col] = F.coalesce("_listed", "_listed_d").isNotNull()
        names.append(gone_col)
    merged = joined.select(*[out.get(c, F.col(c)).alias(c) for c in names])
    if not without_key:
        return merged
    lost = delta.where(F.col(key).isNull())
    if numbered:
        base = F.coalesce(ids.select(F.max("_new_id")).scalar(), max_id(state, id_col))
        lost = assign_ids(lost, own, base=base, id_col="_new_id").withColumn(id_col, F.col("_new_id").cast(state_types[id_col]))
    lost = lost.withColumn(op_col, F.lit(INSERT)).withColumn(gone_col, F.lit(False))
    return merged.unionByName(lost.select(*[
        (F.col(c) if c in lost.columns else F.lit(None)).cast(merged.schema[c].dataType).alias(c) for c in names]))


def mark_deleted(df: DataFrame, deletes: DataFrame, key: str, gone_col: str = "gone",
                 partitions: int | None = None) -> DataFrame:
    """``df`` with a flag for the rows whose ``key`` is listed; a bucketed ``df`` is not shuffled."""
    listed = deletes.where(F.col(key).isNotNull()).select(F.col(key).alias("_listed")).distinct()
    listed = listed.repartition(partitions, "_listed") if partitions else listed
    return (df.join(listed, F.col(key) == F.col("_listed"), "left")
            .withColumn(gone_col, F.col("_listed").isNotNull()).drop("_listed"))
