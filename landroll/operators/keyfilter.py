"""Reading a large state for a small delta: rows that cannot match are dropped before any shuffle.

:func:`key_bits` hashes the delta's keys into a table of bits, one row per 64
of them; :func:`may_match` joins it to the state by broadcast and keeps the rows
whose bit is set: every row with a key of the delta, and a few others (a false
hit costs a shuffled row, the join that follows decides).  So the grouping or
join of the state shuffles about as many rows as the delta has keys, not the
whole state.

The table has at most ``2 ** (bits - 6)`` rows of two numbers whatever the delta's
size: 16 MB for the default.  With d different keys about d / 2^bits of the
other rows pass.  All of it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26
LEAST_BYTES = 64 << 20  # a smaller state is shuffled as it is: the filter would cost more


def _place(keys: Sequence[str | Column], bits: int) -> tuple[Column, Column]:
    """Slot and bit of a key."""
    h = F.xxhash64(*keys)
    return F.shiftrightunsigned(h, 64 - bits + 6), h.bitwiseAND(F.lit(63)).cast("int")


def key_bits(delta: DataFrame, keys: Sequence[str], like: DataFrame | None = None, bits: int = BITS) -> DataFrame:
    """The table of bits for the ``keys`` of ``delta``, cast to the types they have in ``like``."""
    types = {f.name: f.dataType for f in (like or delta).schema.fields}
    slot, bit = _place([F.col(k).cast(types[k]) for k in keys], bits)
    one = F.lit(1).cast("long")
    return (delta.select(slot.alias("_slot"), F.call_function("shiftleft", one, bit).alias("_bit"))
            .groupBy("_slot").agg(F.bit_or("_bit").alias("_bits")))


def may_match(state: DataFrame, keys: Sequence[str], table: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows of ``state`` whose ``keys`` may be among those of the table."""
    slot, bit = _place(list(keys), bits)
    return (state.withColumn("_slot", slot).join(F.broadcast(table), "_slot")
            .where(F.bit_get("_bits", bit) == 1).select(*state.columns))


def mark_matches(state: DataFrame, keys: Sequence[str], table: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """All rows of ``state`` and, as ``name``, whether their ``keys`` may be among those of the table."""
    slot, bit = _place(list(keys), bits)
    return (state.withColumn("_slot", slot).join(F.broadcast(table), "_slot", "left")
            .withColumn(name, F.coalesce(F.bit_get("_bits", bit) == 1, F.lit(False))).select(*state.columns, name))


def matching(state: DataFrame, delta: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows of ``state`` whose ``keys`` may occur in ``delta``: a superset of the semi join, without a shuffle of ``state``."""
    return may_match(state, keys, key_bits(delta, keys, like=state, bits=bits), bits)


def worth_it(state: DataFrame) -> bool:
    """Whether Spark expects ``state`` to be large enough for the filter to pay."""
    return int(str(state._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= LEAST_BYTES
