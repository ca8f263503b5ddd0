"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landroll.session import checkpoint_dir, drop_path

# A word: a maximal run of characters other than the ASCII blanks.  On UTF-8
# bytes ``bytes.split()`` cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The folder for staged tables of the job that runs in this context (thread).
_SCRATCH: ContextVar[str | None] = ContextVar("llm_scratch", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Stage the tables of the enclosed operators in one folder, deleted at the end.

    What the operators return reads those tables: write it before the block ends.
    """
    folder = fresh_path(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        drop_path(spark, folder)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back (``compression``: not the session's).

    The result's plan is a file scan: it survives lost executors, is planned
    from its true size, and is not recomputed by each of its readers.  Inside
    :func:`scratch` the table lasts as long as the block, otherwise until the
    checkpoint folder is cleared.
    """
    spark, folder = df.sparkSession, _SCRATCH.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else fresh_path(spark, name)
    df.write.mode("error").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def row_sum(columns: Iterable[Column]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c
    return total
