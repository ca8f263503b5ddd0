"""Tables bucketed by key through Spark's catalog.

A bucketed table is written with ``bucketBy(n, key).sortBy(key)`` as an
external table: the rows of a key are in bucket hash(key) mod n, and Spark
knows it.  A join on the key then needs no shuffle of the table; the other
side is dealt into the same n partitions (``repartition(n, key)``).  The result
of such a join still lies in the same buckets, so it is written as the next
bucketed table without a shuffle either (``aligned``).

Spark deals both sides of a join anew if it would otherwise have fewer
partitions than ``spark.sql.shuffle.partitions``: :func:`planned_for` lowers that
to the number of buckets while such a join is planned and run.

The catalog may be the session's own: :func:`attach` registers a folder of
bucketed files wherever it is not known yet, the bucket number of a file being
part of its name.  The name of a table derives from its folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Buckets:
    """How a table is bucketed; ``count`` should make buckets of about 128-256 MB."""

    key: str
    count: int


def table_name(path: str) -> str:
    return f"landroll_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, buckets: Buckets, aligned: bool = False, split: str | None = None) -> None:
    """Write ``df`` at ``path``, bucketed and sorted by the key.

    ``aligned``: each task's rows are of one bucket already (the result of a
    join with a table of the same buckets); other rows are dealt out once.
    ``split`` names a column whose values get folders of their own.
    """
    dealt = df if aligned else df.repartition(buckets.count, F.col(buckets.key))
    writer = (dealt.write.mode("error").format("parquet").bucketBy(buckets.count, buckets.key)
              .sortBy(buckets.key).option("path", path))
    if split:
        writer = writer.partitionBy(split)
    # The table of the whole folder is of no use beyond its files: readers attach what they read.
    name = f"{table_name(path)}_written"
    writer.saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def attach(spark: SparkSession, path: str, schema: StructType, buckets: Buckets) -> DataFrame:
    """The bucketed table at ``path``, registered in the session's catalog if it is not there."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{buckets.key}`) "
                  f"SORTED BY (`{buckets.key}`) INTO {buckets.count} BUCKETS LOCATION '{location}'")
    return spark.table(name)


_PARALLELISM = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@contextmanager
def planned_for(spark: SparkSession, buckets: Buckets | None) -> Iterator[None]:
    """Keep a bucketed table where it is in the queries that run inside, even if its buckets are few."""
    before = {name: spark.conf.get(name, None) for name in _PARALLELISM}
    try:
        for name, value in before.items():
            if buckets and value is not None and int(value) > buckets.count:
                spark.conf.set(name, str(buckets.count))
        yield
    finally:
        for name, value in before.items():
            if value is not None:
                spark.conf.set(name, value)


def detach(spark: SparkSession, path: str) -> None:
    """Forget the table of ``path``; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
