"""Apply monthly deliveries as they arrive, with Structured Streaming.

Each delivery drops one small JSON manifest into an inbox folder:

    {"version": "2019-05", "feed": ".../DUP_TAXASSESSOR_2019-05.txt",
     "std": ".../ss_out_2019-05.tsv", "deletes": ".../DUP_PROPERTYDELETES_2019-05.txt"}

A file-stream source reads the manifests that are new; ``foreachBatch``
applies them in version order with :func:`run_cycle`.  Version labels are
compared with their numbers as numbers ("9" before "10").

* A manifest whose version is committed is a replay (of a batch that failed
  half-way, or a second copy) and is skipped.
* A month that was never committed but comes before the current version is
  late: applying it would overwrite newer values, so it is set aside.
* A manifest without a version, or with neither feed nor deletes, is
  malformed and is set aside.

What is set aside stays in ``store.parked()`` with its reason, its line as it
was read and its file (once, also if the batch is replayed), and the other
months go on.  With the ``availableNow`` trigger the query processes
everything in the inbox and stops, which suits a scheduled job; a
processing-time trigger keeps it running.  All manifests that are in the
inbox make one batch, so the order in which they arrived does not matter.
They are the only rows that reach the driver (one per month); the months
themselves run as ordinary distributed jobs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landroll.plans.cycle import run_cycle
from landroll.session import checkpoint_dir
from landroll.sources.state import PARKED, StateStore

MANIFEST_SCHEMA = "version string, feed string, std string, deletes string"


def version_order(version: str) -> list[tuple[int, int, str]]:
    """Sort key of a version label: digits as numbers, the rest as text."""
    return [(0, int(part), "") if part[0] in "0123456789" else (1, 0, part)
            for part in re.findall(r"[0-9]+|[^0-9]+", version)]


def _apply_batch(store: StateStore, mode: str, standardizer: Callable | None, remember_addresses: bool):
    def park(month: dict, reason: str) -> None:
        names = ("version", "feed", "std", "deletes", "reason", "raw", "file")
        row = {**month, "reason": reason}
        seen = store.parked()
        if seen is None or seen.where(F.col("file") == row["file"]).where(F.col("reason") == reason).where(
                F.col("raw").eqNullSafe(row["raw"])).isEmpty():
            store.park(store.spark.createDataFrame([tuple(row[c] for c in names)], PARKED))

    def apply(batch: DataFrame, batch_id: int) -> None:
        months = [r.asDict() for r in batch.collect()]
        usable = [m for m in months if m["version"] and (m["feed"] or m["deletes"]) and (bool(m["feed"]) == bool(m["std"]) or (m["feed"] and standardizer))]
        for month in months:
            if month not in usable:
                park(month, "malformed")
        for month in sorted(usable, key=lambda m: version_order(m["version"])):
            if store.has(month["version"]):
                continue  # a replayed batch or a second copy: nothing is lost
            cur = store.current()
            if cur and version_order(month["version"]) < version_order(cur[0]):
                park(month, f"late: {cur[0]} is current")
                continue
            phases = [*(["load", "merge"] if month["feed"] else []), *(["delete"] if month["deletes"] else []), "sweep"]
            run_cycle(store.spark, store, month["version"], month["feed"], month["std"], month["deletes"],
                      mode=mode, phases=phases, remember_addresses=remember_addresses,
                      standardizer=standardizer if month["feed"] and not month["std"] else None)
    return apply


def watch_deliveries(spark: SparkSession, inbox: str, store: StateStore, mode: str = "strict",
                     checkpoint: str | None = None, available_now: bool = True,
                     interval: str = "1 hour", standardizer: Callable | None = None,
                     remember_addresses: bool = False) -> StreamingQuery:
    """Start the stream; call ``.awaitTermination()`` (available-now) or keep it running.

    With a ``standardizer`` a manifest may leave out "std": its feed is
    standardised in the run (see :func:`landroll.plans.cycle.run_cycle`).
    """
    raw = "_corrupt_record"
    source = (spark.readStream.schema(f"{MANIFEST_SCHEMA}, {raw} string").option("columnNameOfCorruptRecord", raw).json(inbox)
              .select("version", "feed", "std", "deletes", F.col(raw).alias("raw"), F.col("_metadata.file_path").alias("file")))
    writer = (source.writeStream.foreachBatch(_apply_batch(store, mode, standardizer, remember_addresses))
              .option("checkpointLocation", checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/deliveries"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
