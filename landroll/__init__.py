"""landroll: apply periodic property change files to a relational state on Spark.

Sub-packages
------------
sources    readers and writers: delimited feeds, standardised addresses,
           delete lists, the address extract and the versioned state store.
functions  column expressions: address composition and normalisation,
           points, typed casts, boolean parsing, blank/NULL policy.
operators  set-based DataFrame operators: keep-first dedup, stable ids,
           lookups, get-or-insert, upsert, deletes, sweeps, quality rules.
plans      composed jobs: building the identity/entity/parcel trio from a
           stitched feed and the full monthly cycle.
streaming  a file-stream driver that applies each arriving month once.
"""

from landroll.session import build_session, checkpoint_dir, stage

__all__ = ["build_session", "checkpoint_dir", "stage"]
