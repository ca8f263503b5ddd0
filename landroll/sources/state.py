"""Versioned snapshots of the state tables with an all-or-nothing publish.

Parquet tables cannot be updated in place, so each run writes a new copy of
every table it changes, each attempt under a folder of its own:

    <root>/<table>/v=<version>-<attempt>/part-*.parquet
    <root>/_manifests/v=<version>-<attempt>/part-*.json    one row, see below

The manifest (sequence number, version label, table and report paths) is
written last and is the commit point: its files only appear when its write
job commits, and readers take the manifest with the highest sequence number.
A run that fails before that leaves the previous version current, and can be
tried again: nothing refers to the folders of the failed attempt.  A version
is a label; the sequence number alone orders versions.

Tables named in ``buckets`` are written bucketed by their key (see
``sources.buckets``): the monthly upsert joins the state's parcels without
shuffling them.  The manifest names their table, key and number of buckets,
so every reader gets a bucketed scan, also in a session that has not seen the
table; a version written with other buckets, or none, stays readable.  Only Spark readers
and writers are used, so the store works on any filesystem the cluster
shares.  A store has one writer at a time (the monthly job, or the delivery
stream); ``publish`` refuses a label that is committed already, which guards
against replays, not against two concurrent writers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landroll.session import make_folder, path_exists
from landroll.sources.buckets import Buckets, attach, detach, table_name, write_bucketed
from landroll.sources.schemas import REFERENCES_DDL, STATE_DDL


# Tables beside the state: reference counts of its parcels, and addresses with their standardised form.
REFERENCES, ADDRESSES = "references", "addresses"
# A delivery that was set aside: its manifest, why, and the line and file it came from.
PARKED = "version string, feed string, std string, deletes string, reason string, raw string, file string"
MANIFEST = "seq long, version string, tables string, reports string"


@dataclass(frozen=True)
class Stored:
    """A table that lies under the store's root; no version refers to it until it is published."""

    path: str
    buckets: Buckets | None = None

    def entry(self) -> str | dict:
        """How the manifest names it."""
        if self.buckets is None:
            return self.path
        return {"path": self.path, "table": table_name(self.path), "key": self.buckets.key,
                "buckets": self.buckets.count}

    @staticmethod
    def of(entry: str | dict) -> Stored:
        if isinstance(entry, str):
            return Stored(entry)
        return Stored(entry["path"], Buckets(entry["key"], entry["buckets"]))


class StateStore:
    def __init__(self, spark: SparkSession, root: str, buckets: Mapping[str, Buckets] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = dict(buckets or {})

    def _manifests(self) -> DataFrame | None:
        path = f"{self.root}/_manifests"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(MANIFEST).json(path)

    def _newest(self, version: str | None = None) -> Row | None:
        m = self._manifests()
        if m is None:
            return None
        return (m if version is None else m.where(F.col("version") == version)).orderBy(F.col("seq").desc()).first()

    def current(self) -> tuple[str, dict[str, str]] | None:
        """(version, {table: path}) of the newest committed manifest, or None."""
        row = self._newest()
        return None if row is None else (row["version"], _paths(row))

    def has(self, version: str) -> bool:
        """Whether a version of this label is committed."""
        return self._newest(version) is not None

    def stored(self, version: str | None = None) -> dict[str, Stored]:
        """The tables of the current (or a given) version; one small read of the manifests."""
        row = self._newest(version)
        if row is None:
            if version is None:
                return {}
            raise KeyError(f"no version {version}")
        return {t: Stored.of(e) for t, e in json.loads(row["tables"]).items()}

    def paths(self, version: str | None = None) -> dict[str, str]:
        """{table: path} of the current (or a given) version."""
        return {t: s.path for t, s in self.stored(version).items()}

    def snapshot(self, version: str | None = None, stored: Mapping[str, Stored] | None = None) -> dict[str, DataFrame]:
        """Every state table of one version (empty tables for ones never published)."""
        stored = self.stored(version) if stored is None else stored
        return {t: self._load(t, stored) for t in STATE_DDL}

    def _load(self, table: str, stored: Mapping[str, Stored]) -> DataFrame:
        ddl = {**STATE_DDL, REFERENCES: REFERENCES_DDL}.get(table)
        if ddl is None:  # a table beside the state, as it was written
            return self.spark.read.parquet(stored[table].path)
        schema = StructType.fromDDL(ddl)
        if table not in stored:
            return self.spark.createDataFrame([], schema)
        return self.open(stored[table], schema)

    def open(self, stored: Stored, schema: StructType) -> DataFrame:
        if stored.buckets is None:
            return self.spark.read.schema(schema).parquet(stored.path)
        return attach(self.spark, stored.path, schema, stored.buckets)

    def put(self, table: str, df: DataFrame, folder: str, aligned: bool = False, split: str | None = None) -> Stored:
        """Write a table for a version to come, ``folder`` being that of the attempt.

        With ``split`` (a boolean column) the rows for which it is true lie
        apart: the result is the table of the others, see :meth:`apart`.
        """
        path, buckets = f"{self.root}/{table}/{folder}", self.buckets.get(table)
        if buckets:
            write_bucketed(df, path, buckets, aligned, split)
        else:
            writer = df.write.mode("error")
            (writer.partitionBy(split) if split else writer).parquet(path)
        if split:
            path = f"{path}/{split}=false"
            make_folder(self.spark, path)  # it is missing if there are no such rows
        return Stored(path, buckets)

    def apart(self, stored: Stored, schema: StructType) -> DataFrame:
        """The rows that ``put`` has set apart from ``stored``."""
        path = stored.path.removesuffix("=false") + "=true"
        make_folder(self.spark, path)
        return self.spark.read.schema(schema).parquet(path)

    def forget(self, version: str) -> None:
        """Drop the catalog's entries for a version's bucketed tables; the files stay."""
        for s in self.stored(version).values():
            if s.buckets:
                detach(self.spark, s.path)

    def read_report(self, name: str, version: str) -> DataFrame:
        row = self._newest(version)
        if row is None or name not in json.loads(row["reports"]):
            raise KeyError(f"no report {name} of version {version}")
        return self.spark.read.parquet(json.loads(row["reports"])[name])

    def park(self, rows: DataFrame) -> None:
        """Set aside deliveries that cannot be applied; see :meth:`parked`."""
        rows.write.mode("append").parquet(f"{self.root}/_parked")

    def parked(self) -> DataFrame | None:
        """Deliveries that were set aside, or None if there never was one."""
        path = f"{self.root}/_parked"
        return self.spark.read.schema(PARKED).parquet(path) if path_exists(self.spark, path) else None

    def read(self, table: str, version: str | None = None) -> DataFrame:
        """A table of the current (or a given) version; an empty state table if it was never published."""
        return self._load(table, self.stored(version))

    def publish(self, tables: Mapping[str, DataFrame | Stored], version: str,
                reports: Mapping[str, DataFrame] | None = None) -> dict[str, Stored]:
        """Write every table that is not stored yet, then the manifest (which keeps unchanged tables of the last version).

        ``reports`` (audit tables of the run) are written under ``_reports``
        before the manifest.  The reference counts (``REFERENCES``) belong to the
        very tables they come with: a publish without them drops them.
        """
        newest = self._newest()
        if self.has(version):
            raise ValueError(f"version {version!r} is committed already")
        folder = new_folder(version)
        entries = json.loads(newest["tables"]) if newest else {}
        entries.pop(REFERENCES, None)
        for name, table in tables.items():
            entries[name] = (table if isinstance(table, Stored) else self.put(name, table, folder)).entry()
        report_paths = {name: f"{self.root}/_reports/{name}/{folder}" for name in reports or {}}
        for name, path in report_paths.items():
            reports[name].write.mode("error").parquet(path)
        row = (newest["seq"] + 1 if newest else 0, version, json.dumps(entries, sort_keys=True),
               json.dumps(report_paths, sort_keys=True))
        (self.spark.createDataFrame([row], MANIFEST).coalesce(1)
         .write.mode("error").json(f"{self.root}/_manifests/{folder}"))
        return {name: Stored.of(e) for name, e in entries.items()}


def new_folder(version: str) -> str:
    """A folder name for one attempt at a version."""
    return f"v={version}-{uuid.uuid4().hex}"


def _paths(row: Row) -> dict[str, str]:
    return {t: Stored.of(e).path for t, e in json.loads(row["tables"]).items()}
