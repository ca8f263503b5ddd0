"""One monthly cycle: apply a feed and a delete list to the current state.

Phase order keeps referential integrity, as in the original:

1. load    read feed and standardised file (strict or quarantine; or run the
           standardiser's callable on the feed), stitch them on admid to one
           delta row per parcel, check the rules of the three tables;
2. merge   pass 1: identity get-or-insert (first match = lowest id) with
           reactivation of matched inactive identities, then entity
           get-or-insert under the resolved identity;
           pass 2: parcel upsert by admid (id kept on update, new id after
           the current maximum on insert) with the normalised match address;
3. delete  the upsert's join also marks the parcels on the delete list (an
           admid in both ends up deleted); they are written apart from the
           others, and their postcards lose the reference;
4. sweep   identities without parcels become inactive, entities without
           parcels are removed; the state keeps how many parcels refer to
           each, so only parents that the month touches are looked at;
5. publish all four tables as one new version (see ``sources.state``).

The delta resolves both keys against the state directly: its mailing keys are
grouped once for their survivors, and only keys and names that the state
lacks are numbered.  Both foreign keys of a parcel are resolved on the key
columns alone and attached by admid in the upsert, so the delta's parcels are
shuffled once in full width.  The delta is written in full width four times:
feed and standardised load, the stitched delta and, inside the merged parcels,
its result; everything else that is staged is narrow (names, keys and ids).
The merged parcels are written once, at the place that the new version names;
if the store buckets them by admid, they are not shuffled at all.

Every step is a join or an aggregate over whole tables; nothing is collected
to the driver except the counts of ``Observation`` and one example reject of
a failed strict check.  Phase outputs are staged tables in the shared
checkpoint folder, so a lost executor recomputes at most one phase.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from landroll.functions.address import make_point, match_address_raw, normalize_address
from landroll.functions.cast import coalesce_defaults, typed_cast
from landroll.operators.dedup import keep_first
from landroll.operators.enrich import standardize_batches, standardize_once
from landroll.operators.joins import first_match, hot_keys, salted_join
from landroll.operators.keyfilter import matching, worth_it
from landroll.operators.merge import conform, get_or_insert, mark_deleted, reactivate, upsert
from landroll.operators.prune import delete_by_keys, drop_orphans, flag_orphans, null_references
from landroll.operators.refcounts import (apply_changes, childless, count_references, drop_listed, flag_listed, held,
                                          reference_changes)
from landroll.operators.quality import enforce, raise_if_any, reject_path
from landroll.plans.relate import (ENTITY_SOURCE, FLAT_TEXT_DEFAULTS, IDENTITY_KEY, IDENTITY_SOURCE,
                                   MAIL_RENAMES, MAIL_STREET_PARTS, TRIO_INPUT_COLUMNS, address_extract, audit_stitch, check_delta,
                                   delta_rows, identity_survivors, stitch_feed)
from landroll.session import drop_path, phase, stage, staging_area
from landroll.sources.buckets import planned_for
from landroll.sources.delimited import (read_delete_list, read_feed, read_standardized,
                                        write_address_extract)
from landroll.sources.schemas import EXTRACT_COLUMNS, REFERENCES_DDL, STATE_DDL, STD_COLUMNS, STD_FORCED, STD_REQUIRED, STD_SPECS, state_columns
from landroll.sources.state import ADDRESSES, REFERENCES, StateStore, Stored, new_folder

ENTITY_NAMES = list(ENTITY_SOURCE)
ENTITY_KEY = ENTITY_NAMES + ["identity_id"]
PHASES = ("load", "merge", "delete", "sweep")
# Parcel columns the delta carries into the state on insert/update.
PARCEL_UPDATE_COLUMNS = [c for c in state_columns("parcel") if c not in ("id", "admid")]
# Never filled by the feed: with overwrite_nulls=True an update writes NULL
# over the stored value (the original's behaviour), otherwise it is kept.
NEVER_IN_FEED = ["parcel_privacy", "rental_flag"]


@dataclass
class CycleResult:
    version: str
    tables: dict[str, DataFrame]
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    staging: str | None = None   # staging folder, when kept


@dataclass
class Delta:
    rows: DataFrame         # one per parcel: identity, entity and parcel columns
    identities: DataFrame   # survivor per mailing key, with the rows of the key as _rows


def standardize(feed: DataFrame, standardizer: Callable, mode: str = "strict", remember: bool = False,
                memo: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(standardised rows, rejects, new memo entries) of a per-batch callable run on the feed's address extract.

    The callable maps a pandas frame of the extract's columns to one of
    ``STD_COLUMNS`` as text; its output passes the same checks as a file.
    With ``remember`` it sees every distinct address once that ``memo`` lacks,
    under the smallest admid that has it, which a reject then names.
    """
    schema = ", ".join(f"`{c}` string" for c in STD_COLUMNS)
    extract = address_extract(feed).select(*[F.col(c).cast("string").alias(c) for c in EXTRACT_COLUMNS])
    found: list[DataFrame] = []

    def ask(addresses: DataFrame) -> DataFrame:
        text = addresses.select(*[F.col(c).cast("string").alias(c) for c in EXTRACT_COLUMNS])
        typed, _ = typed_cast(standardize_batches(text, standardizer, schema), STD_SPECS, forced=STD_FORCED,
                              required=STD_REQUIRED)
        out = stage(typed, "standardized")
        rejects = out.where(F.size("_problems") > 0).select(
            "admid", F.lit(None).cast("string").alias("raw_line"), F.col("_problems").alias("problems"),
            F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("block_start"))
        if mode == "strict" and rejects.first() is not None:
            path = reject_path(feed.sparkSession, "standardized")
            rejects.write.mode("error").parquet(path)
            raise_if_any(rejects, "standardized", path)
        found.append(rejects)
        return out.where(F.size("_problems") == 0).drop("_problems")

    if not remember:
        return ask(extract), found[0], None
    keyed = extract.withColumn("admid", F.col("admid").cast("long"))
    rows, entries = standardize_once(keyed, ask, "admid", [c for c in EXTRACT_COLUMNS if c != "admid"], memo)
    return rows, found[0], entries


def load_delta(spark: SparkSession, feed_path, std_path, mode: str = "strict",
               standardizer: Callable | None = None, remember: bool = False, memo: DataFrame | None = None,
               ) -> tuple[Delta, dict[str, DataFrame], DataFrame, DataFrame | None]:
    """Read, standardise, stitch and check the month; returns (delta, rejects, audit of the stitch, new memo entries)."""
    # Every column is validated, but only the ones the trio reads are staged.
    std_needed = [c for c in TRIO_INPUT_COLUMNS if c in STD_COLUMNS]
    feed_needed = [c for c in TRIO_INPUT_COLUMNS if c not in std_needed]
    if standardizer is not None:
        feed_needed += [*MAIL_STREET_PARTS, *MAIL_RENAMES]
    with phase(spark, "read feed"):
        feed = read_feed(spark, feed_path, mode, columns=list(dict.fromkeys(feed_needed)))
    rejects = {"feed": feed.rejects}
    entries = None
    with phase(spark, "read standardized"):
        if standardizer is None:
            std = read_standardized(spark, std_path, mode, columns=std_needed)
            std_rows, rejects["standardized"] = std.rows, std.rejects
        else:
            std_rows, rejects["standardized"], entries = standardize(feed.rows, standardizer, mode, remember, memo)
    with phase(spark, "stitch"):
        rows = stage(delta_rows(stitch_feed(feed.rows, std_rows.select("admid", *[c for c in std_needed
                                                                                 if c != "admid"]))), "delta")
        identities = stage(identity_survivors(rows), "delta_identities")
    with phase(spark, "check delta"):
        found, bad_keys = check_delta(rows, identities)
        # The stitch multiplies a parcel whose admid the standardiser repeats: that shows as a repeated admid.
        rejects["constraints"] = enforce(found, mode)
        if mode == "quarantine":
            # Hold back every parcel that breaks a rule or whose identity does.
            bad = rejects["constraints"].where(F.col("table") != "identity")
            rows = delete_by_keys(rows, bad.select(F.col("key").cast("long").alias("admid")), "admid")
            same = [F.col(k).eqNullSafe(F.col(f"_bad_{k}")) for k in IDENTITY_KEY]
            keys = bad_keys.select(*[F.col(k).alias(f"_bad_{k}") for k in IDENTITY_KEY])
            rows = stage(rows.where("admid is not null").join(keys, same, "left_anti"), "delta_kept")
            identities = stage(identity_survivors(rows), "delta_identities")
    return Delta(rows, identities), rejects, audit_stitch(feed.rows, std_rows), entries


def _defaults(df: DataFrame) -> DataFrame:
    return coalesce_defaults(df, [c for c in FLAT_TEXT_DEFAULTS if c in df.columns])


def _known(state: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest id and number of state rows of the candidates' keys; the rest of the state is dropped unshuffled."""
    rows = matching(state, candidates, keys) if worth_it(state) else state
    return (first_match(rows, keys, count_col="n").join(candidates.select(*keys), list(keys), "left_semi"))


def merge_delta(state: dict[str, DataFrame], delta: Delta, overwrite_nulls: bool = True,
                normalizer: Callable[[Column], Column] = normalize_address, deletes: DataFrame | None = None,
                partitions: int | None = None) -> tuple[dict[str, DataFrame], dict, DataFrame]:
    """Pass 1 (identity, entity) and pass 2 (parcel) of the merge; returns new tables, reports and foreign keys.

    The returned parcel table carries an ``op`` column (insert/update/keep)
    and, with ``deletes``, the flag ``gone``.  ``partitions`` is the number of
    buckets of the state's parcels, if they are bucketed.
    """
    identity, entity, parcel = state["identity"], state["entity"], state["parcel"]
    rows = _defaults(delta.rows)

    # Pass 1a: identities.  One pass over the state's identities gives the
    # first match of each key of the delta and the multi-match report.
    cands = _defaults(delta.identities)
    hot_ident = hot_keys(cands, IDENTITY_KEY, count_col="_rows")
    ident_first = stage(_known(identity, cands, IDENTITY_KEY), "state_identity_keys")
    new = cands.drop("_rows").withColumn("mail_location", make_point("mail_longitude", "mail_latitude"))
    _, new_ident = get_or_insert(identity, new, IDENTITY_KEY, existing_keys=ident_first,
                                 defaults={"primary_name": F.lit(""), "rental_count": F.lit(0)})
    new_ident = stage(new_ident, "identity_inserted")  # read by the lookup, the table and the report
    identity = reactivate(identity, ident_first.select("id")).unionByName(new_ident)
    lookup_ident = (ident_first.select("id", *IDENTITY_KEY).unionByName(new_ident.select("id", *IDENTITY_KEY))
                    .withColumnRenamed("id", "identity_id"))

    # Pass 1b: entities under the resolved (state) identity, from names and keys alone.
    named = stage(salted_join(rows.select("admid", *IDENTITY_KEY, *ENTITY_NAMES), lookup_ident, IDENTITY_KEY, "left",
                              hot=hot_ident, salt_cols=["admid"]).select("admid", *ENTITY_KEY), "delta_names")
    ent_cands = stage(keep_first(named.select(*ENTITY_KEY), ENTITY_KEY, count_col="_rows"), "delta_entities")
    hot_ent = hot_keys(ent_cands, ENTITY_KEY, count_col="_rows")
    ent_first = stage(_known(entity, ent_cands, ENTITY_KEY), "state_entity_keys")
    _, new_ent = get_or_insert(entity, ent_cands.drop("_rows"), ENTITY_KEY, existing_keys=ent_first)
    new_ent = stage(new_ent, "entity_inserted")
    entity = entity.unionByName(new_ent)
    lookup_ent = (ent_first.select("id", *ENTITY_KEY).unionByName(new_ent.select("id", *ENTITY_KEY))
                  .withColumnRenamed("id", "entity_id"))
    # The two foreign keys of each parcel: three numbers a row, attached by admid in the upsert.
    foreign = stage(salted_join(named, lookup_ent, ENTITY_KEY, "left", hot=hot_ent, salt_cols=["admid"])
                    .select("admid", "identity_id", "entity_id"), "delta_foreign_keys")

    # Pass 2: parcels, labelled insert / update / keep.
    match = normalizer(match_address_raw("parcel_address1", "parcel_address2", "parcel_city", "parcel_state"))
    own = [c for c in PARCEL_UPDATE_COLUMNS if c not in ("identity_id", "entity_id")]
    parcel_delta = (rows.withColumn("parcel_match_address", match)
                    .withColumn("parcel_location", make_point("parcel_longitude", "parcel_latitude"))
                    .withColumns({c: F.lit(None).cast("boolean") for c in NEVER_IN_FEED}).select("admid", *own))
    parcel = upsert(parcel, parcel_delta, "admid", PARCEL_UPDATE_COLUMNS, overwrite_nulls=True,
                    keep_state_cols=() if overwrite_nulls else NEVER_IN_FEED, delta_keys=foreign,
                    attached=foreign, deletes=deletes, partitions=partitions, checked=True)
    reports = {
        "identity_multi_match": ident_first.where("n > 1").select(*IDENTITY_KEY, "n"),
        "entity_multi_match": ent_first.where("n > 1").select(*ENTITY_KEY, "n"),
        "identity_inserted": new_ident,
        "entity_inserted": new_ent,
    }
    return {"identity": identity, "entity": entity, "parcel": parcel, "postcard": state["postcard"]}, reports, foreign


# The tables a parcel refers to, and by which column.
PARCEL_PARENTS = {"identity": "identity_id", "entity": "entity_id"}


def moved_references(references: DataFrame, parcel: DataFrame, foreign: DataFrame | None, deletes: DataFrame | None,
                     partitions: int | None = None) -> DataFrame:
    """Reference counts after the month: those of ``references``, moved by the parcels that the month touches.

    ``parcel`` is the state before the month, of which three columns are read;
    ``foreign`` has the foreign keys of the delta's parcels.
    """
    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(partitions, "admid") if partitions else df

    listed = None if deletes is None else deletes.select("admid").distinct()
    touched = [df.select("admid") for df in (foreign, listed) if df is not None]
    keys = touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1]).distinct()
    old = parcel.select("admid", *PARCEL_PARENTS.values()).join(dealt(keys), "admid", "left_semi")
    if foreign is None:
        new, gone = old.limit(0), None
    else:
        gone = F.lit(False) if listed is None else F.col("_listed").isNotNull()
        new = foreign if listed is None else foreign.join(
            listed.select(F.col("admid").alias("_listed")), F.col("admid") == F.col("_listed"), "left")
    changes = reference_changes(old, new, PARCEL_PARENTS, gone)
    return stage(apply_changes(references, changes), "references_moved")


def sweep(tables: dict[str, DataFrame], moved: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Identities without parcels become inactive; entities without parcels are dropped; returns the reference counts too.

    With ``moved`` (see :func:`moved_references`) only the parents that the
    month touched are looked at; without, all parcels are counted.
    """
    if moved is not None:
        return {**tables, "identity": flag_listed(tables["identity"], childless(moved, "identity")),
                "entity": drop_listed(tables["entity"], childless(moved, "entity"))}, held(moved)
    counted = stage(count_references(tables["parcel"], PARCEL_PARENTS), "references")
    refs = {p: counted.where(F.col("parent") == p).select(F.col("id").alias(fk)) for p, fk in PARCEL_PARENTS.items()}
    return {**tables,
            "identity": flag_orphans(tables["identity"], refs["identity"], "identity_id"),
            "entity": drop_orphans(tables["entity"], refs["entity"], "entity_id")}, counted


def export_address_extract(spark: SparkSession, feed_path, out_path: str, mode: str = "strict") -> DataFrame:
    """Validate the feed and write the standardiser's input (admid, street, secondary, city, state).

    This is the export that precedes the external standardiser; its output
    file is then the ``std_path`` of :func:`run_cycle`.  Returns the rejects.
    """
    with staging_area(spark, "export") as folder, phase(spark, "export address extract"):
        try:
            feed = read_feed(spark, feed_path, mode, columns=["admid", *MAIL_STREET_PARTS, *MAIL_RENAMES])
            write_address_extract(address_extract(feed.rows), out_path)
            rejects = feed.rejects
            if mode == "quarantine":
                rejects_path = f"{out_path.rstrip('/')}_rejects"
                rejects.write.mode("error").parquet(rejects_path)
        finally:
            drop_path(spark, folder)
    return spark.read.parquet(rejects_path) if mode == "quarantine" else spark.createDataFrame([], rejects.schema)


def _check_options(phases: Sequence[str], feed_path, std_path, delete_path, standardizer,
                   skip_standardize: bool) -> None:
    """Refuse unknown phases, and phases without what they read."""
    unknown = [p for p in phases if p not in PHASES]
    if unknown or not phases:
        raise ValueError(f"unknown phases {unknown}; choose from {PHASES}" if unknown else "no phase to run")
    if ("load" in phases) != ("merge" in phases):
        raise ValueError("load and merge go together: a loaded month is merged")
    if "load" in phases:
        if feed_path is None:
            raise ValueError("phase load needs feed_path")
        if skip_standardize and std_path is None:
            raise ValueError("skip_standardize needs the std_path of an earlier standardisation")
        if not skip_standardize and std_path is None and standardizer is None:
            raise ValueError("phase load needs std_path or a standardizer")
        if std_path is not None and standardizer is not None and not skip_standardize:
            raise ValueError("give std_path or a standardizer, or skip_standardize to prefer the file")
    if "delete" in phases and delete_path is None:
        raise ValueError("phase delete needs delete_path")


def run_cycle(spark: SparkSession, store: StateStore, version: str, feed_path=None, std_path=None,
              delete_path=None, mode: str = "strict", overwrite_nulls: bool = True,
              phases: Sequence[str] = PHASES, publish: bool = True, keep_staging: bool = False,
              normalizer: Callable[[Column], Column] = normalize_address,
              standardizer: Callable | None = None, skip_standardize: bool = False,
              remember_addresses: bool = False) -> CycleResult:
    """Apply one month.  ``phases`` may drop "load" and "merge" (only deletes and sweeps run).

    Addresses are standardised by ``standardizer`` (see :func:`standardize`)
    or come from ``std_path``; ``skip_standardize`` takes the file even if a
    standardizer is given.  ``remember_addresses`` (for a standardizer that
    looks at the address alone) asks it once per distinct address, and keeps
    the answers with the version for later months.

    Intermediate tables live in a staging folder of this run under the shared
    checkpoint folder.  It is deleted at the end, also of a failed run, unless
    ``keep_staging``; without ``publish`` the result frames still read the
    staged tables, so the folder is kept (``result.staging``).  The reports
    are stored with the version (``store.read_report``).
    """
    _check_options(phases, feed_path, std_path, delete_path, standardizer, skip_standardize)
    if publish and store.has(version):
        raise ValueError(f"version {version!r} is committed already")
    keep = keep_staging
    with staging_area(spark, f"run-{version}") as folder:
        # A run that is not published leaves its parcels in its staging folder.
        home = store if publish else StateStore(spark, folder, store.buckets)
        try:
            result, stored, derived = _run(spark, home, store, version, feed_path, std_path, delete_path, mode,
                                           overwrite_nulls, phases, normalizer,
                                           None if skip_standardize else standardizer, remember_addresses)
            if publish:
                _publish(spark, store, result, stored, derived, mode)
            else:
                keep = True
        finally:
            if not keep:
                drop_path(spark, folder)
    result.staging = folder if keep else None
    return result


def _publish(spark: SparkSession, store: StateStore, result: CycleResult, stored: Stored, derived: dict[str, DataFrame],
             mode: str) -> None:
    tables = {**result.tables, "parcel": stored, **derived}
    reports = {name: df for name, df in result.reports.items()}
    # In strict mode any reject has already aborted the run: nothing to keep.
    rejects = {} if mode == "strict" else {f"rejects_{n}": df for n, df in result.rejects.items()}
    with phase(spark, "publish"):
        published = store.publish(tables, result.version, reports={**reports, **rejects})
    result.tables = store.snapshot(stored=published)
    result.reports = {name: store.read_report(name, result.version) for name in reports}
    result.rejects = {name[len("rejects_"):]: store.read_report(name, result.version) for name in rejects}


def _run(spark, home: StateStore, store: StateStore, version, feed_path, std_path, delete_path, mode, overwrite_nulls,
         phases, normalizer, standardizer, remember) -> tuple[CycleResult, Stored, dict[str, DataFrame]]:
    """The new tables, where the parcels are, and what is derived: reference counts if they are swept, address memo.

    The parcels are written under ``home`` once, those on the delete list apart.
    """
    result = CycleResult(version, {})
    stored_before = store.stored()
    tables = store.snapshot(stored=stored_before)
    parcel_before, foreign = tables["parcel"], None
    derived: dict[str, DataFrame] = {}
    buckets = home.buckets.get("parcel")
    partitions = buckets.count if buckets else None
    # The result lies in the buckets of the state it was joined with, if they are the ones it is written with.
    aligned = buckets is not None and "parcel" in stored_before and stored_before["parcel"].buckets == buckets
    deletes = None
    if "delete" in phases:
        with phase(spark, "read deletes"):
            listed = read_delete_list(spark, delete_path, mode)
        result.rejects["deletes"] = listed.rejects
        deletes = listed.rows
    counts = Observation("parcels")
    gone = F.coalesce("gone", F.lit(False))
    counted = [F.count(F.when(~gone, 1)).alias("parcels"), F.count(F.when(gone, 1)).alias("deleted")]
    if "load" in phases:
        memo = stored_before.get(ADDRESSES) if remember else None
        memo = None if memo is None else spark.read.parquet(memo.path)
        delta, rejects, audit, entries = load_delta(spark, feed_path, std_path, mode, standardizer, remember, memo)
        if entries is not None:
            derived[ADDRESSES] = entries if memo is None else memo.unionByName(entries)
        result.rejects.update(rejects)
        with phase(spark, "merge pass 1"):
            tables, reports, foreign = merge_delta(tables, delta, overwrite_nulls, normalizer, deletes, partitions)
        result.reports.update(reports, stitch_audit=audit)
        op = F.col("op")
        counted += [F.count(F.when(op == name, 1)).alias(name) for name in ("insert", "update", "keep")]
        marked = tables["parcel"] if deletes is not None else tables["parcel"].withColumn("gone", F.lit(False))
    elif deletes is not None:
        marked = mark_deleted(tables["parcel"], deletes, "admid", partitions=partitions)
    else:
        marked = tables["parcel"].withColumn("gone", F.lit(False))
    schema = StructType.fromDDL(STATE_DDL["parcel"])
    with phase(spark, "merge pass 2"), planned_for(spark, buckets):
        flagged = conform(marked.observe(counts, *counted), StructType([*schema, StructField("gone", BooleanType())]))
        stored = home.put("parcel", flagged, new_folder(version), aligned=aligned, split="gone")
    result.counts.update(counts.get)
    tables["parcel"] = home.open(stored, schema)
    if deletes is not None:
        tables["postcard"] = null_references(tables["postcard"], home.apart(stored, schema).select("id"), "parcel_id")
    if "sweep" in phases:
        with phase(spark, "sweep"), planned_for(spark, buckets):
            moved = None
            if REFERENCES in stored_before and (foreign is not None or deletes is not None):
                before = store.open(stored_before[REFERENCES], StructType.fromDDL(REFERENCES_DDL))
                moved = moved_references(before, parcel_before, foreign, deletes, partitions)
            tables, derived[REFERENCES] = sweep(tables, moved)
    result.tables = {name: conform(df, StructType.fromDDL(STATE_DDL[name])) for name, df in tables.items()}
    return result, stored, derived

