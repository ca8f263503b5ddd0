"""End-to-end monthly cycle over generated files (the cases of FIXTURES.md section 6)."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from filegen import write_deletes, write_feed, write_std
from landroll.operators.quality import ConstraintViolation, check_fk, check_unique
from landroll.plans.cycle import run_cycle
from landroll.sources.schemas import STATE_DDL
from landroll.sources.state import StateStore


def _state_df(spark, table, rows):
    schema = StructType.fromDDL(STATE_DDL[table])
    full = [{f.name: r.get(f.name) for f in schema.fields} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in full], schema)


def _ident(i, addr, city, inactive=None, zipc="84001"):
    return {"id": i, "mail_address": addr, "mail_city": city, "mail_state": "UT", "mail_zipcode": zipc,
            "mail_verified": "Y", "mail_geoquality": "Zip9", "rdi": "R", "primary_name": "P", "rental_count": 2,
            "inactive": inactive}


def _ent(i, owner, ident):
    names = {c: "" for c in ["owner1_firstname", "owner1_lastname", "owner2_firstname", "owner2_lastname",
                             "coowner", "coowner1_firstname", "coowner1_lastname", "coowner2_firstname",
                             "coowner2_lastname"]}
    return {"id": i, "owner": owner, "identity_id": ident, **names}


def _parcel(i, admid, ident, ent, privacy=None, rental=None):
    return {"id": i, "admid": admid, "parcel_fips": "49035", "record_type": "RESIDENTIAL", "identity_id": ident,
            "entity_id": ent, "parcel_privacy": privacy, "rental_flag": rental, "total_value": 1}


def _feed(admid, owner, **kw):
    return {"admid": admid, "partyowner1namefull": owner, "propertyaddresshousenumber": str(admid),
            "propertyaddressstreetname": "MAIN", "propertyaddresscity": "TOWN", "propertyaddressstate": "UT",
            "taxassessedvaluetotal": admid * 10, **kw}


def _std(admid, addr, city, zipc="84001", lat="40.1", lon="-111.9"):
    return {"admid": admid, "delivery_line_1": addr, "city_name": city, "state_abbreviation": "UT" if addr else "",
            "zipcode": zipc, "summary": "Y", "latitude": lat, "longitude": lon, "precision": "Zip9", "rdi": "R"}


@pytest.fixture()
def month(spark, workdir):
    store = StateStore(spark, os.path.join(workdir, "state"))
    store.publish({
        "identity": _state_df(spark, "identity", [
            _ident(1, "1 MAIN ST", "SPRINGFIELD"), _ident(2, "2 OAK AVE", "OGDEN", True),
            _ident(3, "3 ELM RD", "PROVO", True), _ident(4, "9 DUP LN", "MOAB"), _ident(5, "9 DUP LN", "MOAB")]),
        "entity": _state_df(spark, "entity", [_ent(10, "ALICE", 1), _ent(11, "BOB", 2), _ent(12, "CAROL", 3),
                                               _ent(13, "DAVE", 4)]),
        "parcel": _state_df(spark, "parcel", [_parcel(100, 1001, 1, 10, True, True), _parcel(101, 1002, 2, 11),
                                               _parcel(102, 1003, 3, 12), _parcel(103, 1004, 4, 13)]),
        "postcard": _state_df(spark, "postcard", [{"id": 1, "parcel_id": 102}, {"id": 2, "parcel_id": 103}]),
    }, "000")
    feed = write_feed(os.path.join(workdir, "in", "feed.txt"), [
        _feed(1001, "ZED"), _feed(1002, "BOB"), _feed(1003, "CAROL"), _feed(2001, "EVE"),
        _feed(2002, "GUS"), _feed(2003, "GUS"), _feed(2004, "HAL"), _feed(2005, "HAL"), _feed(2006, "FRANK"),
        _feed(2007, "IVY"), _feed(2008, "JOE"),
        _feed(2009, "KIM", propertyaddresshousenumber="", propertyaddressstreetdirection=" N\t",
              propertyaddressstreetname="  ELM   GROVE ", propertyaddressstreetsuffix="", propertyaddresscity="Caf\xe9",
              propertylatitude="", propertylongitude="-111.5"),
    ])
    std = write_std(os.path.join(workdir, "in", "std.tsv"), [
        _std(1001, "1 MAIN ST", "SPRINGFIELD", zipc="99999", lat="41.0", lon="-112.0"),
        _std(1002, "2 OAK AVE", "OGDEN"), _std(1003, "3 ELM RD", "PROVO"), _std(2001, "7 NEW ST", "PARK CITY"),
        _std(2002, "8 TWIN DR", "LOGAN", zipc="84322"), _std(2003, "8 TWIN DR", "LOGAN", zipc="84321"),
        _std(2004, "", ""), _std(2005, "", ""), _std(2006, "9 DUP LN", "MOAB"), _std(2007, "5 GONE CT", "VERNAL"),
        _std(2009, "4 ELM GROVE", "CAFE"),
    ])
    deletes = write_deletes(os.path.join(workdir, "in", "deletes.txt"), [1003, 2007, 9999, 1003], blank_lines=1)
    return store, feed, std, deletes


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_full_cycle(spark, month):
    store, feed, std, deletes = month
    res = run_cycle(spark, store, "001", feed, std, deletes)
    ident = _rows(res.tables["identity"], "id")
    ent = _rows(res.tables["entity"], "id")
    par = _rows(res.tables["parcel"], "admid")
    cards = _rows(res.tables["postcard"], "id")

    # Parcels: 1003 and 2007 deleted, 2008 had no standardised row, 9999 unknown.
    assert sorted(par) == [1001, 1002, 1004, 2001, 2002, 2003, 2004, 2005, 2006, 2009]
    assert par[1001]["id"] == 100 and par[1002]["id"] == 101 and par[1004]["id"] == 103
    new_ids = [par[a]["id"] for a in [2001, 2002, 2003, 2004, 2005, 2006, 2009]]
    assert new_ids == [104, 105, 106, 107, 108, 109, 111]  # 110 went to 2007, then deleted
    # Update overwrites the never-fed flags with NULL; the new owner is a new entity.
    assert par[1001]["parcel_privacy"] is None and par[1001]["rental_flag"] is None
    assert ent[par[1001]["entity_id"]]["owner"] == "ZED"
    assert par[1001]["total_value"] == 10010

    by_key = {}
    for r in ident.values():
        by_key.setdefault((r["mail_address"], r["mail_city"], r["mail_state"]), []).append(r)
    # Existing identity keeps its attributes; a new one gets primary_name '' and rental_count 0.
    assert ident[1]["mail_zipcode"] == "84001" and ident[1]["mail_latitude"] is None
    new = by_key[("7 NEW ST", "PARK CITY", "UT")][0]
    assert new["primary_name"] == "" and new["rental_count"] == 0 and new["id"] > 5
    assert new["mail_location"]["srid"] == 4326 and new["mail_latitude"] == Decimal("40.100000")
    # Same key twice in the feed: one identity, survivor = smallest attribute tuple.
    twin = by_key[("8 TWIN DR", "LOGAN", "UT")]
    assert len(twin) == 1 and twin[0]["mail_zipcode"] == "84321"
    assert par[2002]["identity_id"] == par[2003]["identity_id"] == twin[0]["id"]
    # Both unstandardised rows share the blank identity.
    blank = by_key[("", "", "")]
    assert len(blank) == 1 and par[2004]["identity_id"] == par[2005]["identity_id"] == blank[0]["id"]
    # Two state identities with one key: the lowest id wins.
    assert par[2006]["identity_id"] == 4
    # Reactivation, then sweep: 2 stays active (NULL), 3 lost its only parcel, 5 never had one.
    assert ident[2]["inactive"] is None
    assert ident[3]["inactive"] is True and ident[5]["inactive"] is True
    assert ident[1]["inactive"] is None

    # Entities without parcels are gone (ALICE lost 1001 to ZED, CAROL lost 1003).
    owners = {r["owner"] for r in ent.values()}
    assert "ALICE" not in owners and "CAROL" not in owners and {"BOB", "DAVE", "ZED", "GUS", "HAL"} <= owners
    # Postcard of the deleted parcel loses its reference.
    assert cards[1]["parcel_id"] is None and cards[2]["parcel_id"] == 103

    # Composition: NULL/blank/tab/double-blank parts; NULL latitude -> NULL point.
    assert par[2009]["parcel_address1"] == "N ELM GROVE"
    assert par[2009]["parcel_city"] == "Caf\xe9"
    assert par[2009]["parcel_location"] is None
    assert par[2001]["parcel_location"] is None  # the feed rows carry no situs coordinates
    assert par[2009]["parcel_match_address"] == "N ELM GROVE CAFE UT"  # accent folded
    assert res.counts["insert"] == 8 and res.counts["update"] == 3 and res.counts["keep"] == 1
    assert res.counts["deleted"] == 2
    assert res.reports["identity_multi_match"].count() == 1
    assert [tuple(r) for r in res.reports["stitch_audit"].collect()] == [(2008, 1, 0, "feed_only")]
    # Referential integrity of the published state.
    t = res.tables
    assert check_fk(t["parcel"], t["identity"], "identity_id").count() == 0
    assert check_fk(t["parcel"], t["entity"], "entity_id").count() == 0
    assert check_fk(t["entity"], t["identity"], "identity_id").count() == 0
    assert check_fk(t["postcard"], t["parcel"], "parcel_id").count() == 0
    assert check_unique(t["parcel"], ["admid"]).count() == 0


def test_feed_row_order_does_not_matter(spark, month, workdir):
    """The same month with its feed and standardised lines reversed gives the same state."""
    store, feed, std, deletes = month
    first = run_cycle(spark, store, "001", feed, std, deletes, publish=False)
    expected = {t: sorted(map(tuple, first.tables[t].collect()), key=repr) for t in ("identity", "entity", "parcel")}

    def reversed_copy(path, name):
        lines = open(path, "rb").read().splitlines()
        out = os.path.join(workdir, "in", name)
        with open(out, "wb") as f:
            f.write(b"\n".join([lines[0]] + lines[1:][::-1]) + b"\n")
        return out

    again = run_cycle(spark, store, "001", reversed_copy(feed, "feed_rev.txt"), reversed_copy(std, "std_rev.tsv"),
                      deletes, publish=False)
    for t, rows in expected.items():
        assert sorted(map(tuple, again.tables[t].collect()), key=repr) == rows


def test_rerun_is_idempotent(spark, month):
    """Applying the same month twice gives the state of applying it once."""
    store, feed, std, deletes = month
    first = run_cycle(spark, store, "001", feed, std, deletes)
    snap = {t: sorted(map(tuple, first.tables[t].collect())) for t in ("identity", "parcel", "postcard")}
    owners = sorted(r["owner"] for r in first.tables["entity"].collect())
    again = run_cycle(spark, store, "002", feed, std, deletes)
    # Only the two deleted admids come back as inserts, and are deleted again.
    assert again.counts["insert"] == 2 and again.counts["deleted"] == 2
    assert sorted(r["owner"] for r in again.tables["entity"].collect()) == owners
    for t, rows in snap.items():
        assert sorted(map(tuple, again.tables[t].collect())) == rows


def test_keep_flags_when_not_overwriting(spark, month):
    store, feed, std, deletes = month
    res = run_cycle(spark, store, "001", feed, std, deletes, overwrite_nulls=False, keep_staging=True)
    par = _rows(res.tables["parcel"], "admid")
    assert par[1001]["parcel_privacy"] is True and par[1001]["rental_flag"] is True
    staged = res.staging.replace("file:", "")
    assert os.path.isdir(staged)
    from landroll.session import drop_path
    drop_path(spark, res.staging)
    assert not os.path.exists(staged)
    # Reports were stored with the version and stay readable.
    assert store.read_report("identity_multi_match", "001").count() == 1


def test_delete_only_phases(spark, month):
    store, feed, std, deletes = month
    res = run_cycle(spark, store, "001", delete_path=deletes, phases=("delete", "sweep"))
    par = _rows(res.tables["parcel"], "admid")
    assert sorted(par) == [1001, 1002, 1004]
    ident = _rows(res.tables["identity"], "id")
    assert ident[3]["inactive"] is True and ident[2]["inactive"] is True  # no reactivation without a feed


def test_failed_run_keeps_previous_version(spark, month, workdir):
    store, feed, std, deletes = month
    bad = write_feed(os.path.join(workdir, "in", "bad.txt"), [_feed(3001, "X"), _feed(3001, "Y")])
    bad_std = write_std(os.path.join(workdir, "in", "bad_std.tsv"), [_std(3001, "1 A ST", "B")])
    with pytest.raises(ConstraintViolation):
        run_cycle(spark, store, "001", bad, bad_std, deletes)
    assert store.current()[0] == "000"
    assert store.read("parcel").count() == 4


def test_stream_applies_each_month_once(spark, month, workdir):
    import json

    from landroll.streaming.monthly import watch_deliveries

    store, feed, std, deletes = month
    inbox = os.path.join(workdir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "m001.json"), "w") as f:
        json.dump({"version": "001", "feed": feed, "std": std, "deletes": deletes}, f)
    ckpt = os.path.join(workdir, "stream-ckpt")
    watch_deliveries(spark, inbox, store, checkpoint=ckpt).awaitTermination()
    assert store.current()[0] == "001"
    parcels = store.read("parcel").count()
    # A delete-only month arrives later; the first month is not applied again.
    later = write_deletes(os.path.join(workdir, "in", "deletes2.txt"), [2001])
    with open(os.path.join(inbox, "m002.json"), "w") as f:
        json.dump({"version": "002", "deletes": later}, f)
    watch_deliveries(spark, inbox, store, checkpoint=ckpt).awaitTermination()
    assert store.current()[0] == "002"
    assert store.read("parcel").count() == parcels - 1


def test_quarantine_holds_back_bad_rows(spark, month, workdir):
    """Length and not-null violations: strict aborts, quarantine applies the rest."""
    store, _, _, deletes = month
    feed = write_feed(os.path.join(workdir, "in", "q.txt"), [
        _feed(4001, "OK"), _feed(4002, "X" * 140), _feed(4003, "USE", propertyusegroup=""),
        _feed(4004, "SITUS", propertyaddressstreetname="S" * 100, propertyaddresshousenumber="9" * 25,
              propertyaddressstreetsuffix="T" * 10),
        _feed(4005, "BOOL", companyflag="perhaps")])
    std = write_std(os.path.join(workdir, "in", "q_std.tsv"), [
        _std(a, f"{a} Q ST", "QTOWN") for a in (4001, 4002, 4003, 4004, 4005)])
    with pytest.raises(ConstraintViolation):
        run_cycle(spark, store, "001", feed, std, deletes)
    res = run_cycle(spark, store, "001", feed, std, deletes, mode="quarantine")
    admids = {r.admid for r in res.tables["parcel"].collect()}
    assert 4001 in admids and not admids & {4002, 4003, 4004, 4005}
    rules = {(r.table, r.rule) for r in res.rejects["constraints"].collect()}
    assert {("entity", "length"), ("parcel", "not_null"), ("parcel", "length")} <= rules
    assert [r.admid for r in res.rejects["feed"].collect()] == [4005]
    assert "X" * 140 not in {r.owner for r in res.tables["entity"].collect()}


def test_cycle_with_every_key_salted(spark, month, monkeypatch):
    """Forcing every key through the salted (hot-key) path changes nothing."""
    import landroll.operators.joins as joins

    store, feed, std, deletes = month
    plain = run_cycle(spark, store, "001", feed, std, deletes, publish=False)
    expected = {t: sorted(map(tuple, plain.tables[t].collect()), key=repr) for t in ("identity", "entity", "parcel")}
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 1)
    salted = run_cycle(spark, store, "001", feed, std, deletes, publish=False)
    for t, rows in expected.items():
        assert sorted(map(tuple, salted.tables[t].collect()), key=repr) == rows


def test_empty_feed_month(spark, month, workdir):
    """A month whose feed and standardised files hold only their header lines."""
    store, _, _, deletes = month
    feed = write_feed(os.path.join(workdir, "in", "empty.txt"), [])
    std = write_std(os.path.join(workdir, "in", "empty_std.tsv"), [])
    res = run_cycle(spark, store, "001", feed, std, deletes)
    assert sorted(r.admid for r in res.tables["parcel"].collect()) == [1001, 1002, 1004]
    assert res.counts["insert"] == 0 and res.counts["update"] == 0 and res.counts["deleted"] == 1
    ident = _rows(res.tables["identity"], "id")
    assert ident[3]["inactive"] is True and ident[2]["inactive"] is True


def _deliver(inbox, name, **manifest):
    import json
    os.makedirs(inbox, exist_ok=True)
    with open(os.path.join(inbox, name), "w") as f:
        f.write(manifest.pop("raw", None) or json.dumps(manifest))


def _watch(spark, store, workdir, inbox):
    from landroll.streaming.monthly import watch_deliveries
    watch_deliveries(spark, inbox, store, checkpoint=os.path.join(workdir, "ckpt")).awaitTermination()


def test_late_and_malformed_manifests_are_parked(spark, month, workdir):
    store, _, _, _ = month
    inbox = os.path.join(workdir, "inbox")
    one = write_deletes(os.path.join(workdir, "in", "d1.txt"), [1001])
    two = write_deletes(os.path.join(workdir, "in", "d2.txt"), [1002])
    _deliver(inbox, "m9.json", version="9", deletes=one)
    _watch(spark, store, workdir, inbox)
    assert store.current()[0] == "9"
    _deliver(inbox, "late.json", version="8", deletes=two)
    _deliver(inbox, "bad1.json", raw="{not json")
    _deliver(inbox, "bad2.json", version="11")
    _deliver(inbox, "bad3.json", version="12", feed="x")
    _deliver(inbox, "next.json", version="10", deletes=two)
    _deliver(inbox, "again.json", version="9", deletes=two)
    _watch(spark, store, workdir, inbox)
    # 10 comes after 9; 8 never was applied and is kept for the operator with the unusable ones.
    assert store.current()[0] == "10"
    assert sorted(r.admid for r in store.read("parcel").collect()) == [1003, 1004]
    parked = [(r.version, r.reason.split(":")[0]) for r in store.parked().collect()]
    assert sorted(parked, key=repr) == sorted([("8", "late"), (None, "malformed"), ("11", "malformed"),
                                               ("12", "malformed")], key=repr)
    _watch(spark, store, workdir, inbox)
    assert store.parked().count() == 4
    # The line and the file of what could not be read are kept, so that it can be mended.
    kept = {r.file.rsplit("/", 1)[1]: r.raw for r in store.parked().collect()}
    assert kept == {"late.json": None, "bad1.json": "{not json", "bad2.json": None, "bad3.json": None}
    # A replay of the whole inbox sets nothing aside twice.
    from landroll.streaming.monthly import version_order, watch_deliveries
    watch_deliveries(spark, inbox, store, checkpoint=os.path.join(workdir, "ckpt-again")).awaitTermination()
    assert store.parked().where("reason = 'malformed'").count() == 3
    assert version_order("2\u00b2") == [(0, 2, ""), (1, 0, "\u00b2")]


def test_inbox_of_twenty_months_in_any_order(spark, workdir):
    import random

    store = StateStore(spark, os.path.join(workdir, "state"))
    store.publish({"identity": _state_df(spark, "identity", [_ident(1, "A", "B")]),
                   "entity": _state_df(spark, "entity", [_ent(1, "X", 1)]),
                   "parcel": _state_df(spark, "parcel", [_parcel(i, i, 1, 1) for i in range(1, 31)]),
                   "postcard": _state_df(spark, "postcard", [])}, "0")
    inbox = os.path.join(workdir, "inbox")
    months = list(range(1, 21))
    random.Random(3).shuffle(months)
    for m in months:
        path = write_deletes(os.path.join(workdir, "in", f"d{m}.txt"), [m])
        _deliver(inbox, f"m{m}.json", version=str(m), deletes=path)
    _watch(spark, store, workdir, inbox)
    assert store.current()[0] == "20" and store.parked() is None
    assert sorted(r.admid for r in store.read("parcel").collect()) == list(range(21, 31))


@pytest.mark.parametrize("after", [0, 1, 2, 3, "manifest"])
def test_publish_can_be_retried_after_any_failure(spark, month, monkeypatch, after):
    from pyspark.sql import DataFrameWriter

    store, _, _, deletes = month
    writes = {"n": 0}
    real_parquet, real_json = DataFrameWriter.parquet, DataFrameWriter.json

    def parquet(self, path, *a, **k):
        real_parquet(self, path, *a, **k)
        if path.startswith(store.root):
            writes["n"] += 1
            if after == writes["n"] - 1:
                raise RuntimeError("lost the driver")

    def json_(self, path, *a, **k):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    if after == "manifest":
        monkeypatch.setattr(DataFrameWriter, "json", json_)
    with pytest.raises(RuntimeError):
        run_cycle(spark, store, "001", delete_path=deletes, phases=("delete", "sweep"))
    assert store.current()[0] == "000" and store.read("parcel").count() == 4
    monkeypatch.setattr(DataFrameWriter, "parquet", real_parquet)
    monkeypatch.setattr(DataFrameWriter, "json", real_json)
    res = run_cycle(spark, store, "001", delete_path=deletes, phases=("delete", "sweep"))
    assert store.current()[0] == "001" and res.counts == {"parcels": 3, "deleted": 1}
    with pytest.raises(ValueError):
        run_cycle(spark, store, "001", delete_path=deletes, phases=("delete", "sweep"))


def test_failed_and_finished_runs_leave_no_staging(spark, month, workdir, monkeypatch):
    import landroll.plans.cycle as cycle

    store, feed, std, deletes = month
    folders = []
    real = cycle.drop_path

    def dropped(spark, folder):
        if "run-" in folder:
            assert os.path.isdir(folder.replace("file:", ""))
            folders.append(folder)
        return real(spark, folder)

    monkeypatch.setattr(cycle, "drop_path", dropped)
    bad = write_feed(os.path.join(workdir, "in", "bad.txt"), [_feed(3001, "X"), _feed(3001, "Y")])
    bad_std = write_std(os.path.join(workdir, "in", "bad_std.tsv"), [_std(3001, "1 A ST", "B")])
    with pytest.raises(ConstraintViolation) as e:
        run_cycle(spark, store, "001", bad, bad_std, deletes)
    # Every reject of a strict abort can be read after the run.
    assert spark.read.parquet(e.value.path).select("key").distinct().count() == 1
    run_cycle(spark, store, "001", feed, std, deletes)
    assert len(folders) == 2 and not any(os.path.exists(f.replace("file:", "")) for f in folders)


@pytest.mark.parametrize("options", [
    {"phases": ("delete", "sweeep"), "delete_path": "d"}, {"phases": ()}, {"phases": ("delete",)},
    {"phases": ("load",), "feed_path": "f", "std_path": "s"}, {"phases": ("merge", "sweep")},
    {"phases": ("load", "merge"), "std_path": "s"}, {"phases": ("load", "merge"), "feed_path": "f"},
    {"phases": ("load", "merge"), "feed_path": "f", "std_path": "s", "standardizer": print},
    {"phases": ("load", "merge"), "feed_path": "f", "standardizer": print, "skip_standardize": True}])
def test_run_options_are_checked(spark, workdir, options):
    store = StateStore(spark, os.path.join(workdir, "state"))
    with pytest.raises(ValueError):
        run_cycle(spark, store, "001", **options)
    assert store.current() is None


def test_standardizer_in_the_run(spark, month, workdir):
    store, feed, std, deletes = month

    def standardizer(pdf):
        import pandas as pd
        from landroll.sources.schemas import STD_COLUMNS
        known = pdf[pdf["admid"] != "2008"]
        out = pd.DataFrame({c: [None] * len(known) for c in STD_COLUMNS}, index=known.index, dtype=object)
        return out.assign(admid=known["admid"], delivery_line_1="7 HOOK ST", city_name="TOWN", state_abbreviation="UT",
                          latitude="40", longitude="-111")

    res = run_cycle(spark, store, "001", feed, None, deletes, standardizer=standardizer)
    par = _rows(res.tables["parcel"], "admid")
    new = [r for r in res.tables["identity"].collect() if r.mail_address == "7 HOOK ST"]
    assert len(new) == 1 and 2008 not in par and par[2001]["identity_id"] == new[0].id
    # skip_standardize takes the file although a standardizer is given.
    again = run_cycle(spark, store, "002", feed, std, deletes, standardizer=standardizer, skip_standardize=True)
    assert any(r.mail_address == "8 TWIN DR" for r in again.tables["identity"].collect())


def test_only_the_first_match_is_reactivated(spark, month, workdir):
    store, _, _, deletes = month
    store.publish({
        "identity": _state_df(spark, "identity", [_ident(4, "9 DUP LN", "MOAB", True), _ident(5, "9 DUP LN", "MOAB", True)]),
        "entity": _state_df(spark, "entity", [_ent(13, "DAVE", 4), _ent(14, "EVA", 5)]),
        "parcel": _state_df(spark, "parcel", [_parcel(103, 1004, 4, 13), _parcel(104, 1005, 5, 14)])}, "000b")
    feed = write_feed(os.path.join(workdir, "in", "one.txt"), [_feed(1004, "DAVE")])
    std = write_std(os.path.join(workdir, "in", "one.tsv"), [_std(1004, "9 DUP LN", "MOAB")])
    res = run_cycle(spark, store, "001", feed, std, phases=("load", "merge", "sweep"))
    ident = _rows(res.tables["identity"], "id")
    # 5 has the same key and still owns a parcel: it stays as it is.
    assert ident[4]["inactive"] is None and ident[5]["inactive"] is True


def _asking(workdir, name):
    """A standardiser that notes every address it is asked for, in a file."""
    path = os.path.join(workdir, name)

    def standardizer(pdf):
        import pandas as pd
        from landroll.sources.schemas import STD_COLUMNS
        with open(path, "a") as f:
            f.writelines(f"{s}|{c}\n" for s, c in zip(pdf["street"], pdf["city"]))
        out = pd.DataFrame({c: [None] * len(pdf) for c in STD_COLUMNS}, index=pdf.index, dtype=object)
        return out.assign(admid=pdf["admid"], delivery_line_1=pdf["street"].str.upper(), city_name=pdf["city"].str.upper(),
                          state_abbreviation="UT", latitude="40", longitude="-111")

    def asked():
        return sorted(open(path).read().split("\n")[:-1]) if os.path.exists(path) else []
    return standardizer, asked


def _mailed(admid, owner, street, city):
    return _feed(admid, owner, contactownermailaddressstreetname=street, contactownermailaddresscity=city)


def test_addresses_are_standardised_once(spark, month, workdir):
    """Three months, the last by a delivery: the callable sees each distinct address once, the results are those of asking always."""
    import json

    from landroll.streaming.monthly import watch_deliveries
    store, _, _, _ = month
    other = StateStore(spark, os.path.join(workdir, "always"))
    other.publish(store.snapshot("000"), "000")
    months = [[(7001, "A", "elm st", "Lehi"), (7002, "B", "elm st", "Lehi"), (7003, "C", "oak st", "Lehi"), (7004, "D", "", "")],
              [(7001, "A", "oak st", "Lehi"), (7005, "E", "fir st", "Orem"), (7006, "F", "", ""), (7007, "G", "elm st", "Lehi")],
              [(7008, "H", "fir st", "Orem"), (7009, "I", "ash st", "Orem")]]
    once, asked = _asking(workdir, "once")
    always, asked_always = _asking(workdir, "always.txt")
    seen = []
    for n, rows in enumerate(months, 1):
        feed = write_feed(os.path.join(workdir, "in", f"m{n}.txt"), [_mailed(*r) for r in rows])
        if n < 3:
            run_cycle(spark, store, f"{n:03}", feed, standardizer=once, remember_addresses=True, phases=("load", "merge", "sweep"))
        else:
            inbox = os.path.join(workdir, "inbox")
            os.makedirs(inbox)
            with open(os.path.join(inbox, "m.json"), "w") as f:
                json.dump({"version": "003", "feed": feed}, f)
            watch_deliveries(spark, inbox, store, checkpoint=os.path.join(workdir, "ck"), standardizer=once,
                             remember_addresses=True).awaitTermination()
        run_cycle(spark, other, f"{n:03}", feed, standardizer=always, phases=("load", "merge", "sweep"))
        seen += [f"{s}|{c or 'nan'}" for _, _, s, c in rows]
    assert sorted(a.replace("None", "").replace("nan", "") for a in asked()) == sorted(
        {f"{s}|{c}" for rows in months for _, _, s, c in rows})
    assert len(asked_always()) == 10
    for t in ("identity", "entity", "parcel"):
        assert sorted(map(tuple, store.read(t).collect()), key=repr) == sorted(map(tuple, other.read(t).collect()), key=repr)
    assert "addresses" in store.paths() and "addresses" not in other.paths()
