from __future__ import annotations

import glob
import os

import pytest

from filegen import feed_line, write_deletes, write_feed, write_std
from landroll.operators.quality import ConstraintViolation
from landroll.plans.relate import address_extract
from landroll.sources.delimited import read_delete_list, read_feed, read_standardized, write_address_extract
from landroll.sources.schemas import FEED_COLUMNS
from landroll.sources.state import StateStore


def test_feed_reader_keeps_data_and_quarantines(spark, workdir):
    good = {"admid": 1, "partyowner1namefull": 'O"Brien\tand Caf\xe9', "propertyaddressinfoprivacy": "t",
            "companyflag": "No", "propertylatitude": "40.1234567"}
    bad_bool = {"admid": 2, "companyflag": "perhaps"}
    short = "3||x"
    long = feed_line({"admid": 4}) + "||extra"
    path = write_feed(os.path.join(workdir, "feed.txt"), [good, bad_bool], raw_lines=[short, long])
    loaded = read_feed(spark, path, mode="quarantine")
    rows = {r.admid: r for r in loaded.rows.collect()}
    assert list(rows) == [1]
    r = rows[1]
    assert r.partyowner1namefull == 'O"Brien\tand Caf\xe9'
    assert r.propertyaddressinfoprivacy is True and r.companyflag is False
    assert str(r.propertylatitude) == "40.123457"
    assert r.situscounty == "" and r.legaldescription is None  # forced vs. plain blank
    rejects = {x.admid: x.problems for x in loaded.rejects.collect()}
    assert rejects[2] == ["companyflag:type"]
    assert "row:field_count" in rejects[3] and "row:field_count" in rejects[4]
    assert len(loaded.rows.columns) == len(FEED_COLUMNS)
    with pytest.raises(ConstraintViolation):
        read_feed(spark, path, mode="strict")
    # Keeping few columns must not skip validating the others.
    narrow = read_feed(spark, path, mode="quarantine", columns=["partyowner1namefull"])
    assert narrow.rows.columns == ["admid", "partyowner1namefull"]
    assert sorted(r.admid for r in narrow.rejects.collect()) == [2, 3, 4]


def test_std_reader_requires_coordinates(spark, workdir):
    path = write_std(os.path.join(workdir, "std.tsv"), [
        {"admid": 1, "delivery_line_1": "1 A ST"}, {"admid": 2, "latitude": ""}])
    loaded = read_standardized(spark, path, mode="quarantine")
    assert [r.admid for r in loaded.rows.collect()] == [1]
    assert [list(r.problems) for r in loaded.rejects.collect()] == [["latitude:required"]]
    row = loaded.rows.first()
    assert row.city_name == "" and row.addressee is None


def test_delete_list(spark, workdir):
    path = write_deletes(os.path.join(workdir, "del.txt"), [5, 7, 5], blank_lines=2)
    loaded = read_delete_list(spark, path)
    assert sorted(r.admid for r in loaded.rows.collect()) == [5, 5, 7]


def test_address_extract_file(spark, workdir):
    path = write_feed(os.path.join(workdir, "feed.txt"), [
        {"admid": 1, "contactownermailaddresshousenumber": "12", "contactownermailaddressstreetname": " Main ",
         "contactownermailaddressstreetsuffix": "St", "contactownermailaddresscity": 'Say "Hi"',
         "contactownermailaddressstate": "UT"}])
    feed = read_feed(spark, path).rows
    out = os.path.join(workdir, "extract")
    write_address_extract(address_extract(feed), out)
    text = b"".join(open(p, "rb").read() for p in sorted(glob.glob(out + "/part-*")))
    assert text == b'admid\tstreet\tsecondary\tcity\tstate\r\n1\t12 Main St\t\t"Say ""Hi"""\tUT\r\n'


def test_state_store_versions(spark, workdir):
    store = StateStore(spark, os.path.join(workdir, "state"))
    assert store.current() is None
    assert store.read("postcard").count() == 0
    store.publish({"postcard": spark.createDataFrame([(1, 10)], "id long, parcel_id long")}, "001")
    store.publish({"postcard": spark.createDataFrame([(1, None)], "id long, parcel_id long")}, "002")
    assert store.current()[0] == "002"
    assert store.read("postcard").first().parcel_id is None
    assert store.read("postcard", "001").first().parcel_id == 10
    with pytest.raises(ValueError):
        store.publish({}, "001")


def test_export_for_standardizer(spark, workdir):
    from landroll.plans.cycle import export_address_extract

    path = write_feed(os.path.join(workdir, "feed.txt"), [
        {"admid": 7, "contactownermailaddresshousenumber": "5", "contactownermailaddressstreetname": "Oak",
         "contactownermailaddressunit": "B", "contactownermailaddresscity": "Ogden",
         "contactownermailaddressstate": "UT"},
        {"admid": 8, "companyflag": "perhaps"}])
    out = os.path.join(workdir, "ss_in")
    rejects = export_address_extract(spark, path, out, mode="quarantine")
    assert [r.admid for r in rejects.collect()] == [8]
    text = b"".join(open(p, "rb").read() for p in sorted(glob.glob(out + "/part-*")))
    assert text == b"admid\tstreet\tsecondary\tcity\tstate\r\n7\t5 Oak\tB\tOgden\tUT\r\n"


def test_rejects_name_their_file(spark, workdir):
    """Two files, a malformed line in one and a bad value in the other: each reject says where it stands."""
    import os

    from landroll.functions.cast import ColumnSpec
    from landroll.sources.delimited import load_typed
    for name, lines in (("a.txt", ["k||v", "1||2", "2||3||4"]), ("b c.txt", ["k||v", "3||x", "4||5"])):
        with open(os.path.join(workdir, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    got = load_typed(spark, [os.path.join(workdir, n) for n in ("a.txt", "b c.txt")],
                     [ColumnSpec("k", "long"), ColumnSpec("v", "int")], "||", mode="quarantine", name="places")
    rejects = {r.k: r for r in got.rejects.collect()}
    assert rejects[2].raw_line == "2||3||4" and rejects[2].file.endswith("/a.txt") and rejects[2].block_start == 0
    assert rejects[3].raw_line is None and rejects[3].file.endswith("/b%20c.txt") and rejects[3].problems == ["v:type"]
    assert got.rows.columns == ["k", "v"] and sorted(r.k for r in got.rows.collect()) == [1, 4]
