"""The full file-based monthly cycle, played on the TPC-H-like scenario.

The scenario's production identities, entities and parcels are published as
version "000" of a fresh state store, with a postcard per line item that
refers to a production parcel; its delta is written as a real 332-column
``||`` feed and a 60-column standardised file, its delete list as a delete
file.  Every column that the state takes from the feed is filled from a
column of the test tables.  ``run_cycle`` then reads, validates, stitches,
merges, deletes, sweeps and publishes version "001".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landroll.operators.merge import conform
from landroll.plans.cycle import run_cycle
from landroll.plans.relate import TRIO_INPUT_COLUMNS, Trio, build_trio
from landroll.session import stage, stage_path
from landroll.sources.schemas import FEED_COLUMNS, STATE_DDL, STD_COLUMNS
from landroll.sources.state import StateStore


def _write_text(df: DataFrame, columns: list[str], given: dict, path: str, sep: str) -> str:
    out = df.select(*[given.get(c, F.lit(None).cast("string")).cast("string").alias(c) for c in columns])
    out.write.option("sep", sep).option("header", True).option("quote", "").option("escape", "").csv(path)
    return path


def _digits(c: str, n: int) -> Column:
    return F.lpad(F.col(c).cast("string"), n, "0")


def feed_values() -> dict[str, Column]:
    """Feed column -> expression over the scenario's delta; each takes its own shape of value."""
    nk, year, amount = F.col("nk"), F.year("dt"), F.floor("price")
    return {
        "admid": F.col("admid"),
        "parcelnumberraw": F.concat(F.lit("P-"), F.col("c_custkey")),
        "situscounty": F.concat(F.col("ci"), F.lit(" COUNTY")),
        "situsstatecountyfips": _digits("nk", 5),
        "propertyaddresshousenumber": F.col("c_custkey"),
        "propertyaddressstreetdirection": F.when(nk % 2 == 0, "N"),
        "propertyaddressstreetname": F.concat(F.lit("OLD  "), F.col("a")),
        "propertyaddressstreetsuffix": F.lit("RD"),
        "propertyaddressstreetpostdirection": F.when(nk % 3 == 0, "W"),
        "propertyaddressunitprefix": F.when(F.col("stat") == "F", "APT"),
        "propertyaddressunitvalue": F.when(F.col("stat") == "F", nk.cast("string")),
        "propertyaddresscity": F.col("ci"),
        "propertyaddressstate": F.substring("st", 1, 2),
        "propertyaddresszip": _digits("nk", 5),
        "propertylongitude": F.when(nk != 5, F.format_string("%.6f", -(nk + F.lit(0.25)))),
        "propertylatitude": F.format_string("%.6f", nk + F.lit(0.5)),
        "geoquality": F.substring("pri", 3, 20),
        "statusowneroccupiedflag": F.when(F.col("stat") == "F", "Y").when(F.col("stat") == "O", "no"),
        "propertyusegroup": F.col("pri"),
        "propertyusestandardized": _digits("nk", 4),
        "arealotacres": F.format_string("%.3f", nk * F.lit(1.125)),
        "areabuilding": F.col("c_custkey") + 10,
        "unitscount": nk + 1,
        "buildingscount": nk + 2,
        "bedroomscount": nk % 7,
        "bathcount": F.format_string("%.1f", (nk % 4) * F.lit(1.5)),
        "pool": nk % 5,
        "guesthouseflag": F.when(nk % 2 == 1, "t"),
        "yearbuilt": year - 30,
        "assessorlastsaledate": F.date_format("dt", "yyyy-MM-dd"),
        "assessorlastsaleamount": amount,
        "taxyearassessed": year,
        "taxassessedvaluetotal": F.floor(F.col("price") * 2),
        "partyowner1namefull": F.col("owner"),
        "partyowner1namefirst": F.substring("owner", 1, 8),
        "partyowner1namelast": F.substring("owner", 10, 9),
        "partyowner2namefirst": F.concat(F.lit("S"), nk),
        "partyowner2namelast": F.col("ci"),
        "partyowner3namefull": F.col("st"),
        "partyowner3namefirst": F.substring("st", 1, 3),
        "partyowner3namelast": F.substring("st", 4, 9),
        "partyowner4namefirst": F.substring("ci", 1, 3),
        "partyowner4namelast": F.substring("a", 1, 4),
    }


def std_values() -> dict[str, Column]:
    """Standardised column -> expression; longitude and summary vary inside a mailing key."""
    return {
        "admid": F.col("admid"), "delivery_line_1": F.col("a"), "city_name": F.col("ci"),
        "state_abbreviation": F.col("st"), "zipcode": _digits("nk", 5), "summary": F.substring("stat", 1, 1),
        "longitude": F.format_string("%.6f", F.floor(F.col("attr")) / 100),
        "latitude": F.format_string("%.6f", F.col("nk") + F.lit(0.75)),
        "precision": F.when(F.col("attr") < 0, "Zip5").otherwise("Zip9"), "rdi": F.substring("pri", 1, 1),
    }


# The entity names that the feed gives, as the production entities have them.
def _names(owner: Column) -> dict[str, Column]:
    return {"owner1_firstname": F.substring(owner, 1, 8), "owner1_lastname": F.substring(owner, 10, 9),
            "owner2_firstname": F.concat(F.lit("S"), "nk"), "owner2_lastname": F.col("ci"), "coowner": F.col("st"),
            "coowner1_firstname": F.substring("st", 1, 3), "coowner1_lastname": F.substring("st", 4, 9),
            "coowner2_firstname": F.substring("ci", 1, 3), "coowner2_lastname": F.substring("a", 1, 4)}


def prepare_month(s) -> tuple[StateStore, str, str, str]:
    """Publish the scenario's production state as version "000"; write the month's three files."""
    spark = s.spark
    root = stage_path(spark, "cycle_files")
    store = StateStore(spark, f"{root}/state")
    identity = s.pid.select("id", F.col("a").alias("mail_address"), F.col("ci").alias("mail_city"),
                            F.col("st").alias("mail_state"), "inactive", "primary_name", "rental_count")
    nations = s.table("nation").select(F.col("n_name").alias("ci"), F.col("n_nationkey").alias("nk"))
    where = s.pid.select(F.col("id").alias("identity_id"), "a", "ci", "st").join(nations, "ci")
    entity = s.pent.join(where, "identity_id").withColumns(_names(F.col("owner")))
    parcel = s.ppar.select("id", "admid", F.floor("price").alias("total_value"), "identity_id", "entity_id",
                           F.lit("00000").alias("parcel_fips"), F.lit("PROD").alias("record_type"),
                           F.col("flag").alias("rental_flag"))
    cards = s.table("lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("admid")).distinct()
    postcard = cards.join(s.ppar.select("admid", F.col("id").alias("parcel_id")), "admid").select("id", "parcel_id")
    tables = {"identity": identity, "entity": entity, "parcel": parcel, "postcard": postcard}
    store.publish({t: conform(df, StructType.fromDDL(STATE_DDL[t])) for t, df in tables.items()}, "000")

    d = s.d
    feed = _write_text(d, FEED_COLUMNS, feed_values(), f"{root}/feed", "||")
    std = _write_text(d, STD_COLUMNS, std_values(), f"{root}/std", "\t")
    deletes = _write_text(s.dele, ["admid"], {"admid": F.col("admid")}, f"{root}/deletes", "\t")
    return store, feed, std, deletes


def apply_month(s, prepared) -> dict[str, DataFrame]:
    """Run the monthly cycle over the prepared files; the published tables."""
    store, feed, std, deletes = prepared
    return run_cycle(s.spark, store, "001", feed, std, deletes, mode="strict").tables


def cycle_from_files(s) -> DataFrame:
    """The final parcels in the oracle's shape."""
    parcel = apply_month(s, prepare_month(s))["parcel"]
    return parcel.select("admid", F.col("total_value").alias("price"), "identity_id", "entity_id")


def cycle_table(s, table: str, point: str | None = None) -> DataFrame:
    """Every column of one published table; a point as its three fields."""
    df = apply_month(s, prepare_month(s))[table]
    if point is None:
        return df
    fields = [F.col(f"{point}.{f}").alias(f"{point}_{f}") for f in ("lon", "lat", "srid")]
    return df.select(*[c for c in df.columns if c != point], *fields)


def month_trio(s, **changed: Column) -> Trio:
    """The relational trio of the month's stitched rows; ``changed`` replaces feed columns."""
    values = {**feed_values(), **std_values(), **changed}
    numbers = {c: F.col(c).cast("decimal(10,6)") for c in ("longitude", "latitude", "propertylongitude",
                                                           "propertylatitude")}
    stitched = s.d.select(*[values[c].alias(c) for c in TRIO_INPUT_COLUMNS]).withColumns(numbers)
    return build_trio(stage(stitched, "stitched"))
