"""Split the stitched feed (feed + standardised address) into the relational trio.

identity  one row per mailing address key (mail_address, mail_city, mail_state);
          the survivor of a key is the smallest tuple of its attributes.
entity    one row per owner-name tuple + identity id.
parcel    one row per admid, with its identity and entity ids.

Ids are dense and follow the natural keys' order.  Both key-resolution joins
are salted on hot keys (every unstandardised row shares the blank address;
rows without co-owners share blank names).  Constraint checks run after the
build, over whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landroll.functions.address import compose, make_point
from landroll.functions.cast import coalesce_defaults
from landroll.operators.dedup import keep_first
from landroll.operators.joins import hot_keys, salted_join
from landroll.operators.keys import assign_ids
from landroll.operators.quality import check_fk, check_rows, fit_lengths, violations
from landroll.session import stage
from landroll.sources.schemas import ENTITY_LIMITS, IDENTITY_LIMITS, PARCEL_LIMITS

# Where each relational column comes from in the stitched feed.
IDENTITY_SOURCE = {
    "mail_address": "delivery_line_1",
    "mail_city": "city_name",
    "mail_state": "state_abbreviation",
    "mail_zipcode": "zipcode",
    "mail_verified": "summary",
    "mail_longitude": "longitude",
    "mail_latitude": "latitude",
    "mail_geoquality": "precision",
    "rdi": "rdi",
}
ENTITY_SOURCE = {
    "owner": "partyowner1namefull",
    "coowner": "partyowner3namefull",
    "owner1_firstname": "partyowner1namefirst",
    "owner1_lastname": "partyowner1namelast",
    "owner2_firstname": "partyowner2namefirst",
    "owner2_lastname": "partyowner2namelast",
    "coowner1_firstname": "partyowner3namefirst",
    "coowner1_lastname": "partyowner3namelast",
    "coowner2_firstname": "partyowner4namefirst",
    "coowner2_lastname": "partyowner4namelast",
}
PARCEL_SOURCE = {
    "admid": "admid",
    "parcel_number": "parcelnumberraw",
    "parcel_county": "situscounty",
    "parcel_fips": "situsstatecountyfips",
    "parcel_city": "propertyaddresscity",
    "parcel_state": "propertyaddressstate",
    "parcel_zipcode": "propertyaddresszip",
    "parcel_longitude": "propertylongitude",
    "parcel_latitude": "propertylatitude",
    "parcel_geoquality": "geoquality",
    "owner_occupied": "statusowneroccupiedflag",
    "record_type": "propertyusegroup",
    "land_use": "propertyusestandardized",
    "acres": "arealotacres",
    "sqft_total": "areabuilding",
    "unit_count": "unitscount",
    "building_count": "buildingscount",
    "bedroom_count": "bedroomscount",
    "bathroom_count": "bathcount",
    "pool": "pool",
    "guesthouse": "guesthouseflag",
    "year_built": "yearbuilt",
    "last_sale": "assessorlastsaledate",
    "last_price": "assessorlastsaleamount",
    "year_assessed": "taxyearassessed",
    "total_value": "taxassessedvaluetotal",
}
# Situs address lines are composed from these feed parts, in this order.
ADDRESS1_PARTS = ["propertyaddresshousenumber", "propertyaddressstreetdirection", "propertyaddressstreetname",
                  "propertyaddressstreetsuffix", "propertyaddressstreetpostdirection"]
ADDRESS2_PARTS = ["propertyaddressunitprefix", "propertyaddressunitvalue"]
# Mailing street sent to the standardiser.
MAIL_STREET_PARTS = ["contactownermailaddresshousenumber", "contactownermailaddressstreetdirection",
                     "contactownermailaddressstreetname", "contactownermailaddressstreetsuffix",
                     "contactownermailaddressstreetpostdirection"]
MAIL_RENAMES = {"contactownermailaddressunit": "secondary", "contactownermailaddresscity": "city",
                "contactownermailaddressstate": "state"}

# The only stitched columns the trio build reads (of 332 feed + 55 standardised).
TRIO_INPUT_COLUMNS = list(dict.fromkeys(
    ["admid"] + list(IDENTITY_SOURCE.values()) + list(ENTITY_SOURCE.values()) + list(PARCEL_SOURCE.values())
    + ADDRESS1_PARTS + ADDRESS2_PARTS))

IDENTITY_KEY = ["mail_address", "mail_city", "mail_state"]
ENTITY_KEY = list(ENTITY_SOURCE) + ["identity_id"]
# Not-null rules of the relational tables (blank text was already forced to '').
PARCEL_REQUIRED = ["id", "admid", "parcel_fips", "record_type", "identity_id", "entity_id"]
ENTITY_REQUIRED = ["id", "identity_id"]
IDENTITY_REQUIRED = ["id"] + IDENTITY_KEY
# Flattened delta: text columns that default to '' (numbers, flags, dates and
# mail_zipcode keep NULL).
FLAT_TEXT_DEFAULTS = (list(ENTITY_SOURCE) + ["mail_address", "mail_city", "mail_state", "mail_verified",
                      "mail_geoquality", "rdi", "primary_name", "parcel_number", "parcel_county", "parcel_fips",
                      "parcel_address1", "parcel_address2", "parcel_city", "parcel_state", "parcel_zipcode",
                      "parcel_geoquality", "record_type", "land_use"])


def address_extract(feed: DataFrame) -> DataFrame:
    """Feed rows as the standardiser's input: admid, composed street, unit, city, state."""
    return feed.select("admid", compose(*MAIL_STREET_PARTS).alias("street"),
                       *[F.col(src).alias(dst) for src, dst in MAIL_RENAMES.items()])


def stitch_feed(feed: DataFrame, std: DataFrame, feed_key: str = "admid", std_key: str = "admid") -> DataFrame:
    """Inner join on the keys; feed rows without a standardised row drop out.

    Feed columns win over standardised ones of the same name.
    """
    std_cols = [c for c in std.columns if c not in feed.columns and c not in
                (std_key, "street", "secondary", "city", "state", "blank")]
    std = std.select(F.col(std_key).alias("_std_key"), *std_cols)
    return feed.join(std, feed[feed_key] == std["_std_key"], "inner").drop("_std_key")


def audit_stitch(feed: DataFrame, std: DataFrame, feed_key: str = "admid", std_key: str = "admid") -> DataFrame:
    """Keys that the stitch drops or multiplies: (key, n_feed, n_std, problems).

    ``feed_only`` has no standardised row and drops out, ``std_only`` has no
    feed row, ``repeated_feed`` and ``repeated_std`` multiply rows.  Only the
    keys are read; both sides are counted in one map-side combined aggregate.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    keys = (feed.select(F.col(feed_key).alias("key"), one.alias("f"), none.alias("s"))
            .unionByName(std.select(F.col(std_key).alias("key"), none.alias("f"), one.alias("s"))))
    counted = keys.groupBy("key").agg(F.sum("f").alias("n_feed"), F.sum("s").alias("n_std"))
    problems = F.concat_ws(",", F.when(F.col("n_std") == 0, "feed_only"), F.when(F.col("n_feed") == 0, "std_only"),
                           F.when(F.col("n_feed") > 1, "repeated_feed"), F.when(F.col("n_std") > 1, "repeated_std"))
    return counted.withColumn("problems", problems).where("problems <> ''")


def project(stitched: DataFrame, source: Mapping[str, str]) -> DataFrame:
    """The columns of one relational table; ``source`` is {column: stitched column}."""
    return stitched.select(*[F.col(src).alias(dst) for dst, src in source.items()])


def delta_rows(stitched: DataFrame) -> DataFrame:
    """One row per parcel with the columns of its identity, entity and parcel, before defaults."""
    renamed = {**{dst: F.col(src) for dst, src in {**IDENTITY_SOURCE, **ENTITY_SOURCE, **PARCEL_SOURCE}.items()},
               "parcel_address1": compose(*ADDRESS1_PARTS), "parcel_address2": compose(*ADDRESS2_PARTS)}
    rows = stitched.select(*[c.alias(name) for name, c in renamed.items()])
    return fit_lengths(rows, _limits(rows, {**IDENTITY_LIMITS, **ENTITY_LIMITS, **PARCEL_LIMITS}))


def identity_survivors(delta: DataFrame) -> DataFrame:
    """One identity per mailing key of the delta, with the number of rows of the key as ``_rows``."""
    return keep_first(delta.select(*IDENTITY_SOURCE), IDENTITY_KEY, count_col="_rows")


def check_delta(delta: DataFrame, survivors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trio's rules on the flat delta: (every violation, mailing keys of bad identities).

    Violations of parcels and entities carry the admid as key; foreign keys
    hold by construction, as every row resolves to the ids it is given.
    """
    limits = {"parcel": _limits(delta, PARCEL_LIMITS), "entity": _limits(delta, ENTITY_LIMITS)}
    found = check_rows(delta, "admid", {"parcel": [c for c in PARCEL_REQUIRED if c in delta.columns]}, limits,
                       {"parcel": ["admid"]})
    own = _limits(survivors, IDENTITY_LIMITS)
    of_identity = check_rows(survivors, IDENTITY_KEY, {"identity": IDENTITY_KEY}, {"identity": own})
    broken = F.lit(False)
    for c in IDENTITY_KEY:
        broken = broken | F.col(c).isNull()
    for c, n in own.items():
        broken = broken | F.coalesce(F.rtrim(F.substring(c, n + 1, 1 << 30)) != "", F.lit(False))
    return found.unionByName(of_identity), survivors.where(broken).select(*IDENTITY_KEY).distinct()


@dataclass
class Trio:
    identity: DataFrame
    entity: DataFrame
    parcel: DataFrame


def build_trio(stitched: DataFrame) -> Trio:
    ident_rows = project(stitched, IDENTITY_SOURCE)
    ident_counted = assign_ids(keep_first(ident_rows, IDENTITY_KEY, count_col="_rows"), IDENTITY_KEY)
    identity = ident_counted.drop("_rows").withColumn(
        "mail_location", make_point("mail_longitude", "mail_latitude"))

    resolved = salted_join(
        stitched.withColumns({dst: F.col(src) for dst, src in IDENTITY_SOURCE.items() if dst in IDENTITY_KEY}),
        identity.select(*IDENTITY_KEY, F.col("id").alias("identity_id")), IDENTITY_KEY, "left",
        hot=hot_keys(ident_counted, IDENTITY_KEY, count_col="_rows"), salt_cols=["admid"])
    # Read twice below (entity build, parcel keying): staged so the join runs once.
    resolved = stage(resolved.withColumns({dst: F.col(src) for dst, src in ENTITY_SOURCE.items()}), "resolved")

    ent_counted = assign_ids(keep_first(resolved.select(*ENTITY_KEY), ENTITY_KEY, count_col="_rows"), ENTITY_KEY)
    entity = ent_counted.drop("_rows")
    keyed = salted_join(resolved, entity.select(*ENTITY_KEY, F.col("id").alias("entity_id")), ENTITY_KEY, "left",
                        hot=hot_keys(ent_counted, ENTITY_KEY, count_col="_rows"), salt_cols=["admid"])

    parcel_rows = keyed.select(
        *[F.col(src).alias(dst) for dst, src in PARCEL_SOURCE.items()],
        compose(*ADDRESS1_PARTS).alias("parcel_address1"),
        compose(*ADDRESS2_PARTS).alias("parcel_address2"),
        F.lit(None).cast("boolean").alias("parcel_privacy"),
        F.lit(None).cast("boolean").alias("rental_flag"),
        "identity_id", "entity_id")
    parcel = assign_ids(parcel_rows, ["admid"]).withColumn(
        "parcel_location", make_point("parcel_longitude", "parcel_latitude"))
    return Trio(identity, entity, parcel)


def _limits(df: DataFrame, limits: dict) -> dict:
    return {c: n for c, n in limits.items() if c in df.columns}


def check_trio(trio: Trio) -> DataFrame:
    """Every constraint violation of the trio as (table, rule, key, detail)."""
    found = [
        check_rows(trio.parcel, "admid", {"parcel": PARCEL_REQUIRED}, {"parcel": _limits(trio.parcel, PARCEL_LIMITS)},
                   {"parcel": ["admid", "id"]}),
        check_rows(trio.entity, "id", {"entity": ENTITY_REQUIRED}, {"entity": _limits(trio.entity, ENTITY_LIMITS)},
                   {"entity": ["id"]}),
        check_rows(trio.identity, "id", {"identity": IDENTITY_REQUIRED},
                   {"identity": _limits(trio.identity, IDENTITY_LIMITS)}, {"identity": ["id"]}),
        violations("parcel", "fk_identity", check_fk(trio.parcel, trio.identity, "identity_id"), ["admid"]),
        violations("parcel", "fk_entity", check_fk(trio.parcel, trio.entity, "entity_id"), ["admid"]),
        violations("entity", "fk_identity", check_fk(trio.entity, trio.identity, "identity_id"), ["id"]),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def flatten(trio: Trio) -> DataFrame:
    """One delta row per parcel with its identity's and entity's attributes (inner FK joins)."""
    ident = trio.identity.select(F.col("id").alias("identity_id"), *IDENTITY_SOURCE, "mail_location",
                                 F.lit("").alias("primary_name"), F.lit(None).cast("smallint").alias("rental_count"))
    ent = trio.entity.select(F.col("id").alias("entity_id"), *ENTITY_SOURCE)
    flat = salted_join(salted_join(trio.parcel.drop("id"), ident, ["identity_id"], "inner", salt_cols=["admid"]),
                       ent, ["entity_id"], "inner", salt_cols=["admid"])
    return coalesce_defaults(flat, FLAT_TEXT_DEFAULTS)
