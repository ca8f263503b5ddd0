"""Schemas of the supplier files and of the state tables.

The file schemas are positional: the header line is skipped and its names
are ignored.  Every column is read as text and then cast (see
``landroll.functions.cast.typed_cast``), so a bad value is reported, never
silently NULL.
"""

from __future__ import annotations

import re

from landroll.functions.cast import ColumnSpec

# ---------------------------------------------------------------------------
# The flat property feed, 332 columns in file order.
# Types: varchar(n) = text of at most n characters, char(n) = fixed-width text
# (kept trimmed), bigint / int / smallint, numeric(p,s), boolean, date.
# ---------------------------------------------------------------------------
FEED_LAYOUT = """
admid bigint, situsstatecode varchar(2), situscounty varchar(50), propertyjurisdictionname varchar(50),
situsstatecountyfips char(5), combinedstatisticalarea varchar(100), cbsaname varchar(100), cbsacode char(5),
msaname varchar(100), msacode char(5), metropolitandivision varchar(100), minorcivildivisionname varchar(100),
minorcivildivisioncode char(5), neighborhoodcode varchar(10), censusfipsplacecode char(5), censustract int,
censusblockgroup smallint, censusblock int, parcelnumberraw varchar(60), parcelnumberformatted varchar(60),
parcelnumberyearadded smallint, parcelnumberalternate varchar(60), parcelmapbook varchar(10), parcelmappage varchar(10),
parcelnumberyearchange smallint, parcelnumberprevious varchar(60), parcelaccountnumber varchar(35),
propertyaddressfull varchar(150), propertyaddresshousenumber varchar(25), propertyaddressstreetdirection varchar(10),
propertyaddressstreetname varchar(100), propertyaddressstreetsuffix varchar(25),
propertyaddressstreetpostdirection varchar(10), propertyaddressunitprefix varchar(20),
propertyaddressunitvalue varchar(25), propertyaddresscity varchar(50), propertyaddressstate varchar(2),
propertyaddresszip varchar(5), propertyaddresszip4 varchar(4), propertyaddresscrrt varchar(4),
propertyaddressinfoprivacy boolean, congressionaldistricthouse smallint, propertylatitude numeric(10,6),
propertylongitude numeric(10,6), geoquality varchar(20), legaldescription varchar(255), legalrange varchar(35),
legaltownship varchar(35), legalsection varchar(35), legalquarter varchar(4), legalquarterquarter varchar(4),
legalsubdivision varchar(50), legalphase varchar(10), legaltractnumber varchar(10), legalblock1 varchar(10),
legalblock2 varchar(10), legallotnumber1 varchar(10), legallotnumber2 varchar(10), legallotnumber3 varchar(10),
legalunit varchar(10), partyowner1namefull varchar(150), partyowner1namefirst varchar(50),
partyowner1namemiddle varchar(20), partyowner1namelast varchar(50), partyowner1namesuffix varchar(20),
trustdescription varchar(50), companyflag boolean, partyowner2namefull varchar(150),
partyowner2namefirst varchar(50), partyowner2namemiddle varchar(20), partyowner2namelast varchar(50),
partyowner2namesuffix varchar(20), ownertypedescription1 varchar(50), ownershipvestingrelationcode varchar(3),
partyowner3namefull varchar(150), partyowner3namefirst varchar(50), partyowner3namemiddle varchar(20),
partyowner3namelast varchar(50), partyowner3namesuffix varchar(20), partyowner4namefull varchar(150),
partyowner4namefirst varchar(50), partyowner4namemiddle varchar(20), partyowner4namelast varchar(50),
partyowner4namesuffix varchar(20), ownertypedescription2 varchar(50), contactownermailingcounty varchar(50),
contactownermailingfips char(5), contactownermailaddressfull varchar(100),
contactownermailaddresshousenumber varchar(20), contactownermailaddressstreetdirection varchar(10),
contactownermailaddressstreetname varchar(100), contactownermailaddressstreetsuffix varchar(25),
contactownermailaddressstreetpostdirection varchar(10), contactownermailaddressunitprefix varchar(20),
contactownermailaddressunit varchar(20), contactownermailaddresscity varchar(50),
contactownermailaddressstate char(2), contactownermailaddresszip char(5), contactownermailaddresszip4 char(4),
contactownermailaddresscrrt varchar(4), contactownermailaddressinfoformat varchar(50),
contactownermailinfoprivacy boolean, statusowneroccupiedflag boolean, deedowner1namefull varchar(150),
deedowner1namefirst varchar(50), deedowner1namemiddle varchar(20), deedowner1namelast varchar(50),
deedowner1namesuffix varchar(20), deedowner2namefull varchar(150), deedowner2namefirst varchar(50),
deedowner2namemiddle varchar(20), deedowner2namelast varchar(50), deedowner2namesuffix varchar(20),
deedowner3namefull varchar(150), deedowner3namefirst varchar(50), deedowner3namemiddle varchar(20),
deedowner3namelast varchar(50), deedowner3namesuffix varchar(20), deedowner4namefull varchar(150),
deedowner4namefirst varchar(50), deedowner4namemiddle varchar(20), deedowner4namelast varchar(50),
deedowner4namesuffix varchar(20), taxyearassessed smallint, taxassessedvaluetotal bigint,
taxassessedvalueimprovements bigint, taxassessedvalueland bigint, taxassessedimprovementsperc numeric(9,2),
previousassessedvalue bigint, taxmarketvalueyear smallint, taxmarketvaluetotal bigint,
taxmarketvalueimprovements bigint, taxmarketvalueland bigint, taxmarketimprovementsperc numeric(6,2),
taxfiscalyear smallint, taxratearea varchar(20), taxbilledamount numeric(18,2), taxdelinquentyear smallint,
lastassessortaxrollupdate date, assrlastupdated date, taxexemptionhomeownerflag boolean,
taxexemptiondisabledflag boolean, taxexemptionseniorflag boolean, taxexemptionveteranflag boolean,
taxexemptionwidowflag boolean, taxexemptionadditional varchar(10), yearbuilt smallint, yearbuilteffective smallint,
zonedcodelocal varchar(50), propertyusemuni varchar(10), propertyusegroup varchar(50),
propertyusestandardized varchar(4), assessorlastsaledate date, assessorlastsaleamount bigint,
assessorpriorsaledate date, assessorpriorsaleamount bigint, lastownershiptransferdate date,
lastownershiptransferdocumentnumber varchar(20), lastownershiptransfertransactionid bigint,
deedlastsaledocumentbook varchar(15), deedlastsaledocumentpage varchar(15), deedlastdocumentnumber varchar(25),
deedlastsaledate date, deedlastsaleprice bigint, deedlastsaletransactionid bigint, areabuilding int,
areabuildingdefinitioncode varchar(2), areagross int, area1stfloor int, area2ndfloor int, areaupperfloors int,
arealotacres numeric(18,7), arealotsf numeric(18,7), arealotdepth numeric(9,1), arealotwidth numeric(9,1),
roomsatticarea int, roomsatticflag boolean, roomsbasementarea int, roomsbasementareafinished int,
roomsbasementareaunfinished int, parkinggarage varchar(3), parkinggaragearea int, parkingcarport varchar(3),
parkingcarportarea bigint, hvaccoolingdetail varchar(3), hvacheatingdetail varchar(3), hvacheatingfuel varchar(3),
utilitiessewageusage varchar(3), utilitieswatersource varchar(3), utilitiesmobilehomehookupflag boolean,
foundation varchar(3), construction varchar(3), interiorstructure varchar(3), plumbingfixturescount smallint,
constructionfireresistanceclass varchar(3), safetyfiresprinklersflag boolean, flooringmaterialprimary smallint,
bathcount numeric(7,3), bathpartialcount smallint, bedroomscount smallint, roomscount int, storiescount smallint,
unitscount int, roomsbonusroomflag boolean, roomsbreakfastnookflag boolean, roomscellarflag boolean,
roomscellarwineflag boolean, roomsexerciseflag boolean, roomsfamilycode varchar(4), roomsgameflag boolean,
roomsgreatflag boolean, roomshobbyflag boolean, roomslaundryflag boolean, roomsmediaflag boolean,
roomsmudflag boolean, roomsofficearea int, roomsofficeflag boolean, roomssaferoomflag boolean,
roomssittingflag boolean, roomsstormshelter boolean, roomsstudyflag boolean, roomssunroomflag boolean,
roomsutilityarea int, roomsutilitycode varchar(4), fireplace varchar(2), fireplacecount smallint,
accessabilityelevatorflag boolean, accessabilityhandicapflag boolean, escalatorflag boolean,
centralvacuumflag boolean, contentintercomflag boolean, contentsoundsystemflag boolean, wetbarflag boolean,
securityalarmflag boolean, structurestyle smallint, exterior1code varchar(3), roofmaterial varchar(3),
roofconstruction varchar(3), contentstormshutterflag boolean, contentoverheaddoorflag boolean,
viewdescription varchar(3), porchcode varchar(3), porcharea int, patioarea int, deckflag boolean, deckarea int,
featurebalconyflag boolean, balconyarea int, breezewayflag boolean, parkingrvparkingflag boolean,
parkingspacecount int, drivewayarea int, drivewaymaterial varchar(2), pool smallint, poolarea int,
contentsaunaflag boolean, topographycode smallint, fencecode varchar(2), fencearea int, courtyardflag boolean,
courtyardarea int, arborpergolaflag boolean, sprinklersflag boolean, golfcoursegreenflag boolean,
tenniscourtflag boolean, sportscourtflag boolean, arenaflag boolean, waterfeatureflag boolean, pondflag boolean,
boatliftflag boolean, buildingscount smallint, bathhousearea int, bathhouseflag boolean, boataccessflag boolean,
boathousearea int, boathouseflag boolean, cabinarea int, cabinflag boolean, canopyarea int, canopyflag boolean,
gazeboarea int, gazeboflag boolean, graineryarea int, graineryflag boolean, greenhousearea int,
greenhouseflag boolean, guesthousearea int, guesthouseflag boolean, kennelarea int, kennelflag boolean,
leantoarea int, leantoflag boolean, loadingplatformarea int, loadingplatformflag boolean, milkhousearea int,
milkhouseflag boolean, outdoorkitchenfireplaceflag boolean, poolhousearea int, poolhouseflag boolean,
poultryhousearea int, poultryhouseflag boolean, quonsetarea int, quonsetflag boolean, shedarea int,
shedcode varchar(4), siloarea int, siloflag boolean, stablearea int, stableflag boolean, storagebuildingarea int,
storagebuildingflag boolean, utilitybuildingarea int, utilitybuildingflag boolean, polestructurearea int,
polestructureflag boolean, communityrecroomflag boolean, publicationdate date, parcelshellrecord boolean,
rawsitusaddress varchar(100), rawsituscity varchar(50), rawsitusstate varchar(2), rawsituszip varchar(5),
rawsituszip4 varchar(4), rawsitushousenumber varchar(20), rawsitushousenumberfraction varchar(20),
rawsitusstreetname varchar(100), rawsitusdirection varchar(10), rawsitusaddresssuffix varchar(25),
rawsituspostdirection varchar(10), rawsitusunitprefix varchar(20), rawsitusunitvalue varchar(20),
contactownermailaddressforeign boolean
"""

# Feed columns whose blank field is '' instead of NULL.
FEED_FORCED = [
    "situscounty", "parcelnumberraw", "propertyaddressfull", "propertyaddresshousenumber",
    "propertyaddressstreetdirection", "propertyaddressstreetname", "propertyaddressstreetsuffix",
    "propertyaddressstreetpostdirection", "propertyaddressunitprefix", "propertyaddressunitvalue",
    "propertyaddresscity", "propertyaddressstate", "propertyaddresszip", "geoquality", "partyowner1namefull",
    "partyowner3namefull", "partyowner1namefirst", "partyowner1namelast", "partyowner2namefirst",
    "partyowner2namelast", "partyowner3namefirst", "partyowner3namelast", "partyowner4namefirst",
    "partyowner4namelast", "contactownermailaddressfull", "contactownermailaddresshousenumber",
    "contactownermailaddressstreetdirection", "contactownermailaddressstreetname",
    "contactownermailaddressstreetsuffix", "contactownermailaddressstreetpostdirection",
    "contactownermailaddressunitprefix", "contactownermailaddressunit", "contactownermailaddresscity",
    "contactownermailaddressstate", "contactownermailaddresszip", "contactownermailaddresszip4",
    "contactownermailaddresscrrt", "propertyusestandardized",
]

# ---------------------------------------------------------------------------
# The standardised-address file, 60 tab-separated columns.
# ---------------------------------------------------------------------------
STD_LAYOUT = """
admid bigint, street text, secondary text, city text, state text, blank text, sequence text, summary text,
addressee text, delivery_line_1 text, delivery_line_2 text, city_name text, state_abbreviation text,
full_zipcode text, notes text, county_name text, rdi text, latitude numeric(10,6), longitude numeric(10,6),
precision text, dpv_match_code text, dpv_footnotes text, footnotes text, county_fips text, record_type text,
zip_type text, carrier_route text, congressional_district text, building_default_indicator text,
elot_sequence text, elot_sort text, time_zone text, utc_offset text, dst text, dpv_cmra text, ews_match text,
lacslink_indicator text, lacslink_code text, suitelink_match text, dpv_vacant text, active text,
urbanization text, primary_number text, street_name text, street_predirection text, street_postdirection text,
street_suffix text, secondary_number text, secondary_designator text, extra_secondary_number text,
extra_secondary_designator text, pmb_designator text, pmb_number text, default_city_name text, zipcode text,
plus4_code text, delivery_point text, delivery_point_check_digit text, last_line text, delivery_point_barcode text
"""

# Standardised columns whose blank field is '' instead of NULL.
STD_FORCED = [
    "admid", "summary", "delivery_line_1", "city_name", "state_abbreviation", "county_name", "rdi", "latitude",
    "longitude", "precision", "county_fips", "primary_number", "street_name", "street_predirection",
    "street_postdirection", "street_suffix", "secondary_number", "secondary_designator", "extra_secondary_number",
    "extra_secondary_designator", "zipcode",
]

# Forced numeric columns cannot hold '': a blank there rejects the row.
STD_REQUIRED = ["admid", "latitude", "longitude"]

# Address-extract columns (sent to the standardiser), in file order.
EXTRACT_COLUMNS = ["admid", "street", "secondary", "city", "state"]

_ITEM = re.compile(r"(\w+)\s+([a-z]+)(?:\((\d+)(?:,(\d+))?\))?")
_KINDS = {"bigint": "long", "int": "int", "smallint": "short", "boolean": "bool", "date": "date",
          "varchar": "string", "text": "string", "char": "char", "numeric": "decimal"}


def parse_layout(layout: str) -> list[ColumnSpec]:
    """``name type[(a[,b])]`` items separated by commas -> column specs, in order."""
    specs = []
    for name, typ, a, b in _ITEM.findall(layout):
        kind = _KINDS[typ]
        if kind == "decimal":
            specs.append(ColumnSpec(name, kind, precision=int(a), scale=int(b or 0)))
        else:
            specs.append(ColumnSpec(name, kind, length=int(a) if a else None))
    return specs


FEED_SPECS = parse_layout(FEED_LAYOUT)
FEED_COLUMNS = [s.name for s in FEED_SPECS]
STD_SPECS = parse_layout(STD_LAYOUT)
STD_COLUMNS = [s.name for s in STD_SPECS]

# ---------------------------------------------------------------------------
# State tables (Spark DDL).  Varchar limits are checked by the validator.
# ---------------------------------------------------------------------------
POINT = "struct<lon:double,lat:double,srid:int>"

IDENTITY_DDL = (
    "id bigint, mail_address string, mail_city string, mail_state string, mail_zipcode string, "
    "mail_verified string, mail_longitude decimal(10,6), mail_latitude decimal(10,6), mail_geoquality string, "
    f"mail_location {POINT}, rdi string, primary_name string, rental_count smallint, inactive boolean"
)
ENTITY_DDL = (
    "id bigint, owner string, owner1_firstname string, owner1_lastname string, owner2_firstname string, "
    "owner2_lastname string, coowner string, coowner1_firstname string, coowner1_lastname string, "
    "coowner2_firstname string, coowner2_lastname string, identity_id bigint"
)
PARCEL_DDL = (
    "id bigint, admid bigint, parcel_number string, parcel_county string, parcel_fips string, "
    "parcel_address1 string, parcel_address2 string, parcel_city string, parcel_state string, "
    "parcel_zipcode string, parcel_privacy boolean, parcel_longitude decimal(10,6), "
    f"parcel_latitude decimal(10,6), parcel_geoquality string, parcel_location {POINT}, owner_occupied boolean, "
    "record_type string, land_use string, acres decimal(18,7), sqft_total int, unit_count int, "
    "building_count int, bedroom_count smallint, bathroom_count decimal(7,3), pool smallint, guesthouse boolean, "
    "year_built smallint, last_sale date, last_price bigint, year_assessed smallint, total_value bigint, "
    "rental_flag boolean, parcel_match_address string, entity_id bigint, identity_id bigint"
)
POSTCARD_DDL = "id bigint, parcel_id bigint"

# Derived from the parcels: how many refer to each identity and entity (see operators.refcounts).
REFERENCES_DDL = "parent string, id long, n long"
STATE_DDL = {"identity": IDENTITY_DDL, "entity": ENTITY_DDL, "parcel": PARCEL_DDL, "postcard": POSTCARD_DDL}


def state_columns(table: str) -> list[str]:
    """Column names of a state table, in order (commas inside a type do not separate columns)."""
    return [item.split()[0] for item in re.split(r",(?![^(<]*[)>])", STATE_DDL[table])]


# Varchar limits of the relational tables.
IDENTITY_LIMITS = {"mail_address": 128, "mail_city": 128, "mail_state": 32, "mail_zipcode": 12,
                   "mail_verified": 32, "mail_geoquality": 20, "rdi": 12, "primary_name": 128}
ENTITY_LIMITS = {"owner": 128, "owner1_firstname": 50, "owner1_lastname": 50, "owner2_firstname": 50,
                 "owner2_lastname": 50, "coowner": 128, "coowner1_firstname": 50, "coowner1_lastname": 50,
                 "coowner2_firstname": 50, "coowner2_lastname": 50}
PARCEL_LIMITS = {"parcel_number": 60, "parcel_county": 50, "parcel_fips": 5, "parcel_address1": 128,
                 "parcel_address2": 128, "parcel_city": 50, "parcel_state": 2, "parcel_zipcode": 5,
                 "parcel_geoquality": 20, "record_type": 50, "land_use": 4}
