"""Address expressions, all JVM-side (no Python UDF).

compose            parts joined by one blank, whitespace runs collapsed,
                   outer blanks trimmed; a NULL part counts as blank.
match_address_raw  parts (NULL -> '') joined by one blank, no collapsing.
normalize_address  our normaliser for match keys (the original's body is not
                   available, so this is a documented definition of ours):
                   upper-case, Latin-1 accented letters to their base letter,
                   every character other than A-Z, 0-9 and blank becomes a
                   blank, whitespace collapsed and trimmed, then each word
                   found in ABBREVIATIONS is replaced by its short form.
make_point         (lon, lat, srid) struct, NULL when either coordinate is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street suffix, direction and unit words and their short
# forms (USPS Publication 28 standard abbreviations).
ABBREVIATIONS = {
    "STREET": "ST",
    "AVENUE": "AVE",
    "BOULEVARD": "BLVD",
    "DRIVE": "DR",
    "ROAD": "RD",
    "LANE": "LN",
    "COURT": "CT",
    "PLACE": "PL",
    "CIRCLE": "CIR",
    "HIGHWAY": "HWY",
    "PARKWAY": "PKWY",
    "TERRACE": "TER",
    "TRAIL": "TRL",
    "NORTH": "N",
    "SOUTH": "S",
    "EAST": "E",
    "WEST": "W",
    "NORTHEAST": "NE",
    "NORTHWEST": "NW",
    "SOUTHEAST": "SE",
    "SOUTHWEST": "SW",
    "APARTMENT": "APT",
    "SUITE": "STE",
}

# Upper-case Latin-1 letters with accents and their base letters.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
UNACCENTED = "AAAAAACEEEEIIIINOOOOOOUUUUY"

DEFAULT_SRID = 4326


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse_ws(col: str | Column) -> Column:
    """Runs of whitespace -> one blank, then outer blanks trimmed."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def compose(*parts: str | Column) -> Column:
    """Join address parts with blanks, collapse whitespace, trim; NULL parts are skipped."""
    return collapse_ws(F.concat_ws(" ", *[_c(p) for p in parts]))


def match_address_raw(*parts: str | Column) -> Column:
    """Join parts with one blank each; NULL parts become '' (a blank part leaves a double blank)."""
    return F.concat_ws(" ", *[F.coalesce(_c(p), F.lit("")) for p in parts])


def normalize_address(col: str | Column) -> Column:
    plain = F.translate(F.upper(_c(col)), ACCENTED, UNACCENTED)
    cleaned = collapse_ws(F.regexp_replace(plain, "[^A-Z0-9 ]", " "))
    table = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    words = F.split(cleaned, " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


def make_point(lon: str | Column, lat: str | Column, srid: int = DEFAULT_SRID) -> Column:
    lon_c, lat_c = _c(lon), _c(lat)
    point = F.struct(lon_c.cast("double").alias("lon"), lat_c.cast("double").alias("lat"),
                     F.lit(srid).alias("srid"))
    return F.when(lon_c.isNotNull() & lat_c.isNotNull(), point)


def point_ewkt(point: str | Column) -> Column:
    """Extended WKT text of a point struct, e.g. ``SRID=4326;POINT(-111.9 40.7)``."""
    p = _c(point)
    return F.when(p.isNotNull(), F.format_string("SRID=%d;POINT(%s %s)", p["srid"],
                                                 p["lon"].cast("string"), p["lat"].cast("string")))
