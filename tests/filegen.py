"""Write small supplier files (feed, standardised addresses, delete list)."""

from __future__ import annotations

import os

from landroll.sources.schemas import FEED_COLUMNS, STD_COLUMNS

# Feed values every row needs to pass the parcel not-null rules.
FEED_DEFAULTS = {"situsstatecountyfips": "49035", "propertyusegroup": "RESIDENTIAL"}


def _write(path: str, header: list[str], lines: list[str], sep: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write((sep.join(header) + "\n").encode("latin-1"))
        for line in lines:
            f.write((line + "\n").encode("latin-1"))
    return path


def feed_line(values: dict) -> str:
    row = {**FEED_DEFAULTS, **values}
    return "||".join(str(row.get(c, "")) for c in FEED_COLUMNS)


def write_feed(path: str, rows: list[dict], raw_lines: list[str] = ()) -> str:
    return _write(path, FEED_COLUMNS, [feed_line(r) for r in rows] + list(raw_lines), "||")


def std_line(values: dict) -> str:
    row = {"latitude": "0", "longitude": "0", **values}
    return "\t".join(str(row.get(c, "")) for c in STD_COLUMNS)


def write_std(path: str, rows: list[dict], raw_lines: list[str] = ()) -> str:
    return _write(path, STD_COLUMNS, [std_line(r) for r in rows] + list(raw_lines), "\t")


def write_deletes(path: str, admids: list, blank_lines: int = 0) -> str:
    return _write(path, ["admid"], [str(a) for a in admids] + [""] * blank_lines, "\t")
