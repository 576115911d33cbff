"""Zipped boundary files."""

import io
import os
import struct
import zipfile

import pytest
from pages import rows

from statlake.session import scratch_path
from statlake.sources.shapefile import read_boundary_archives, read_dbf

WIDTHS = {"KEY_CODE": 11, "PREF": 2, "CITY": 3, "CITY_NAME": 14, "HCODE": 4}


def shapes(squares):
    """A file of one clockwise unit square for each corner."""
    out = io.BytesIO()
    for number, (x, y) in enumerate(squares, 1):
        points = [(x, y), (x, y + 1), (x + 1, y + 1), (x + 1, y), (x, y)]
        record = struct.pack("<i4d3i", 5, x, y, x + 1, y + 1, 1, len(points), 0) + b"".join(struct.pack("<dd", *p) for p in points)
        out.write(struct.pack(">2i", number, len(record) // 2) + record)
    data = out.getvalue()
    return struct.pack(">i20xi", 9994, 50 + len(data) // 2) + struct.pack("<2i64x", 1000, 5) + data


def records(table, encoding="cp932"):
    """Attribute records; a row of None is one marked as deleted."""
    size = 1 + sum(WIDTHS.values())
    head = struct.pack("<4BIHH20x", 3, 99, 1, 1, len(table), 33 + 32 * len(WIDTHS), size)
    head += b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", w, 0) for n, w in WIDTHS.items()) + b"\r"
    return head + b"".join((b"*" if r is None else b" ") + b"".join((r or {}).get(n, "").encode(encoding).ljust(w) for n, w in WIDTHS.items()) for r in table)


def town(k, name="港町"):
    return {"KEY_CODE": f"46360{k:04d}", "PREF": "46", "CITY": "360", "CITY_NAME": name, "HCODE": "8101"}


def archive(spark, name, squares, table):
    folder = scratch_path(spark, name).removeprefix("file:")
    os.makedirs(folder)
    with zipfile.ZipFile(f"{folder}/towns.zip", "w") as z:
        z.writestr("towns.SHP", shapes(squares))
        z.writestr("towns.DBF", records(table))
    return folder


def test_attributes_stay_with_their_shapes(spark):
    folder = archive(spark, "zip", [(0, 0), (10, 0), (20, 0)], [town(1), None, town(3, "山町")])
    got = {r["KEY_CODE"]: (r["CITY_NAME"], r["polygons"][0][0][0]["x"]) for r in rows(read_boundary_archives(spark, folder))}
    assert got == {"463600001": ("港町", 0.0), "463600003": ("山町", 20.0)}


def test_files_that_do_not_fit_are_errors(spark):
    with pytest.raises(Exception, match="zip"):
        read_boundary_archives(spark, archive(spark, "zip", [(0, 0)], [town(1), town(2)])).collect()
    with pytest.raises(UnicodeDecodeError):
        read_dbf(records([town(1, "\x81 half a letter")], "latin-1"))
    assert read_dbf(records([town(1)]))[0]["CITY_NAME"] == "港町"
