"""Distributed loader for zipped boundary shapefiles.

``binaryFile`` gives one row per archive (Spark packs files into splits of
``spark.sql.files.maxPartitionBytes``, which bounds the bytes one task
holds); ``mapInPandas`` unpacks each archive with ``zipfile`` and decodes
the polygon records (``.shp``) and attributes (``.dbf``, CP932 text) with
``struct``.  Output rows carry the small-area attributes, the polygons as
``array<array<array<struct<x,y>>>>`` and the SRID of the chosen datum.
Partition the result by ``(year, datum, pref)`` when landing it so that
boundary queries prune to the prefectures they need.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTRS = ["KEY_CODE", "PREF", "CITY", "S_AREA", "PREF_NAME", "CITY_NAME", "S_NAME", "HCODE"]
SCHEMA = (
    "source_path string, record int, "
    + ", ".join(f"{a} string" for a in ATTRS)
    + ", attrs map<string,string>, polygons array<array<array<struct<x:double,y:double>>>>"
)


def _ring_area2(pts: list[tuple[float, float]]) -> float:
    return sum(pts[i][0] * pts[i + 1][1] - pts[i + 1][0] * pts[i][1] for i in range(len(pts) - 1))


def read_shp(data: bytes) -> list[list[list[tuple[float, float]]] | None]:
    """Polygon records -> polygons (ring 0 exterior).  Shapefile exteriors
    are clockwise; each clockwise ring opens a polygon and the following
    counter-clockwise rings are its holes."""
    out = []
    pos = 100
    n = len(data)
    while pos + 8 <= n:
        _, words = struct.unpack(">ii", data[pos:pos + 8])
        content = data[pos + 8:pos + 8 + 2 * words]
        pos += 8 + 2 * words
        (shape_type,) = struct.unpack("<i", content[:4])
        if shape_type == 0:
            out.append(None)
            continue
        if shape_type not in (5, 15, 25):
            raise ValueError(f"unsupported shape type {shape_type}")
        n_parts, n_points = struct.unpack("<ii", content[36:44])
        parts = list(struct.unpack(f"<{n_parts}i", content[44:44 + 4 * n_parts]))
        off = 44 + 4 * n_parts
        xy = struct.unpack(f"<{2 * n_points}d", content[off:off + 16 * n_points])
        pts = [(xy[2 * i], xy[2 * i + 1]) for i in range(n_points)]
        polys: list[list[list[tuple[float, float]]]] = []
        for k, start in enumerate(parts):
            end = parts[k + 1] if k + 1 < n_parts else n_points
            ring = pts[start:end]
            if _ring_area2(ring) <= 0 or not polys:
                polys.append([ring])
            else:
                polys[-1].append(ring)
        out.append(polys)
    return out


def read_dbf(data: bytes, encoding: str = "cp932") -> list[dict[str, str | None] | None]:
    """dBASE records as dicts of stripped strings (None when blank), in the
    order of the shapes; a deleted record is None.  Text that is not in the
    encoding is an error."""
    n_rec, header_len, rec_len = struct.unpack("<IHH", data[4:12])
    fields = []
    pos = 32
    while data[pos] != 0x0D:
        name = data[pos:pos + 11].split(b"\x00")[0].decode("ascii")
        length = data[pos + 16]
        fields.append((name, length))
        pos += 32
    rows = []
    for i in range(n_rec):
        rec = data[header_len + i * rec_len: header_len + (i + 1) * rec_len]
        if rec[:1] == b"*":
            rows.append(None)  # its shape is still in the other file
            continue
        off = 1
        row = {}
        for name, length in fields:
            txt = rec[off:off + length].decode(encoding).strip()
            row[name] = txt or None
            off += length
        rows.append(row)
    return rows


def _archive_rows(path: str, content: bytes, encoding: str) -> list[dict]:
    zf = zipfile.ZipFile(io.BytesIO(content))
    names = zf.namelist()
    rows = []
    for shp in [n for n in names if n.lower().endswith(".shp")]:
        stem = shp[:-4]
        dbf = next((n for n in names if n.lower() == f"{stem.lower()}.dbf"), None)
        geoms = read_shp(zf.read(shp))
        attrs = read_dbf(zf.read(dbf), encoding) if dbf else [{} for _ in geoms]
        for i, (g, a) in enumerate(zip(geoms, attrs, strict=True)):
            if a is None:
                continue
            polys = None if g is None else [[[{"x": x, "y": y} for x, y in ring] for ring in poly] for poly in g]
            row = {"source_path": path, "record": i, "attrs": {k: v for k, v in a.items() if v is not None},
                   "polygons": polys}
            for k in ATTRS:
                row[k] = a.get(k)
            rows.append(row)
    return rows


def read_boundary_archives(spark: SparkSession, path: str, datum: str = "2000",
                           encoding: str = "cp932") -> DataFrame:
    """Zipped small-area shapefiles under ``path`` -> boundary features."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["source_path", "record", *ATTRS, "attrs", "polygons"]
        for b in batches:
            for p, c in zip(b["path"], b["content"], strict=True):
                yield pd.DataFrame(_archive_rows(p, bytes(c), encoding), columns=cols)

    feats = files.select("path", "content").mapInPandas(parse, SCHEMA)
    srid = 6668 if str(datum) == "2011" else 4612
    return feats.withColumn("srid", F.lit(srid))
