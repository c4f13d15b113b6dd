"""Well-known binary geometry to its fixed JSON text."""

from __future__ import annotations

import json
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F, types as T

# Geometry type codes.
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString",
         6: "MultiPolygon", 7: "GeometryCollection"}


def _shape(data: bytes, at: int):
    """(kind, coordinates or members, next position) of the geometry at ``at``."""
    order = "<" if data[at] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5

    def count(at):
        return struct.unpack_from(order + "I", data, at)[0], at + 4

    def points(n, at):
        flat = struct.unpack_from(f"{order}{2 * n}d", data, at)
        flat = [int(v) if v.is_integer() else v for v in flat]
        return [list(p) for p in zip(flat[::2], flat[1::2])], at + 16 * n

    if kind == 1:
        (point,), at = points(1, at)
        return kind, point, at
    n, at = count(at)
    if kind == 2:
        line, at = points(n, at)
        return kind, line, at
    parts = []
    for _ in range(n):
        if kind == 3:
            m, at = count(at)
            part, at = points(m, at)
        else:
            inner, part, at = _shape(data, at)
            if kind == 7:
                part = {"type": KINDS[inner], "coordinates": part}
        parts.append(part)
    return kind, parts, at


def _text(wkb, srid) -> str | None:
    if wkb is None:
        return None
    kind, body, _ = _shape(bytes(wkb), 0)
    field = "geometries" if kind == 7 else "coordinates"
    return json.dumps({field: body, "type": KINDS[kind], "srid": 0 if pd.isna(srid) else int(srid)},
                      separators=(",", ":"))


@F.pandas_udf(T.StringType())
def _to_json(wkb: pd.Series, srid: pd.Series) -> pd.Series:
    return pd.Series([_text(w, s) for w, s in zip(wkb, srid)], dtype="object")


def geometry_to_json(wkb: Column, srid: Column | None = None) -> Column:
    return _to_json(wkb, F.lit(0) if srid is None else srid)
