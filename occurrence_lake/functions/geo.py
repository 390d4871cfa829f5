"""Planar predicates on longitude/latitude (FLT-2, FLT-5) and the tile grid.

All are plain column expressions: comparisons on the raw coordinate
columns are pushed to the Parquet scan, the rest runs in codegen.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from occurrence_lake.functions.sqltext import dbl, ref


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Box:
    min_lon: float
    min_lat: float
    max_lon: float
    max_lat: float


# Most horizontal bands that a polygon's edges are cut into, and most times
# that an edge is listed on average.
MAX_BANDS, MAX_COPIES = 512, 8


# ---------------------------------------------------------------------------
# polygons
# ---------------------------------------------------------------------------
def parse_wkt_polygon(wkt: str) -> list[list[tuple[float, float]]]:
    """Rings of a ``POLYGON((x y, ...), (hole), ...)`` text, x = longitude, or
    of all members of a ``MULTIPOLYGON``: they do not overlap, so the
    even-odd rule holds over all their rings."""
    text = wkt.strip()
    if not re.match(r"(MULTI)?POLYGON\s*\(", text.upper()):
        raise ValueError(f"not a WKT POLYGON or MULTIPOLYGON: {wkt[:40]!r}")
    rings = []
    for ring_text in re.findall(r"\(([^()]*)\)", text):
        ring = [tuple(float(v) for v in pair.split()) for pair in ring_text.split(",") if pair.strip()]
        if len(ring) < 4 or ring[0] != ring[-1]:
            raise ValueError("a polygon ring needs at least 4 vertices and must be closed")
        rings.append(ring)
    if not rings:
        raise ValueError(f"no ring in {wkt[:40]!r}")
    return rings


def polygon_box(rings) -> Box:
    xs = [x for ring in rings for x, _ in ring]
    ys = [y for ring in rings for _, y in ring]
    return Box(min(xs), min(ys), max(xs), max(ys))


def ring_is_rectangle(rings) -> bool:
    """One axis-aligned rectangle (the shape of the acquisition predicate)."""
    if len(rings) != 1 or len(rings[0]) != 5:
        return False
    ring = rings[0][:4]
    xs, ys = {x for x, _ in ring}, {y for _, y in ring}
    return len(xs) == 2 and len(ys) == 2 and all(
        ring[i][0] == ring[(i + 1) % 4][0] or ring[i][1] == ring[(i + 1) % 4][1] for i in range(4))


def inside_box(lon, lat, box: Box) -> Column:
    """Closed rectangle test; both ``between`` reach the Parquet scan."""
    return _col(lon).between(box.min_lon, box.max_lon) & _col(lat).between(box.min_lat, box.max_lat)


def polygon_edges(rings):
    """Non-horizontal edges as (xi, yi, xj, yj, dx, dy) with dx, dy computed once."""
    edges = []
    for ring in rings:
        for (xi, yi), (xj, yj) in zip(ring[:-1], ring[1:]):
            if yi != yj:
                edges.append((xi, yi, xj, yj, xj - xi, yj - yi))
    return edges


def inside_polygon(lon: str, lat: str, rings) -> Column:
    """FLT-2 for any polygon: even-odd rule by counting edge crossings of a
    ray to +x.  An edge counts when exactly one end is above the point
    (half-open), so a vertex is never counted twice.  Holes are rings too.

    The bounding-box conjunct comes first: it is a pushed-down scan filter,
    the crossing count runs only on what survives it.  The edges are one
    constant array, cut into horizontal bands of equal height; a point folds
    over the edges of its own band only, so neither planning nor the test
    itself grows with the whole number of edges.
    """
    edges = polygon_edges(rings)
    if not edges:
        return F.lit(False)
    b = polygon_box(rings)
    n, bands = max(1, min(MAX_BANDS, len(edges) // 8)), []
    while not bands:
        height = (b.max_lat - b.min_lat) / n

        def spanned(e):
            # a band more on each side: rounding never loses an edge
            low, high = ((y - b.min_lat) / height for y in sorted((e[1], e[3])))
            return range(max(0, int(low) - 1), min(n - 1, int(high) + 1) + 1)

        if n > 1 and sum(len(spanned(e)) for e in edges) > MAX_COPIES * len(edges):
            n //= 2     # long edges lie in many bands: make fewer
            continue
        bands = [[] for _ in range(n)]
        for e in edges:
            for i in spanned(e):
                bands[i].append(e)
    flat = [[v for xi, yi, _, yj, dx, dy in band for v in (xi, yi, yj, dx, dy)] for band in bands]
    # one string literal, folded to a constant array when the plan is made
    table = f"from_json('{json.dumps(flat)}', 'array<array<double>>')"
    x, y = ref(lon), ref(lat)
    mine = f"get({table}, CAST(least(greatest(floor(({y} - {dbl(b.min_lat)}) / {dbl(height)}), 0), {n - 1}) AS INT))"
    crossed = ("((p.y < p.e[i + 1]) <> (p.y < p.e[i + 2])) "
               "AND p.x < p.e[i + 3] * (p.y - p.e[i + 1]) / p.e[i + 4] + p.e[i]")
    count = F.expr(f"get(transform(array(named_struct('x', {x}, 'y', {y}, 'e', {mine})), p -> CASE WHEN size(p.e) = 0 THEN 0 "
                   f"ELSE size(filter(sequence(0, size(p.e) - 5, 5), i -> {crossed})) END), 0)")
    return inside_box(lon, lat, b) & (count % 2 == 1)


def inside_geometry(lon, lat, wkt: str) -> Column:
    rings = parse_wkt_polygon(wkt)
    if ring_is_rectangle(rings):
        return inside_box(lon, lat, polygon_box(rings))
    return inside_polygon(lon, lat, rings)


# ---------------------------------------------------------------------------
# envelopes (FLT-5)
# ---------------------------------------------------------------------------
def envelope_overlaps(min_lon, min_lat, max_lon, max_lat, box: Box) -> Column:
    """``geom && box`` on bounding boxes: closed intervals overlap on both
    axes.  An empty geometry (NULL envelope) overlaps nothing."""
    return ((_col(min_lon) <= box.max_lon) & (_col(max_lon) >= box.min_lon)
            & (_col(min_lat) <= box.max_lat) & (_col(max_lat) >= box.min_lat))


def envelopes_overlap(a: dict, b: dict) -> Column:
    """Overlap of two envelopes given as dicts of min_lon/min_lat/max_lon/max_lat columns."""
    return ((a["min_lon"] <= b["max_lon"]) & (a["max_lon"] >= b["min_lon"])
            & (a["min_lat"] <= b["max_lat"]) & (a["max_lat"] >= b["min_lat"]))


# ---------------------------------------------------------------------------
# tile grid: geographic quad tiles (EPSG:4326), 2^(z+1) x 2^z tiles at zoom
# z, each 180 / 2^z degrees wide, x from -180 eastwards, y from +90 south.
# ---------------------------------------------------------------------------
def tile_size(z) -> Column:
    return F.lit(180.0) / F.pow(F.lit(2.0), _col(z).cast("double"))


def tile_bounds(z, x, y) -> dict:
    size = tile_size(z)
    x, y = _col(x), _col(y)
    return {
        "min_lon": x * size - F.lit(180.0),
        "max_lon": (x + 1) * size - F.lit(180.0),
        "max_lat": F.lit(90.0) - y * size,
        "min_lat": F.lit(90.0) - (y + 1) * size,
    }


def tile_x(lon, z) -> Column:
    return F.floor((_col(lon) + F.lit(180.0)) / tile_size(z))


def tile_y(lat, z) -> Column:
    return F.floor((F.lit(90.0) - _col(lat)) / tile_size(z))


# ---------------------------------------------------------------------------
# Tile grids of the many-tiles join.  Both are quad trees over a unit
# square (the geographic one: two squares side by side).
# ---------------------------------------------------------------------------
MERCATOR_MAX_LAT = 85.05112877980659  # the latitude at which the square ends


def mercator_bounds(z, x, y) -> dict:
    """Longitude/latitude box of a Web Mercator tile."""
    n = F.pow(F.lit(2.0), _col(z).cast("double"))
    lat = lambda row: F.degrees(F.atan(F.sinh(F.lit(math.pi) * (F.lit(1.0) - F.lit(2.0) * row / n))))
    x, y = _col(x), _col(y)
    return {"min_lon": x / n * 360.0 - 180.0, "max_lon": (x + 1) / n * 360.0 - 180.0, "max_lat": lat(y), "min_lat": lat(y + 1)}


def _geographic_unit(lon: Column, lat: Column) -> tuple[Column, Column]:
    return (lon + 180.0) / 180.0, (F.lit(90.0) - lat) / 180.0


def _mercator_unit(lon: Column, lat: Column) -> tuple[Column, Column]:
    clipped = F.least(F.greatest(lat, F.lit(-MERCATOR_MAX_LAT)), F.lit(MERCATOR_MAX_LAT))
    return (lon + 180.0) / 360.0, (F.lit(1.0) - F.asinh(F.tan(F.radians(clipped))) / math.pi) / 2.0


@dataclass(frozen=True)
class TileGrid:
    width: int            # squares side by side at level 0
    to_unit: Callable     # (lon, lat) -> (u east, v south)
    bounds: Callable      # (z, x, y) -> box columns


GRIDS = {"geographic": TileGrid(2, _geographic_unit, tile_bounds), "mercator": TileGrid(1, _mercator_unit, mercator_bounds)}
