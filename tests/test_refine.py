import math
import random

import pytest
from pyspark.sql import functions as F

from occurrence_lake.functions.geo import inside_geometry, parse_wkt_polygon
from occurrence_lake.operators import areas, refine
from occurrence_lake.schema import RAW_SCHEMA
from occurrence_lake.sources import fixtures

from conftest import SF_SMALL


def _raw(spark, rows):
    """Raw rows from dicts; missing columns NULL."""
    full = [tuple(r.get(f.name) for f in RAW_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_taxonomic_filter(spark):
    base = dict(taxon_key=1, decimal_longitude=6.0, decimal_latitude=45.0, year=2020, month=5, day=1)
    raw = _raw(spark, [
        dict(base, gbif_id="1", species="s", **{"class": "Aves"}),
        dict(base, gbif_id="2", species="s", **{"class": None}),       # NULL class: dropped
        dict(base, gbif_id="3", species=None, **{"class": "Mammalia"}),  # NULL species: dropped
        dict(base, gbif_id="4", species="s", **{"class": "Insecta"}),
        dict(base, gbif_id="5", species="s", **{"class": "Mammalia"}),
    ])
    out = refine.filtered_occurrences(raw)
    assert sorted(r.gbif_id for r in out.collect()) == ["1", "5"]
    assert out.columns == ["gbif_id", "taxon_key", "decimal_latitude", "decimal_longitude",
                           "coordinate_uncertainty_in_meters", "coordinate_precision", "elevation",
                           "elevation_accuracy", "depth", "depth_accuracy", "date"]


def _inside(x, y, rings):
    """Brute-force even-odd test with the same half-open rule."""
    c = 0
    for ring in rings:
        for (xi, yi), (xj, yj) in zip(ring[:-1], ring[1:]):
            if (y < yi) != (y < yj) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
                c += 1
    return c % 2 == 1


def test_polygon_against_brute_force(spark):
    wkt = ("POLYGON((4.5 44.5, 8.0 44.6, 7.2 46.0, 6.0 45.2, 5.0 47.5, 4.5 44.5),"
           "(5.3 45.0, 6.1 45.0, 5.9 45.3, 5.3 45.0))")
    rings = parse_wkt_polygon(wkt)
    rnd = random.Random(7)
    pts = [(rnd.uniform(4.0, 8.5), rnd.uniform(44.0, 48.0)) for _ in range(3000)]
    pts += [(5.0, 47.5), (4.5, 44.5), (6.0, 45.2), (5.3, 45.0)]  # vertices
    df = spark.createDataFrame(pts, "x double, y double")
    got = {(r.x, r.y) for r in df.filter(inside_geometry("x", "y", wkt)).collect()}
    want = {(x, y) for x, y in pts if _inside(x, y, rings)}
    assert got == want and 0 < len(got) < len(pts)


def test_rectangle_is_closed(spark):
    df = spark.createDataFrame([(4.63127, 44.84424), (7.5505, 46.81983), (7.55051, 45.0)], "x double, y double")
    got = df.filter(inside_geometry("x", "y", refine.ACQUISITION_POLYGON)).count()
    assert got == 2


def test_acquire_filters_everything(spark):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    got = refine.acquire(raw).collect()
    assert got and all(r.country_code == "FR" and r.kingdom == "Animalia" and 2015 <= r.year <= 2025
                       and 4.63127 <= r.decimal_longitude <= 7.5505 for r in got)
    want = raw.filter((F.col("country_code") == "FR") & (F.col("kingdom") == "Animalia") & F.col("year").between(2015, 2025)
                      & F.col("decimal_longitude").between(4.63127, 7.5505)
                      & F.col("decimal_latitude").between(44.84424, 46.81983)).count()
    assert len(got) == want


def test_serving_rows(spark):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    serving = refine.serving_occurrences(refine.geospatial_occurrences(refine.filtered_occurrences(raw)))
    assert dict(serving.dtypes)["taxon_key"] == "int"
    assert serving.filter(F.col("elevation") == 0.0).count() == 0


def test_declared_schemas(spark):
    from occurrence_lake.schema import FILTERED_SCHEMA, SERVING_OCCURRENCES_SCHEMA
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    filtered = refine.filtered_occurrences(raw)
    serving = refine.serving_occurrences(refine.geospatial_occurrences(filtered))

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    assert shape(filtered.schema) == shape(FILTERED_SCHEMA)
    assert shape(serving.schema) == shape(SERVING_OCCURRENCES_SCHEMA)
    assert raw.schema.names == RAW_SCHEMA.names


def test_polygon_of_many_edges(spark):
    """5,000 edges against a plain crossing count; planning and testing stay
    within a small multiple of 100 edges."""
    import math
    import random
    import time
    from occurrence_lake.functions.geo import inside_geometry

    def star(n):
        ring = [(6 + (1 + i % 2) * math.cos(2 * math.pi * i / n), 45 + (1 + i % 2) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [*ring, ring[0]]

    def inside(x, y, ring):
        return sum((yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi for (xi, yi), (xj, yj) in zip(ring, ring[1:])) % 2 == 1

    rnd = random.Random(6)
    points = [(i, rnd.uniform(3.5, 8.5), rnd.uniform(42.5, 47.5)) for i in range(1000)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    seconds = {}
    for n in (100, 5000):
        ring = star(n)
        wkt = "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"
        t = time.time()
        got = {r.id for r in df.filter(inside_geometry("x", "y", wkt)).collect()}
        seconds[n] = time.time() - t
        assert got == {i for i, x, y in points if inside(x, y, ring)} and 100 < len(got) < 900
    assert seconds[5000] < 10 * max(1.0, seconds[100])


def _star(n, cx, cy, r):
    ring = [(cx + r * (1 + 0.4 * math.cos(7 * t)) * math.cos(t), cy + r * (1 + 0.4 * math.cos(7 * t)) * math.sin(t))
            for t in (2 * math.pi * i / n for i in range(n))]
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + ")"


AREAS = [
    (1, "POLYGON((4.5 44.5, 8.0 44.6, 7.2 46.0, 6.0 45.2, 5.0 47.5, 4.5 44.5),(5.3 45.0, 6.1 45.0, 5.9 45.3, 5.3 45.0))"),
    (2, f"MULTIPOLYGON({_star(900, 6.0, 45.5, 0.8).join(['(', ')'])}, (({_star(5, -6.1, 40.0, 2.0)[1:-1]})))"),
    (3, refine.ACQUISITION_POLYGON),
    (4, f"multipolygon (({_star(40, 5.0, 46.0, 1e-4)}))"),                       # smaller than the points' distances
    (5, "POLYGON((-180 -90, 180 -90, 180 90, 0 89, -180 90, -180 -90))"),
    (6, None),
    (7, "POLYGON((4 44, 8 44, 8 46, 6 46, 6 45, 5 45, 5 46, 4 46, 4 44))"),       # edges along cell borders
]


def test_many_areas_against_brute_force(spark):
    rnd = random.Random(11)
    pts = [(rnd.uniform(4.0, 8.5), rnd.uniform(44.0, 48.0)) for _ in range(1500)]
    pts += [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(300)]
    pts += [(x / 4, y / 4) for x in range(15, 34) for y in range(175, 193)]       # on cell borders, edges and vertices
    pts += [(5.0 + rnd.uniform(-2e-4, 2e-4), 46.0 + rnd.uniform(-2e-4, 2e-4)) for _ in range(300)]
    pts += [pts[0], pts[0], (4.63127, 44.84424), (7.5505, 46.81983)]              # repeated rows stay; a closed rectangle
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)] + [(-1, None, 45.0), (-2, 6.0, None)], "area bigint, x double, y double")
    table = spark.createDataFrame(AREAS, "key int, shape string")
    got = sorted((r["key"], r["area"]) for r in areas.within_areas(df, table, "x", "y", "key", "shape").collect())
    want = []
    for key, wkt in AREAS:
        if wkt is not None:
            rings = parse_wkt_polygon(wkt)
            box = rings[0] if key == 3 else None
            for i, (x, y) in enumerate(pts):
                if (box[0][0] <= x <= box[2][0] and box[0][1] <= y <= box[2][1]) if box else _inside(x, y, rings):
                    want.append((key, i))
    assert got == sorted(want) and {k for k, _ in got} == {1, 2, 3, 4, 5, 7}
    one = df.where(inside_geometry("x", "y", AREAS[1][1])).count()
    assert one == sum(k == 2 for k, _ in got) > 0


def test_areas_empty_and_wrong(spark):
    df = spark.createDataFrame([(1, 6.0, 45.0)], "id bigint, x double, y double")
    none = spark.createDataFrame([], "key int, shape string")
    assert areas.within_areas(df, none, "x", "y", "key", "shape").count() == 0
    some = spark.createDataFrame(AREAS, "key int, shape string")
    assert areas.within_areas(df.where("false"), some, "x", "y", "key", "shape").columns == ["id", "x", "y", "key"]
    assert areas.within_areas(df.where("false"), some, "x", "y", "key", "shape").count() == 0
    for bad in ("POINT(1 2)", "POLYGON((1 2, 3 4, 1 2))", "POLYGON((0 0, 1 0, 1 1, 0 1))", "MULTIPOLYGON EMPTY"):
        with pytest.raises(Exception, match="not a WKT|a ring needs"):
            areas.within_areas(df, spark.createDataFrame([(1, bad)], "key int, shape string"), "x", "y", "key", "shape").collect()
    with pytest.raises(ValueError):
        areas.within_areas(df, some, "x", "y", "id", "shape")


def test_cells_inside_an_area_need_no_edges(spark):
    """A large area's points are mostly settled by whole cells."""
    edges = areas.area_edges(spark.createDataFrame(AREAS, "key int, shape string").where("key = 2 or key = 5"), "key", "shape")
    cells = areas.cover(edges, areas.edge_bands(edges)).groupBy("area").agg(F.count("*").alias("n"), F.count_if("whole").alias("whole")).collect()
    assert all(r["n"] < 1200 for r in cells) and {r["area"]: r["whole"] / r["n"] for r in cells}[5] > 0.7


def _random_areas(rnd):
    """Stars of few and of many edges around 0 and elsewhere, some on a coarse grid."""
    out = []
    for key in range(60):
        n, cx, cy, r = rnd.choice([3, 4, 5, 7, 12, 60, 400]), rnd.uniform(-2, 2), rnd.uniform(-2, 2), rnd.choice([0.05, 0.4, 1.5])
        ring = [(cx + r * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        if key % 3 == 0:
            ring = [(round(x * 4) / 4, round(y * 4) / 4) for x, y in ring]
        out.append((key, [*ring, ring[0]]))
    return out


def test_a_point_is_settled_by_the_one_row_of_its_cell(spark, monkeypatch):
    """One join a kind of cell (none after it), whatever the areas; a table of
    areas in one piece is dealt out before its texts are parsed."""
    rnd, made = random.Random(23), {}
    own = _random_areas(rnd)
    pts = [(rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for _ in range(600)] + [(x / 4, y / 4) for x in range(-9, 10) for y in range(-9, 10)]
    pts += [p for _, ring in own[::4] for p in ring[:20]] + [(rnd.uniform(-3, 3), ring[i][1]) for _, ring in own for i in (0, 1)] + [(0.3, -1e-20), (-1e-20, 0.3)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id bigint, x double, y double")
    table = spark.createDataFrame([(k, "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))") for k, ring in own], "key int, shape string").coalesce(1)
    write = areas._written
    monkeypatch.setattr(areas, "_written", lambda frame, name: made.setdefault(name, write(frame, name)))
    found = areas.within_areas(df, table, "x", "y", "key", "shape")
    boxes = [(k, [min(c) for c in zip(*ring)], [max(c) for c in zip(*ring)], ring) for k, ring in own]
    want = [(k, i) for k, low, high, ring in boxes for i, (x, y) in enumerate(pts) if low[0] <= x <= high[0] and low[1] <= y <= high[1] and _inside(x, y, [ring])]
    assert sorted((r["key"], r["id"]) for r in found.collect()) == sorted(want)
    assert len(made["area-edges"].inputFiles()) > 1
    kinds = made["area-cells"].select("plain").distinct().count()
    assert kinds == 2 and found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == kinds
