import math
import random

import pytest
from pyspark.sql import functions as F

from occurrence_lake.functions import wkb as W
from occurrence_lake.functions.geo import Box
from occurrence_lake.operators import constraints, layer, metrics
from occurrence_lake.operators.multipoint import species_all_occurrence, species_extents


def test_species_in_parts_is_whole(spark):
    rnd = random.Random(3)
    rows = [(1, f"h{i}", rnd.uniform(4, 8), rnd.uniform(44, 47)) for i in range(500)]   # hot species
    rows += [(2, f"c{i}", rnd.uniform(4, 8), rnd.uniform(44, 47)) for i in range(7)]
    rows += [(3, "n0", None, 45.0)]
    df = spark.createDataFrame(rows, "taxon_key long, gbif_id string, lon double, lat double")
    pts = W.with_point_wkb(df, "lon", "lat", "coordinates")
    one = species_all_occurrence(pts, lon="lon", lat="lat")
    assert sorted((r.taxon_key, r.part) for r in one.collect()) == [(1, 0), (2, 0), (3, 0)]
    sp = species_all_occurrence(pts, lon="lon", lat="lat", parts=5)
    parts = sp.collect()
    hot = [r for r in parts if r.taxon_key == 1]
    assert len(hot) == 5 and sum(r.n_points for r in hot) == 500
    assert max(r.n_points for r in hot) < 200
    # every point is in exactly one part
    exploded = sp.select("taxon_key", F.explode(W.multipoint_points("all_occurrence_coordinates")).alias("p"))
    back = sorted((r.taxon_key, r.x, r.y) for r in W.with_point_xy(exploded, "p", "x", "y").collect())
    assert back == sorted((k, x, y) for k, _, x, y in rows if x is not None)
    # one envelope per species, the same however it is split
    extents = [sorted(map(tuple, species_extents(s).collect())) for s in (one, sp)]
    assert extents[0] == extents[1] and len(extents[0]) == 3
    # a species with only NULL points: empty MultiPoint, NULL envelope
    none = [r for r in parts if r.taxon_key == 3][0]
    assert bytes(none.all_occurrence_coordinates).hex() == "010400000000000000" and none.min_lon is None


def test_layer_returns_whole_species(spark):
    """A box at one corner of a species returns all its parts; a tile pairs
    with it once."""
    rnd = random.Random(4)
    rows = [(1, f"h{i}", 5.0 + rnd.random(), 45.0 + rnd.random()) for i in range(40)] + [(1, "corner", 5.0, 45.0), (2, "far", 9.0, 49.0)]
    pts = W.with_point_wkb(spark.createDataFrame(rows, "taxon_key long, gbif_id string, lon double, lat double"), "lon", "lat", "coordinates")
    sp = species_all_occurrence(pts, lon="lon", lat="lat", parts=8)
    geoms = layer.layer_bbox(sp, Box(4.9, 44.9, 5.001, 45.001)).select(F.explode(W.multipoint_points("geom")))
    assert geoms.count() == 41
    tiles = spark.createDataFrame([(6, 65, 16), (3, 8, 1), (0, 1, 0)], "z int, x long, y long")
    pairs = [tuple(r) for r in layer.layer_tiles(sp, tiles).collect()]
    assert len(pairs) == len(set(pairs)) and (0, 1, 0, 1) in pairs
    with pytest.raises(Exception, match="tile zoom"):
        layer.layer_tiles(sp, spark.createDataFrame([(31, 0, 0)], "z int, x long, y long")).collect()


def _overlaps(e, t):
    return e[0] <= t[2] and e[2] >= t[0] and e[1] <= t[3] and e[3] >= t[1]


def _tile_box(z, x, y):
    size = 180.0 / 2.0 ** z
    return (x * size - 180.0, 90.0 - (y + 1) * size, (x + 1) * size - 180.0, 90.0 - y * size)


def test_tiles_join_against_brute_force(spark):
    rnd = random.Random(11)
    envs = []
    for k in range(300):
        w = rnd.choice([0.0, 1e-4, 0.01, 0.3, 2.0, 40.0])
        x0, y0 = rnd.uniform(-10, 20), rnd.uniform(30, 60)
        envs.append((k, 0, x0, y0, x0 + w * rnd.random(), y0 + w * rnd.random()))
    envs.append((999, 0, 5.625, 45.0, 5.625, 45.0))          # exactly on tile corners
    species = spark.createDataFrame(envs, "taxon_key long, part long, min_lon double, min_lat double, "
                                          "max_lon double, max_lat double")
    tiles = []
    for z in (3, 6, 9, 12):
        size = 180.0 / 2 ** z
        for _ in range(60):
            lon, lat = rnd.uniform(-10, 20), rnd.uniform(30, 60)
            tiles.append((z, int((lon + 180) // size), int((90 - lat) // size)))
        tiles.append((z, int((5.625 + 180) // size), int((90 - 45.0) // size)))
    tiles = sorted(set(tiles))
    tdf = spark.createDataFrame(tiles, "z int, x long, y long")
    got = {(r.z, r.x, r.y, r.taxon_key) for r in layer.layer_tiles(species, tdf).collect()}
    want = {(z, x, y, e[0]) for (z, x, y) in tiles for e in envs if _overlaps(e[2:], _tile_box(z, x, y))}
    assert got == want and len(want) > 100


def test_mercator_tiles_against_brute_force(spark):
    rnd = random.Random(12)
    envs = []
    for k in range(200):
        w = rnd.choice([0.0, 1e-3, 0.3, 2.0, 90.0])
        x0, y0 = rnd.uniform(-170, 80), rnd.uniform(-89, 60)
        envs.append((k, 0, x0, y0, x0 + w * rnd.random(), min(90.0, y0 + w * rnd.random())))
    species = spark.createDataFrame(envs, "taxon_key long, part long, min_lon double, min_lat double, max_lon double, max_lat double")
    tiles = sorted({(z, rnd.randrange(2 ** z), rnd.randrange(2 ** z)) for z in (0, 1, 3, 5) for _ in range(80)})
    lat = lambda v, z: math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * v / 2 ** z))))
    box = lambda z, x, y: (x / 2 ** z * 360 - 180, lat(y + 1, z), (x + 1) / 2 ** z * 360 - 180, lat(y, z))
    got = [(r.z, r.x, r.y, r.taxon_key) for r in layer.layer_tiles(species, spark.createDataFrame(tiles, "z int, x long, y long"), grid="mercator").collect()]
    want = {(z, x, y, e[0]) for (z, x, y) in tiles for e in envs if _overlaps(e[2:], box(z, x, y))}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_heavy_cells_are_salted_at_any_level(spark):
    """A third of the tiles below one cell of level 9, many small envelopes
    under one tile: no join key holds much more than its share, the rows are
    those without salts, and levels without an envelope make no ancestors."""
    from occurrence_lake.functions.geo import GRIDS
    tiles = (spark.range(20_000).selectExpr("14 AS z", "IF(id % 3 = 0, 9000 + id % 30, id % 32768) AS x", "IF(id % 3 = 0, 3000 + id % 27, id % 16384) AS y").distinct()
             .unionByName(spark.range(8_000).selectExpr("17 AS z", "72000 + id % 200 AS x", "24000 + floor(id / 200) AS y"))
             .unionByName(spark.sql("SELECT 0 AS z, 1L AS x, 0L AS y")))
    corner = lambda k, size: (-180 + 72000 / 2 ** 18 * 360 + size, 90 - 24100 / 2 ** 17 * 180, -180 + 72100 / 2 ** 18 * 360, 90 - 24000 / 2 ** 17 * 180 - size)
    huge = [(k, -170.0, -80.0, 170.0, 80.0) for k in range(3)]
    middle = [(5 + k, *corner(k, k / 1e5)) for k in range(4)]
    small = [(10 + k, 5.0 + k / 1e4, 45.0, 5.001 + k / 1e4, 45.001) for k in range(2000)]
    ext = spark.createDataFrame(huge + middle + small, "taxon_key long, min_lon double, min_lat double, max_lon double, max_lat double")
    g = GRIDS["geographic"]
    t, env = layer.placed_tiles(tiles), layer.placed_envelopes(ext, "taxon_key", g)
    left, right = layer.tile_cells(t, layer._seen(env, "env_level")[1]), layer.envelope_cells(env, layer._seen(t, "z")[1], g)
    assert {r.level for r in left.filter("kind = 'A'").select("level").distinct().collect()} <= {r.env_level for r in env.select("env_level").distinct().collect()}
    largest = lambda df, *salts: df.groupBy(*layer.CELL, *salts).count().agg(F.max("count")).first()[0]
    many, wide = layer.frequent_cells(left), layer.frequent_cells(right)
    salts = layer.cell_salts(many, wide, 16, 400)
    counts = {r.h: r["count"] for r in left.groupBy(F.xxhash64(*layer.CELL).alias("h")).count().collect()}
    limit = max(400, sum(counts.values()) / 16)
    assert {h for h, n in counts.items() if n > 1.3 * limit} <= salts.keys() and largest(left) > 4 * limit
    assert largest(layer._salted(left, salts, 0, ["z", "x", "y"]), "s0", "s1") < 1.5 * limit
    assert largest(right) >= 2000 and largest(layer._salted(right, salts, 1, ["taxon_key"]), "s0", "s1") < 1.5 * max(400, right.count() / 16)
    pairs = layer.layer_tiles(None, tiles, extents=ext, heavy_rows=400)
    assert pairs.count() == pairs.distinct().count() and pairs.filter("z = 0").count() == 2003
    plain = layer.layer_tiles(None, tiles, extents=ext)
    assert pairs.exceptAll(plain).isEmpty() and plain.exceptAll(pairs).isEmpty()


def test_cells_heavy_by_pairs_are_salted():
    assert layer.cell_salts((1000, {1: 500, 2: 5}), (1000, {1: 400, 2: 5}), 10, heavy_rows=100) == {1: (5, 4)}
    assert layer.cell_salts((1000, {1: 90}), (1000, {1: 90}), 10, heavy_rows=1) == {1: (10, 1)}   # few rows, many pairs
    assert layer.cell_salts((9, {1: 9}), (0, {}), 4) == {}


def test_layer_bbox_optional_taxon(spark):
    species = spark.createDataFrame(
        [(1, 0, b"\x01", 5.5, 45.5, 5.6, 45.6), (2, 0, b"\x02", 9.0, 49.0, 9.5, 49.5),
         (3, 0, b"\x03", None, None, None, None)],
        "taxon_key long, part long, all_occurrence_coordinates binary, min_lon double, min_lat double, "
        "max_lon double, max_lat double")
    box = Box(5.0, 45.0, 6.0, 46.0)
    assert [r.taxon_key for r in layer.layer_bbox(species, box).collect()] == [1]
    assert layer.layer_bbox(species, box, taxon_key=2).count() == 0


def test_envelopes(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, -1.0)], "taxon_key long, decimal_longitude double, "
                               "decimal_latitude double")
    r = layer.species_envelopes(df).first()
    assert (r.min_lon, r.min_lat, r.max_lon, r.max_lat) == (1.0, -1.0, 3.0, 2.0)


def test_constraints_and_metrics(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert [(r.k, r.n) for r in constraints.duplicate_keys(df, "k").collect()] == [("a", 2)]
    v = constraints.key_violations(df, "k").first()
    assert (v.null_keys, v.duplicated_keys) == (1, 1)
    counts = {r.table_name: r.row_count for r in metrics.table_counts({"t": df, "u": df.limit(1)}).collect()}
    assert counts == {"t": 4, "u": 1}
    assert metrics.preview(spark.range(100), order_by="id").count() == 10
    observed, obs = metrics.observed(spark.range(42), "n")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["row_count"] == 42


def test_zorder_clustering_lets_box_queries_skip_row_groups(spark, workdir):
    """Species rows sorted by the envelope Z-order key: a small box can
    overlap few row groups (Parquet min/max statistics), key order cannot."""
    import glob
    import pyarrow.parquet as pq
    from occurrence_lake.operators.layer import envelope_zorder_sql
    sp = spark.range(0, 100_000, 1, 4).select(
        F.col("id").alias("taxon_key"), (F.rand(1) * 40 - 10).alias("cx"), (F.rand(2) * 30 + 35).alias("cy"),
        F.expr("repeat('x', 200)").cast("binary").alias("geom"))
    sp = sp.select("taxon_key", "geom", (F.col("cx") - 0.1).alias("min_lon"), (F.col("cy") - 0.1).alias("min_lat"),
                   (F.col("cx") + 0.1).alias("max_lon"), (F.col("cy") + 0.1).alias("max_lat"))
    box = Box(5.0, 45.0, 6.0, 46.0)

    def must_read(path):
        total = kept = 0
        for f in glob.glob(path + "/*.parquet"):
            md = pq.ParquetFile(f).metadata
            names = [md.schema.column(j).name for j in range(md.num_columns)]
            for i in range(md.num_row_groups):
                st = {names[j]: md.row_group(i).column(j).statistics for j in range(len(names))}
                total += 1
                kept += (st["min_lon"].min <= box.max_lon and st["max_lon"].max >= box.min_lon
                         and st["min_lat"].min <= box.max_lat and st["max_lat"].max >= box.min_lat)
        return kept / total

    fractions = {}
    for name, order in (("key", [F.col("taxon_key")]), ("z", [F.expr(envelope_zorder_sql()), F.col("taxon_key")])):
        path = f"{workdir}/{name}"
        sp.sortWithinPartitions(*order).write.option("parquet.block.size", str(256 * 1024)).parquet(path)
        fractions[name] = must_read(path)
    assert fractions["key"] > 0.9 and fractions["z"] < 0.4
