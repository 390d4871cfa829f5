"""Parts by place: bounded parts, the same points, boxes that read only
their parts."""

import contextlib
import io

import numpy as np
from pyspark.sql import functions as F

from occurrence_lake.functions.geo import Box
from occurrence_lake.functions.wkb import with_point_wkb
from occurrence_lake.operators import layer, multipoint, quadtree
from occurrence_lake.plans.assets import run
from occurrence_lake.sinks.parquet import write_years
from occurrence_lake.sources import fixtures
from occurrence_lake.streaming.ingest import serving_tables

from conftest import SF_SMALL

SCHEMA = "gbif_id string, taxon_key long, decimal_longitude double, decimal_latitude double"


def _points(spark):
    rnd = np.random.default_rng(2)
    rows = [(f"a{i}", 1, 5 + float(rnd.normal()) / 50, 45 + float(rnd.normal()) / 50) for i in range(3000)]     # a hot species
    rows += [(f"b{i}", 2, 6.5, 45.5) for i in range(500)]                                                       # all at one place
    rows += [(f"c{i}", 3, float(rnd.uniform(-180, 180)), float(rnd.uniform(-90, 90))) for i in range(30)]       # small
    rows += [("n", 1, None, 45.0), ("e0", 4, -180.0, -90.0), ("e1", 4, 180.0, 90.0), ("z", None, 1.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_parts_are_bounded_and_lose_nothing(spark):
    points = _points(spark)
    placed = quadtree.place_parts(points, 40)
    assert placed.columns == [*points.columns, "part"]
    assert sorted(map(tuple, placed.drop("part").collect()), key=repr) == sorted(map(tuple, points.collect()), key=repr)
    sizes = {(r.taxon_key, r.part): r["count"] for r in placed.groupBy("taxon_key", "part").count().collect()}
    assert max(sizes.values()) <= 40
    assert [k for k in sizes if k[0] in (3, 4, None)] == sorted([(3, 1), (4, 1), (None, 1)], key=lambda k: [x[0] for x in sizes].index(k[0]))
    assert sizes[1, 0] == 1                                       # the sighting without a place
    assert 3000 / 40 <= sum(k[0] == 1 for k in sizes) <= 4 * 3000 / 40 and sum(k[0] == 2 for k in sizes) >= 13
    assert placed.where("taxon_key = 2").select("part").distinct().count() == sum(k[0] == 2 for k in sizes)


def test_nothing_to_split(spark):
    points = _points(spark)
    assert {r.part for r in quadtree.place_parts(points, 10_000).select("part").distinct().collect()} == {0, 1}
    assert quadtree.place_parts(points.limit(0), 5).count() == 0


def test_a_box_reads_the_parts_it_meets(spark, workdir):
    placed = quadtree.place_parts(_points(spark), 40)
    species = multipoint.species_all_occurrence(with_point_wkb(placed, "decimal_longitude", "decimal_latitude", "coordinates"), part_col="part")
    species.write.parquet(f"{workdir}/species")
    stored = spark.read.parquet(f"{workdir}/species")
    box = Box(4.99, 44.99, 5.0, 45.0)
    some, whole = layer.layer_bbox(stored, box, 1, whole=False), layer.layer_bbox(stored, box, 1)
    assert 0 < some.count() < whole.count() / 4
    assert whole.count() == stored.where("taxon_key = 1").count()
    inside = placed.where("taxon_key = 1 AND decimal_longitude BETWEEN 4.99 AND 5.0 AND decimal_latitude BETWEEN 44.99 AND 45.0").select("part").distinct()
    met = stored.where("taxon_key = 1 AND min_lon <= 5.0 AND max_lon >= 4.99 AND min_lat <= 45.0 AND max_lat >= 44.99")
    assert inside.join(met, "part", "left_anti").count() == 0
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        some.explain("formatted")
    assert "LessThanOrEqual(min_lon,5.0)" in text.getvalue() and "Join" not in text.getvalue()


def test_run_with_parts_by_place(spark, workdir):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    write_years(raw, f"{workdir}/raw")
    report = run(spark, f"{workdir}/raw", fixtures.vernacular_records(spark, SF_SMALL), f"{workdir}/out", f"{workdir}/serving", part_points=2)
    occurrences, species = serving_tables(spark, f"{workdir}/serving")
    assert occurrences.read().count() == report.row_counts["filtered_occurrences"]
    parts = species.read()
    assert parts.agg(F.max("n_points")).first()[0] <= 2 and parts.count() == report.row_counts["species_all_occurrence"]
    assert parts.join(occurrences.read(), ["taxon_key", "part"], "left_anti").count() == 0
    assert parts.agg(F.sum("n_points")).first()[0] == occurrences.read().where("coordinates IS NOT NULL").count()
