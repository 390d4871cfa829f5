"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's tables, with a DuckDB SQL twin (``ORACLE_SQL``) that computes the
same rows independently.

Binary WKB is returned as upper-case hex text on both sides so that values
hash equal.  The SQL twins inline the stand-in views as CTEs because only
the base tables are registered for DuckDB.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import scratch_path
from occurrence_lake.functions.geo import GRIDS, Box, parse_wkt_polygon, polygon_edges, tile_x, tile_y
from occurrence_lake.functions.wkb import multipoint_points, with_point_wkb, with_point_xy
from occurrence_lake.operators import constraints, layer, metrics, multipoint, names, quadtree, refine
from occurrence_lake.plans.assets import LazyAssets
from occurrence_lake.schema import MEASURES, RAW_NAMES, VERNACULAR_SCHEMA
from occurrence_lake.sinks.parquet import fill_declared, materialize, write_table, write_years
from occurrence_lake.sinks.upsert import KeyedTable
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.parquet import read_raw_years
from occurrence_lake.sources.replies import malformed_replies, parse_species_replies
from occurrence_lake.sources.tsv import read_occurrence_tsv, read_quoted_tsv, write_occurrence_tsv
from occurrence_lake.streaming.ingest import ServingIngest

# ---------------------------------------------------------------------------
# Query parameters (fixed values of the test queries)
# ---------------------------------------------------------------------------
LAYER_BOX = Box(5.0, 45.0, 6.0, 46.0)
LAYER_TAXON = 12
TILE_ZOOMS = [6, 9, 12]
# A concave polygon with a hole, inside the stand-in data's area.
POLYGON_WITH_HOLE = ("POLYGON((4.5 44.5, 8.0 44.6, 7.2 46.0, 6.0 45.2, 5.0 47.5, 4.5 44.5),"
                     "(5.3 45.0, 6.1 45.0, 5.9 45.3, 5.3 45.0))")
OVERWRITTEN_YEARS = [2016, 2017]
DUPLICATED_YEAR = 2020
UPSERT_FIRST_LAST_YEAR = 2020   # initial snapshot: years <= this
UPSERT_BATCH_FROM_YEAR = 2019   # batch: years >= this, depth set to 1
UPSERT_RESEND_YEAR = 2022       # re-sent later in the same batch with NULL elevation
STREAM_FIRST_DROP_LAST_YEAR = 2020
MANY_PARTS = 8
PART_POINTS = 6   # of the quadtree queries: most points of a part
QUERY_SLOTS = 8   # of the tables that the queries make
MERCATOR_ZOOMS = [2, 6, 9, 12]


def _outline_wkt(n: int) -> str:
    """A ragged outline of ``n`` vertices inside the stand-in's area."""
    ring = []
    for i in range(n):
        t = 2 * math.pi * i / n
        r = 1.0 + 0.3 * math.cos(5 * t) + 0.02 * (i * 7919 % 13) / 13
        ring.append((6.0 + 1.3 * r * math.cos(t), 45.8 + r * math.sin(t)))
    return "POLYGON((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"


POLYGON_OF_MANY_EDGES = _outline_wkt(2000)


def _assets(spark: SparkSession, sf_dir: str, parts: int = 1) -> LazyAssets:
    return LazyAssets(lambda: fixtures.raw_occurrences(spark, sf_dir),
                      lambda: fixtures.vernacular_records(spark, sf_dir), parts=parts)


def _points(species: DataFrame, geom: str) -> DataFrame:
    """The points of species' parts: taxon_key, lon, lat."""
    pts = species.select("taxon_key", F.explode(multipoint_points(geom)).alias("p"))
    return with_point_xy(pts, "p", "lon", "lat").select("taxon_key", "lon", "lat")


def _hex(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.hex(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# pipeline tables
# ---------------------------------------------------------------------------
def q_filtered_occurrences(spark, sf_dir):
    return _assets(spark, sf_dir)["filtered_occurrences"]


def q_geospatial_occurrences(spark, sf_dir):
    return _hex(_assets(spark, sf_dir)["geospatial_occurrences"], "coordinates")


def q_species_multipoint(spark, sf_dir):
    sp = _assets(spark, sf_dir)["species_all_occurrence"]
    return _hex(sp.select("taxon_key", "all_occurrence_coordinates", "n_points",
                          "min_lon", "min_lat", "max_lon", "max_lat"), "all_occurrence_coordinates")


def q_unique_taxon_keys(spark, sf_dir):
    return _assets(spark, sf_dir)["unique_taxon_keys"]


def q_scientific_names(spark, sf_dir):
    return _assets(spark, sf_dir)["scientific_names"]


def q_vernacular_names(spark, sf_dir):
    return _assets(spark, sf_dir)["vernacular_names"]


def q_species_names(spark, sf_dir):
    return _assets(spark, sf_dir)["species_names"]


def q_missing_vernacular(spark, sf_dir):
    return names.missing_vernacular(_assets(spark, sf_dir)["vernacular_names"])


def q_occurrences_serving(spark, sf_dir):
    return _hex(_assets(spark, sf_dir)["occurrences"], "coordinates")


def q_filtered_preview(spark, sf_dir):
    return metrics.preview(_assets(spark, sf_dir)["filtered_occurrences"], order_by="gbif_id")


def q_table_metrics(spark, sf_dir):
    """MET-1 as the runner takes it: every table is written once, counted
    while it is written, and the next ones are made from it; the counts come
    back as rows."""
    a = _assets(spark, sf_dir)
    base = scratch_path(spark, "table_metrics")
    counts = []
    for name in a.keys():
        counts.append((name, write_table(a[name], f"{base}/{name}", name)))
        a.stored(name, spark.read.parquet(f"{base}/{name}"))
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def q_table_previews(spark, sf_dir):
    """LIM-1 + MET-1: the key-ordered preview of the written filtered table,
    with its row count taken while writing."""
    path = scratch_path(spark, "table_previews")
    n = write_table(_assets(spark, sf_dir)["filtered_occurrences"], path, "filtered_occurrences")
    shown = metrics.preview(spark.read.parquet(path), order_by="gbif_id")
    return shown.select("gbif_id", "taxon_key", F.lit(n).cast("long").alias("row_count"))


def q_write_table(spark, sf_dir):
    """SNK-1: a whole table overwritten and read back."""
    path = scratch_path(spark, "write_table")
    f = _assets(spark, sf_dir)["filtered_occurrences"]
    write_table(f.limit(1), path, "first")
    write_table(f, path, "second", ["taxon_key"])
    return spark.read.parquet(path)


def q_materialize(spark, sf_dir):
    """SNK-4: a result as a named table, read by its name."""
    path = scratch_path(spark, "materialize")
    materialize(_assets(spark, sf_dir)["species_names"], "occlake_species_names", path)
    return spark.table("occlake_species_names")


def q_fill_declared(spark, sf_dir):
    """SNK-5: the vernacular names cast to their declared table, key checked."""
    return fill_declared(spark, _assets(spark, sf_dir)["vernacular_names"], VERNACULAR_SCHEMA, "taxon_key")


def q_malformed_replies(spark, sf_dir):
    """EXP-9: every whole reply is checked; every 7th key's have text behind
    them, which only a check that reads to the end finds."""
    replies = fixtures.species_replies_from_records(fixtures.vernacular_records(spark, sf_dir))
    return malformed_replies(replies.withColumn("body", fixtures.with_text_behind("taxon_key", "body")))


# ---------------------------------------------------------------------------
# acquisition
# ---------------------------------------------------------------------------
_ACQ_COLS = ["gbif_id", "taxon_key", "decimal_longitude", "decimal_latitude", "year"]


def q_acquire_rectangle(spark, sf_dir):
    return refine.acquire(fixtures.raw_occurrences(spark, sf_dir)).select(*_ACQ_COLS)


def q_acquire_polygon(spark, sf_dir):
    raw = fixtures.raw_occurrences(spark, sf_dir)
    return refine.acquire(raw, polygon_wkt=POLYGON_WITH_HOLE).select(*_ACQ_COLS)


def q_acquire_years(spark, sf_dir):
    return refine.acquire(fixtures.raw_occurrences(spark, sf_dir), years=[2016, 2021]).select(*_ACQ_COLS)


def q_acquire_polygon_many(spark, sf_dir):
    raw = fixtures.raw_occurrences(spark, sf_dir)
    return refine.acquire(raw, polygon_wkt=POLYGON_OF_MANY_EDGES).select(*_ACQ_COLS)


def q_acquire_areas(spark, sf_dir):
    """FLT-2 over a table of areas, each of two members, one with a hole."""
    raw = fixtures.raw_occurrences(spark, sf_dir).select(*_ACQ_COLS, "country_code", "kingdom")
    return refine.acquire_areas(raw, fixtures.acquisition_areas(spark, sf_dir), "area_id", "wkt").select("area_id", *_ACQ_COLS)


# ---------------------------------------------------------------------------
# map layer
# ---------------------------------------------------------------------------
def q_species_parts(spark, sf_dir):
    """Species split into parts hold the same points as unsplit ones."""
    return _points(_assets(spark, sf_dir, MANY_PARTS)["species_all_occurrence"], "all_occurrence_coordinates")


def q_layer_bbox_parts(spark, sf_dir):
    """The layer over split species returns whole species."""
    sp = _assets(spark, sf_dir, MANY_PARTS)["species_all_occurrence"]
    return _points(layer.layer_bbox(sp, LAYER_BOX), "geom")


def _place_species(spark, sf_dir) -> DataFrame:
    f = _assets(spark, sf_dir)["filtered_occurrences"].select("gbif_id", "taxon_key", "decimal_longitude", "decimal_latitude")
    points = with_point_wkb(quadtree.place_parts(f, PART_POINTS), "decimal_longitude", "decimal_latitude", "coordinates")
    return multipoint.species_all_occurrence(points, lon="decimal_longitude", lat="decimal_latitude", part_col="part")


def q_species_quadtree(spark, sf_dir):
    """Parts by place: which there are, and what each holds."""
    return _place_species(spark, sf_dir).select("taxon_key", "part", "n_points", "min_lon", "min_lat", "max_lon", "max_lat").where("n_points > 0")


def q_layer_bbox_quadtree(spark, sf_dir):
    """The layer's points over parts by place, without the parts elsewhere."""
    return _points(layer.layer_bbox(_place_species(spark, sf_dir), LAYER_BOX, whole=False), "geom")


def q_layer_bbox(spark, sf_dir):
    sp = _assets(spark, sf_dir)["species_all_occurrence"]
    return _hex(layer.layer_bbox(sp, LAYER_BOX), "geom")


def q_layer_bbox_species(spark, sf_dir):
    sp = _assets(spark, sf_dir)["species_all_occurrence"]
    return _hex(layer.layer_bbox(sp, LAYER_BOX, taxon_key=LAYER_TAXON), "geom")


def occupied_tiles(points: DataFrame, zooms=TILE_ZOOMS) -> DataFrame:
    """Tiles holding at least one sighting, at each zoom (the tiles a map
    would request)."""
    z = F.explode(F.array(*[F.lit(int(v)) for v in zooms])).alias("z")
    return (points.filter(F.col("decimal_longitude").isNotNull())
            .select(z, "decimal_longitude", "decimal_latitude")
            .select("z", tile_x("decimal_longitude", F.col("z")).alias("x"),
                    tile_y("decimal_latitude", F.col("z")).alias("y"))
            .distinct())


def q_layer_tiles(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return layer.layer_tiles(a["species_all_occurrence"], occupied_tiles(a["filtered_occurrences"]))


def q_layer_tiles_parts(spark, sf_dir):
    """Each (tile, species) pair once, however many parts a species has."""
    a = _assets(spark, sf_dir, MANY_PARTS)
    return layer.layer_tiles(a["species_all_occurrence"], occupied_tiles(a["filtered_occurrences"]))


def occupied_mercator_tiles(points: DataFrame, zooms=MERCATOR_ZOOMS) -> DataFrame:
    """Web Mercator tiles holding at least one sighting, at each zoom."""
    n = F.pow(F.lit(2.0), F.col("z").cast("double"))
    u, v = GRIDS["mercator"].to_unit(F.col("decimal_longitude"), F.col("decimal_latitude"))
    return (points.filter(F.col("decimal_longitude").isNotNull())
            .select(F.explode(F.array(*[F.lit(int(z)) for z in zooms])).alias("z"), "decimal_longitude", "decimal_latitude")
            .select("z", F.floor(u * n).alias("x"), F.floor(v * n).alias("y")).distinct())


def q_layer_tiles_mercator(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return layer.layer_tiles(a["species_all_occurrence"], occupied_mercator_tiles(a["filtered_occurrences"]), grid="mercator")


# ---------------------------------------------------------------------------
# WKB decode
# ---------------------------------------------------------------------------
def q_wkb_roundtrip(spark, sf_dir):
    # A point is NULL exactly when a coordinate is: filter on the inputs, so
    # the predicate is not pushed through (and inlined into) the encoding.
    f = _assets(spark, sf_dir)["filtered_occurrences"].filter(
        F.col("decimal_longitude").isNotNull() & F.col("decimal_latitude").isNotNull())
    geo = refine.geospatial_occurrences(f)
    return with_point_xy(geo.select("gbif_id", "coordinates"), "coordinates", "lon", "lat").select("gbif_id", "lon", "lat")


def q_multipoint_roundtrip(spark, sf_dir):
    return _points(_assets(spark, sf_dir)["species_all_occurrence"], "all_occurrence_coordinates")


# ---------------------------------------------------------------------------
# sinks and sources with a round trip through storage
# ---------------------------------------------------------------------------
def q_upsert_occurrences(spark, sf_dir):
    """The raw year is carried along to split the rows (a date may be NULL)."""
    a = _assets(spark, sf_dir)
    year = a["raw_occurrences"].select("gbif_id", F.col("year").alias("_year"))
    serving = a["occurrences"].join(year, "gbif_id")
    keep = a["occurrences"].columns
    snap = KeyedTable(spark, scratch_path(spark, "upsert_occurrences"), "gbif_id", slots=QUERY_SLOTS)
    snap.replace(serving.filter(F.col("_year") <= UPSERT_FIRST_LAST_YEAR).select(*keep))
    changed = (serving.filter(F.col("_year") >= UPSERT_BATCH_FROM_YEAR).select(*keep)
               .withColumn("depth", F.lit(1.0)).withColumn("seq", F.lit(1)))
    resent = (serving.filter(F.col("_year") == UPSERT_RESEND_YEAR).select(*keep)
              .withColumn("elevation", F.lit(None).cast("double")).withColumn("seq", F.lit(2)))
    result = snap.upsert(changed.unionByName(resent), order_by=["seq"], pick="last", drop=["seq"])
    return _hex(result, "coordinates")


def q_year_overwrite(spark, sf_dir):
    raw = fixtures.raw_occurrences(spark, sf_dir)
    root = scratch_path(spark, "year_overwrite")
    write_years(raw, root)
    write_years(raw.filter(F.col("year").isin(OVERWRITTEN_YEARS) & (F.col("kingdom") == "Animalia")), root)
    return read_raw_years(spark, root).select("gbif_id", "taxon_key", "kingdom", "year")


def q_tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tsv_roundtrip")
    write_occurrence_tsv(fixtures.raw_occurrences(spark, sf_dir), path)
    return read_occurrence_tsv(spark, path)


def q_tsv_quoted_breaks(spark, sf_dir):
    """SRC-1 with line breaks inside quoted fields."""
    path = scratch_path(spark, "tsv_quoted_breaks")
    raw = fixtures.raw_occurrences(spark, sf_dir)
    noted = F.expr("concat(locality, CASE WHEN year % 3 = 0 THEN '\n\nnote \"two\nlines\"' ELSE '' END)")
    write_occurrence_tsv(raw.withColumn("locality", noted), path)
    return read_quoted_tsv(spark, path)


def q_streaming_species(spark, sf_dir):
    """Extracts land in two drops; the stream keeps the serving tables
    current; the species table must equal the batch-built one."""
    raw = fixtures.raw_occurrences(spark, sf_dir)
    base = scratch_path(spark, "streaming_species")
    landing = f"{base}/landing"
    ingest = ServingIngest(spark, landing, f"{base}/serving", checkpoint=f"{base}/checkpoint", slots=QUERY_SLOTS)
    for i, drop in enumerate((F.col("year") <= STREAM_FIRST_DROP_LAST_YEAR, F.col("year") > STREAM_FIRST_DROP_LAST_YEAR)):
        write_occurrence_tsv(raw.filter(drop), f"{landing}/drop-{i}")
        ingest.run_available()
    sp = ingest.species.read()
    return _hex(sp.select(F.col("taxon_key").cast("long").alias("taxon_key"), "all_occurrence_coordinates",
                          "n_points", "min_lon", "min_lat", "max_lon", "max_lat"), "all_occurrence_coordinates")


def q_duplicate_keys(spark, sf_dir):
    raw = fixtures.raw_occurrences(spark, sf_dir)
    batch = raw.unionByName(raw.filter(F.col("year") == DUPLICATED_YEAR))
    return constraints.duplicate_keys(batch, "gbif_id")


def q_vernacular_from_json(spark, sf_dir):
    replies = fixtures.species_replies_from_records(fixtures.vernacular_records(spark, sf_dir))
    parsed = parse_species_replies(replies)
    return names.first_name_per_language(parsed, order_by=("page", "pos"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "species_multipoint": q_species_multipoint,
    "filtered_occurrences": q_filtered_occurrences,
    "geospatial_occurrences": q_geospatial_occurrences,
    "unique_taxon_keys": q_unique_taxon_keys,
    "scientific_names": q_scientific_names,
    "vernacular_names": q_vernacular_names,
    "species_names": q_species_names,
    "missing_vernacular": q_missing_vernacular,
    "occurrences_serving": q_occurrences_serving,
    "filtered_preview": q_filtered_preview,
    "table_metrics": q_table_metrics,
    "acquire_rectangle": q_acquire_rectangle,
    "acquire_polygon": q_acquire_polygon,
    "layer_bbox": q_layer_bbox,
    "layer_bbox_species": q_layer_bbox_species,
    "layer_tiles": q_layer_tiles,
    "wkb_roundtrip": q_wkb_roundtrip,
    "multipoint_roundtrip": q_multipoint_roundtrip,
    "upsert_occurrences": q_upsert_occurrences,
    "year_overwrite": q_year_overwrite,
    "tsv_roundtrip": q_tsv_roundtrip,
    "tsv_quoted_breaks": q_tsv_quoted_breaks,
    "streaming_species": q_streaming_species,
    "duplicate_keys": q_duplicate_keys,
    "vernacular_from_json": q_vernacular_from_json,
    "malformed_replies": q_malformed_replies,
    "acquire_years": q_acquire_years,
    "acquire_polygon_many": q_acquire_polygon_many,
    "acquire_areas": q_acquire_areas,
    "species_parts": q_species_parts,
    "layer_bbox_parts": q_layer_bbox_parts,
    "species_quadtree": q_species_quadtree,
    "layer_bbox_quadtree": q_layer_bbox_quadtree,
    "layer_tiles_parts": q_layer_tiles_parts,
    "layer_tiles_mercator": q_layer_tiles_mercator,
    "table_previews": q_table_previews,
    "write_table": q_write_table,
    "materialize": q_materialize,
    "fill_declared": q_fill_declared,
}


# ===========================================================================
# DuckDB twins
# ===========================================================================
_OCC = """occ AS (
  SELECT CAST(event_id AS VARCHAR) AS gbif_id,
    user_id AS taxon_key,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'species ' || CAST(user_id AS VARCHAR) END AS species,
    CASE event_type WHEN 'view' THEN 'Aves' WHEN 'click' THEN 'Mammalia' WHEN 'signup' THEN 'Insecta'
      WHEN 'error' THEN NULL ELSE 'Reptilia' END AS "class",
    CASE WHEN event_id % 10 = 0 THEN 'Plantae' ELSE 'Animalia' END AS kingdom,
    CASE WHEN event_id % 9 = 0 THEN 'IT' ELSE 'FR' END AS country_code,
    'Genus ' || CAST(user_id AS VARCHAR) || CASE WHEN event_type = 'signup' THEN ' var. rara'
      WHEN event_id % 2 = 0 THEN ' minor' ELSE '' END AS scientific_name,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE 4e0 + (user_id % 40) / 1e1 + (event_id % 101) / 1e3 END AS decimal_longitude,
    44e0 + (user_id % 35) / 1e1 + (event_id % 103) / 1e3 AS decimal_latitude,
    CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE value END AS elevation,
    CASE WHEN event_id % 4 = 0 THEN 0e0 ELSE (event_id % 50) * 1e1 END AS coordinate_uncertainty_in_meters,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE 1e-3 END AS coordinate_precision,
    CASE WHEN event_id % 8 = 0 THEN 0e0 ELSE value / 1e1 END AS elevation_accuracy,
    CASE WHEN event_id % 3 = 0 THEN 0e0 ELSE CAST(event_id % 20 AS DOUBLE) END AS depth,
    CAST(NULL AS DOUBLE) AS depth_accuracy,
    'Col "' || event_type || '" ' || CAST(user_id % 7 AS VARCHAR) AS locality,
    2014 + event_id % 13 AS "year",
    CAST(month(ts) AS BIGINT) AS "month",
    CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE day(ts) END AS BIGINT) AS "day"
  FROM events)"""

_VN = """vn AS (
  SELECT 3 * (doc_id % 160) AS taxon_key, doc_id AS seq,
    CASE lang WHEN 'de' THEN 'deu' WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' ELSE 'spa' END AS language,
    CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS name
  FROM documents)"""

_MEAS = ", ".join(MEASURES)

_FILTERED = f"""filtered AS (
  SELECT gbif_id, taxon_key, decimal_latitude, decimal_longitude, {_MEAS},
    make_date("year", "month", "day") AS "date"
  FROM occ WHERE species IS NOT NULL AND ("class" = 'Mammalia' OR "class" = 'Aves'))"""


def _point_hex(lon: str, lat: str) -> str:
    return f"hex(st_aswkb(('POINT(' || {lon} || ' ' || {lat} || ')')::GEOMETRY)::BLOB)"


_GEO = f"""geo AS (
  SELECT gbif_id, taxon_key, {_point_hex('decimal_longitude', 'decimal_latitude')} AS coordinates,
    {_MEAS}, "date", decimal_longitude AS lon, decimal_latitude AS lat
  FROM filtered)"""

_SPECIES = """species AS (
  SELECT taxon_key,
    hex(st_aswkb((CASE WHEN count(coordinates) = 0 THEN 'MULTIPOINT EMPTY'
      ELSE 'MULTIPOINT(' || string_agg(lon || ' ' || lat, ', ' ORDER BY coordinates)
        FILTER (WHERE coordinates IS NOT NULL) || ')' END)::GEOMETRY)::BLOB) AS all_occurrence_coordinates,
    count(coordinates) AS n_points,
    min(lon) FILTER (WHERE coordinates IS NOT NULL) AS min_lon,
    min(lat) FILTER (WHERE coordinates IS NOT NULL) AS min_lat,
    max(lon) FILTER (WHERE coordinates IS NOT NULL) AS max_lon,
    max(lat) FILTER (WHERE coordinates IS NOT NULL) AS max_lat
  FROM geo GROUP BY taxon_key)"""

_KEYS = "keys AS (SELECT DISTINCT taxon_key FROM filtered)"

_VERN = """vern AS (
  SELECT CAST(k.taxon_key AS INTEGER) AS taxon_key,
    arg_min(vn.name, vn.seq) FILTER (WHERE vn.language = 'deu' AND vn.name IS NOT NULL) AS vernacular_name_deu,
    arg_min(vn.name, vn.seq) FILTER (WHERE vn.language = 'eng' AND vn.name IS NOT NULL) AS vernacular_name_eng,
    arg_min(vn.name, vn.seq) FILTER (WHERE vn.language = 'fra' AND vn.name IS NOT NULL) AS vernacular_name_fra
  FROM keys k LEFT JOIN vn ON vn.taxon_key = k.taxon_key GROUP BY k.taxon_key)"""

_SCI = """sci AS (
  SELECT DISTINCT k.taxon_key, r.scientific_name FROM keys k JOIN occ r ON r.taxon_key = k.taxon_key)"""

_SERVING = f"""serving AS (
  SELECT gbif_id, CAST(taxon_key AS INTEGER) AS taxon_key, coordinates,
    {", ".join(f"nullif({m}, 0e0) AS {m}" for m in MEASURES)}, "date"
  FROM geo)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _acq_sql(extra_where: str = "", years=refine.YEARS) -> str:
    years = ", ".join(str(y) for y in years)
    return (f"SELECT gbif_id, taxon_key, decimal_longitude, decimal_latitude, \"year\" FROM occ "
            f"WHERE country_code = 'FR' AND kingdom = 'Animalia' AND \"year\" IN ({years}) {extra_where}")


def _polygon_sql(wkt: str) -> str:
    rings = parse_wkt_polygon(wkt)
    rows = ", ".join(f"({xi!r}, {yi!r}, {yj!r}, {dx!r}, {dy!r})" for xi, yi, xj, yj, dx, dy in polygon_edges(rings))
    years = ", ".join(str(y) for y in refine.YEARS)
    return _with(_OCC, f"edges(xi, yi, yj, dx, dy) AS (VALUES {rows})") + f"""
SELECT c.gbif_id, c.taxon_key, c.decimal_longitude, c.decimal_latitude, c."year"
FROM occ c JOIN edges e
  ON (c.decimal_latitude < e.yi) <> (c.decimal_latitude < e.yj)
 AND c.decimal_longitude < e.dx * (c.decimal_latitude - e.yi) / e.dy + e.xi
WHERE c.country_code = 'FR' AND c.kingdom = 'Animalia' AND c."year" IN ({years})
GROUP BY c.gbif_id, c.taxon_key, c.decimal_longitude, c.decimal_latitude, c."year"
HAVING count(*) % 2 = 1"""


def _areas_sql() -> str:
    sides = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for m in fixtures.AREA_MEMBERS for ring in m for a, b in zip(ring[:-1], ring[1:]))
    years = ", ".join(str(y) for y in refine.YEARS)
    placed = ", ".join(f"{v} AS {k}" for k, v in fixtures.AREA_SQL.items())
    return _with(_OCC, f"sides(from_x, from_y, to_x, to_y) AS (VALUES {sides})", f"placed AS (SELECT s_suppkey AS area_id, {placed} FROM supplier)", """edges AS (
  SELECT area_id, (cx + from_x * scale) / 1e3 AS xi, (cy + from_y * scale) / 1e3 AS yi, (cx + to_x * scale) / 1e3 AS xj, (cy + to_y * scale) / 1e3 AS yj
  FROM placed, sides)""") + f"""
SELECT e.area_id, c.gbif_id, c.taxon_key, c.decimal_longitude, c.decimal_latitude, c."year"
FROM occ c JOIN edges e
  ON (c.decimal_latitude < e.yi) <> (c.decimal_latitude < e.yj)
 AND c.decimal_longitude < (e.xj - e.xi) * (c.decimal_latitude - e.yi) / (e.yj - e.yi) + e.xi
WHERE c.country_code = 'FR' AND c.kingdom = 'Animalia' AND c."year" IN ({years})
GROUP BY e.area_id, c.gbif_id, c.taxon_key, c.decimal_longitude, c.decimal_latitude, c."year"
HAVING count(*) % 2 = 1"""


def _box_sql(box: Box) -> str:
    return (f"'POLYGON(({box.min_lon} {box.min_lat}, {box.max_lon} {box.min_lat}, {box.max_lon} {box.max_lat}, "
            f"{box.min_lon} {box.max_lat}, {box.min_lon} {box.min_lat}))'::GEOMETRY")


def _layer_bbox_sql(box: Box, taxon: int | None) -> str:
    extra = f" AND s.taxon_key = {int(taxon)}" if taxon is not None else ""
    # The overlap test is DuckDB's own extent intersection (&&) on the
    # species' MultiPoint, not our envelope columns.
    return _with(_OCC, _FILTERED, _GEO, _SPECIES) + f"""
SELECT s.taxon_key, s.all_occurrence_coordinates AS geom FROM species s
WHERE st_intersects_extent(st_geomfromwkb(unhex(s.all_occurrence_coordinates)),
  {_box_sql(box)}){extra}"""


def _tiles_sql() -> str:
    zooms = ", ".join(f"({z})" for z in TILE_ZOOMS)
    return _with(_OCC, _FILTERED, _GEO, _SPECIES, f"zz(z) AS (VALUES {zooms})", """tiles AS (
  SELECT DISTINCT zz.z, CAST(floor((f.decimal_longitude + 180e0) / (180e0 / pow(2e0, zz.z))) AS BIGINT) AS x,
    CAST(floor((90e0 - f.decimal_latitude) / (180e0 / pow(2e0, zz.z))) AS BIGINT) AS y
  FROM filtered f, zz WHERE f.decimal_longitude IS NOT NULL)""") + """
SELECT t.z, t.x, t.y, s.taxon_key FROM tiles t JOIN species s
  ON s.min_lon <= (t.x + 1) * (180e0 / pow(2e0, t.z)) - 180e0
 AND s.max_lon >= t.x * (180e0 / pow(2e0, t.z)) - 180e0
 AND s.min_lat <= 90e0 - t.y * (180e0 / pow(2e0, t.z))
 AND s.max_lat >= 90e0 - (t.y + 1) * (180e0 / pow(2e0, t.z))"""


def _mercator_sql() -> str:
    zooms = ", ".join(f"({z})" for z in MERCATOR_ZOOMS)
    lat = lambda row: f"degrees(atan(sinh(pi() * (1e0 - 2e0 * ({row}) / pow(2e0, t.z)))))"
    lon = lambda col: f"({col}) / pow(2e0, t.z) * 360e0 - 180e0"
    return _with(_OCC, _FILTERED, _GEO, _SPECIES, f"zz(z) AS (VALUES {zooms})", """tiles AS (
  SELECT DISTINCT zz.z, CAST(floor((f.decimal_longitude + 180e0) / 360e0 * pow(2e0, zz.z)) AS BIGINT) AS x,
    CAST(floor((1e0 - asinh(tan(radians(f.decimal_latitude))) / pi()) / 2e0 * pow(2e0, zz.z)) AS BIGINT) AS y
  FROM filtered f, zz WHERE f.decimal_longitude IS NOT NULL)""") + f"""
SELECT t.z, t.x, t.y, s.taxon_key FROM tiles t JOIN species s
  ON s.min_lon <= {lon("t.x + 1")} AND s.max_lon >= {lon("t.x")}
 AND s.min_lat <= {lat("t.y")} AND s.max_lat >= {lat("t.y + 1")}"""


def _upsert_sql() -> str:
    return _with(_OCC, _FILTERED, _GEO, _SERVING) + f"""
SELECT s.gbif_id, s.taxon_key, s.coordinates, s.coordinate_uncertainty_in_meters, s.coordinate_precision,
  CASE WHEN o."year" = {UPSERT_RESEND_YEAR} THEN NULL ELSE s.elevation END AS elevation,
  s.elevation_accuracy,
  CASE WHEN o."year" >= {UPSERT_BATCH_FROM_YEAR} AND o."year" <> {UPSERT_RESEND_YEAR} THEN 1e0
       ELSE s.depth END AS depth,
  s.depth_accuracy, s."date"
FROM serving s JOIN occ o USING (gbif_id)"""


def _vernacular_json_sql() -> str:
    cols = ",\n  ".join(f"arg_min(name, seq) FILTER (WHERE language = '{lang}' AND name IS NOT NULL) AS vernacular_name_{lang}"
                        for lang in ("deu", "eng", "fra"))
    return _with(_VN) + f"SELECT taxon_key,\n  {cols}\nFROM vn GROUP BY taxon_key"


_ALL_TABLES = {
    "raw_occurrences": "occ",
    "filtered_occurrences": "filtered",
    "geospatial_occurrences": "geo",
    "unique_taxon_keys": "keys",
    "vernacular_names": "vern",
    "scientific_names": "sci",
    "species_all_occurrence": "species",
    "species_names": "vern v JOIN sci s ON s.taxon_key = v.taxon_key",
    "occurrences": "serving",
}

_NAME_COLS = "vernacular_name_deu, vernacular_name_eng, vernacular_name_fra"

_QUADTREE = f"""placed AS (
  SELECT gbif_id, taxon_key, decimal_longitude AS lon, decimal_latitude AS lat,
    least(greatest(CAST(floor((decimal_longitude + 180e0) / 360e0 * 65536e0) AS BIGINT), 0), 65535) AS cx,
    least(greatest(CAST(floor((decimal_latitude + 90e0) / 180e0 * 65536e0) AS BIGINT), 0), 65535) AS cy
  FROM filtered WHERE decimal_longitude IS NOT NULL AND decimal_latitude IS NOT NULL),
full_cells AS (
  SELECT taxon_key, CAST(lv AS INTEGER) AS lv, cx >> CAST(16 - lv AS INTEGER) AS x, cy >> CAST(16 - lv AS INTEGER) AS y
  FROM placed, range(0, 17) r(lv) GROUP BY ALL HAVING count(*) > {PART_POINTS}),
own AS (
  SELECT p.gbif_id, p.taxon_key, p.lon, p.lat, p.cx, p.cy, CAST(coalesce(max(c.lv), -1) + 1 AS INTEGER) AS lv
  FROM placed p LEFT JOIN full_cells c ON c.taxon_key = p.taxon_key AND c.x = p.cx >> (16 - c.lv) AND c.y = p.cy >> (16 - c.lv) GROUP BY ALL),
parted AS (
  SELECT *, CAST((1::BIGINT << (2 * lv)) + coalesce(list_sum(list_transform(range(0, lv), lambda i:
    ((((cx >> (16 - lv)) >> CAST(i AS INTEGER)) & 1) << CAST(2 * i AS INTEGER)) + ((((cy >> (16 - lv)) >> CAST(i AS INTEGER)) & 1) << CAST(2 * i + 1 AS INTEGER)))), 0) AS BIGINT) AS part
  FROM own),
place_parts AS (
  SELECT taxon_key, part, count(*) AS n_points, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat
  FROM parted GROUP BY taxon_key, part)"""

ORACLE_SQL: dict[str, str] = {
    "species_quadtree": _with(_OCC, _FILTERED, _QUADTREE) + "SELECT * FROM place_parts",
    "layer_bbox_quadtree": _with(_OCC, _FILTERED, _QUADTREE) + f"""
SELECT p.taxon_key, p.lon, p.lat FROM parted p JOIN place_parts s USING (taxon_key, part)
WHERE s.min_lon <= {LAYER_BOX.max_lon} AND s.max_lon >= {LAYER_BOX.min_lon} AND s.min_lat <= {LAYER_BOX.max_lat} AND s.max_lat >= {LAYER_BOX.min_lat}""",
    "species_multipoint": _with(_OCC, _FILTERED, _GEO, _SPECIES) + "SELECT * FROM species",
    "streaming_species": _with(_OCC, _FILTERED, _GEO, _SPECIES) + "SELECT * FROM species",
    "filtered_occurrences": _with(_OCC, _FILTERED) + "SELECT * FROM filtered",
    "geospatial_occurrences": _with(_OCC, _FILTERED, _GEO)
        + f'SELECT gbif_id, taxon_key, coordinates, {_MEAS}, "date" FROM geo',
    "unique_taxon_keys": _with(_OCC, _FILTERED, _KEYS) + "SELECT * FROM keys",
    "scientific_names": _with(_OCC, _FILTERED, _KEYS, _SCI) + "SELECT * FROM sci",
    "vernacular_names": _with(_OCC, _FILTERED, _KEYS, _VN, _VERN) + "SELECT * FROM vern",
    "species_names": _with(_OCC, _FILTERED, _KEYS, _VN, _VERN, _SCI)
        + f"SELECT CAST(s.taxon_key AS INTEGER) AS taxon_key, s.scientific_name, {_NAME_COLS} "
          "FROM sci s JOIN vern v ON v.taxon_key = s.taxon_key",
    "missing_vernacular": _with(_OCC, _FILTERED, _KEYS, _VN, _VERN)
        + "SELECT count(*) FILTER (WHERE vernacular_name_deu IS NULL AND vernacular_name_eng IS NULL "
          "AND vernacular_name_fra IS NULL) AS missing_vernacular, count(*) AS species FROM vern",
    "occurrences_serving": _with(_OCC, _FILTERED, _GEO, _SERVING) + "SELECT * FROM serving",
    "filtered_preview": _with(_OCC, _FILTERED) + "SELECT * FROM filtered ORDER BY gbif_id LIMIT 10",
    "table_metrics": _with(_OCC, _FILTERED, _GEO, _SPECIES, _KEYS, _VN, _VERN, _SCI, _SERVING)
        + "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {src}"
                               for name, src in _ALL_TABLES.items()),
    "acquire_rectangle": _with(_OCC) + _acq_sql(
        "AND decimal_longitude BETWEEN 4.63127 AND 7.5505 AND decimal_latitude BETWEEN 44.84424 AND 46.81983"),
    "acquire_polygon": _polygon_sql(POLYGON_WITH_HOLE),
    "acquire_polygon_many": _polygon_sql(POLYGON_OF_MANY_EDGES),
    "acquire_areas": _areas_sql(),
    "acquire_years": _with(_OCC) + _acq_sql(
        "AND decimal_longitude BETWEEN 4.63127 AND 7.5505 AND decimal_latitude BETWEEN 44.84424 AND 46.81983", [2016, 2021]),
    "layer_bbox": _layer_bbox_sql(LAYER_BOX, None),
    "layer_bbox_species": _layer_bbox_sql(LAYER_BOX, LAYER_TAXON),
    "layer_tiles": _tiles_sql(),
    "layer_tiles_parts": _tiles_sql(),
    "layer_tiles_mercator": _mercator_sql(),
    "layer_bbox_parts": _with(_OCC, _FILTERED, _GEO, _SPECIES) + f"""
SELECT g.taxon_key, g.lon, g.lat FROM geo g SEMI JOIN (SELECT s.taxon_key FROM species s
WHERE st_intersects_extent(st_geomfromwkb(unhex(s.all_occurrence_coordinates)), {_box_sql(LAYER_BOX)})) k USING (taxon_key)
WHERE g.coordinates IS NOT NULL""",
    "species_parts": _with(_OCC, _FILTERED)
        + "SELECT taxon_key, decimal_longitude AS lon, decimal_latitude AS lat FROM filtered "
          "WHERE decimal_longitude IS NOT NULL",
    "write_table": _with(_OCC, _FILTERED) + "SELECT * FROM filtered",
    "table_previews": _with(_OCC, _FILTERED) + "SELECT gbif_id, taxon_key, (SELECT count(*) FROM filtered) AS row_count "
        "FROM filtered ORDER BY gbif_id LIMIT 10",
    "fill_declared": _with(_OCC, _FILTERED, _KEYS, _VN, _VERN) + "SELECT * FROM vern",
    "malformed_replies": _with(_VN) + f"SELECT count(*) AS replies, count(*) FILTER (taxon_key % 7 = 0) AS malformed FROM "
        f"(SELECT DISTINCT taxon_key, floor(seq / {fixtures.REPLY_PAGE_SIZE}) AS page FROM vn)",
    "wkb_roundtrip": _with(_OCC, _FILTERED)
        + "SELECT gbif_id, decimal_longitude AS lon, decimal_latitude AS lat FROM filtered "
          "WHERE decimal_longitude IS NOT NULL",
    "multipoint_roundtrip": _with(_OCC, _FILTERED)
        + "SELECT taxon_key, decimal_longitude AS lon, decimal_latitude AS lat FROM filtered "
          "WHERE decimal_longitude IS NOT NULL",
    "upsert_occurrences": _upsert_sql(),
    "year_overwrite": _with(_OCC) + "SELECT gbif_id, taxon_key, kingdom, \"year\" FROM occ WHERE "
        f"\"year\" NOT IN ({', '.join(str(y) for y in OVERWRITTEN_YEARS)}) OR kingdom = 'Animalia'",
    "tsv_roundtrip": _with(_OCC) + "SELECT " + ", ".join(
        f'"{c}"' if c in fixtures.RAW_STAND_IN_SQL else f'NULL AS "{c}"' for c in RAW_NAMES) + " FROM occ",
    "duplicate_keys": _with(_OCC) + "SELECT gbif_id, count(*) AS n FROM (SELECT gbif_id FROM occ UNION ALL "
        f"SELECT gbif_id FROM occ WHERE \"year\" = {DUPLICATED_YEAR}) GROUP BY gbif_id HAVING count(*) > 1",
    "vernacular_from_json": _vernacular_json_sql(),
}
ORACLE_SQL["tsv_quoted_breaks"] = ORACLE_SQL["tsv_roundtrip"].replace(
    '"locality"', """locality || CASE WHEN "year" % 3 = 0 THEN chr(10) || chr(10) || 'note "two' || chr(10) || 'lines"' ELSE '' END AS "locality\"""")
ORACLE_SQL["materialize"] = ORACLE_SQL["species_names"]
