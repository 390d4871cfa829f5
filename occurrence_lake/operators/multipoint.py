"""AGG-3/4/5: every sighting of a species as one WKB MultiPoint.

A species is a group, and one group could hold a third of all rows.
``parts`` (chosen by the caller, the same for every species and every size
of the data) splits each species by a hash of the occurrence id into at most
that many rows ``(key, part)``; the union of a species' parts is always the
whole set of its points.  ``parts=1`` gives one row per species,
byte-identical to ``ST_Collect``; a MultiPoint past Spark's 2 GB value limit
then fails with Spark's error instead of changing its key.

Plan: a single shuffle on (key, part) with a partial ``listagg``.  The
envelope of a species is an aggregate of its parts' (``species_extents``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.functions.wkb import collect_points_sql, multipoint_wkb, with_point_xy
from occurrence_lake.schema import SRID

EXTENT = ["min_lon", "min_lat", "max_lon", "max_lat"]


def part_of(id_col: str, geom: str, parts: int):
    """The part of a sighting; sightings without a point are in part 0."""
    if parts < 1:
        raise ValueError(f"parts must be at least 1, not {parts}")
    return F.when(F.col(geom).isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(F.col(id_col)), F.lit(int(parts)).cast("long")))


def species_all_occurrence(points: DataFrame, key: str = "taxon_key", geom: str = "coordinates",
                           id_col: str = "gbif_id", lon: str | None = None, lat: str | None = None,
                           parts: int = 1, part_col: str | None = None, out: str = "all_occurrence_coordinates") -> DataFrame:
    """``(key, part, n_points, <out> MultiPoint WKB, min/max lon/lat)``.

    Points are ordered by their WKB bytes inside a MultiPoint (the reference
    leaves the order unspecified).  NULL points are skipped; a part whose
    points are all NULL gets the empty MultiPoint and a NULL envelope.  The
    envelope comes from ``lon``/``lat`` when given, else from the WKB.  With
    ``part_col`` the parts are those that the points name.
    """
    part = F.col(part_col) if part_col else part_of(id_col, geom, parts)
    points = points.withColumn("_part", part)
    if lon and lat:
        pts = points.select(key, "_part", geom, F.col(lon).alias("_x"), F.col(lat).alias("_y"))
    else:
        pts = with_point_xy(points.select(key, "_part", geom), geom, "_x", "_y")
    present = F.col(geom).isNotNull()
    pts = pts.select(key, geom, F.col("_part").alias("part"), F.when(present, F.col("_x")).alias("_x"),
                     F.when(present, F.col("_y")).alias("_y"))
    agg = pts.groupBy(key, "part").agg(
        F.count(geom).alias("n_points"),
        collect_points_sql(geom).alias("_body"),
        F.min("_x").alias("min_lon"), F.min("_y").alias("min_lat"),
        F.max("_x").alias("max_lon"), F.max("_y").alias("max_lat"),
    )
    meta = {"encoding": "WKB", "geometry_type": "MultiPoint", "srid": SRID}
    return agg.select(key, "part", "n_points", multipoint_wkb("n_points", "_body").alias(out, metadata=meta), *EXTENT)


def species_extents(species: DataFrame, key: str = "taxon_key") -> DataFrame:
    """One envelope per species, from the envelopes of its parts."""
    return species.groupBy(key).agg(F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
                                    F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"))
