"""Acquisition and refinement of raw occurrences (FLT-1..4, EXP-1/3/4/7/8, AGG-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.functions.geo import inside_geometry
from occurrence_lake.functions.scalars import make_date_strict, narrow_to_int, zero_as_null
from occurrence_lake.functions.wkb import typed_geometry, with_point_wkb
from occurrence_lake.operators.areas import within_areas
from occurrence_lake.schema import MEASURES

# ---------------------------------------------------------------------------
# The acquisition predicate of the reference pipeline
# (country, area, kingdom, yearly partitions).  GBIF kingdom key 1 is the
# kingdom "Animalia"; the extract carries the name, not the key.
# ---------------------------------------------------------------------------
ACQUISITION_COUNTRY = "FR"
ACQUISITION_POLYGON = "POLYGON((4.63127 44.84424,7.5505 44.84424,7.5505 46.81983,4.63127 46.81983,4.63127 44.84424))"
ACQUISITION_KINGDOM = "Animalia"
YEARS = [2015, 2016, 2017, 2018, 2019, 2020, 2021, 2022, 2023, 2024, 2025]

# Taxonomic filter: species known, class one of these.
KEPT_CLASSES = ["Mammalia", "Aves"]


def _asked(country: str, kingdom: str, years) -> Column:
    return ((F.col("country_code") == country)
            & (F.col("kingdom") == kingdom)
            & F.col("year").isin([int(y) for y in years]))


def acquire(raw: DataFrame, country: str = ACQUISITION_COUNTRY, polygon_wkt: str = ACQUISITION_POLYGON,
            kingdom: str = ACQUISITION_KINGDOM, years=YEARS) -> DataFrame:
    """FLT-1 (+ FLT-2, FLT-4): the download predicate as a filter.

    Every conjunct is a column comparison, so all of them reach the Parquet
    scan as pushed filters, and ``year`` prunes partitions when it is the
    partition column.  A non-rectangular polygon adds a crossing count
    after the bounding-box prefilter.
    """
    return raw.filter(_asked(country, kingdom, years) & inside_geometry("decimal_longitude", "decimal_latitude", polygon_wkt))


def acquire_areas(raw: DataFrame, areas: DataFrame, area_id: str, wkt: str, country: str = ACQUISITION_COUNTRY,
                  kingdom: str = ACQUISITION_KINGDOM, years=YEARS) -> DataFrame:
    """FLT-1 with a table of areas for FLT-2: a row per occurrence and area
    that holds it, with the area's id."""
    return within_areas(raw.filter(_asked(country, kingdom, years)), areas, "decimal_longitude", "decimal_latitude", area_id, wkt)


def filtered_occurrences(raw: DataFrame, carry=(), strict_dates: bool = True) -> DataFrame:
    """FLT-3 + EXP-1 + EXP-3: kept taxa, the measures, and a date from parts.

    The predicate (``IsNotNull(species)``, ``class IN (...)``) is pushed
    into the scan and only the 12 columns below are read.  A NULL class is
    dropped (a NULL comparison is not true).  An impossible date aborts
    unless ``strict_dates`` is off; then it is NULL.
    """
    kept = raw.filter(F.col("species").isNotNull() & F.col("class").isin(KEPT_CLASSES))
    return kept.select(
        "gbif_id", "taxon_key", "decimal_latitude", "decimal_longitude", *MEASURES,
        make_date_strict("year", "month", "day", strict_dates).alias("date"), *carry,
    )


def geospatial_occurrences(filtered: DataFrame, carry=()) -> DataFrame:
    """EXP-4: latitude/longitude replaced by a WKB Point (x = longitude)."""
    points = with_point_wkb(filtered, "decimal_longitude", "decimal_latitude", "coordinates")
    return points.select("gbif_id", "taxon_key", "coordinates", *MEASURES, "date", *carry)


def unique_taxon_keys(filtered: DataFrame) -> DataFrame:
    """AGG-1: distinct keys (NULL is one group).  Partial aggregation on the
    map side collapses a hot key before the shuffle."""
    return filtered.select("taxon_key").distinct()


def serving_occurrences(geospatial: DataFrame, carry=(), zeros_as_null: bool = True) -> DataFrame:
    """The serving ``occurrences`` rows (EXP-7, EXP-8): INTEGER key that must
    fit, and every zero measure turned into NULL as the reference's loader
    does (``float(v) if v else None``), unless ``zeros_as_null`` is off."""
    return geospatial.select(
        "gbif_id",
        narrow_to_int("taxon_key", "taxon_key").alias("taxon_key"),
        typed_geometry("coordinates", "Point"),
        *[zero_as_null(m).alias(m) if zeros_as_null else F.col(m) for m in MEASURES],
        "date", *carry,
    )
