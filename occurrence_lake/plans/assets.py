"""The pipeline's tables as one lazy DataFrame graph, and a runner that
materialises it.

``LazyAssets`` only declares plans; Catalyst sees the whole chain, so a
filter or column list chosen downstream reaches the raw scan.  ``run``
writes each table once (Parquet, counted while writing) and reads the next
stage from what was written: this cuts lineage, and a lost executor only
re-runs tasks of the current stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import remove, scratch_path
from occurrence_lake.functions.scalars import narrow_to_int
from occurrence_lake.functions.wkb import require_valid, with_point_wkb
from occurrence_lake.operators import multipoint, names, quadtree, refine
from occurrence_lake.operators.constraints import assert_primary_key
from occurrence_lake.operators.metrics import preview
from occurrence_lake.schema import VERNACULAR_SCHEMA
from occurrence_lake.sinks.parquet import fill_declared, materialize, write_table, write_years
from occurrence_lake.sinks.upsert import SERVING_SLOTS, KeyedTable
from occurrence_lake.sinks.year_keys import YearKeys
from occurrence_lake.sources.parquet import read_raw_years
from occurrence_lake.sources.tsv import read_occurrence_tsv, read_quoted_tsv
from occurrence_lake.streaming.ingest import serving_tables


class LazyAssets:
    """Every table of the pipeline, derived lazily from the raw occurrences
    and the vernacular-name records, each built on first use only.

    Building a DataFrame costs driver round trips for analysis, so a query
    that needs two tables should not pay for nine.
    """

    def __init__(self, raw_fn, records_fn, name_order=("seq",), parts: int = 1):
        self._fns = {"raw_occurrences": raw_fn, "_records": records_fn}
        self._name_order = name_order
        self._parts = parts
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def stored(self, name: str, df: DataFrame) -> None:
        """From now on ``name`` is this table, e.g. its rows read back."""
        self._built[name] = df

    def keys(self):
        return ["raw_occurrences", "filtered_occurrences", "geospatial_occurrences", "unique_taxon_keys",
                "vernacular_names", "scientific_names", "species_all_occurrence", "species_names",
                "occurrences"]

    def items(self):
        return [(k, self[k]) for k in self.keys()]

    def _build(self, name: str) -> DataFrame:
        if name in self._fns:
            return self._fns[name]()
        if name == "filtered_occurrences":
            return refine.filtered_occurrences(self["raw_occurrences"])
        if name == "geospatial_occurrences":
            return refine.geospatial_occurrences(self["filtered_occurrences"])
        if name == "unique_taxon_keys":
            return refine.unique_taxon_keys(self["filtered_occurrences"])
        if name == "vernacular_names":
            return names.vernacular_names(self["unique_taxon_keys"], self["_records"], self._name_order)
        if name == "scientific_names":
            return names.scientific_names(self["unique_taxon_keys"], self["raw_occurrences"])
        if name == "species_all_occurrence":
            f = self["filtered_occurrences"]
            return multipoint.species_all_occurrence(
                with_point_wkb(f.select("gbif_id", "taxon_key", "decimal_longitude", "decimal_latitude"),
                               "decimal_longitude", "decimal_latitude", "coordinates"),
                lon="decimal_longitude", lat="decimal_latitude", parts=self._parts)
        if name == "species_names":
            return names.species_names(self["scientific_names"], self["vernacular_names"])
        if name == "occurrences":
            return refine.serving_occurrences(self["geospatial_occurrences"])
        raise KeyError(name)


@dataclass
class RunReport:
    row_counts: dict[str, int] = field(default_factory=dict)
    previews: dict[str, list] = field(default_factory=dict)
    null_keys: int = 0


def ingest_extracts(spark: SparkSession, tsv_paths, raw_root: str, check_keys: bool = True,
                    acquire: bool = False, replace: bool = True, quoted_breaks: bool = False) -> int:
    """Yearly extracts (TSV) -> raw Parquet partitioned by year (SRC-1, SNK-2).

    The text is parsed once, into staged Parquet; a malformed row aborts.
    With ``check_keys`` a NULL or repeated ``gbif_id`` within a year aborts
    the load before anything is written (CON-1, the yearly table's primary
    key); the check is one aggregation pass, combinable on the map side.
    With ``acquire`` the acquisition predicate (FLT-1) is applied here, for
    extracts that were not filtered at download; with ``quoted_breaks``
    quoted fields may hold line breaks."""
    staged = scratch_path(spark, "staged-extracts")
    try:
        raw = (read_quoted_tsv if quoted_breaks else read_occurrence_tsv)(spark, tsv_paths, staged=staged)
        if acquire:
            raw = refine.acquire(raw)
        if check_keys:
            assert_primary_key(raw, ["year", "gbif_id"])
        return write_years(raw, raw_root, "partitioned_raw_occurrences", replace=replace)
    finally:
        remove(spark, staged)


def run(spark: SparkSession, raw_root: str, name_records: DataFrame, out_root: str,
        serving_root: str | None = None, name_order=("seq",), check_keys: bool = True, parts: int = 1,
        slots: int = SERVING_SLOTS, part_points: int | None = None) -> RunReport:
    """Materialise every table under ``out_root`` and upsert the three
    serving tables under ``serving_root``.  Returns counts and previews.

    ``raw_occurrences`` stays the yearly dataset itself (SRC-3), so a year
    filter on it prunes directories.  With ``check_keys`` a ``gbif_id`` that
    is NULL or stored twice in the union of the years aborts (CON-1; the keys
    of checked years are kept beside the raw dataset).  Rows
    without a taxon key are set aside under ``<out_root>/null_taxon_keys``
    and counted, instead of ending the run at the serving table's key.
    ``part_points`` splits species by place into parts of at most so many
    points, instead of into ``parts`` parts by a hash."""
    out = out_root.rstrip("/")
    report = RunReport()

    def shown(df: DataFrame) -> list[dict]:
        """Ten stored rows: a limit opens one file, it scans no table."""
        return [r.asDict() for r in preview(df).collect()]

    def save(name: str, df: DataFrame, sort_by=None) -> DataFrame:
        path = f"{out}/{name}"
        report.row_counts[name] = write_table(df, path, name, sort_by)
        saved = spark.read.parquet(path)
        report.previews[name] = shown(saved)
        return saved

    raw = materialize(read_raw_years(spark, raw_root), "raw_occurrences")
    if check_keys:
        YearKeys(spark, raw_root).check(raw)   # reads the years that changed since the last check
    report.row_counts["raw_occurrences"] = raw.count()   # answered from file footers
    report.previews["raw_occurrences"] = shown(raw)
    everything = refine.filtered_occurrences(raw)
    report.null_keys = write_table(everything.filter(F.col("taxon_key").isNull()), f"{out}/null_taxon_keys", "null_taxon_keys")
    filtered = save("filtered_occurrences", everything.filter(F.col("taxon_key").isNotNull()), ["taxon_key"])
    geospatial = save("geospatial_occurrences", refine.geospatial_occurrences(filtered), ["taxon_key"])
    keys = save("unique_taxon_keys", refine.unique_taxon_keys(filtered))
    vernacular = save("vernacular_names", fill_declared(
        spark, names.vernacular_names(keys, name_records, name_order), VERNACULAR_SCHEMA, "taxon_key"))
    scientific = save("scientific_names", names.scientific_names(keys, raw))
    # same rows as from ``geospatial``, but the envelope comes straight from
    # lon/lat instead of decoding every stored point
    points = filtered.select("gbif_id", "taxon_key", "decimal_longitude", "decimal_latitude")
    if part_points:
        points = quadtree.place_parts(points, part_points)
    species = multipoint.species_all_occurrence(
        with_point_wkb(points, "decimal_longitude", "decimal_latitude", "coordinates"),
        lon="decimal_longitude", lat="decimal_latitude", parts=parts, part_col="part" if part_points else None)

    if serving_root:
        occurrences, species_table = serving_tables(spark, serving_root, slots)
        # The parts of a species are replaced together (a run with fewer
        # parts leaves none behind); species absent from this run keep their
        # rows, as an ON CONFLICT upsert keeps them.
        # WKB read back from storage is checked as a typed geometry column would
        species_rows = require_valid(species.withColumn("taxon_key", narrow_to_int("taxon_key")),
                                     "all_occurrence_coordinates", "MultiPoint")
        former = species_table.read().select("taxon_key", "part").join(
            keys.select(narrow_to_int("taxon_key").alias("taxon_key")), "taxon_key", "left_semi") if species_table.exists() else None
        tables = {"species_all_occurrence": species_table}
        species_table.replace_groups(species_rows, former)
        tables["species_names"] = KeyedTable(spark, f"{serving_root.rstrip('/')}/species_names", "taxon_key", slots)
        tables["species_names"].upsert(names.species_names(scientific, vernacular), order_by=["scientific_name"], pick="first")
        serving = require_valid(refine.serving_occurrences(geospatial), "coordinates", "Point")
        if part_points:
            serving = serving.join(points.select("gbif_id", "part"), "gbif_id")
        else:
            serving = serving.withColumn("part", multipoint.part_of("gbif_id", "coordinates", parts))
        occurrences.upsert(serving)
        tables["occurrences"] = occurrences.rows
        for name, table in tables.items():
            report.row_counts[name] = table.row_count()   # counted while written
            report.previews[name] = shown(table.read())
    return report
