"""The materialising runner: TSV extracts -> year-partitioned raw -> every
table written once -> serving snapshots; counts agree with the lazy graph."""

from pyspark.sql import functions as F

import pytest

from occurrence_lake.operators.constraints import KeyViolation
from occurrence_lake.plans.assets import LazyAssets, ingest_extracts, run
from occurrence_lake.sinks.parquet import write_years
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.tsv import write_occurrence_tsv

from conftest import SF_SMALL


def test_run_pipeline(spark, workdir):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    for year in (2015, 2016):
        write_occurrence_tsv(raw.filter(F.col("year") == year), f"{workdir}/extracts/{year}")
    write_occurrence_tsv(raw.filter(~F.col("year").isin(2015, 2016)), f"{workdir}/extracts/rest")
    n = ingest_extracts(spark, f"{workdir}/extracts/*", f"{workdir}/raw")
    assert n == raw.count()

    records = fixtures.vernacular_records(spark, SF_SMALL)
    report = run(spark, f"{workdir}/raw", records, f"{workdir}/out", f"{workdir}/serving")
    lazy = LazyAssets(lambda: raw, lambda: records)
    for name in ("filtered_occurrences", "geospatial_occurrences", "unique_taxon_keys",
                 "vernacular_names", "scientific_names", "occurrences"):
        assert report.row_counts[name] == lazy[name].count(), name
    # the serving table has one row per key, whatever names a species has
    assert report.row_counts["species_names"] == lazy["species_names"].select("taxon_key").distinct().count()
    assert report.row_counts["species_all_occurrence"] == lazy["species_all_occurrence"].count()
    assert len(report.previews["filtered_occurrences"]) == 10

    # a second run upserts onto the same serving snapshots without growing them
    again = run(spark, f"{workdir}/raw", records, f"{workdir}/out2", f"{workdir}/serving")
    assert again.row_counts["occurrences"] == report.row_counts["occurrences"]


def test_run_checks_the_union_and_sets_null_keys_aside(spark, workdir):
    raw = fixtures.raw_occurrences(spark, SF_SMALL)
    holes = raw.withColumn("taxon_key", F.when(F.col("gbif_id").cast("long") % 10 == 0, None).otherwise(F.col("taxon_key")))
    write_years(holes, f"{workdir}/raw")
    records = fixtures.vernacular_records(spark, SF_SMALL)
    report = run(spark, f"{workdir}/raw", records, f"{workdir}/out", f"{workdir}/serving", parts=3)
    aside = spark.read.parquet(f"{workdir}/out/null_taxon_keys")
    assert report.null_keys == aside.count() > 0
    assert report.row_counts["occurrences"] == report.row_counts["filtered_occurrences"]
    assert spark.table("raw_occurrences").filter("year = 2016").count() == holes.filter("year = 2016").count()
    write_years(holes.filter("year = 2016"), f"{workdir}/raw", replace=False)   # stored twice
    with pytest.raises(KeyViolation):
        run(spark, f"{workdir}/raw", records, f"{workdir}/out2")
