"""Plan shape: filters and column lists reach the Parquet scan, the year
filter prunes partitions, and no nested-loop or cartesian join appears."""

import io
import contextlib

from occurrence_lake.operators import refine
from occurrence_lake.sinks.parquet import write_years
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.parquet import read_raw_years
from occurrence_lake.plans.driver_queries import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filtered_pushdown_and_pruning(spark, workdir):
    root = f"{workdir}/raw"
    write_years(fixtures.raw_occurrences(spark, SF_SMALL), root)
    raw = read_raw_years(spark, root)
    plan = _plan(refine.filtered_occurrences(raw))
    assert "PushedFilters: [IsNotNull(species), In(class, [Aves,Mammalia])]" in plan or (
        "IsNotNull(species)" in plan and "In(class" in plan)
    scan = [l for l in plan.splitlines() if l.startswith("ReadSchema")][0]
    assert "locality" not in scan and "species" in scan          # column pruning
    acq = _plan(refine.acquire(raw, years=[2016, 2017]))
    assert "PartitionFilters: [year" in acq and "IN (2016,2017)" in acq
    assert "GreaterThanOrEqual(decimal_longitude" in acq          # box pushed to the scan


def test_no_nested_loop_or_cartesian(spark):
    for name in ("layer_tiles", "scientific_names", "species_multipoint", "vernacular_names", "species_names"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_wkb_stays_in_codegen(spark):
    plan = _plan(QUERIES["geospatial_occurrences"](spark, SF_SMALL))
    # "* " marks an operator compiled by whole-stage codegen
    assert "* Project" in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_hot_key_operators_aggregate_before_shuffling(spark):
    """Operators whose key may hold a third of the rows reduce it map side:
    a partial aggregate sits below every exchange on that key."""
    from occurrence_lake.operators import constraints, layer, names
    from occurrence_lake.sinks.upsert import dedupe_by_key
    rows = spark.range(0, 1000).selectExpr("id % 3 AS taxon_key", "id AS seq", "'eng' AS language",
                                           "CAST(id AS STRING) AS name", "CAST(id AS DOUBLE) AS decimal_longitude",
                                           "CAST(id AS DOUBLE) AS decimal_latitude", "CAST(id % 5 AS STRING) AS scientific_name")
    cases = {
        "upsert dedupe": dedupe_by_key(rows.select("taxon_key", "seq", "name"), "taxon_key", ["seq"]),
        "names per language": names.first_name_per_language(rows),
        "scientific names": names.scientific_names(rows.select("taxon_key").distinct(), rows),
        "key check": constraints.key_violations(rows, "taxon_key"),
        "envelopes": layer.species_envelopes(rows),
    }
    for label, df in cases.items():
        plan = _plan(df)
        assert "partial_" in plan or "HashAggregate" in plan.split("Exchange")[-1], label
        # every shuffle on the key is fed by a partial aggregate
        physical = plan.split("\n\n")[0]
        lines = physical.splitlines()
        for i, line in enumerate(lines):
            if "Exchange" in line and "SinglePartition" not in line:
                below = "\n".join(lines[i + 1:i + 4])
                assert "Aggregate" in below, (label, physical)
