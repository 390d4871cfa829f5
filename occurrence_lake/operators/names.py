"""Species names (AGG-2, AGG-6, JOIN-1, JOIN-2, JOIN-3, MET-2).

The reference looks every key up over HTTP, ten threads at a time; here the
lookups are a table of name records and the lookup is a join.  Records are
aggregated per taxon **before** joining, with combinable aggregates, so a
taxon with very many names is reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.functions.scalars import narrow_to_int
from occurrence_lake.schema import LANGUAGES

NAME_COLUMNS = [f"vernacular_name_{lang}" for lang in LANGUAGES]


def first_name_per_language(records: DataFrame, order_by=("seq",), key: str = "taxon_key",
                            language: str = "language", name: str = "name") -> DataFrame:
    """AGG-6: per key and language, the first non-NULL name in API order.

    ``''`` is a name.  ``min_by`` ignores rows whose ordering is NULL, so the
    ordering is NULL for rows of another language or without a name.
    """
    order: Column = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    aggs = [F.min_by(F.col(name), F.when((F.col(language) == lang) & F.col(name).isNotNull(), order))
            .alias(f"vernacular_name_{lang}") for lang in LANGUAGES]
    return records.groupBy(key).agg(*aggs)


def vernacular_names(keys: DataFrame, records: DataFrame, order_by=("seq",)) -> DataFrame:
    """JOIN-3 + SNK-5: every key, with its three names or NULLs; INTEGER key."""
    # names nobody asked for go before the aggregation; the join brings the
    # keys without any back
    useful = records.filter(F.col("language").isin(LANGUAGES) & F.col("name").isNotNull())
    names = first_name_per_language(useful, order_by)
    return (keys.join(names, on="taxon_key", how="left")
            .select(narrow_to_int("taxon_key", "taxon_key").alias("taxon_key"), *NAME_COLUMNS))


def scientific_names(keys: DataFrame, raw: DataFrame) -> DataFrame:
    """JOIN-1 + AGG-2: distinct (taxon_key, scientific_name) of the raw rows
    whose key is among ``keys``; NULL keys never match.

    DISTINCT runs first (partial aggregate per map task, so a hot key is
    collapsed before the shuffle), then a semi join to the keys: equal to
    the reference's join-then-DISTINCT, without the blow-up of the join.
    """
    pairs = raw.select("taxon_key", "scientific_name").distinct()
    return pairs.join(keys.select("taxon_key"), on="taxon_key", how="left_semi")


def species_names(scientific: DataFrame, vernacular: DataFrame) -> DataFrame:
    """JOIN-2: scientific and vernacular names of the same key (inner)."""
    sci = scientific.select(F.col("taxon_key").cast("long").alias("taxon_key"), "scientific_name")
    vern = vernacular.select(F.col("taxon_key").cast("long").alias("taxon_key"), *NAME_COLUMNS)
    return (sci.join(vern, on="taxon_key", how="inner")
            .select(narrow_to_int("taxon_key", "taxon_key").alias("taxon_key"), "scientific_name", *NAME_COLUMNS))


def missing_vernacular(vernacular: DataFrame) -> DataFrame:
    """MET-2: number of species without any vernacular name."""
    none = F.col(NAME_COLUMNS[0]).isNull()
    for c in NAME_COLUMNS[1:]:
        none = none & F.col(c).isNull()
    return vernacular.agg(F.count_if(none).alias("missing_vernacular"),
                          F.count(F.lit(1)).alias("species"))
