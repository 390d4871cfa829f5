"""Stand-in inputs built from the driver's tables (FIXTURES.md, F3).

The reference reads occurrence extracts and a species web API; neither is
available here, so Spark derives equivalent frames from the given tables:

* ``raw_occurrences_from_events``: the 50-column raw schema, one occurrence
  per ``events`` row (taxon = user, coordinates in the French Alps box).
* ``vernacular_records_from_documents``: vernacular-name records, one per
  ``documents`` row, ``seq`` = API order.
* ``species_replies_from_records``: the same records as species-API JSON
  replies, in pages of bounded size.

Everything is a projection of a table scan, so work grows with the tables.
The SQL twins used by the DuckDB oracle live in ``plans.driver_queries``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.schema import RAW_SCHEMA

# Fixed value: page size of the species-reply stand-in.
REPLY_PAGE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The stand-in columns as Spark SQL (doubles written 1e1 etc. so that they
# are DOUBLE, not DECIMAL); columns not listed are NULL of their type.
RAW_STAND_IN_SQL = {
    "gbif_id": "CAST(event_id AS STRING)",
    "taxon_key": "user_id",
    "species": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('species ', CAST(user_id AS STRING)) END",
    "class": ("CASE event_type WHEN 'view' THEN 'Aves' WHEN 'click' THEN 'Mammalia' "
              "WHEN 'signup' THEN 'Insecta' WHEN 'error' THEN NULL ELSE 'Reptilia' END"),
    "kingdom": "CASE WHEN event_id % 10 = 0 THEN 'Plantae' ELSE 'Animalia' END",
    "country_code": "CASE WHEN event_id % 9 = 0 THEN 'IT' ELSE 'FR' END",
    "scientific_name": ("concat('Genus ', CAST(user_id AS STRING), CASE WHEN event_type = 'signup' THEN ' var. rara' "
                        "WHEN event_id % 2 = 0 THEN ' minor' ELSE '' END)"),
    "decimal_longitude": ("CASE WHEN event_id % 17 = 0 THEN NULL "
                          "ELSE 4e0 + (user_id % 40) / 1e1 + (event_id % 101) / 1e3 END"),
    "decimal_latitude": "44e0 + (user_id % 35) / 1e1 + (event_id % 103) / 1e3",
    "elevation": "CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE value END",
    "coordinate_uncertainty_in_meters": "CASE WHEN event_id % 4 = 0 THEN 0e0 ELSE (event_id % 50) * 1e1 END",
    "coordinate_precision": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 1e-3 END",
    "elevation_accuracy": "CASE WHEN event_id % 8 = 0 THEN 0e0 ELSE value / 1e1 END",
    "depth": "CASE WHEN event_id % 3 = 0 THEN 0e0 ELSE CAST(event_id % 20 AS DOUBLE) END",
    "locality": "concat('Col \"', event_type, '\" ', CAST(user_id % 7 AS STRING))",
    "year": "2014 + event_id % 13",
    "month": "CAST(month(ts) AS BIGINT)",
    "day": "CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE day(ts) END AS BIGINT)",
}


def raw_occurrences_from_events(events: DataFrame) -> DataFrame:
    """F3 ``occ`` in the raw schema; columns F3 does not define are derived
    the same way (zeros and NULLs included) or left NULL."""
    return events.selectExpr(*[
        f"CAST({RAW_STAND_IN_SQL.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in RAW_SCHEMA.fields
    ])


def raw_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_occurrences_from_events(table(spark, sf_dir, "events"))


def vernacular_records_from_documents(documents: DataFrame) -> DataFrame:
    """F3 ``vn``: (taxon_key, seq, language, name)."""
    return documents.selectExpr(
        "3 * (doc_id % 160) AS taxon_key",
        "doc_id AS seq",
        "CASE lang WHEN 'de' THEN 'deu' WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' ELSE 'spa' END AS language",
        "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS name",
    )


def vernacular_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vernacular_records_from_documents(table(spark, sf_dir, "documents"))


def species_replies_from_records(records: DataFrame) -> DataFrame:
    """Species-API replies ``(taxon_key, page, body)``, JSON text.

    A page gathers the records of one taxon whose ``seq`` falls in one
    window of ``REPLY_PAGE_SIZE``: a group is never larger than that, however
    many names a taxon has.
    """
    page = F.floor(F.col("seq") / REPLY_PAGE_SIZE)
    pages = (records
             .groupBy("taxon_key", page.alias("page"))
             .agg(F.array_sort(F.collect_list(F.struct("seq", "language", "name"))).alias("items")))
    results = F.transform("items", lambda it: F.struct(it["language"].alias("language"),
                                                       it["name"].alias("vernacularName")))
    body = F.to_json(F.struct(results.alias("results")))
    return pages.select("taxon_key", "page", body.alias("body"))


def with_text_behind(taxon_key: str, body: str) -> Column:
    """A reply's whole body; every 7th key's with a second closing brace."""
    return F.when(F.col(taxon_key) % 7 == 0, F.concat(body, F.lit("}"))).otherwise(F.col(body))


# An area's vertices, times its scale in thousandths of a
# degree, around its centre: an arrow with a hole, and a triangle apart.
AREA_MEMBERS = [[[(-3, -3), (3, -2), (1, 0), (3, 3), (-3, 2), (-3, -3)], [(-1, -1), (0, -1), (0, 0), (-1, -1)]],
                [[(4, -1), (6, 0), (4, 1), (4, -1)]]]
AREA_SQL = {"cx": "4200 + (s_suppkey * 37) % 4300", "cy": "44100 + (s_suppkey * 53) % 4000", "scale": "10 + 15 * (s_suppkey % 5)"}


def acquisition_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of areas ``(area_id, wkt)``, one a supplier, of several sizes."""
    def text(centre: str, step: int) -> str:
        return f"format_string('%d.%03d', ({centre} + {step} * scale) div 1000, ({centre} + {step} * scale) % 1000)"

    ring = lambda r: "'(', " + ", ', ', ".join(f"{text('cx', x)}, ' ', {text('cy', y)}" for x, y in r) + ", ')'"
    member = lambda m: "'(', " + ", ', ', ".join(ring(r) for r in m) + ", ')'"
    wkt = "concat('MULTIPOLYGON (', " + ", ', ', ".join(member(m) for m in AREA_MEMBERS) + ", ')')"
    placed = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS area_id", *[f"CAST({v} AS BIGINT) AS {k}" for k, v in AREA_SQL.items()])
    return placed.selectExpr("area_id", f"{wkt} AS wkt")
