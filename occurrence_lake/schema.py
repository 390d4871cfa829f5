"""Declared schemas.  Nothing is ever inferred: a column that is NULL in a
whole file must still get its declared type (EXP-2, SRC-1)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The occurrence extract's 50 columns, in file order, as
# (snake_case name, type, source header name).  The header names are the
# public GBIF "SIMPLE_CSV" download header; the file is bound by position,
# so the order below is the order of the file.
# ---------------------------------------------------------------------------
S, D, L = "string", "double", "long"
RAW_COLUMNS = [
    ("gbif_id", S, "gbifID"),
    ("dataset_key", S, "datasetKey"),
    ("occurrence_id", S, "occurrenceID"),
    ("kingdom", S, "kingdom"),
    ("phylum", S, "phylum"),
    ("class", S, "class"),
    ("order", S, "order"),
    ("family", S, "family"),
    ("genus", S, "genus"),
    ("species", S, "species"),
    ("infraspecific_epithet", S, "infraspecificEpithet"),
    ("taxon_rank", S, "taxonRank"),
    ("scientific_name", S, "scientificName"),
    ("verbatim_scientific_name", S, "verbatimScientificName"),
    ("verbatim_scientific_name_authorship", S, "verbatimScientificNameAuthorship"),
    ("country_code", S, "countryCode"),
    ("locality", S, "locality"),
    ("state_province", S, "stateProvince"),
    ("occurrence_status", S, "occurrenceStatus"),
    ("individual_count", D, "individualCount"),
    ("publishing_org_key", S, "publishingOrgKey"),
    ("decimal_latitude", D, "decimalLatitude"),
    ("decimal_longitude", D, "decimalLongitude"),
    ("coordinate_uncertainty_in_meters", D, "coordinateUncertaintyInMeters"),
    ("coordinate_precision", D, "coordinatePrecision"),
    ("elevation", D, "elevation"),
    ("elevation_accuracy", D, "elevationAccuracy"),
    ("depth", D, "depth"),
    ("depth_accuracy", D, "depthAccuracy"),
    ("event_date", S, "eventDate"),
    ("day", L, "day"),
    ("month", L, "month"),
    ("year", L, "year"),
    ("taxon_key", L, "taxonKey"),
    ("species_key", D, "speciesKey"),
    ("basis_of_record", S, "basisOfRecord"),
    ("institution_code", S, "institutionCode"),
    ("collection_code", S, "collectionCode"),
    ("catalog_number", S, "catalogNumber"),
    ("record_number", S, "recordNumber"),
    ("identified_by", S, "identifiedBy"),
    ("date_identified", S, "dateIdentified"),
    ("license", S, "license"),
    ("rights_holder", S, "rightsHolder"),
    ("recorded_by", S, "recordedBy"),
    ("type_status", S, "typeStatus"),
    ("establishment_means", S, "establishmentMeans"),
    ("last_interpreted", S, "lastInterpreted"),
    ("media_type", S, "mediaType"),
    ("issue", S, "issue"),
]

# The six measures carried to the serving tables, in output order.
MEASURES = [
    "coordinate_uncertainty_in_meters",
    "coordinate_precision",
    "elevation",
    "elevation_accuracy",
    "depth",
    "depth_accuracy",
]

# The three vernacular languages (ISO 639-3), in column order.
LANGUAGES = ["deu", "eng", "fra"]

# The map layer's spatial reference.
SRID = 4326

_TYPES = {S: T.StringType(), D: T.DoubleType(), L: T.LongType()}

RAW_NAMES = [name for name, _, _ in RAW_COLUMNS]
RAW_HEADER = [header for _, _, header in RAW_COLUMNS]
RAW_SCHEMA = T.StructType([T.StructField(n, _TYPES[t], True) for n, t, _ in RAW_COLUMNS])


FILTERED_SCHEMA = T.StructType(
    [T.StructField("gbif_id", T.StringType()), T.StructField("taxon_key", T.LongType()),
     T.StructField("decimal_latitude", T.DoubleType()), T.StructField("decimal_longitude", T.DoubleType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    + [T.StructField("date", T.DateType())]
)

# The serving ``occurrences`` table: INTEGER key, WKB Point, the measures
# (zero already NULL), the date.
SERVING_OCCURRENCES_SCHEMA = T.StructType(
    [T.StructField("gbif_id", T.StringType()), T.StructField("taxon_key", T.IntegerType()),
     T.StructField("coordinates", T.BinaryType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    + [T.StructField("date", T.DateType())]
)

VERNACULAR_SCHEMA = T.StructType(
    [T.StructField("taxon_key", T.IntegerType(), False)]
    + [T.StructField(f"vernacular_name_{lang}", T.StringType()) for lang in LANGUAGES]
)

# One species-API reply: {"results": [{"language": ..., "vernacularName": ...}, ...]}
SPECIES_REPLY_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("language", T.StringType()),
        T.StructField("vernacularName", T.StringType()),
    ]))),
])
