"""SRC-2 / SRC-3: Parquet datasets.

A dataset is a directory; reading it is a bag union of its files (no
dedup).  The raw schema is always given, so a year whose file holds only
NULLs in some column keeps the declared types, and Spark prunes columns and
pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from occurrence_lake.schema import RAW_SCHEMA


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """SRC-2: one Parquet dataset (file or directory)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_raw_years(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: every yearly partition below ``path`` as one table.

    ``year`` is a partition column, so a filter on it prunes directories
    before any file is opened.
    """
    df = spark.read.schema(RAW_SCHEMA).option("basePath", path).parquet(path)
    return df.select(*[f"`{c}`" for c in RAW_SCHEMA.names])  # declared order; year is not last
