"""Parquet sinks (SNK-1, SNK-2, SNK-4, SNK-5).

Writes go through Spark's commit protocol: a table appears whole or not at
all, and a task lost mid-write is simply re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occurrence_lake.operators.constraints import assert_primary_key
from occurrence_lake.operators.metrics import observed


def write_table(df: DataFrame, path: str, name: str | None = None, sort_within: list[str] | None = None) -> int:
    """SNK-1: overwrite a whole table; returns its row count (MET-1), counted
    while writing.  ``sort_within`` clusters rows inside each file (e.g. by
    key) so that Parquet min/max statistics prune row groups on read."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out, obs = observed(out, name or "write")
    out.write.mode("overwrite").parquet(path)
    return int(obs.get.get("row_count", 0))


def write_years(df: DataFrame, path: str, name: str | None = None, replace: bool = True) -> int:
    """SNK-2: write rows into ``year`` partitions.

    ``replace=True`` replaces only the years present in ``df`` (dynamic
    partition overwrite, as a write option, so the session's setting is
    left alone).  ``replace=False`` adds files next to the existing ones, as
    the reference does when a year is downloaded again under another
    download key (the raw union then holds both, no dedup).

    Rows are clustered by year with a ``rebalance`` hint: AQE splits a year
    that holds a large share of the rows into advisory-size chunks (many
    writer tasks, files of ~``advisoryPartitionSizeInBytes``) and merges
    small years, so no single task writes a whole year.
    """
    out, obs = observed(df.hint("rebalance", "year"), name or "write_years")
    writer = out.write.partitionBy("year")
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
    return int(obs.get.get("row_count", 0))


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """SNK-4: make a query result a named table.

    With ``path`` the rows are written (durable, survives executor loss and
    cuts the lineage) and the view reads them back; without, the view is a
    named plan.
    """
    spark = df.sparkSession
    if path:
        write_table(df, path, name)
        df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def fill_declared(spark: SparkSession, df: DataFrame, schema: T.StructType, key: str | None = None) -> DataFrame:
    """SNK-5: computed rows cast to a declared table schema (by name), with
    the primary key checked as the declared table would."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for declared table: {missing}")
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if key:
        assert_primary_key(out, key)
    return out
