"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import scratch_path

#: A word of the contracts: a run of ASCII letters or digits, or of any
#: characters beyond ASCII.  Applied after A-Z were lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ship(module_name: str) -> None:
    """Pickle the Python functions of a module by value, so that executors
    need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def process_cache(name: str, build):
    """A value built once per Python worker process and kept for its life."""
    cache = sys.__dict__.setdefault("_occurrence_lake_llm", {})
    if name not in cache:
        cache[name] = build()
    return cache[name]


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut the lineage: write ``df`` once below the shared folder and read it
    back.  Unlike a cached frame it survives lost executors, and its file
    sizes give Spark a measured size for the broadcast decision."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the fast path for texts whose
    characters are all ASCII; other texts go through ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))


def contract_words(text: Column) -> Column:
    """Words of the contracts as an array (null text: no words)."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row: inside lambdas an
    optimizer could else evaluate its expression for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def identity(id_value: Column, text_hash: Column, names: tuple[str, str]) -> list[Column]:
    """A document's identity (id and text) as plain, never null columns, for
    joins that find its rows again."""
    return [F.coalesce(id_value.cast("string"), F.lit("null")).alias(names[0]), text_hash.alias(names[1])]


def rows_of(df: DataFrame, keys: DataFrame, how: str, id_col: str, text_col: str, once: bool = False) -> DataFrame:
    """Rows of ``df`` whose document is (``left_semi``) or is not
    (``left_anti``) among ``keys`` (``id``, ``th``); ``once``: one row a
    document.  All columns of ``df`` come back, of whatever name."""
    names = tuple(f"_{n}" + "_" * max(map(len, df.columns)) for n in ("kid", "th"))
    found = keys.select(*identity(F.col("id"), F.col("th"), names))
    th = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = df.select("*", *identity(F.col(id_col), th, names)).join(found, list(names), how)
    out = out.dropDuplicates(list(names)) if once else out
    return out.drop(*names)
