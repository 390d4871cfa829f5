"""CON-1: a key that must be unique and non-NULL.

The check is an aggregation (partial counts per map task, so a key that
repeats a billion times is one row per task before the shuffle); only the
offending keys, never the data, come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys seen more than once, with their count (NULL keys are one group)."""
    return (df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def key_violations(df: DataFrame, key) -> DataFrame:
    """One row: number of rows with a NULL key part and of duplicated keys."""
    keys = _keys(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~any_null & (F.col("n") > 1)).alias("duplicated_keys"),
    )


class KeyViolation(ValueError):
    pass


def assert_primary_key(df: DataFrame, key) -> None:
    """Abort as a PRIMARY KEY would: raise if any key is NULL or repeated."""
    row = key_violations(df, key).first()
    if row["null_keys"] or row["duplicated_keys"]:
        raise KeyViolation(f"primary key {key!r} violated: {row['null_keys']} NULL, "
                           f"{row['duplicated_keys']} duplicated")
