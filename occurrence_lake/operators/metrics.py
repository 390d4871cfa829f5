"""Run metadata (AGG-7, MET-1, LIM-1).

Every materialised table reports its row count and a ten-row preview.  The
count is taken while the table is written (``Observation``), so no second
pass over the data is needed; the preview is a ``limit``, or a top-k by key
when it has to be deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

PREVIEW_ROWS = 10


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by=None) -> DataFrame:
    """LIM-1: any ``n`` rows, or the first ``n`` by ``order_by`` (a per-task
    top-k merged on the driver side of the plan, no global sort)."""
    if order_by:
        cols = [order_by] if isinstance(order_by, str) else list(order_by)
        return df.orderBy(*cols).limit(n)
    return df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """AGG-7: ``SELECT COUNT(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for several tables in one plan."""
    parts = [row_count(df).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in when ``df`` is executed (MET-1)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("row_count")), obs
