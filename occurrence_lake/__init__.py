"""occurrence_lake: a Spark-native species-occurrence pipeline.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; nothing is pulled to the driver except tiny
metadata (a snapshot version number, a preview of ten rows).
"""

from occurrence_lake.config import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
