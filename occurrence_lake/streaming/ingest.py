"""Incremental ingestion with Structured Streaming.

The reference loads occurrence extracts as they arrive (one per year and
download) and upserts the serving tables.  Here a landing folder of
tab-separated extracts is a streaming file source; every micro-batch:

1. is staged, every column converted (a malformed row aborts it), and
   refined exactly like the batch pipeline (filter, date, WKB point, serving
   measures); the last row per ``gbif_id`` wins, by file order then line
   order inside the batch;
2. looks its ids up in the table of places (only their slots are read) and
   writes down where they lay before the batch: those species parts and the
   ones that its rows fall in are *touched*;
3. is upserted into ``occurrences``, which lie by species part: only slots
   of touched parts are rebuilt;
4. gathers the touched parts again from ``occurrences`` (only their slots
   are read) and replaces just those in ``species_all_occurrence``.

So a batch reads and writes the slots it touches, whatever the history
holds.  ``foreachBatch`` is at-least-once.  What steps 1 and 2 wrote stays
until the batch is done, and each commit carries the batch id: a replay goes
on where the batch died, with the places as they were before it.  The staged
text and the batch's own tables are removed when it is done.  Row counts of
the batches are kept in ``counts`` (taken while writing).  The checkpoint
lives in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.config import finished, remove, shared_dir
from occurrence_lake.operators import multipoint, refine
from occurrence_lake.operators.layer import envelope_zorder_sql
from occurrence_lake.schema import RAW_SCHEMA
from occurrence_lake.sinks.upsert import SERVING_SLOTS, KeyedTable, LocatedTable
from occurrence_lake.sources.tsv import TSV_READ_OPTIONS, stage


def extract_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New extract files below ``landing_dir`` as a stream of raw rows."""
    reader = (spark.readStream.schema(RAW_SCHEMA).options(**TSV_READ_OPTIONS)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(landing_dir).withColumn("_file", F.col("_metadata.file_path"))


def serving_tables(spark: SparkSession, serving_root: str, slots: int = SERVING_SLOTS) -> tuple[LocatedTable, KeyedTable]:
    """``occurrences`` (by id, lying by species part) and
    ``species_all_occurrence`` (a row a species part, sorted by place)."""
    root = serving_root.rstrip("/")
    return (LocatedTable(spark, f"{root}/occurrences", "gbif_id", ["taxon_key", "part"], slots),
            KeyedTable(spark, f"{root}/species_all_occurrence", ["taxon_key", "part"], slots, order_sql=envelope_zorder_sql()))


class ServingIngest:
    """Keeps ``occurrences`` and ``species_all_occurrence`` under
    ``serving_root`` up to date from a landing folder."""

    def __init__(self, spark: SparkSession, landing_dir: str, serving_root: str,
                 checkpoint: str | None = None, parts: int = 1, slots: int = SERVING_SLOTS):
        self.spark = spark
        self.landing_dir = landing_dir
        self.root = serving_root.rstrip("/")
        self.parts = parts
        self.occurrences, self.species = serving_tables(spark, serving_root, slots)
        self.checkpoint = checkpoint or shared_dir(spark, "streams", "serving_ingest")
        self.counts: dict[int, dict[str, int]] = {}

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        tag = f"stream-{batch_id}"
        work = f"{self.root}/{tag}"
        if self.species.last_batch() == tag:
            remove(self.spark, work)
            return
        # file name, then position in the file, orders rows of one key
        carry = ("_file", "_line")
        if finished(self.spark, f"{work}/before"):
            serving = None   # a replay: prepared before
        else:
            raw = stage(batch.withColumn("_line", F.monotonically_increasing_id()), f"{work}/extract", replace=True)
            if raw.isEmpty():
                remove(self.spark, work)
                return
            serving = refine.serving_occurrences(
                refine.geospatial_occurrences(refine.filtered_occurrences(raw, carry), carry), carry)
            serving = serving.withColumn("part", multipoint.part_of("gbif_id", "coordinates", self.parts))
        rows, before = self.occurrences.prepare(serving, work, order_by=list(carry), drop=list(carry))
        self.occurrences.commit(work, tag)
        # touched: where the sent ids are now, and where they were before
        # this batch (an id may move to another species)
        touched = rows.select("taxon_key", "part").unionByName(before.select("taxon_key", "part")).distinct()
        points = self.occurrences.at(touched).select("gbif_id", "taxon_key", "part", "coordinates")
        self.species.replace_groups(multipoint.species_all_occurrence(points, part_col="part"), touched, batch_id=tag)
        self.counts[batch_id] = {"occurrences": self.occurrences.rows.row_count(), "species_all_occurrence": self.species.row_count()}
        remove(self.spark, work)

    def start(self, available_now: bool = True, max_files_per_trigger: int | None = None):
        stream = extract_stream(self.spark, self.landing_dir, max_files_per_trigger)
        writer = (stream.writeStream.foreachBatch(self.apply_batch)
                  .option("checkpointLocation", self.checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()

    def run_available(self) -> None:
        """Process every file present now, then stop."""
        q = self.start(available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
