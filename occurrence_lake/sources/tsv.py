"""SRC-1: occurrence extracts as tab-separated text.

The file has a header line that is skipped, and columns are bound **by
position** to the declared schema (EXP-2 renames camelCase to snake_case
for free).  An empty field is NULL, a malformed value or a row with the
wrong number of fields aborts the load.  Spark's text reader only sees such
rows when it converts every column, which a pruned read does not; so the
text is parsed exactly once, all columns of it, into *staged* Parquet, and
everything else (key check, year write, stream) reads that.  Files are read
in parallel splits.  ``read_occurrence_tsv`` takes every line as a record;
``read_quoted_tsv`` also takes line breaks inside quotes, without the
``multiLine`` option, which would make a file unsplittable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurrence_lake.config import remove, scratch_path
from occurrence_lake.schema import RAW_HEADER, RAW_SCHEMA

TSV_READ_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "enforceSchema": "true",   # bind by position, ignore the header's names
    "mode": "FAILFAST",
    "quote": '"',
    "escape": '"',             # "say ""hi""" -> say "hi"
    "nullValue": "",
    "emptyValue": "",
    "multiLine": "false",
    "columnPruning": "false",  # rows of a wrong length fail whatever is read
}


def stage(raw: DataFrame, path: str | None = None, replace: bool = False) -> DataFrame:
    """Write raw text rows, every column converted, and read them back."""
    spark = raw.sparkSession
    path = path or scratch_path(spark, "staged-extracts")
    raw.write.mode("overwrite" if replace else "errorifexists").parquet(path)
    return spark.read.schema(raw.schema).parquet(path)


def read_occurrence_tsv(spark: SparkSession, path, schema=RAW_SCHEMA, staged: str | None = None) -> DataFrame:
    """Read one file, a directory or a list of paths of raw extracts, through
    a staged copy (at ``staged``, else in the shared folder)."""
    return stage(spark.read.schema(schema).options(**TSV_READ_OPTIONS).csv(path), staged)


def write_occurrence_tsv(df: DataFrame, path: str) -> None:
    """Write raw rows as an extract: source header names, tab separated.

    Used to produce test extracts from the stand-in tables; quotes inside a
    value are doubled, NULL is an empty field.
    """
    (df.toDF(*RAW_HEADER)
       .write.mode("overwrite")
       .option("sep", "\t").option("header", "true")
       .option("quote", '"').option("escape", '"')
       .option("nullValue", "").option("emptyValue", '""')
       .csv(path))


# ---------------------------------------------------------------------------
# Line breaks inside quotes, without giving up splits
# ---------------------------------------------------------------------------
# A field: quoted (a doubled quote stands for one), else plain, or empty.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^\t]*+|[^"\t][^\t]*+)?+'
_FROM_OUTSIDE = rf"(?s)^{_FIELD}(?:\t{_FIELD})*+\z"
_FROM_INSIDE = rf'(?s)^(?:[^"]++|"")*+"[^\t]*+(?:\t{_FIELD})*+\z'


def quoted_lines(spark: SparkSession, path) -> DataFrame:
    """Every line with its place (``file``, ``block``: start of its split,
    ``n``: ascending within the split) and whether it ends inside quotes when
    it begins outside (``f0``) or inside of them (``f1``)."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("n"), F.regexp_replace("value", "\r$", "").alias("value"), F.col("value").endswith("\r").alias("cr"))
    quoted = F.contains(F.col("value"), F.lit('"'))
    return lines.select("*", F.when(quoted, ~F.col("value").rlike(_FROM_OUTSIDE)).otherwise(F.lit(False)).alias("f0"),
                        F.when(quoted, ~F.col("value").rlike(_FROM_INSIDE)).otherwise(F.lit(True)).alias("f1"))


def _state(start: Column, const: Column, swaps: Column) -> Column:
    """Inside quotes?  ``const``: (value, swaps) at the last line that ends
    the same way from either state; ``swaps``: lines so far that turn it."""
    odd = lambda c: c % 2 == 1
    return F.when(const.isNotNull(), const["value"] != odd(swaps - const["swaps"])).otherwise(start != odd(swaps))


def quoted_records(lines: DataFrame) -> DataFrame:
    """Whole records (``file``, ``value``) of written ``quoted_lines``,
    headers left out.

    A line is a function of the state (inside quotes or not) before it; the
    functions of a split are composed in order, splits of a file are composed
    from one row a split, and so each split learns the state it begins in.
    Records of one line stay as they are, only the lines of longer ones are
    gathered.  A file that ends inside quotes raises."""
    split = Window.partitionBy("file", "block").orderBy("n")
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = F.sum(F.when(F.col("f0") & ~F.col("f1"), 1).otherwise(0)).over(upto)
    rows = lines.withColumn("swaps", turned)
    fixed = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("value"), F.col("swaps").alias("swaps")))
    rows = rows.withColumn("const", F.last(fixed, ignorenulls=True).over(upto))

    ends = rows.groupBy("file", "block").agg(F.max_by(F.struct("swaps", "const"), "n").alias("end"), F.min("n").alias("first_n"), F.max("n").alias("last_n"))
    by_block = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a split as one function: constant, or the number of its turns
    swaps = F.sum(F.col("end.swaps")).over(by_block)
    ends = ends.withColumn("total", swaps)
    value = F.col("end.const.value") != ((F.col("end.swaps") - F.col("end.const.swaps")) % 2 == 1)
    ends = ends.withColumn("file_const", F.last(F.when(F.col("end.const").isNotNull(), F.struct(value.alias("value"), F.col("total").alias("swaps"))), ignorenulls=True).over(by_block))
    ends = ends.withColumn("after", _state(F.lit(False), F.col("file_const"), F.col("total")))
    in_file = Window.partitionBy("file").orderBy("block")
    ends = ends.select("file", "block", "first_n", "after", F.coalesce(F.lag("after").over(in_file), F.lit(False)).alias("before"),
                       F.row_number().over(in_file).alias("nth"), F.lead("block").over(in_file).isNull().alias("is_last"))
    broken = ends.where(F.col("is_last") & F.col("after")).select("file").first()
    if broken is not None:
        raise ValueError(f"a quoted field of {broken['file']} is never closed")

    rows = rows.join(ends.select("file", "block", "first_n", "before", "nth"), ["file", "block"])
    rows = rows.withColumn("after", _state(F.col("before"), F.col("const"), F.col("swaps")))
    rows = rows.withColumn("starts", ~F.coalesce(F.lag("after").over(split), F.col("before")))
    header = (F.col("nth") == 1) & (F.col("n") == F.col("first_n"))
    rows = rows.where(~header)
    whole = rows.where(F.col("starts") & ~F.col("after")).select("file", "value")
    # Lines of longer records: a record is named by its first line, which may
    # lie in an earlier split; the lines of a file's longer records follow
    # each other by (block, n).
    longer = rows.where(~(F.col("starts") & ~F.col("after"))).select("file", "block", "n", "value", "cr", "starts", "after")
    longer = longer.withColumn("key", F.last(F.when(F.col("starts"), F.col("n")), ignorenulls=True).over(upto))
    lasts = longer.groupBy("file", "block").agg(F.max("key").alias("last_key"))
    carried = lasts.select("file", "block", F.last("last_key", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("open_key"))
    longer = longer.join(carried, ["file", "block"]).withColumn("key", F.coalesce("key", "open_key"))
    ended = F.concat(F.col("value"), F.when(F.col("after"), F.when(F.col("cr"), "\r\n").otherwise("\n")).otherwise(""))
    joined = (longer.groupBy("file", "key").agg(F.array_sort(F.collect_list(F.struct("block", "n", ended.alias("part")))).alias("parts"))
              .select("file", F.array_join("parts.part", "").alias("value")))
    return whole.unionByName(joined).where("value <> ''")


def read_quoted_tsv(spark: SparkSession, path, schema=RAW_SCHEMA, staged: str | None = None) -> DataFrame:
    """``read_occurrence_tsv`` for extracts whose quoted fields may hold line
    breaks.  Files stay split: the lines are written once with their places,
    and put together by ``quoted_records``, which shuffles them by split.  Use
    it only for extracts that need it.  Lines end in LF or CRLF."""
    kept = scratch_path(spark, "quoted-lines")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: v for k, v in TSV_READ_OPTIONS.items() if k in ("sep", "mode", "quote", "escape", "nullValue", "emptyValue")}
    try:
        quoted_lines(spark, path).write.parquet(kept)
        records = quoted_records(spark.read.parquet(kept))
        return stage(records.select(F.from_csv("value", ddl, options).alias("row")).select("row.*"), staged)
    finally:
        remove(spark, kept)
