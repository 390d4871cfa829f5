"""AGG-5 / FLT-5: species parts by place, from an adaptive quadtree.

A species with more than ``limit`` points is split into the quarters of the
map, a quarter with more than ``limit`` again, and so on; its parts are the
quarters that are left.  So a species of any size becomes rows of bounded
size without anybody guessing a number of parts, small species stay one row,
and the envelope of a part is small: a box may read only the parts it meets.

A point's *code* interleaves the bits of its grid cell (``PLACE_LEVELS``
levels of the longitude/latitude square) and goes on with bits of a hash of
its id, two a level, so that points of one and the same place split too.
Quarter ``c`` at level ``l`` is the prefix of ``2 * l`` bits.

Counting goes ``STEP`` levels a round: only points in quarters that have to
be split are counted again, by a combinable aggregation on (species,
quarter), so a hot species is spread over all tasks.  The table of split
quarters has about one row for ``limit`` points; it joins by its measured
size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.config import scratch_path

PLACE_LEVELS, HASH_LEVELS = 16, 8
DEPTH = PLACE_LEVELS + HASH_LEVELS
STEP = 8
CODE = "_code"


def code(lon: str, lat: str, id_col: str) -> Column:
    """A point's code; null without coordinates."""
    cells = 1 << PLACE_LEVELS

    def cell(unit: str) -> str:
        return f"least(greatest(CAST(floor({unit} * {float(cells)}D) AS BIGINT), 0L), {cells - 1}L)"

    x, y = cell(f"((`{lon}` + 180D) / 360D)"), cell(f"((`{lat}` + 90D) / 180D)")
    bits = [f"shiftleft(shiftright(x, {i}) & 1L, {2 * (i + HASH_LEVELS)}) | shiftleft(shiftright(y, {i}) & 1L, {2 * (i + HASH_LEVELS) + 1})" for i in range(PLACE_LEVELS)]
    place = F.expr(f"get(transform(array(named_struct('x', {x}, 'y', {y})), p -> {' | '.join(bits).replace('(x,', '(p.x,').replace('(y,', '(p.y,')}), 0)")
    return F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), place.bitwiseOR(F.xxhash64(id_col).bitwiseAND(F.lit((1 << 2 * HASH_LEVELS) - 1))))


def _prefix(level: int) -> Column:
    return F.shiftright(F.col(CODE), 2 * (DEPTH - level))


def split_quarters(points: DataFrame, limit: int, key: str = "taxon_key") -> DataFrame:
    """``(key, level, cell)`` of every quarter with more than ``limit``
    points (columns ``key``, ``_code``), from the whole map (level 0) down."""
    if limit < 1:
        raise ValueError(f"limit must be at least 1, not {limit}")
    spark = points.sparkSession
    points = points.select(key, CODE).where(F.col(CODE).isNotNull() & F.col(key).isNotNull())

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "split-quarters")
        df.select(key, "level", "cell").write.parquet(path)
        return spark.read.parquet(path)

    n = F.count(F.lit(1)).alias("n")
    found = [stored(points.groupBy(key).agg(n).where(F.col("n") > limit).withColumn("level", F.lit(0)).withColumn("cell", F.lit(0).cast("long")))]
    for level in range(0, DEPTH, STEP):
        to = min(level + STEP, DEPTH)
        full = found[-1].where(F.col("level") == level).select(key, "cell")
        if full.isEmpty():
            break
        fine = points.withColumn("cell", _prefix(level)).join(full, [key, "cell"], "left_semi").groupBy(key, _prefix(to).alias("fine")).agg(n)
        up = (fine.withColumn("level", F.explode(F.sequence(F.lit(level + 1), F.lit(to))))
              .withColumn("cell", F.call_function("shiftright", F.col("fine"), 2 * (F.lit(to) - F.col("level")))))
        counted = up.groupBy(key, "level", "cell").agg(F.sum("n").alias("n"))
        found.append(stored(counted.where((F.col("n") > limit) & (F.col("level") < DEPTH))))
    return reduce(DataFrame.unionByName, found)


def with_parts(points: DataFrame, splits: DataFrame, key: str = "taxon_key", out: str = "part") -> DataFrame:
    """``points`` (with ``_code``) and their part: the quarter below the last
    one of theirs that is split, as a number that tells level and cell apart;
    0 for points without a place."""
    levels = sorted(r[0] for r in splits.select("level").distinct().collect())   # at most DEPTH
    joined = points
    for level in levels:
        here = splits.where(F.col("level") == level).select(F.col(key).alias("_k"), F.col("cell").alias("_c"), F.lit(level).alias(f"_split{level}"))
        joined = joined.join(here, (F.col(key) == F.col("_k")) & (_prefix(level) == F.col("_c")), "left").drop("_k", "_c")
    last = F.greatest(F.lit(-1), F.lit(-1), *[F.col(f"_split{level}") for level in levels])
    own = last + 1
    number = F.call_function("shiftleft", F.lit(1).cast("long"), 2 * own).bitwiseOR(F.call_function("shiftright", F.col(CODE), 2 * (F.lit(DEPTH) - own)))
    return joined.withColumn(out, F.coalesce(number, F.lit(0).cast("long"))).drop(CODE, *[f"_split{level}" for level in levels])


def place_parts(points: DataFrame, limit: int, key: str = "taxon_key", lon: str = "decimal_longitude", lat: str = "decimal_latitude",
                id_col: str = "gbif_id", out: str = "part") -> DataFrame:
    """``points`` with the quadtree part of each."""
    coded = points.withColumn(CODE, code(lon, lat, id_col))
    return with_parts(coded, split_quarters(coded, limit, key), key, out)
