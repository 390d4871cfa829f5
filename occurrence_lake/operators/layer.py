"""The map layer (AGG-8, FLT-5, FLT-6, JOIN-4).

The reference's tile server asks, per tile, for every species whose
MultiPoint envelope overlaps the tile box (``geom && !BBOX!``), optionally
for one taxon.  Here a species row carries its envelope (computed in the
same aggregation as its MultiPoint), so the single-box query is four
comparisons, and many tiles at once are an equi-join on a hierarchical grid
instead of a nested-loop range join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.functions.geo import GRIDS, Box, TileGrid, envelope_overlaps, envelopes_overlap
from occurrence_lake.operators.multipoint import species_extents

MAX_LEVEL = 30
# A cell is heavy with more rows of one side, or more pairs, than half a
# task's share, but never below HEAVY_ROWS and PAIRS_A_ROW times as many pairs.
# TOP, TRACKED: cells a task that the sketch returns and keeps (its counts are
# off by less than 4 / TRACKED of a task's share).
HEAVY_ROWS, PAIRS_A_ROW = 10_000, 100
TOP, TRACKED = 16, 64
_EDGE = 1e-9  # cell units; widens a cell range so touching cells are candidates


def species_envelopes(points: DataFrame, key: str = "taxon_key", lon: str = "decimal_longitude",
                      lat: str = "decimal_latitude") -> DataFrame:
    """AGG-8: bounding box per species from its points (min/max are
    combinable: map-side partial aggregation makes a hot species cheap)."""
    return points.groupBy(key).agg(
        F.min(lon).alias("min_lon"), F.min(lat).alias("min_lat"),
        F.max(lon).alias("max_lon"), F.max(lat).alias("max_lat"))


# Grid level of the write-time clustering key: cells of 180 / 2^12 degrees
# (about 5 km), fine enough that one row group spans a compact area.
CLUSTER_LEVEL = 12


def envelope_zorder_sql(level: int = CLUSTER_LEVEL) -> str:
    """SQL for a Z-order (Morton) key of the envelope centre's grid cell.

    Rows written sorted by it keep nearby species together, so the min/max
    statistics Parquet keeps per row group on the envelope columns are
    tight, and a box query skips the row groups it cannot overlap (the
    "sort by grid cell on write" index of the serving table).  Empty
    geometries (NULL envelope) get NULL and sort first.
    """
    size = f"(180.0D / power(2.0D, {int(level)}))"
    cx = f"CAST(floor(((min_lon + max_lon) / 2.0D + 180.0D) / {size}) AS BIGINT)"
    cy = f"CAST(floor((90.0D - (min_lat + max_lat) / 2.0D) / {size}) AS BIGINT)"
    bits = []
    for i in range(int(level) + 1):
        bits.append(f"shiftleft(shiftright({cx}, {i}) & 1L, {2 * i})")
        bits.append(f"shiftleft(shiftright({cy}, {i}) & 1L, {2 * i + 1})")
    return "(" + " | ".join(bits) + ")"


def layer_bbox(species: DataFrame, box: Box, taxon_key: int | None = None,
               geom: str = "all_occurrence_coordinates", extents: DataFrame | None = None, whole: bool = True) -> DataFrame:
    """FLT-5 + FLT-6: the layer rows for one box, optionally one taxon.

    A species is chosen by its own envelope (``extents``, one row per
    species; derived from the parts when not given) and comes back with all
    its parts.  Without ``whole`` only the parts whose own envelope overlaps
    come back: a filter on stored columns, so row groups of other parts are
    not read (worth it with parts by place).  An absent parameter adds no
    predicate at all (not ``taxon_key = NULL``).
    """
    cond = envelope_overlaps("min_lon", "min_lat", "max_lon", "max_lat", box)
    if taxon_key is not None:
        wanted = F.col("taxon_key") == F.lit(int(taxon_key))
        species = species.filter(wanted)
        extents = extents.filter(wanted) if extents is not None else None
    if not whole:
        return species.filter(cond).select("taxon_key", F.col(geom).alias("geom"))
    chosen = (species_extents(species) if extents is None else extents).filter(cond).select("taxon_key")
    return species.join(chosen, "taxon_key", "left_semi").select("taxon_key", F.col(geom).alias("geom"))


# ---------------------------------------------------------------------------
# JOIN-4: many tiles at once
# ---------------------------------------------------------------------------
def _explode_cells(df: DataFrame, level, grid: TileGrid) -> DataFrame:
    """A row per grid cell at ``level`` that an envelope (u0..v1) touches."""
    size = F.pow(F.lit(2.0), -level.cast("double"))
    top = F.pow(F.lit(2.0), level.cast("double")).cast("long")

    def cells(low, high, n):
        clamp = lambda v: F.least(F.greatest(v, F.lit(0).cast("long")), n - 1)
        return F.sequence(clamp(F.floor(low / size - _EDGE)), clamp(F.floor(high / size + _EDGE)))

    return (df.withColumn("cx", F.explode(cells(F.col("u0"), F.col("u1"), top * grid.width)))
              .withColumn("cy", F.explode(cells(F.col("v0"), F.col("v1"), top))))


def _seen(df: DataFrame, column: str) -> tuple[int, list[int]]:
    """(rows, the levels that occur): at most ``MAX_LEVEL + 1`` levels, as
    they are checked when they are made."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.collect_set(column).alias("levels")).first()
    return row["n"], sorted(row["levels"])


def _each(levels: list[int], below: str):
    """A row for each of ``levels`` up to a column."""
    return F.explode(F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda v: v <= F.col(below)))


CELL = ["kind", "level", "cx", "cy"]


def _tasks(df: DataFrame) -> int:
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent_cells(cells: DataFrame) -> tuple[int, dict[int, int]]:
    """(rows, hash of a cell -> its rows) for the most frequent cells, from a
    sketch of bounded size: the driver sees ``TOP`` entries a task at most."""
    top, tracked = min(TOP * _tasks(cells), 100_000), min(TRACKED * _tasks(cells), 1_000_000)
    sketch = F.call_function("approx_top_k", F.col("h"), F.lit(top), F.lit(tracked))
    seen = cells.select(F.xxhash64(*CELL).alias("h")).agg(F.count("h").alias("n"), sketch.alias("top")).first()
    return seen["n"], {r["item"]: r["count"] for r in seen["top"] or []}


def cell_salts(left: tuple[int, dict[int, int]], right: tuple[int, dict[int, int]], tasks: int, heavy_rows: int = HEAVY_ROWS) -> dict[int, tuple[int, int]]:
    """Hash of a heavy cell -> salts of its left and of its right rows, so
    that no key has more rows, or pairs, than the limits."""
    work = {h: left[1].get(h, 1) * right[1].get(h, 1) for h in left[1].keys() | right[1].keys()}
    most = [max(side[0] / tasks, heavy_rows) for side in (left, right)]
    pairs = max(sum(work.values()) / tasks, PAIRS_A_ROW * heavy_rows)
    out = {}
    for h, n in work.items():
        rows = [left[1].get(h, 1), right[1].get(h, 1)]
        salts = [max(1, math.ceil(r / m)) for r, m in zip(rows, most)]
        more = math.ceil(n / (pairs * salts[0] * salts[1]))
        larger = rows.index(max(rows))
        salts[larger] = min(rows[larger], salts[larger] * more)
        if max(salts) > 1:
            out[h] = tuple(salts)
    return out


def _salted(cells: DataFrame, salts: dict[int, tuple[int, int]], side: int, by: list[str]) -> DataFrame:
    """Rows of a heavy cell dealt over their side's salts (``s0`` or ``s1``)
    and repeated for the other side's, so each two rows still meet once."""
    own, other = f"s{side}", f"s{1 - side}"
    if not salts:
        return cells.select("*", F.lit(0).alias(own), F.lit(0).alias(other))
    rows = [(h, s[side], s[1 - side]) for h, s in sorted(salts.items())]
    table = cells.sparkSession.createDataFrame(rows, "_h long, _own int, _other int")   # as many rows as two sketches return at most
    joined = cells.withColumn("_h", F.xxhash64(*CELL)).join(F.broadcast(table), "_h", "left")
    dealt = joined.withColumn(own, F.pmod(F.xxhash64(*by), F.coalesce("_own", F.lit(1))).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1))).drop("_h", "_own", "_other")


def placed_tiles(tiles: DataFrame) -> DataFrame:
    """``(z, x, y)`` as numbers; a zoom outside 0..``MAX_LEVEL`` raises."""
    zoom = F.col("z").cast("int")
    checked = F.when(zoom.between(0, MAX_LEVEL), zoom).otherwise(
        F.raise_error(F.concat(F.lit(f"tile zoom outside 0..{MAX_LEVEL}: "), F.coalesce(zoom.cast("string"), F.lit("null")))))
    return tiles.select(checked.alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


def placed_envelopes(extents: DataFrame, key: str, grid: TileGrid) -> DataFrame:
    """Envelopes with their unit coordinates and ``env_level``, the finest
    level whose cells are at least as large."""
    u0, v0 = grid.to_unit(F.col("min_lon"), F.col("max_lat"))
    u1, v1 = grid.to_unit(F.col("max_lon"), F.col("min_lat"))
    env = extents.filter(F.col("min_lon").isNotNull()).select(
        key, "min_lon", "min_lat", "max_lon", "max_lat", u0.alias("u0"), u1.alias("u1"), v0.alias("v0"), v1.alias("v1"))
    width = F.greatest(F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0"))
    own = F.when(width <= 0.0, F.lit(MAX_LEVEL)).otherwise(
        F.least(F.greatest(F.floor(-F.log2(width)), F.lit(0)), F.lit(MAX_LEVEL))).cast("int")
    return env.withColumn("env_level", own)


def tile_cells(t: DataFrame, env_levels: list[int]) -> DataFrame:
    """Kind A: a tile's ancestors at the envelope levels that occur; kind B:
    the tile itself."""
    up = F.col("z") - F.col("level")
    ancestors = (t.withColumn("level", _each(env_levels, "z"))
                 .withColumn("kind", F.lit("A")).withColumn("cx", F.call_function("shiftright", F.col("x"), up))
                 .withColumn("cy", F.call_function("shiftright", F.col("y"), up)))
    selves = t.withColumn("level", F.col("z")).withColumn("kind", F.lit("B")).withColumn("cx", F.col("x")).withColumn("cy", F.col("y"))
    return ancestors.unionByName(selves)


def envelope_cells(env: DataFrame, zooms: list[int], grid: TileGrid) -> DataFrame:
    """Kind A: the cells an envelope touches at its own level; kind B: those
    at the coarser zooms that occur."""
    at_own = env.withColumn("level", F.col("env_level")).withColumn("kind", F.lit("A"))
    coarser = env.withColumn("level", _each(zooms, "env_level")).where("level < env_level").withColumn("kind", F.lit("B"))
    return _explode_cells(at_own.unionByName(coarser), F.col("level"), grid)


def layer_tiles(species: DataFrame, tiles: DataFrame, key: str = "taxon_key", grid: str = "geographic",
                extents: DataFrame | None = None, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """JOIN-4: every (tile, species) whose envelopes overlap, once.

    ``tiles`` holds ``(z, x, y)`` of the geographic quad grid or, with
    ``grid="mercator"``, of Web Mercator (the usual XYZ requests of a map).
    Each envelope is placed at its own level, the finest whose cell is at
    least as large as the envelope, where it touches at most 3 x 3 cells.

    * kind A, envelope level <= tile zoom: the tile's ancestor cell at the
      envelope's level must be one of the envelope's cells;
    * kind B, envelope level  > tile zoom: the tile must be one of the cells
      the envelope touches at the tile's zoom (again at most 3 x 3).

    Both are equality matches on (kind, level, cx, cy): one hash join with no
    nested loop; the exact overlap test then removes the near misses.
    Ancestors are made only for envelope levels that occur, envelope cells
    only for zooms that occur.  Cells that are heavy by the rows of either
    side or by their pairs, at any level, are found by sketches and salted by
    their counts: each side's rows are dealt over its own salts and repeated
    for the other side's.  A zoom outside 0..``MAX_LEVEL`` raises.
    """
    g = GRIDS[grid]
    t = placed_tiles(tiles)
    env = placed_envelopes(species_extents(species, key) if extents is None else extents, key, g)
    (n_tiles, zooms), (n_envelopes, levels) = _seen(t, "z"), _seen(env, "env_level")
    left, right = tile_cells(t, levels), envelope_cells(env, zooms, g)
    salts = {}
    # a row is in a cell once, so few rows make no heavy cell
    if max(n_tiles, n_envelopes) > heavy_rows or n_tiles * n_envelopes > PAIRS_A_ROW * heavy_rows:
        salts = cell_salts(frequent_cells(left), frequent_cells(right), _tasks(left), heavy_rows)
    joined = _salted(left, salts, 0, ["z", "x", "y"]).join(_salted(right, salts, 1, [key]), on=[*CELL, "s0", "s1"], how="inner")
    envd = {c: F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")}
    return joined.filter(envelopes_overlap(envd, g.bounds(F.col("z"), F.col("x"), F.col("y")))).select("z", "x", "y", key)
