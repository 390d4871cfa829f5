"""FLT-2 for a table of areas: which points lie in which areas.

Each area (WKT POLYGON or MULTIPOLYGON, x = longitude) is covered by cells of
a power-of-two grid, some 32 to its longer side.  A cell that no edge passes
lies inside or outside as a whole; the outer ones are dropped.  A cell that
edges pass carries these, and what the edges to its right add, so that a
point is settled by the one row of its cell: it looks up its own cell once
per grid size that occurs (an equi-join), and nothing is joined after that.
Nothing is a plan literal: areas and cells are tables, so their number only
makes tables longer.

The test is the even-odd rule of ``geo.inside_polygon`` over all rings of an
area (members of a MULTIPOLYGON do not overlap by its definition); a single
axis-aligned rectangle is closed, as there.  A null point or area gives no
row; another geometry or a broken ring raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.config import scratch_path

CELLS_A_SIDE = 32
EDGE = ("xi", "yi", "xj", "yj")
ABOUT = ("area", "box", "is_box", "level")
# by how much an edge's way through a row of cells is widened: a share of the
# cell, and one of the coordinates
SLACK, ROUNDING = 1e-6, 2.0 ** -48
# A cell of up to so many edges and turns has them as columns, which Spark
# compiles; one of more has lists, an edge list for some EDGES_A_STRIP edges.
PLAIN_EDGES, PLAIN_TURNS = 3, 2
EDGES_A_STRIP, MAX_STRIPS = 8, 512


def area_edges(areas: DataFrame, id_col: str, wkt_col: str) -> DataFrame:
    """Edges of every ring, with what describes their area: ``area``, xi, yi,
    xj, yj, ``box`` (min_lon, min_lat, max_lon, max_lat), ``level`` (the grid
    size is 2^level) and ``is_box``."""
    wkt = F.trim(F.col(wkt_col))
    bad = lambda what: F.raise_error(F.concat(F.lit(what), F.substring(wkt, 1, 60)))
    # null areas are asked for again in each check: Spark may move the filter
    rings = F.when(wkt.isNull() | F.upper(wkt).rlike(r"^(MULTI)?POLYGON\s*\("), F.regexp_extract_all(wkt, F.lit(r"\(([^()]*)\)"), F.lit(1))).otherwise(
        bad("not a WKT POLYGON or MULTIPOLYGON: "))
    point = lambda p: F.split(F.trim(p), r"\s+").cast("array<double>")
    sound = lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)) & F.forall(r, lambda p: F.size(p) == 2)
    rows = areas.where(wkt.isNotNull()).select(F.col(id_col).alias("area"), wkt.alias(wkt_col), F.transform(rings, lambda r: F.transform(F.split(r, ","), point)).alias("rings"))
    rows = rows.select("area", F.when(F.col("rings").isNull() | (F.size("rings") > 0) & F.forall("rings", sound), F.col("rings")).otherwise(
        bad("a ring needs at least 4 vertices and must be closed: ")).alias("rings"))
    edge = lambda r, i: F.struct(F.get(F.get(r, i), F.lit(0)).alias("xi"), F.get(F.get(r, i), F.lit(1)).alias("yi"),
                                 F.get(F.get(r, i + 1), F.lit(0)).alias("xj"), F.get(F.get(r, i + 1), F.lit(1)).alias("yj"))
    edges = F.flatten(F.transform("rings", lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda i: edge(r, i))))
    rows = rows.select("area", F.size("rings").alias("n_rings"), edges.alias("edges"))
    xs, ys = F.col("edges.xi"), F.col("edges.yi")
    box = F.struct(F.array_min(xs).alias("min_lon"), F.array_min(ys).alias("min_lat"), F.array_max(xs).alias("max_lon"), F.array_max(ys).alias("max_lat"))
    straight = F.forall("edges", lambda e: (e["xi"] == e["xj"]) != (e["yi"] == e["yj"]))
    rows = rows.select("area", "edges", box.alias("box"),
                       ((F.col("n_rings") == 1) & (F.size("edges") == 4) & straight).alias("is_box"))
    side = F.greatest(F.col("box.max_lon") - F.col("box.min_lon"), F.col("box.max_lat") - F.col("box.min_lat"), F.lit(1e-9))
    # outer: else Spark derives a filter on the edges, and parses every text twice for it
    rows = rows.select("area", "box", "is_box", F.ceil(F.log2(side / CELLS_A_SIDE)).cast("int").alias("level"), F.inline_outer("edges"))
    return rows.where(F.col("xi").isNotNull())


def cell_size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level.cast("double"))


def _cell(v: Column) -> Column:
    return F.floor(v / cell_size(F.col("level")))


def edge_bands(edges: DataFrame) -> DataFrame:
    """``area``, ``band`` (a row of cells) and its ``edges``, each with the
    cells ``first`` to ``last`` that it may pass there, its ``ends`` inside
    the row, and whether one of its ends lies above (``flips``)."""
    size = cell_size(F.col("level"))
    low, high = F.least("yi", "yj"), F.greatest("yi", "yj")
    rows = edges.select("area", "level", *EDGE, F.explode(F.sequence(_cell(low), _cell(high))).alias("band"))
    # where the edge is while it crosses this row of cells
    at = lambda y: F.when(F.col("yi") == F.col("yj"), F.lit(None)).otherwise(
        F.col("xi") + (F.least(F.greatest(y, low), high) - F.col("yi")) * (F.col("xj") - F.col("xi")) / (F.col("yj") - F.col("yi")))
    a, b = F.coalesce(at(F.col("band") * size), F.col("xi")), F.coalesce(at((F.col("band") + 1) * size), F.col("xj"))
    more = F.greatest(F.abs("xi"), F.abs("xj")) * ROUNDING / size + SLACK
    bottom, top = F.col("band") * size, (F.col("band") + 1) * size
    inner = F.filter(F.array("yi", "yj"), lambda y: (F.col("yi") != F.col("yj")) & (y > bottom) & (y < top))
    edge = F.struct(F.floor(F.least(a, b) / size - more).alias("first"), F.floor(F.greatest(a, b) / size + more).alias("last"), *EDGE,
                    ((F.col("yi") >= top) != (F.col("yj") >= top)).alias("flips"), inner.alias("ends"))
    return rows.select("area", "band", edge.alias("edge")).groupBy("area", "band").agg(F.collect_list("edge").alias("edges"))


def _odd_ones(ys: Column) -> Column:
    """The values that occur an odd number of times."""
    met = lambda kept, y: F.when(F.element_at(kept, -1) == y, F.slice(kept, 1, F.size(kept) - 1)).otherwise(F.concat(kept, F.array(y)))
    one = lambda kept, y: F.when(F.size(kept) == 0, F.array(y)).otherwise(met(kept, y))
    return F.aggregate(F.array_sort(ys), F.array().cast("array<double>"), one)


def _odd(flags: Column) -> Column:
    return F.size(flags) % 2 == 1


def cover(edges: DataFrame, bands: DataFrame) -> DataFrame:
    """Cells that meet an area: ``level``, ``cx``, ``cy``, ``area``, ``whole``
    (no edge passes), and for the others the area's ``box``, whether this is
    all of it (``is_box``), and its crossings.  Those of edges to the right
    of the cell depend on a point's y only, and cancel where two of them
    meet: ``odd`` says whether their number is odd above the ``turns``, the
    latitudes in the cell where it changes.  The edges that pass are
    ``edge0`` to ``edge2`` in ``plain`` cells, which have ``turn0`` and
    ``turn1`` also, else ``strips`` by equal parts of the cell's height."""
    size = cell_size(F.col("level"))
    rows = edges.select(*ABOUT).distinct().join(bands.withColumnRenamed("edges", "row"), "area")
    low, high = F.array_min("row.first"), F.array_max("row.last")
    left, right = _cell(F.col("box.min_lon")), _cell(F.col("box.max_lon"))
    cells = F.sequence(F.when(F.col("is_box"), left).otherwise(F.least(F.greatest(low, left), right)),
                       F.when(F.col("is_box"), right).otherwise(F.greatest(F.least(high, right), left)))
    # a generator: else Spark moves the filter below before the lists, and makes
    # them twice; all columns from it, since Spark loses others if few are asked for
    lists = F.transform(cells, lambda cx: F.struct(
        *ABOUT, cx.alias("cx"), F.col("band").alias("cy"), ((F.col("band") + 0.5) * size).alias("centre"), F.filter("row", lambda e: (e["first"] <= cx) & (cx <= e["last"])).alias("passing"),
        F.filter("row", lambda e: (e["first"] > cx) & (e["flips"] | (F.size(e["ends"]) > 0))).alias("beyond")))
    rows = rows.select(F.inline_outer(lists))
    ends = F.flatten(F.transform("beyond", lambda e: e["ends"]))
    rows = rows.select(*ABOUT, "cx", "cy", "centre", (F.size("passing") == 0).alias("whole"), F.filter("passing", lambda e: e["yi"] != e["yj"]).alias("here"),
                       _odd(F.filter("beyond", lambda e: e["flips"])).alias("odd"),
                       F.when(F.size("beyond") > 0, _odd_ones(ends)).otherwise(F.array().cast("array<double>")).alias("turns"))
    rows = rows.where(~F.col("whole") | F.col("is_box") | (F.col("odd") != _odd(F.filter("turns", lambda y: F.col("centre") < y))))
    plain = (F.size("here") <= PLAIN_EDGES) & (F.size("turns") <= PLAIN_TURNS)
    edge = lambda e: F.struct(*[e[c].alias(c) for c in EDGE])
    single = [F.when(plain, value(F.get(a, F.lit(i)))).alias(f"{c}{i}")
              for a, c, value, n in (("turns", "turn", lambda t: t, PLAIN_TURNS), ("here", "edge", lambda e: F.when(e.isNotNull(), edge(e)), PLAIN_EDGES)) for i in range(n)]
    bottom, n = F.col("cy") * size, F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size("here"), F.lit(EDGES_A_STRIP)) / EDGES_A_STRIP)))
    n = F.least(n, F.lit(float(MAX_STRIPS)))
    strip = lambda i: F.filter("here", lambda e: (F.least(e["yi"], e["yj"]) <= bottom + (i + 1 + SLACK) * size / n)
                               & (F.greatest(e["yi"], e["yj"]) >= bottom + (i - SLACK) * size / n))
    strips = F.transform(F.sequence(F.lit(0), n.cast("int") - 1), lambda i: F.transform(strip(i), edge))
    return rows.select("area", "level", "cx", "cy", "whole", F.when(~F.col("whole"), F.col("box")).alias("box"), (F.col("whole") | F.col("is_box")).alias("closed"),
                       "odd", plain.alias("plain"), *single, F.when(~plain, F.col("turns")).alias("turns"), F.when(~plain, strips).alias("strips"))


def _crosses(e: Column) -> Column:
    x, y = F.col("x"), F.col("y")
    return ((y < e["yi"]) != (y < e["yj"])) & (x < (e["xj"] - e["xi"]) * (y - e["yi"]) / (e["yj"] - e["yi"]) + e["xi"])


def _is_inside(odd: Column) -> Column:
    """Whether a point (x, y) is in the area of its cell, ``odd`` being
    whether an odd number of edges is crossed."""
    in_box = F.col("x").between(F.col("box.min_lon"), F.col("box.max_lon")) & F.col("y").between(F.col("box.min_lat"), F.col("box.max_lat"))
    return (F.col("box").isNull() | in_box) & (F.col("closed") | odd)


def _plainly_odd() -> Column:
    odd = F.col("odd")
    for i in range(PLAIN_TURNS):
        odd = odd != F.coalesce(F.col("y") < F.col(f"turn{i}"), F.lit(False))
    for i in range(PLAIN_EDGES):
        odd = odd != F.coalesce(_crosses(F.col(f"edge{i}")), F.lit(False))
    return odd


def _odd_by_lists() -> Column:
    y = F.col("y")
    strip = F.floor((y / cell_size(F.col("level")) - F.col("cy")) * F.size("strips")).cast("int")
    strip = F.get("strips", F.least(strip, F.size("strips") - 1))
    return (F.col("odd") != _odd(F.filter("turns", lambda t: y < t))) != _odd(F.filter(strip, _crosses))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def within_areas(points: DataFrame, areas: DataFrame, lon: str, lat: str, area_id: str, wkt: str) -> DataFrame:
    """A row per point and area that holds it: all columns of ``points``, and
    ``area_id``.  ``points`` must not have a column of that name."""
    if area_id in points.columns:
        raise ValueError(f"points already have a column {area_id!r}")
    # A table of areas is small as a file and large as cells: dealt out before its texts are parsed.
    slots = int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written: each is used twice.
    edges = _written(area_edges(areas.repartition(slots, F.col(f"`{area_id}`")), area_id, wkt), "area-edges")
    covered = _written(cover(edges, edge_bands(edges)), "area-cells")
    levels = {r["plain"]: r["levels"] for r in covered.groupBy("plain").agg(F.collect_set("level").alias("levels")).collect()}   # one for each size of area, some 60 at most
    own = [F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(points.columns)]
    x, y = F.col(f"`{lon}`").cast("double"), F.col(f"`{lat}`").cast("double")
    at = points.where(x.isNotNull() & y.isNotNull()).select(*own, x.alias("x"), y.alias("y"))

    def met(is_plain: bool) -> DataFrame:
        known = F.array(*[F.lit(v) for v in sorted(levels.get(is_plain, []))]).cast("array<int>")
        placed = at.select("*", F.explode(known).alias("level"))
        placed = placed.select("*", _cell(F.col("x")).alias("cx"), _cell(F.col("y")).alias("cy"))
        # Merged, not broadcast: a row meets many, so it is the join that has to be dealt out.
        some = placed.join(covered.where("plain" if is_plain else "NOT plain").hint("merge"), ["level", "cx", "cy"])
        some = some.where(_is_inside(_plainly_odd() if is_plain else _odd_by_lists()))
        return some.select(*[F.col(f"own{i}").alias(c) for i, c in enumerate(points.columns)], F.col("area").alias(area_id))

    return met(True).unionAll(met(False)) if False in levels else met(True)
