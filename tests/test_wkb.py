import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from occurrence_lake.functions import wkb as W
from occurrence_lake.operators.multipoint import species_all_occurrence


def _hex(b):
    return None if b is None else bytes(b).hex().upper()


def test_point_literal(spark):
    df = spark.createDataFrame([(6.5, 45.25)], "lon double, lat double")
    assert _hex(W.with_point_wkb(df, "lon", "lat", "w").first().w) == "01010000000000000000001A400000000000A04640"


def test_point_null_coordinate(spark):
    df = spark.createDataFrame([(None, 45.0), (6.0, None)], "lon double, lat double")
    assert [r.w for r in W.with_point_wkb(df, "lon", "lat", "w").collect()] == [None, None]


def _expected(lon, lat):
    return struct.pack("<BIdd", 1, 1, lon, lat).hex().upper()


def test_point_bits_edge_values(spark):
    vals = [0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 2.0 ** -1022, 5e-324, 1e-310, 1.7976931348623157e308,
            -3.75, float("inf"), float("-inf"), 4.733, 45.25, 0.1, 1 / 3]
    vals += [2.0 ** k for k in range(-1074, 1024, 37)]
    vals += [math.nextafter(2.0 ** k, 0.0) for k in range(-1000, 1000, 41)]
    rows = [(v, -v / 3.0) for v in vals]
    df = spark.createDataFrame(rows, "lon double, lat double")
    out = W.with_point_xy(W.with_point_wkb(df, "lon", "lat", "w"), "w", "x", "y").collect()
    for r in out:
        assert _hex(r.w) == _expected(r.lon, r.lat)
        assert struct.pack("<dd", r.x, r.y) == struct.pack("<dd", r.lon, r.lat)


def test_nan_is_canonical(spark):
    df = spark.createDataFrame([(float("nan"), 2.0)], "lon double, lat double")
    assert _hex(W.with_point_wkb(df, "lon", "lat", "w").first().w) == \
        "0101000000" + "000000000000F87F" + "0000000000000040"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=True), min_size=1, max_size=40))
def test_point_roundtrip_property(spark, values):
    rows = [(v, values[-1 - i]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    out = W.with_point_xy(W.with_point_wkb(df, "lon", "lat", "w"), "w", "x", "y").collect()
    for r in out:
        assert _hex(r.w) == _expected(r.lon, r.lat)
        assert struct.pack("<dd", r.x, r.y) == struct.pack("<dd", r.lon, r.lat)


def test_multipoint_literal_and_empty(spark):
    rows = [(1, "a", 6.5, 45.25), (1, "b", 1.0, 2.0), (2, "c", None, 3.0)]
    df = spark.createDataFrame(rows, "taxon_key long, gbif_id string, lon double, lat double")
    pts = W.with_point_wkb(df, "lon", "lat", "coordinates")
    got = {r.taxon_key: _hex(r.all_occurrence_coordinates) for r in species_all_occurrence(pts).collect()}
    p1 = "01010000000000000000001A400000000000A04640"              # little-endian bytes:
    p2 = "0101000000" + "000000000000F03F" + "0000000000000040"   # ...1A40 < ...F03F
    assert got[1] == "010400000002000000" + p1 + p2
    assert got[2] == "010400000000000000"


def test_multipoint_decode(spark):
    rows = [(1, str(i), random.Random(i).uniform(4, 8), random.Random(-i).uniform(44, 47)) for i in range(50)]
    df = spark.createDataFrame(rows, "taxon_key long, gbif_id string, lon double, lat double")
    sp = species_all_occurrence(W.with_point_wkb(df, "lon", "lat", "coordinates"))
    row = sp.select(W.multipoint_count("all_occurrence_coordinates").alias("n"),
                    W.multipoint_is_valid("all_occurrence_coordinates").alias("ok")).first()
    assert row.n == 50 and row.ok
    pts = sp.select(F.explode(W.multipoint_points("all_occurrence_coordinates")).alias("p"))
    dec = W.with_point_xy(pts, "p", "x", "y").collect()
    assert sorted((r.x, r.y) for r in dec) == sorted((r[2], r[3]) for r in rows)


def test_point_validity(spark):
    df = spark.createDataFrame([(bytes.fromhex("01010000000000000000001A400000000000A04640"),),
                                (bytes.fromhex("0101"),),
                                (bytes.fromhex("010400000000000000"),)], "w binary")
    assert [r.ok for r in df.select(W.point_is_valid("w").alias("ok")).collect()] == [True, False, False]


def test_require_valid_and_typed_metadata(spark):
    import pytest
    good = spark.createDataFrame([(bytes.fromhex("01010000000000000000001A400000000000A04640"),), (None,)], "w binary")
    assert W.require_valid(good, "w", "Point").count() == 2
    bad = spark.createDataFrame([(bytes.fromhex("0101000000"),)], "w binary")
    with pytest.raises(Exception):
        W.require_valid(bad, "w", "Point").collect()
    mp = spark.createDataFrame([(bytes.fromhex("010400000000000000"),)], "w binary")
    assert W.require_valid(mp, "w", "MultiPoint").count() == 1
    typed = good.select(W.typed_geometry("w", "Point"))
    assert typed.schema["w"].metadata == {"encoding": "WKB", "geometry_type": "Point", "srid": 4326}


def test_decode_big_endian_input(spark):
    be = struct.pack(">BIdd", 0, 1, 6.5, -45.25)
    df = spark.createDataFrame([(be,)], "w binary")
    r = W.with_point_xy(df, "w", "x", "y").first()
    assert (r.x, r.y) == (6.5, -45.25)
    assert df.select(W.point_is_valid("w").alias("ok")).first().ok


def test_every_member_of_a_multipoint_is_checked(spark):
    import struct

    def point(order, kind=1):
        return struct.pack("<BIdd" if order else ">BIdd", order, kind, 6.5, 45.25)

    def multi(order, *members, n=None):
        return struct.pack("<BII" if order else ">BII", order, 4, len(members) if n is None else n) + b"".join(members)

    good = [multi(1), multi(0), multi(1, point(1), point(0)), multi(0, point(0), point(1), point(1))]
    bad = [multi(1, point(1), point(1, 2)), multi(0, point(2)[:1] + point(0)[1:]), multi(1, point(1)[:1] + point(0)[1:]), multi(1, point(1), n=2), multi(1, point(1), n=0),
           point(1), multi(1, point(1))[:8], b"", multi(1, point(1, 0x20000001))]
    df = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate(good + bad)], "i int, w binary")
    got = {r.i: r.ok for r in df.select("i", W.multipoint_is_valid("w").alias("ok")).collect()}
    assert [bool(got[i]) for i in range(len(got))] == [True] * len(good) + [False] * len(bad)
    assert W.require_valid(df.where(f"i < {len(good)}"), "w", "MultiPoint").where("w IS NOT NULL").count() == len(good)
    for i in range(len(good), len(good) + len(bad)):
        with pytest.raises(Exception, match="not a valid WKB MultiPoint"):
            W.require_valid(df.where(f"i = {i}"), "w", "MultiPoint").collect()
    points = df.where("i = 3").select(F.explode(W.multipoint_points("w")).alias("p"))
    assert {(r.lon, r.lat) for r in W.with_point_xy(points, "p").collect()} == {(6.5, 45.25)}
