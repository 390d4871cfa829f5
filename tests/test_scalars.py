import math

import pytest

from occurrence_lake.functions.scalars import make_date_strict, narrow_to_int, zero_as_null


def test_zero_as_null(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,), (2.5,)], "v double")
    out = [r.v for r in df.select(zero_as_null("v").alias("v")).collect()]
    assert out[0] is None and out[1] is None and math.isnan(out[2]) and out[3] is None and out[4] == 2.5


def test_make_date(spark):
    df = spark.createDataFrame([(2020, 2, 29), (2021, 1, None), (None, 3, 4)], "y long, m long, d long")
    out = [r.d for r in df.select(make_date_strict("y", "m", "d").alias("d")).collect()]
    assert str(out[0]) == "2020-02-29" and out[1] is None and out[2] is None


def test_make_date_impossible_raises(spark):
    df = spark.createDataFrame([(2020, 2, 30)], "y long, m long, d long")
    with pytest.raises(Exception):
        df.select(make_date_strict("y", "m", "d")).collect()


def test_narrow_to_int(spark):
    ok = spark.createDataFrame([(7,), (2 ** 31 - 1,)], "k long")
    assert [r.k for r in ok.select(narrow_to_int("k").alias("k")).collect()] == [7, 2 ** 31 - 1]
    for bad in ([(3000000000,)], [(None,)]):
        df = spark.createDataFrame(bad, "k long")
        with pytest.raises(Exception) as e:
            df.select(narrow_to_int("k", "taxon_key")).collect()
        if bad[0][0] is not None:
            assert "CAST_OVERFLOW" in str(e.value)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_ansi(spark, ansi):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad_date = spark.createDataFrame([(2020, 2, 30)], "y long, m long, d long")
        with pytest.raises(Exception):
            bad_date.select(make_date_strict("y", "m", "d")).collect()
        big = spark.createDataFrame([(3000000000,)], "k long")
        with pytest.raises(Exception):
            big.select(narrow_to_int("k")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_lenient_dates_and_kept_zeros(spark):
    from occurrence_lake.functions.scalars import make_date_strict
    from occurrence_lake.operators.refine import serving_occurrences
    rows = spark.createDataFrame([(2020, 2, 29), (2021, 2, 29), (2021, 13, 1), (None, 1, 1), (2021, 1, 9)], "y long, m long, d long")
    got = [str(r[0]) for r in rows.select(make_date_strict("y", "m", "d", strict=False)).collect()]
    assert got == ["2020-02-29", "None", "None", "None", "2021-01-09"]
    geo = spark.sql("SELECT '1' AS gbif_id, 5L AS taxon_key, X'00' AS coordinates, 0e0 AS coordinate_uncertainty_in_meters, 0e0 AS coordinate_precision, "
                    "0e0 AS elevation, 1e0 AS elevation_accuracy, 0e0 AS depth, 0e0 AS depth_accuracy, DATE'2020-01-01' AS date")
    assert serving_occurrences(geo).first().depth is None
    assert serving_occurrences(geo, zeros_as_null=False).first().depth == 0.0
