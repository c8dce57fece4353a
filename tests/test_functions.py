"""Column expressions against the FIXTURES.md golden cases."""

import math

import pytest
from pyspark.sql import functions as F

from dryspell.functions import (
    canonical_code, composite_key, date_label_parts, is_missing, key_part, natural_zone_name,
    normal_pdf, standardize, utm_easting_northing, zone_label, zone_number,
)
from dryspell.functions.geo import segment_distance_sq


def test_canonical_code(spark):
    rows = [("0012",), ("000",), ("12A",), ("00B6-0360",), ("",), ("0" * 30 + "7",)]
    got = spark.createDataFrame(rows, "c string").select(canonical_code("c").alias("f")).collect()
    assert [r.f for r in got] == ["12", "0", "12A", "00B6-0360", "", "7"]


def test_sentinel_truncates_toward_zero(spark):
    vals = ["-9999", "-9999.000", "-9999.7", "-9998.9", "0", "3.5", "1e10", "1e20", "-10000", "-9999.9999999"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.m for r in df.select(is_missing("v").alias("m")).collect()]
    assert got == [True, True, True, False, False, False, False, False, False, True]
    # the same rule for other sentinels, against Python's truncation
    for sentinel in (0, 5, -3):
        xs = [-4.0, -3.5, -3.0, -2.5, -0.5, 0.0, 0.5, 4.9, 5.0, 5.5, 6.0]
        d = spark.createDataFrame([(x,) for x in xs], "v double")
        got = [r.m for r in d.select(is_missing("v", sentinel).alias("m")).collect()]
        assert got == [int(x) == sentinel for x in xs]


def test_text_that_is_no_number_is_not_missing_and_fails_the_parse(spark):
    from dryspell.functions.values import parse_value
    for text in ("", "abc", "NaN", "-Infinity"):
        df = spark.createDataFrame([(text,)], "v string")
        assert df.select(is_missing("v").alias("m")).first().m is False
        with pytest.raises(Exception):
            df.select(parse_value("v")).collect()
    assert spark.createDataFrame([(None,)], "v string").select(is_missing("v").alias("m")).first().m is True


def test_composite_key_roundtrip(spark):
    df = spark.createDataFrame([("330020", 2000, 3)], "code string, year int, month int")
    r = df.select(composite_key("code", "year", "month").alias("k")).select(
        "k", key_part("k", 1).alias("c"), key_part("k", 3).alias("m")).first()
    assert r.k == "330020##2000##3" and r.c == "330020" and r.m == "3"
    # a NULL part makes the whole key NULL (concat, not concat_ws)
    df2 = spark.createDataFrame([("1", None)], "code string, year int")
    assert df2.select(composite_key("code", "year").alias("k")).first().k is None


def test_date_parts(spark):
    y, m, d = date_label_parts(F.lit("2000-01-03"))
    r = spark.range(1).select(y.alias("y"), m.alias("m"), d.alias("d")).first()
    assert (r.y, r.m, r.d) == (2000, 1, 3)


@pytest.mark.parametrize("lat,name", [
    (-17.8, "Norte Grande"), (-17.7, None), (-28.0, "Norte Chico"), (-27.99, "Norte Grande"),
    (-32.0, "Centro"), (-37.0, "Sur"), (-43.5, "Austral"), (-56.0, "Austral"), (-56.01, None)])
def test_natural_bands(spark, lat, name):
    r = spark.createDataFrame([(lat,)], "lat double").select(natural_zone_name("lat").alias("z")).first()
    assert r.z == name


def test_zone_number_and_label(spark):
    df = spark.createDataFrame([("Centro",), ("Atlantis",), (None,)], "n string")
    got = df.select(zone_number("n").alias("z"), zone_label(zone_number("n")).alias("l")).collect()
    assert [(r.z, r.l) for r in got] == [(3, "Centro"), (0, None), (0, None)]


def test_standardize_and_pdf(spark):
    df = spark.createDataFrame([(200.0, 250.0, 111.80339887498948), (50.0, 50.0, 0.0)],
                               "x double, mu double, sd double")
    got = df.select(standardize("x", "mu", "sd").alias("z"), normal_pdf("x", "mu", "sd").alias("p")).collect()
    assert got[0].z == pytest.approx(-0.447214, abs=1e-6)
    assert got[0].p == pytest.approx(math.exp(-0.1) / (111.80339887498948 * math.sqrt(2 * math.pi)))
    assert got[1].z is None and got[1].p is None


def test_utm_golden(spark):
    df = spark.createDataFrame([(-33.45, -70.66), (-20.0, -69.0), (-40.0, -69.0)], "lat double, lon double")
    e, n = utm_easting_northing("lat", "lon")
    got = df.select(e.alias("e"), n.alias("n")).collect()
    assert got[0].e == pytest.approx(345713.154, abs=1e-3)
    assert got[0].n == pytest.approx(6297592.028, abs=1e-3)
    assert got[1].e == pytest.approx(500000.0, abs=1e-6)
    assert got[2].e == pytest.approx(500000.0, abs=1e-6)


def test_segment_distance(spark):
    rows = [(2.0, 5.0, 3.0, 0.0, 3.0, 10.0), (-3.0, -4.0, 0.0, 0.0, 0.0, 10.0), (1.0, 1.0, 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "px double, py double, ax double, ay double, bx double, by double")
    got = [r.d for r in df.select(segment_distance_sq("px", "py", "ax", "ay", "bx", "by").alias("d")).collect()]
    assert got == [1.0, 25.0, 2.0]


def test_band_and_filter_bounds(spark):
    from dryspell.operators.ingest import station_filter
    rows = [(lat, lon, inst) for lat in (-18.0, -18.1, -54.99, -55.0) for lon in (-76.0, -75.9, -66.0, -66.1)
            for inst in ("DGA", "GHCN", None)]
    df = spark.createDataFrame(rows, "lat double, lon double, inst string")
    for r in df.select("*", station_filter("inst", "lat", "lon").alias("k")).collect():
        assert r.k == (r.inst != "GHCN" and -55.0 < r.lat < -18.0 and -76.0 < r.lon < -66.0)
