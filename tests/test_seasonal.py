"""Seasonal SPI against plain Python, text geometry, and joins of stored tables."""

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dryspell.functions import distributions as D
from dryspell.operators import colocated, seasonal, stats as ST
from dryspell.sources import wkt

MONTHLY = "code string, year int, month int, precip double"
VERTICES = "region int, feature_id int, seq int, x double, y double"


def gamma_cdf(a, x):
    """Series below a + 1, Lentz's continued fraction above."""
    if x <= 0:
        return 0.0
    head = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return head * total
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - head * h


def test_distributions_equal_numeric_references(spark):
    rng = random.Random(3)
    rows = [(a, a * rng.choice([0.001, 0.1, 0.5, 0.9, 1.0, 1.1, 2.0, 5.0])) for a in
            [0.05, 0.3, 0.99, 1.0, 1.5, 2.0, 7.3, 40.0, 333.3, 5000.0] for _ in range(12)] + [(2.0, 0.0), (2.0, -1.0), (0.5, 300.0)]
    df = spark.createDataFrame(rows, "a double, x double")
    for r in df.select("a", "x", F.expr(D.gamma_cdf_sql("a", "x")).alias("p"), F.expr(D.ln_gamma_sql("a")).alias("g")).collect():
        assert r.p == pytest.approx(gamma_cdf(r.a, r.x), rel=1e-9, abs=1e-300), (r.a, r.x)
        assert r.g == pytest.approx(math.lgamma(r.a), rel=1e-12, abs=1e-12)
    ps = [2.0 ** -53, 1e-12, 1e-5, 0.02, 0.075, 0.3, 0.5, 0.7, 0.925, 0.98, 0.999999, 1 - 2.0 ** -53]
    for r in spark.createDataFrame([(p,) for p in ps], "p double").select("p", F.expr(D.normal_quantile_sql("p")).alias("z")).collect():
        assert r.z == pytest.approx(statistics.NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-12)


def some_months(seed):
    rng = random.Random(seed)
    return [(code, 1990 + t // 12, t % 12 + 1, 0.0 if rng.random() < 0.3 else rng.gammavariate(1.3, 40))
            for code in ("a", "b", "c") for t in range(240) if rng.random() < 0.93]


@pytest.mark.parametrize("k", [1, 3, 7])
def test_seasonal_spi_equals_plain_python(spark, k):
    rows = some_months(k)
    value = {(c, y * 12 + m - 1): p for c, y, m, p in rows}
    total = {(c, t): sum(value[c, t - i] for i in range(k)) if all((c, t - i) in value for i in range(k)) else None
             for c, t in value}
    per = defaultdict(list)
    for (c, t), x in total.items():
        if x is not None:
            per[t % 12 + 1].append(x)
    sums = seasonal.running_sums(spark.createDataFrame(rows, MONTHLY), k)
    got = seasonal.seasonal_spi(sums, ["month"]).collect()
    assert len(got) == len(rows)
    for r in got:
        x = total[r.code, r.year * 12 + r.month - 1]
        assert (r.total is None) == (x is None)
        if x is None:
            assert r.spi is None
            continue
        positive = [v for v in per[r.month] if v > 0]
        a = math.log(statistics.fmean(positive)) - statistics.fmean(map(math.log, positive))
        shape = (1 + math.sqrt(1 + 4 * a / 3)) / (4 * a)
        q = 1 - len(positive) / len(per[r.month])
        h = q + (1 - q) * gamma_cdf(shape, x * shape / statistics.fmean(positive))
        want = statistics.NormalDist().inv_cdf(min(max(h, 2.0 ** -53), 1 - 2.0 ** -53))
        assert r.total == pytest.approx(x) and r.spi == pytest.approx(want, abs=1e-6)


def test_gaps_years_and_fits_without_spread(spark):
    rows = [("a", 2000, 11, 1.0), ("a", 2000, 12, 2.0), ("a", 2001, 1, 4.0), ("a", 2001, 3, 8.0), ("b", 2000, 12, 5.0)]
    got = {(r.code, r.year, r.month): r.total for r in seasonal.running_sums(spark.createDataFrame(rows, MONTHLY), 3).collect()}
    assert got == {("a", 2000, 11): None, ("a", 2000, 12): None, ("a", 2001, 1): 7.0, ("a", 2001, 3): None, ("b", 2000, 12): None}
    with pytest.raises(ValueError):
        seasonal.running_sums(spark.createDataFrame(rows, MONTHLY), 0)
    flat = spark.createDataFrame([("a", 2000 + i, 1, 3.0) for i in range(9)] + [("a", 2000 + i, 2, 0.0) for i in range(9)]
                                 + [("a", 2000, 3, 1.0)], MONTHLY)
    assert {r.spi for r in seasonal.seasonal_spi(seasonal.running_sums(flat, 1), ["month"]).collect()} == {None}
    assert seasonal.seasonal_spi(seasonal.running_sums(flat.limit(0), 2), ["month"]).count() == 0
    steady = spark.createDataFrame([("a", 1000 + i, 1, 1e6 + i) for i in range(-50, 51)], MONTHLY)
    spi = sorted(r.spi for r in seasonal.seasonal_spi(seasonal.running_sums(steady, 1), ["month"]).collect())
    assert spi[50] == pytest.approx(0, abs=1e-3) and -1.8 < spi[0] < -1.6 and 1.6 < spi[-1] < 1.8


def test_moments_merge(spark):
    keys = ["month"]
    sums = seasonal.running_sums(spark.createDataFrame(some_months(5), MONTHLY), 2)
    parts = [seasonal.gamma_moments(sums.where(f"code {op} 'a'"), keys) for op in ("=", "<>")]
    both = parts[0].unionByName(parts[1]).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("n", "zeros", "positive", "log_total")))
    whole = {r.month: r for r in seasonal.gamma_fit(seasonal.gamma_moments(sums, keys), keys).collect()}
    for r in seasonal.gamma_fit(both, keys).collect():
        assert r.shape == pytest.approx(whole[r.month].shape, rel=1e-9)


# text geometry

def parse(spark, *texts):
    df = spark.createDataFrame([(1, 10 * i, t) for i, t in enumerate(texts)], wkt.WKT_LINES)
    return sorted(tuple(r) for r in wkt.vertices_of_wkt(df).collect())


def test_wkt_lines(spark):
    assert parse(spark, "LINESTRING (1 2, 3.5 -4e2, +.5 6.)") == [(1, 0, 0, 1.0, 2.0), (1, 0, 1, 3.5, -400.0), (1, 0, 2, 0.5, 6.0)]
    assert parse(spark, "  multilinestring( ( 1 2 ,3 4 ) , (5\t6,\n7 8) ) ") == [
        (1, 0, 0, 1.0, 2.0), (1, 0, 1, 3.0, 4.0), (1, 1, 0, 5.0, 6.0), (1, 1, 1, 7.0, 8.0)]
    assert parse(spark, "LINESTRING EMPTY", "MultiLineString  empty ", "LineString(1 1,2 2)") == [
        (1, 20, 0, 1.0, 1.0), (1, 20, 1, 2.0, 2.0)]
    assert parse(spark) == []


@pytest.mark.parametrize("bad", [
    None, "", "POINT (1 2)", "LINESTRING 1 2, 3 4", "LINESTRING (1 2, 3 4", "LINESTRING (1 2, 3 4))", "LINESTRING ((1 2, 3 4))",
    "LINESTRING (1 2)", "LINESTRING ()", "LINESTRING (1 2, )", "LINESTRING (1 2 3, 4 5 6)", "LINESTRING Z (1 2, 3 4)",
    "LINESTRING (1 2, a b)", "LINESTRING (1 2, NaN 4)", "LINESTRING (1 2, 3 4) x", "MULTILINESTRING (1 2, 3 4)",
    "MULTILINESTRING ((1 2, 3 4)(5 6, 7 8))", "MULTILINESTRING ((1 2, 3 4), (5 6))", "MULTILINESTRING ((1 2, 3 4), 5 6)",
    "LINESTRING (1 2, 3 4), (5 6, 7 8)", "LINESTRING (1 2, 1e 4)", "LINESTRINGS (1 2, 3 4)", "LINESTRING EMPTY (1 2, 3 4)"])
def test_wkt_that_is_none_fails(spark, bad):
    with pytest.raises(Exception, match="USER_RAISED|not a |line of one"):
        parse(spark, "LINESTRING (0 0, 1 1)", bad)


def test_wkt_round_trip_of_a_long_line(spark):
    rng = random.Random(2)
    rows = [(3, f, i, rng.uniform(-1e7, 1e7), rng.uniform(-1e-7, 1e7)) for f in range(4) for i in range(2 if f else 50000)]
    df = spark.createDataFrame(rows, VERTICES)
    text = wkt.wkt_of_features(df, 3)
    assert text.count() == 2
    assert sorted(tuple(r) for r in wkt.vertices_of_wkt(text).collect()) == sorted(rows)


# stored tables

def test_stored_tables_join_without_an_exchange(spark):
    rng = random.Random(1)
    yearly = spark.createDataFrame([(str(rng.randint(1, 60)), 1990 + i % 20, 100, rng.random()) for i in range(2000)],
                                   "code string, year int, days bigint, precip double")
    stations = spark.createDataFrame([(f"{c:08d}", -30.0 - c, -70.0) for c in range(1, 55)] + [("7", 0.0, 0.0)],
                                     "code string, lat double, lon double")
    lookup = spark.createDataFrame([(str(c), c % 5) for c in range(1, 40)], "code string, zone int")
    stored = colocated.store_for_climatology(yearly, stations, lookup, buckets=6)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = colocated.climatology_of_stored(*stored)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        totals = stored[0].groupBy("code", "year").agg(F.sum("precip"))
        assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = ST.station_climatology(yearly, stations, lookup)
    assert [r[0] for r in got] == [r[0] for r in sorted(map(tuple, want.collect()))]
    assert got == [pytest.approx(r) for r in sorted(map(tuple, want.collect()))] or all(
        a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2:] == b[2:] for a, b in zip(got, sorted(map(tuple, want.collect()))))
