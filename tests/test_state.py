"""Distinct-day bitmaps, the incremental month state and ranks by range partitions."""

import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dryspell.operators import accumulate, incremental
from dryspell.operators.ranking import rank_in_group, ranges_of

DAILY = "code string, year int, month int, day int, precip double"


def some_daily(seed, n=4000, years=(1899, 1999, 2000, 2001)):
    rng = random.Random(seed)
    rows = [(str(rng.randint(1, 6)), rng.choice(years), rng.randint(1, 12), rng.randint(1, 31),
             float(rng.randint(0, 50))) for _ in range(n)]
    return rows + rows[:50] + [(None, 2000, 1, 1, 1.0), ("1", None, 1, 1, 1.0)]


def totals(rows, key):
    out = defaultdict(lambda: [0, set(), 0.0])
    for r in rows:
        if None not in r[:2] and r[1] >= 1900:
            t = out[tuple(r[:key])]
            t[0] += 1
            t[1].add(r[2:4])
            t[2] += r[4]
    return {k: (n, len(days), p) for k, (n, days, p) in out.items()}


def flat(df, keys):
    return {tuple(r[k] for k in keys): (r.days, r.distinct_days, r.precip) for r in df.collect()}


def test_distinct_days_equal_brute_force(spark):
    rows = some_daily(1)
    got = flat(accumulate.yearly_distinct_days(spark.createDataFrame(rows, DAILY), min_days=None), ["code", "year"])
    assert got == totals(rows, 2)
    least = sorted(v[1] for v in got.values())[len(got) // 2]
    kept = flat(accumulate.yearly_distinct_days(spark.createDataFrame(rows, DAILY), min_days=least), ["code", "year"])
    assert kept == {k: v for k, v in got.items() if v[1] >= least}


def test_distinct_days_of_every_day_and_of_bad_days(spark):
    rows = [("1", 2000, m, d, 1.0) for m in range(1, 13) for d in range(1, 32)] * 2
    got = accumulate.yearly_distinct_days(spark.createDataFrame(rows, DAILY), min_days=None).first()
    assert (got.days, got.distinct_days) == (744, 372)
    gap = accumulate.yearly_distinct_days(spark.createDataFrame([("1", 2000, 3, None, 1.0)], DAILY), min_days=None).first()
    assert (gap.days, gap.distinct_days) == (1, 0)
    for bad in (("1", 2000, 13, 1, 1.0), ("1", 2000, 1, 0, 1.0), ("1", 2000, 1, 32, 1.0)):
        with pytest.raises(Exception, match="out of range"):
            accumulate.yearly_distinct_days(spark.createDataFrame([bad], DAILY), min_days=None).collect()


def test_distinct_days_combine_before_the_shuffle(spark):
    df = accumulate.yearly_distinct_days(spark.createDataFrame(some_daily(2, 100), DAILY), min_days=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_or" in plan and "Expand" not in plan


def listing(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs}


def test_loads_equal_one_full_run(spark, tmp_dir):
    rows, path = some_daily(3), f"{tmp_dir}/state"
    loads = {"a": rows[:1500], "b": rows[1500:1600], "c": rows[1600:]}
    for name, part in loads.items():
        assert incremental.apply_load(spark, path, spark.createDataFrame(part, DAILY), name)
    state = incremental.read_state(spark, path)
    assert flat(incremental.yearly_of(state, min_days=None), ["code", "year"]) == totals(rows, 2)
    assert flat(incremental.monthly_of(state), ["code", "year", "month"]) == totals(rows, 3)
    full = incremental.month_state(spark.createDataFrame(rows, DAILY))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, full.collect()))
    days = sorted(v[1] for v in totals(rows, 2).values())[5]
    by_days = incremental.yearly_of(state, min_days=days, distinct=True)
    assert flat(by_days, ["code", "year"]) == {k: v for k, v in totals(rows, 2).items() if v[1] >= days}


def test_replay_changes_nothing(spark, tmp_dir):
    path, df = f"{tmp_dir}/state", spark.createDataFrame(some_daily(4, 200), DAILY)
    assert incremental.apply_load(spark, path, df, "a")
    before = listing(path)
    assert not incremental.apply_load(spark, path, df, "a")
    assert listing(path) == before


def test_only_touched_years_are_written(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    incremental.apply_load(spark, path, spark.createDataFrame(some_daily(5, 500), DAILY), "a")
    before = listing(path)
    late = [("1", 2001, 5, 6, 2.0), ("9", 2003, 1, 1, 4.0)]
    incremental.apply_load(spark, path, spark.createDataFrame(late, DAILY), "b")
    new = set(listing(path)) - set(before)
    assert all(listing(path)[f] == t for f, t in before.items())
    years = {p.split("year=")[1].split("/")[0] for p in new if "/data/" in p and "year=" in p}
    assert years == {"2001", "2003"}
    assert flat(incremental.yearly_of(incremental.read_state(spark, path), min_days=None), ["code", "year"]) == \
        totals(some_daily(5, 500) + late, 2)
    some = incremental.read_state(spark, path, [2003])
    assert [tuple(r) for r in some.collect()] == [("9", 1, 1, 4.0, 2, 2003)]
    assert "PartitionFilters: [" in some._jdf.queryExecution().executedPlan().toString()


def test_a_load_that_dies_leaves_the_state_as_it_was(spark, tmp_dir):
    path, rows = f"{tmp_dir}/state", some_daily(6, 300)
    incremental.apply_load(spark, path, spark.createDataFrame(rows, DAILY), "a")
    # The second load wrote its years, then died before its commit.
    wrong = incremental.month_state(spark.createDataFrame([("1", 2000, 1, 1, 1e9), ("z", 1999, 1, 1, 1e9)], DAILY))
    wrong.write.partitionBy("year").parquet(f"{path}/data/version=2")
    assert flat(incremental.yearly_of(incremental.read_state(spark, path), min_days=None), ["code", "year"]) == totals(rows, 2)
    more = [("1", 2000, 2, 2, 3.0)]
    assert incremental.apply_load(spark, path, spark.createDataFrame(more, DAILY), "b")
    assert flat(incremental.yearly_of(incremental.read_state(spark, path), min_days=None), ["code", "year"]) == \
        totals(rows + more, 2)


def test_empty_state_and_empty_load(spark, tmp_dir):
    path, none = f"{tmp_dir}/state", spark.createDataFrame([], DAILY)
    assert incremental.read_state(spark, path).count() == 0
    assert incremental.apply_load(spark, path, none, "a") and not incremental.apply_load(spark, path, none, "a")
    assert incremental.read_state(spark, path).count() == 0


def test_ranks_equal_a_window(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(30)]),
             rng.random()) for _ in range(3000)] + [("hot", 7, 0.5)] * 1000
    df = spark.createDataFrame(rows, "g string, k int, v double")
    got = rank_in_group(df, ["g"], ["k", "v"], ranges=16).collect()
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(r)
    for g, part in want.items():
        part.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [tuple(r)[:3] for r in sorted((r for r in got if r.g == g), key=lambda r: r.rank)] == part
        assert sorted(r.rank for r in got if r.g == g) == list(range(1, len(part) + 1))


def test_ranks_spread_one_hot_group(spark):
    """No range holds much more than its share, though half of the rows are equal and all are one group."""
    df = spark.range(40000).select(F.lit("x").alias("g"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    got = rank_in_group(df, ["g"], ["k"], ranges=20)
    sizes = [r["count"] for r in ranges_of(df, ["g"], ["k"], 20).groupBy("_range").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3 * 40000 / 20
    assert got.agg(F.count("rank"), F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (40000, 1, 40000, 40000)
    with pytest.raises(ValueError):
        rank_in_group(df, ["g"], ["k"], rank="k")
