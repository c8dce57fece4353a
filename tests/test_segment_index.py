"""The stored segment index: equal to a fresh search, updated in place, read below the finest level only."""

import math
import os
import random

import pytest

from dryspell.operators import segment_index as I
from dryspell.operators.boundaries import segments
from dryspell.operators.nearest import nearest_by_grid

SEGS = "region int, ax double, ay double, bx double, by double"
POINTS = "id bigint, x double, y double"


def some_segments(rng, n, x=(0.0, 1000.0), size=20.0):
    out = []
    for _ in range(n):
        ax, ay = rng.uniform(*x), rng.uniform(*x)
        out.append((rng.randint(0, 5), ax, ay, ax + rng.uniform(-size, size), ay + rng.uniform(-size, size)))
    return out


def distance(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    u = 0 if dx == dy == 0 else max(0, min(1, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
    return math.hypot(px - ax - u * dx, py - ay - u * dy)


def check(spark, path, points, segs):
    got = {r.id: r for r in I.nearest_with_index(spark.createDataFrame(points, POINTS), path, point_keys=["id"]).collect()}
    assert len(got) == len(points)
    for i, px, py in points:
        per = {}
        for region, *s in segs:
            per[region] = min(per.get(region, math.inf), distance(px, py, *s))
        best = min(per.values())
        assert math.sqrt(got[i].d2) == pytest.approx(best, rel=1e-9, abs=1e-9)
        assert per[got[i].region] == pytest.approx(best, rel=1e-9, abs=1e-9)


def listing(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs}


def test_additions_far_points_and_growing_extents(spark, tmp_dir):
    rng, path = random.Random(1), f"{tmp_dir}/index"
    segs = some_segments(rng, 60)
    points = [(i, rng.uniform(-100, 1100), rng.uniform(-100, 1100)) for i in range(60)]
    points += [(100, 1e6, -1e6), (101, -5e4, 3.0)]
    assert I.add_segments(spark, path, spark.createDataFrame(segs, SEGS), "a")
    check(spark, path, points, segs)
    more = some_segments(rng, 30) + some_segments(rng, 10, x=(5000.0, 6000.0)) + some_segments(rng, 5, x=(-9e4, 0.0))
    assert I.add_segments(spark, path, spark.createDataFrame(more, SEGS), "b")
    check(spark, path, points, segs + more)
    fresh = {r.id: r.d2 for r in nearest_by_grid(spark.createDataFrame(points, POINTS), spark.createDataFrame(segs + more, SEGS),
                                                 point_keys=["id"], tag="region").collect()}
    again = I.nearest_with_index(spark.createDataFrame(points, POINTS), path, point_keys=["id"]).collect()
    assert {r.id: pytest.approx(r.d2) for r in again} == fresh


def test_replays_and_untouched_tiles(spark, tmp_dir):
    rng, path = random.Random(2), f"{tmp_dir}/index"
    segs = some_segments(rng, 80, size=5.0)
    assert I.add_segments(spark, path, spark.createDataFrame(segs, SEGS), "a")
    before = listing(path)
    assert not I.add_segments(spark, path, spark.createDataFrame(segs, SEGS), "a")
    assert listing(path) == before
    corner = [(9, 3.0, 3.0, 4.0, 4.0)]
    assert I.add_segments(spark, path, spark.createDataFrame(corner, SEGS), "b")
    assert all(listing(path)[f] == t for f, t in before.items())
    tiles = {c["load"]: set(c["tiles"]) for c in I.commits(spark, path)}
    assert tiles["b"] < tiles["a"] | tiles["b"] and len(tiles["b"]) <= 5
    check(spark, path, [(1, 3.5, 3.4), (2, 500.0, 500.0)], segs + corner)


def test_an_addition_that_dies_is_not_read(spark, tmp_dir):
    path, segs = f"{tmp_dir}/index", some_segments(random.Random(3), 20)
    I.add_segments(spark, path, spark.createDataFrame(segs, SEGS), "a")
    # A second writer died before its commit: it left cells and pieces of version 2.
    bad = f"{tmp_dir}/bad"
    I.add_segments(spark, bad, spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], SEGS), "x")
    for part in ("cells", "pieces"):
        os.rename(f"{bad}/{part}/version=1", f"{path}/{part}/version=2")
    check(spark, path, [(1, 0.0, 0.0), (2, 77.0, 900.0)], segs)
    more = [(7, 0.0, 0.0, 5.0, 5.0)]
    I.add_segments(spark, path, spark.createDataFrame(more, SEGS), "b")
    check(spark, path, [(1, 0.0, 0.0), (2, 77.0, 900.0)], segs + more)


def test_a_search_reads_no_segments(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    I.add_segments(spark, path, spark.createDataFrame(some_segments(random.Random(4), 50), SEGS), "a")
    files = I.nearest_with_index(spark.createDataFrame([(1, 1.0, 1.0)], POINTS), path, point_keys=["id"]).inputFiles()
    assert files and all("/cells/" in f or "/pieces/" in f for f in files)


def test_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    points, none = spark.createDataFrame([(1, 1.0, 1.0)], POINTS), spark.createDataFrame([], SEGS)
    assert I.nearest_with_index(points, path, point_keys=["id"]).count() == 0
    with pytest.raises(ValueError):
        I.add_segments(spark, path, none, "a")
    I.add_segments(spark, path, spark.createDataFrame([(2, 5.0, 5.0, 5.0, 5.0)], SEGS), "a")
    assert I.add_segments(spark, path, none, "b")
    assert I.nearest_with_index(points.limit(0), path, point_keys=["id"]).count() == 0
    assert I.nearest_with_index(points, path, point_keys=["id"]).first().region == 2
    assert segments(spark.createDataFrame([], "region int, feature_id int, seq int, x double, y double")).count() == 0
