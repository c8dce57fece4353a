"""Containment against exact even-odd counting, on coordinates that meet grid lines, edges and vertices."""

import random
from fractions import Fraction

import pytest

from dryspell.operators import boundaries as B
from dryspell.operators.containment import containing_region

VERTICES = "region int, feature_id int, seq int, x double, y double"
POINTS = "code string, x double, y double"


def vertices(rings):
    """rings: (region, feature, [(x, y), ...])."""
    return [(r, f, i, float(x), float(y)) for r, f, ring in rings for i, (x, y) in enumerate(ring)]


def brute(points, rings):
    out = []
    for code, px, py in points:
        held = []
        if px is not None and py is not None and px == px and py == py and abs(px) < 1e300 and abs(py) < 1e300:
            px, py = Fraction(px), Fraction(py)
            for region in sorted({r for r, _, _ in rings}):
                odd, touches = 0, False
                for r, _, ring in rings:
                    if r != region or len(ring) < 2:
                        continue
                    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
                        ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
                        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
                        touches |= (cross == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by))
                        if (ay <= py) != (by <= py):
                            odd += (px < ax + (py - ay) * (bx - ax) / (by - ay))
                if odd % 2 or touches:
                    held.append(region)
        out.append((code, held[0] if held else None))
    return sorted(out, key=str)


def check(spark, points, rings, **options):
    df = containing_region(spark.createDataFrame(points, POINTS),
                           B.close_rings(spark.createDataFrame(vertices(rings), VERTICES)), **options)
    assert sorted(((r.code, r.region) for r in df.collect()), key=str) == brute(points, rings)


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6)]


@pytest.mark.parametrize("cell", [None, 1.0, 2.0, 3.7, 50.0])
def test_holes_edges_and_vertices(spark, cell):
    rings = [(2, 0, SQUARE), (2, 1, HOLE), (5, 0, [(8, 8), (14, 8), (14, 14), (8, 14)]),
             (7, 0, [(20, 0), (30, 5), (20, 10), (24, 5)]), (9, 0, [(50, 50)]), (9, 1, [(60, 60), (70, 70)])]
    points = [(f"p{x}_{y}", x / 2, y / 2) for x in range(-3, 64) for y in range(-3, 32)]
    points += [("on-line", 65.0, 65.0), ("far", 1e9, 1e9), ("none", None, 1.0), ("nan", float("nan"), 5.0),
               ("inf", float("inf"), 5.0), ("twice", 1.0, 1.0), ("twice", 1.0, 1.0)]
    check(spark, points, rings, cell_size=cell)


@pytest.mark.parametrize("seed,cell", [(1, None), (2, 1.0), (3, 0.5), (4, 7.0)])
def test_random_rings_on_a_lattice(spark, seed, cell):
    rng = random.Random(seed)
    rings = [(rng.randint(0, 4), f, [(rng.randint(0, 20), rng.randint(0, 20)) for _ in range(rng.randint(2, 9))])
             for f in range(14)]
    points = [(str(i), rng.randint(-1, 42) / 2, rng.randint(-1, 42) / 2) for i in range(400)]
    check(spark, points, rings, cell_size=cell)


def test_random_rings_of_any_floats(spark):
    rng = random.Random(9)
    rings = []
    for f in range(12):
        cx, cy = rng.uniform(0, 1e6), rng.uniform(7e6, 8e6)
        rings.append((f % 5, f, [(cx + rng.uniform(-2e5, 2e5), cy + rng.uniform(-2e5, 2e5)) for _ in range(30)]))
    points = [(str(i), rng.uniform(-2e5, 1.2e6), rng.uniform(6.8e6, 8.2e6)) for i in range(500)]
    points += [(f"v{i}", x, y) for i, (x, y) in enumerate(rings[3][2])]
    check(spark, points, rings)


def test_nothing_and_bad_vertices(spark):
    points = spark.createDataFrame([("a", 1.0, 1.0)], POINTS)
    none = spark.createDataFrame([], VERTICES)
    assert [tuple(r) for r in containing_region(points, none).collect()] == [("a", None)]
    rings = B.close_rings(spark.createDataFrame(vertices([(1, 0, SQUARE)]), VERTICES))
    assert containing_region(points.limit(0), rings).count() == 0
    bad = spark.createDataFrame([(1, 0, 0, 0.0, 0.0), (1, 0, 1, None, 3.0), (1, 0, 2, 4.0, 4.0)], VERTICES)
    with pytest.raises(Exception, match="finite"):
        containing_region(points, B.close_rings(bad)).collect()


def test_plan_has_only_equi_joins(spark):
    rings = B.close_rings(spark.createDataFrame(vertices([(1, 0, SQUARE), (1, 1, HOLE)]), VERTICES))
    df = containing_region(spark.createDataFrame([("a", 1.0, 1.0)], POINTS), rings)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
