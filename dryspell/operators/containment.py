"""Station -> administrative region by containment in closed rings.

A point is in a region if a ray from it to the right crosses the region's ring
edges an odd number of times, all rings of the region taken together: a ring
inside another is a hole. Testing every point against every edge of its height
does not scale, so the test is cut in two by a square grid:

* *Known corners.* The lower left corner of a cell has the parity of the edges
  that cross its band's lower line to its right. An edge is counted once for each
  line it crosses, in the last column whose corner lies left of it; odd counts of a
  line, in order, bound the runs of cells whose corner is inside.
* *Local edges.* From a point, the path to its cell's corner (left along its
  height, then down the cell's side) stays in the cell, so only edges registered
  there can change the parity on the way. A point meets the few edges of its cell.

Both halves give partial counts per (point, region), summed before the shuffle:
one equi-join on the cell for the local edges, one on (band, block of columns)
for the runs, no cross join. The same orientation test decides on which side of an
edge a point or corner lies, along the height and down the side, so rounding
cannot make the two halves disagree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.operators._exec import broadcast_checked, materialize
from dryspell.operators.boundaries import segments
from dryspell.operators.nearest import _pieces

# Cells of a run are registered in blocks of this many columns.
_RUN_BLOCK = 64
# Cells touched within a millionth of their size count as touched.
_TOUCH = 1e-6


def _left(qx: str, qy: str) -> str:
    """SQL text: Q lies left of A -> B."""
    return f"((bx - ax) * ({qy} - ay) - (by - ay) * ({qx} - ax) > 0.0D)"


def _right_of(qx: str, qy: str) -> str:
    """SQL text: the ray from Q to the right crosses the edge (lower end counts, upper does not)."""
    return (f"(((ay <= {qy}) <> (by <= {qy})) AND CASE WHEN {qx} < least(ax, bx) THEN true "
            f"WHEN {qx} >= greatest(ax, bx) THEN false ELSE {_left(qx, qy)} = (by > ay) END)")


def _above(qx: str, qy: str) -> str:
    """SQL text: the ray from Q upwards crosses the edge (left end counts, right does not)."""
    return (f"(((ax <= {qx}) <> (bx <= {qx})) AND CASE WHEN {qy} < least(ay, by) THEN true "
            f"WHEN {qy} >= greatest(ay, by) THEN false ELSE (NOT {_left(qx, qy)}) = (bx > ax) END)")


def ring_edges(rings: DataFrame) -> DataFrame:
    """(region, feature_id, seq, ax, ay, bx, by) of closed rings; a coordinate that is no finite number fails."""
    bad = " OR ".join(f"{c} IS NULL OR isnan({c}) OR abs({c}) = double('Infinity')" for c in ("ax", "ay", "bx", "by"))
    sound = F.when(F.expr(bad), F.raise_error(F.lit("ring vertex without finite coordinates")).cast("boolean"))
    return segments(rings).where(F.coalesce(sound, F.lit(True)))


def _corner_runs(edges: DataFrame, s: float) -> DataFrame:
    """(region, cy, lo, hi): runs of cells of a band whose lower left corner is inside."""
    sd = f"CAST({s!r} AS DOUBLE)"
    line = f"(CAST(cy AS DOUBLE) * {sd})"
    crossed = (edges.selectExpr("region", "ax", "ay", "bx", "by",
                                f"explode(sequence(floor(least(ay, by) / {sd}), floor(greatest(ay, by) / {sd}) + 1)) AS cy")
               .where(f"(ay <= {line}) <> (by <= {line})")
               .selectExpr("*", f"floor((ax + ({line} - ay) * (bx - ax) / (by - ay)) / {sd}) AS _c"))
    corner = lambda d: _right_of(f"(CAST(_c + {d} AS DOUBLE) * {sd})", line)
    last = (f"CASE WHEN {corner(1)} THEN _c + 1 WHEN {corner(0)} THEN _c WHEN {corner(-1)} THEN _c - 1 "
            "ELSE _c - 2 END")
    # Even counts at a column cancel, so a line has at most one row a column.
    odd = (crossed.selectExpr("region", "cy", f"{last} AS k").groupBy("region", "cy", "k")
           .agg(F.count("*").alias("n")).where("n % 2 = 1"))
    order = Window.partitionBy("region", "cy").orderBy(F.desc("k"))
    runs = odd.select("region", "cy", F.col("k").alias("hi"), F.row_number().over(order).alias("rank"),
                      F.lead("k").over(order).alias("next"))
    closed = F.when(F.col("next").isNull(), F.raise_error(F.lit("ring is not closed")).cast("bigint"))
    return (runs.where("rank % 2 = 1")
            .select("region", "cy", (F.coalesce(closed, F.col("next")) + 1).alias("lo"), "hi"))


def containing_region(points: DataFrame, rings: DataFrame, *, cell_size: float | None = None) -> DataFrame:
    """(code, region): the lowest region that holds each point, or NULL; one row per point row.

    ``rings`` is a closed vertex table (see :func:`boundaries.close_rings`). A point
    on an edge or vertex is inside. Points without finite coordinates are in no
    region. ``cell_size`` sets the grid; by default a cell is about an edge long.
    """
    pts = materialize(points.select("code", "x", "y").withColumn("_row", F.monotonically_increasing_id()),
                      "contained-points")
    edges = materialize(ring_edges(rings).select("region", "ax", "ay", "bx", "by")
                        .withColumn("eid", F.monotonically_increasing_id()), "ring-edges")
    ext = edges.selectExpr("least(ax, bx) AS x0", "greatest(ax, bx) AS x1", "least(ay, by) AS y0",
                           "greatest(ay, by) AS y1", "sqrt(pow(bx - ax, 2) + pow(by - ay, 2)) AS len").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"),
        F.avg("len").alias("len"), F.count("*").alias("n")).first()
    if not ext["n"]:
        return pts.select("code", F.lit(None).cast(rings.schema["region"].dataType).alias("region"))
    diag = max(math.hypot(ext["x1"] - ext["x0"], ext["y1"] - ext["y0"]), 1e-9)
    s = cell_size or max(ext["len"], diag / math.sqrt(ext["n"]), diag / 65536.0)
    sd = f"CAST({s!r} AS DOUBLE)"

    placed = (pts.where("NOT isnan(x) AND NOT isnan(y) AND abs(x) < double('Infinity') AND abs(y) < double('Infinity')")
              .where(f"x BETWEEN {ext['x0'] - s!r}D AND {ext['x1'] + s!r}D AND y BETWEEN {ext['y0'] - s!r}D AND "
                     f"{ext['y1'] + s!r}D")
              .selectExpr("_row", "x AS px", "y AS py", f"floor(x / {sd}) AS cx", f"floor(y / {sd}) AS cy"))
    local = broadcast_checked(_pieces(edges, s, _TOUCH).select("region", "eid", "ax", "ay", "bx", "by", "cx", "cy")
                              .dropDuplicates(["eid", "cx", "cy"]).drop("eid"))
    runs = broadcast_checked(
        _corner_runs(edges, s).selectExpr("region", "cy", "lo", "hi", f"explode(sequence(floor(lo / {_RUN_BLOCK}), "
                                          f"floor(hi / {_RUN_BLOCK}))) AS block"))
    left, low = f"(CAST(cx AS DOUBLE) * {sd})", f"(CAST(cy AS DOUBLE) * {sd})"
    turns = (f"CAST({_right_of('px', 'py')} <> {_right_of(left, 'py')} AS INT) + "
             f"CAST({_above(left, 'py')} <> {_above(left, low)} AS INT)")
    on_edge = ("(bx - ax) * (py - ay) - (by - ay) * (px - ax) = 0.0D AND px BETWEEN least(ax, bx) AND greatest(ax, bx)"
               " AND py BETWEEN least(ay, by) AND greatest(ay, by)")
    near = placed.join(local, ["cx", "cy"]).selectExpr("_row", "region", f"{turns} AS odd", f"{on_edge} AS touches")
    inside_corner = (placed.withColumn("block", F.expr(f"floor(cx / {_RUN_BLOCK})")).join(runs, ["cy", "block"])
                     .where("cx BETWEEN lo AND hi")
                     .select("_row", "region", F.lit(1).alias("odd"), F.lit(False).alias("touches")))
    held = (near.unionByName(inside_corner).groupBy("_row", "region")
            .agg(F.sum("odd").alias("odd"), F.max("touches").alias("touches"))
            .where("odd % 2 = 1 OR touches").groupBy("_row").agg(F.min("region").alias("region")))
    return pts.join(held, "_row", "left").select("code", "region")
