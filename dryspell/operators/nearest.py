"""Station -> administrative region by distance to region boundaries
(reference stage 3b).

The reference measures, for every station, the distance to each region's
boundary line and keeps the closest region (lowest region on ties). Pairing
every station with every segment does not scale, so this is an exact
branch-and-bound descent over a grid pyramid, written as joins:

* Level k has cell size ``s_k = s_top / 8**k``; the top cell is at least the
  extent's diagonal, the finest about one segment long. Segments are cut into
  pieces no longer than the cell and registered in the cells their (slightly
  padded) bounding box touches. Per (group, cell) the index keeps the
  bounding box of its pieces and one representative segment.
* At the top level every point's 3 x 3 block of cells holds every group's
  cells (an equi-join on the cell id). For each (point, group, cell) the
  distance to the cell's piece box is a lower bound and the exact distance
  to its representative segment an upper bound. Cells whose lower bound
  exceeds the best upper bound of their (point, group) cannot hold the
  nearest point and are dropped.
* Surviving cells descend to their 8 x 8 children (an equi-join on the
  parent cell id) and are pruned again; at the finest level the distances to the
  pieces' original segments are computed exactly.

The cell holding the nearest segment point always survives (its lower bound
is at most the true distance, which is at most any upper bound), so the
result is exact. Work per (point, group) is a few cells per level instead of
every segment. Segments and the cell index are written to the shared
checkpoint folder, and the frontier every few levels, so lineage stays
short.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell import schemas as S
from dryspell.functions.geo import (
    distance_sq_at_sql, segment_param_sql, utm_easting_northing,
)
from dryspell.operators._exec import broadcast_checked, materialize
from dryspell.operators.boundaries import segments as boundary_segments

# Relative slack on the pruning test, so rounding in the piece coordinates
# can only keep a cell, never drop one that holds the nearest point.
_SLACK = 1e-9
# Each cell has BRANCH x BRANCH children; the frontier is written to the
# shared folder every CUT_EVERY levels to keep the lineage short.
_BRANCH = 8
_CUT_EVERY = 3
# Levels below the top whose cells (at most 4 x 64**k a group) are broadcast after a count.
_TOP_LEVELS = 2
_OFFSETS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def project_stations(stations: DataFrame, zone: int | None = S.UTM_ZONE) -> DataFrame:
    """(code, x, y): stations with valid coordinates projected to UTM metres."""
    valid = stations.where((F.col("lat") > F.lit(S.VALID_LAT_MIN)) & (F.col("lon") > F.lit(S.VALID_LON_MIN)))
    e, n = utm_easting_northing("lat", "lon", zone)
    return valid.select("code", e.alias("x"), n.alias("y"))


def _pieces(segs: DataFrame, s: float, slack: float = 1e-9) -> DataFrame:
    """Register segment pieces (length <= s) in the grid cells they touch, padded by ``slack`` of a cell.

    Expressions are SQL text so building the plan costs a few JVM calls.
    """
    sd = f"CAST({s!r} AS DOUBLE)"
    pad = f"CAST({s * slack!r} AS DOUBLE)"
    n = f"greatest(1, CAST(ceil(sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)) / {sd}) AS INT))"
    at = "{a} + ({b} - {a}) * ({t} / CAST(_np AS DOUBLE))"
    x0 = at.format(a="ax", b="bx", t="CAST(_k AS DOUBLE)")
    x1 = at.format(a="ax", b="bx", t="(CAST(_k AS DOUBLE) + 1.0D)")
    y0 = at.format(a="ay", b="by", t="CAST(_k AS DOUBLE)")
    y1 = at.format(a="ay", b="by", t="(CAST(_k AS DOUBLE) + 1.0D)")
    pieces = (segs.withColumn("_np", F.expr(n))
              .select("*", F.explode(F.sequence(F.lit(0), F.col("_np") - 1)).alias("_k"))
              .selectExpr("*", f"least({x0}, {x1}) AS _bx0", f"greatest({x0}, {x1}) AS _bx1",
                          f"least({y0}, {y1}) AS _by0", f"greatest({y0}, {y1}) AS _by1"))
    return (pieces.selectExpr("*", f"floor((_bx0 - {pad}) / {sd}) AS _cxl", f"floor((_bx1 + {pad}) / {sd}) AS _cxh",
                              f"floor((_by0 - {pad}) / {sd}) AS _cyl", f"floor((_by1 + {pad}) / {sd}) AS _cyh")
            .select("*", F.explode(F.sequence("_cxl", "_cxh")).alias("cx"))
            .select("*", F.explode(F.sequence("_cyl", "_cyh")).alias("cy"))
            .drop("_np", "_k", "_cxl", "_cxh", "_cyl", "_cyh"))


def _cell_index(sg: DataFrame, group_cols: list[str], s: float, level: int) -> DataFrame:
    """Per (group, cell) at one level: bounding box of the pieces and a representative segment."""
    rep = [F.min_by(c, "_sid").alias(f"_r{c}") for c in ("ax", "ay", "bx", "by")]
    return (_pieces(sg, s).groupBy(*group_cols, "cx", "cy")
            .agg(F.min("_bx0").alias("_lx0"), F.max("_bx1").alias("_lx1"),
                 F.min("_by0").alias("_ly0"), F.max("_by1").alias("_ly1"), *rep)
            .withColumn("level", F.lit(level)))


def _bounded(df: DataFrame, keys: list[str], prev_ub: str | None) -> DataFrame:
    """Add lower/upper bounds per (point, group, cell); keep cells that may hold the nearest point."""
    lb2 = ("pow(greatest(_lx0 - _px, 0.0D, _px - _lx1), 2) + pow(greatest(_ly0 - _py, 0.0D, _py - _ly1), 2)")
    with_b = df.selectExpr("*", f"{lb2} AS _lb2",
                           segment_param_sql("_px", "_py", "_rax", "_ray", "_rbx", "_rby") + " AS _ru")
    ub2 = F.expr(distance_sq_at_sql("_px", "_py", "_rax", "_ray", "_rbx", "_rby", "_ru"))
    best = F.min(ub2).over(Window.partitionBy(*keys))
    if prev_ub:
        best = F.least(best, F.col(prev_ub))
    with_b = with_b.select("*", best.alias("_ub2"))
    return with_b.where(F.expr(f"_lb2 <= _ub2 * (1.0D + {_SLACK!r}D)"))


def nearest_by_grid(points: DataFrame, segs: DataFrame, *, point_keys: list[str],
                    group_cols: list[str] | None = None, tag: str | None = None,
                    cell_size: float | None = None, own_group: bool = False) -> DataFrame:
    """Exact nearest segment per point (and per group, if ``group_cols``).

    ``points``: unique point_keys + (x, y). ``segs``: group_cols + tag +
    (ax, ay, bx, by). Returns point_keys + group_cols + (d2, tag): the
    smallest squared distance and, among segments at that distance, the
    smallest ``tag``. ``cell_size`` sets the finest cell. With ``own_group``
    the points carry ``group_cols`` too and meet only their own group.
    """
    group_cols = list(group_cols or [])
    tag_col = F.col(tag) if tag else F.lit(0)
    # Points are a cheap projection, recomputed where used; segments are read
    # once per level, so they are written once.
    held = [*point_keys, *group_cols] if own_group else point_keys
    pts = points.select(*held, F.col("x").alias("_px"), F.col("y").alias("_py"))
    sg = materialize(segs.select(*group_cols, tag_col.alias("_tag"), "ax", "ay", "bx", "by")
                     .withColumn("_sid", F.monotonically_increasing_id()), "grid-segments")

    # One small action: joint extent, mean segment length, segment and point counts.
    ext = (sg.selectExpr("least(ax, bx) AS _x0", "greatest(ax, bx) AS _x1", "least(ay, by) AS _y0",
                         "greatest(ay, by) AS _y1", "sqrt(pow(bx - ax, 2) + pow(by - ay, 2)) AS _len",
                         "1 AS _seg")
           .unionByName(pts.selectExpr("_px AS _x0", "_px AS _x1", "_py AS _y0", "_py AS _y1",
                                       "CAST(NULL AS DOUBLE) AS _len", "0 AS _seg"))
           .agg(F.min("_x0").alias("x0"), F.max("_x1").alias("x1"), F.min("_y0").alias("y0"),
                F.max("_y1").alias("y1"), F.avg("_len").alias("len"),
                F.sum("_seg").alias("segments"), F.count_if(F.col("_seg") == 0).alias("points"))
           .first())
    if not ext["segments"] or not ext["points"] or ext["x0"] is None:
        fields = ([pts.schema[k] for k in point_keys] + [sg.schema[g] for g in group_cols]
                  + [T.StructField("d2", T.DoubleType()), T.StructField(tag or "_tag", sg.schema["_tag"].dataType)])
        empty = pts.sparkSession.createDataFrame([], T.StructType(fields))
        return empty if tag else empty.drop("_tag")
    diag = max(math.hypot(ext["x1"] - ext["x0"], ext["y1"] - ext["y0"]), 1e-9)
    fine = cell_size or max(ext["len"] or 0.0, diag / math.sqrt(max(ext["segments"], 1)), diag / 65536.0)
    levels = max(0, math.ceil(math.log(diag / fine, _BRANCH)))
    while fine * _BRANCH ** levels < diag:
        levels += 1
    top = fine * _BRANCH ** levels           # >= diag: the top block covers everything
    size = [top / _BRANCH ** k for k in range(levels + 1)]

    index = materialize(reduce(DataFrame.unionByName,
                               [_cell_index(sg, group_cols, size[k], k) for k in range(levels + 1)]),
                        "grid-index", partition_by="level")
    return descend(pts, size, lambda k: index.where(F.col("level") == k).drop("level"), _pieces(sg, size[levels]),
                   point_keys=point_keys, group_cols=group_cols, tag=tag, own_group=own_group)


def descend(pts: DataFrame, size: list[float], cells, pieces: DataFrame, *, point_keys: list[str],
            group_cols: list[str], tag: str | None, own_group: bool = False) -> DataFrame:
    """The search itself: from the top level's cells down to the pieces of the finest.

    ``pts``: point_keys (+ group_cols with ``own_group``) + (_px, _py). ``size``: cell size of
    every level, the top one at least the joint extent's diagonal. ``cells(k)``: the
    level's index. ``pieces``: the finest level's pieces with their segments.
    """
    held = [*point_keys, *group_cols] if own_group else point_keys
    top, levels = size[0], len(size) - 1
    keys = [*point_keys, *group_cols]
    offsets = F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy"))
                        for dx, dy in _OFFSETS])
    probe = (pts.select("*", F.floor(F.col("_px") / top).alias("_cx0"),
                        F.floor(F.col("_py") / top).alias("_cy0"), F.explode(offsets).alias("_o"))
             .select(*held, "_px", "_py", (F.col("_cx0") + F.col("_o.dx")).alias("cx"),
                     (F.col("_cy0") + F.col("_o.dy")).alias("cy")))
    # The top levels hold few cells, on which all points meet: they are broadcast
    # once counted, whatever the optimizer's settings, so no task takes a whole cell.
    meet = ["cx", "cy", *(group_cols if own_group else [])]
    frontier = _bounded(probe.join(broadcast_checked(cells(0)), meet), keys, None)
    frontier = frontier.select(*keys, "_px", "_py", "cx", "cy", "_ub2")
    for k in range(1, levels + 1):
        children = (cells(k).withColumn("_pcx", F.floor(F.col("cx") / _BRANCH))
                    .withColumn("_pcy", F.floor(F.col("cy") / _BRANCH)))
        if k <= _TOP_LEVELS:
            children = broadcast_checked(children)
        parents = frontier.select(*keys, "_px", "_py", F.col("cx").alias("_pcx"), F.col("cy").alias("_pcy"),
                                  F.col("_ub2").alias("_prev"))
        step = _bounded(parents.join(children, [*group_cols, "_pcx", "_pcy"]), keys, "_prev")
        frontier = step.select(*keys, "_px", "_py", "cx", "cy", "_ub2")
        if k % _CUT_EVERY == 0 and k < levels:
            frontier = materialize(frontier, f"grid-frontier-{k}")

    cand = (frontier.select(*keys, "_px", "_py", "cx", "cy")
            .join(pieces, [*group_cols, "cx", "cy"])
            .select(*keys, "_tag", "_px", "_py", "ax", "ay", "bx", "by",
                    F.expr(segment_param_sql("_px", "_py", "ax", "ay", "bx", "by")).alias("_u")))
    d2 = F.expr(distance_sq_at_sql("_px", "_py", "ax", "ay", "bx", "by", "_u"))
    # Hash-aggregate min(d2) per tag first (partial aggregation, no sort);
    # the (d2, tag) tie-break then runs on at most one row per tag.
    per_tag = (cand.select(*keys, "_tag", d2.alias("d2"))
               .groupBy(*keys, "_tag").agg(F.min("d2").alias("d2")))
    out = (per_tag.groupBy(*keys).agg(F.min(F.struct("d2", "_tag")).alias("_b"))
           .select(*keys, "_b.d2", "_b._tag"))
    return out.withColumnRenamed("_tag", tag) if tag else out.drop("_tag")


def _row_points(points: DataFrame) -> DataFrame:
    """Points with a row id, written once: codes may repeat, rows never merge."""
    return materialize(points.withColumn("_row", F.monotonically_increasing_id()), "grid-points")


def distance_to_own_region(points: DataFrame, boundaries: DataFrame, *, features: str = "all",
                           cell_size: float | None = None) -> DataFrame:
    """(code, region, dist): each point's distance to the boundary of the region it names.

    ``points`` has (code, x, y, region). One row per point row; the distance is
    NULL where the region has no boundary.
    """
    pts = _row_points(points.select("code", "x", "y", "region"))
    res = nearest_by_grid(pts, boundary_segments(boundaries, features), point_keys=["_row"],
                          group_cols=["region"], cell_size=cell_size, own_group=True)
    return (pts.join(res.select("_row", "d2"), "_row", "left")
            .select("code", "region", F.sqrt("d2").alias("dist")))


def nearest_region(points: DataFrame, boundaries: DataFrame, *, features: str = "all",
                   cell_size: float | None = None) -> DataFrame:
    """(code, region, dist): the closest region boundary; lowest region wins ties.

    One row per point row, also where codes repeat.
    """
    pts = _row_points(points.select("code", "x", "y"))
    segs = boundary_segments(boundaries, features)
    res = nearest_by_grid(pts, segs, point_keys=["_row", "code"], tag="region", cell_size=cell_size)
    return res.select("code", "region", F.sqrt("d2").alias("dist"))


def stations_per_region(assigned: DataFrame) -> DataFrame:
    """(region, stations)."""
    return assigned.groupBy("region").agg(F.count(F.lit(1)).alias("stations"))
