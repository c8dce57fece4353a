"""The grid pyramid of :mod:`nearest` as a stored table that grows with new boundaries.

``cells`` holds, for every level, a cell's bounding box and one representative
segment; ``pieces`` the finest cells' segments. Both are partitioned by tile (a cell
of level 1), ``cells`` by level as well. New segments add pieces, and rewrite the cells
of the tiles they touch under a new version; a small commit then names the version,
the tiles and the levels' sizes. A (level, tile) is read from its latest committed
version, so an addition that dies leaves nothing that is read, and one whose name is
committed is not applied again. One writer runs at a time.

A search reads no segments: the levels above the finest come from ``cells``, the
finest from ``pieces``. Coarser levels than the stored ones, which far points or
added segments may need, are merged from level 0 on the fly; they have a few cells.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.operators import nearest as N
from dryspell.operators._exec import materialize, release_after
from dryspell.operators.boundaries import segments as boundary_segments
from dryspell.operators.incremental import _exists

COMMIT = "load string, top double, levels int, tiles array<string>, version int"
_BOX = {"_lx0": F.min, "_lx1": F.max, "_ly0": F.min, "_ly1": F.max}
_REP = ["_rax", "_ray", "_rbx", "_rby"]


def _merged(cells: DataFrame, *keys: str) -> DataFrame:
    """One row per cell: the joint box, and one of the representatives, whole."""
    return (cells.groupBy(*keys, "cx", "cy")
            .agg(*(f(c).alias(c) for c, f in _BOX.items()), F.min(F.struct(*_REP)).alias("_rep"))
            .select(*keys, "cx", "cy", *_BOX, *(F.col("_rep")[c].alias(c) for c in _REP)))


def _tile(level: int) -> F.Column:
    """The tile of a cell of a level: its ancestor on level 1; 'top' for level 0."""
    if level == 0:
        return F.lit("top")
    step = N._BRANCH ** (level - 1)
    return F.concat_ws("_", F.floor(F.col("cx") / step), F.floor(F.col("cy") / step))


def commits(spark: SparkSession, path: str) -> list:
    """The committed additions, oldest first: a row each."""
    if not _exists(spark, f"{path}/commits"):
        return []
    return spark.read.schema(COMMIT).parquet(f"{path}/commits").orderBy("version").collect()


def add_segments(spark: SparkSession, path: str, segs: DataFrame, load: str, *, tag: str = "region",
                 cell_size: float | None = None) -> bool:
    """Add ``segs`` (tag, ax, ay, bx, by) to the index under ``path``; False if ``load`` was added before.

    The first addition sets the levels: ``cell_size`` or about a segment's length for
    the finest, and the top one at least the extent's diagonal.
    """
    done = commits(spark, path)
    if any(c["load"] == load for c in done):
        return False
    version = max((c["version"] for c in done), default=0) + 1
    with release_after():
        sg = materialize(segs.select(F.col(tag).alias("_tag"), "ax", "ay", "bx", "by")
                         .withColumn("_sid", F.monotonically_increasing_id()), "index-segments")
        if done:
            top, levels = done[-1]["top"], done[-1]["levels"]
        else:
            ext = sg.selectExpr("least(ax, bx) AS x0", "greatest(ax, bx) AS x1", "least(ay, by) AS y0",
                                "greatest(ay, by) AS y1", "sqrt(pow(bx - ax, 2) + pow(by - ay, 2)) AS len").agg(
                F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"),
                F.avg("len").alias("len"), F.count("*").alias("n")).first()
            if not ext["n"]:
                raise ValueError("the first addition to an index needs segments")
            diag = max(math.hypot(ext["x1"] - ext["x0"], ext["y1"] - ext["y0"]), 1e-9)
            fine = cell_size or max(ext["len"], diag / math.sqrt(ext["n"]), diag / 65536.0)
            levels = max(1, math.ceil(math.log(diag / fine, N._BRANCH)))
            while fine * N._BRANCH ** levels < diag:
                levels += 1
            top = fine * N._BRANCH ** levels
        size = [top / N._BRANCH ** k for k in range(levels + 1)]
        new = reduce(DataFrame.unionByName, [N._cell_index(sg, [], size[k], k).withColumn("tile", _tile(k))
                                             for k in range(levels + 1)])
        new = materialize(new, "index-new-cells")
        tiles = sorted(r["tile"] for r in new.select("tile").distinct().collect())
        if tiles:
            old = _stored_cells(spark, path, done, set(tiles))
            columns = ["level", "tile", "cx", "cy", *_BOX, *_REP]
            both = new.select(*columns) if old is None else new.select(*columns).unionByName(old.select(*columns))
            (_merged(both, "level", "tile").hint("rebalance", "level", "tile").write.mode("overwrite")
             .partitionBy("level", "tile").parquet(f"{path}/cells/version={version}"))
            (N._pieces(sg, size[levels]).withColumn("tile", _tile(levels))
             .select("tile", "cx", "cy", "_tag", "ax", "ay", "bx", "by").hint("rebalance", "tile")
             .write.mode("overwrite").partitionBy("tile").parquet(f"{path}/pieces/version={version}"))
    (spark.createDataFrame([(load, top, levels, tiles)], "load string, top double, levels int, tiles array<string>")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={version}"))
    return True


def _stored_cells(spark: SparkSession, path: str, done: list, tiles: set | None = None) -> DataFrame | None:
    """The committed cells, or those of some tiles: only their folders are read."""
    latest = {tile: c["version"] for c in done for tile in c["tiles"] if tiles is None or tile in tiles}
    if not latest:
        return None
    cells = spark.read.schema("cx bigint, cy bigint, _lx0 double, _lx1 double, _ly0 double, _ly1 double, "
                              "_rax double, _ray double, _rbx double, _rby double, version int, level int, tile string"
                              ).parquet(f"{path}/cells")
    by_version: dict[int, list[str]] = {}
    for tile, version in latest.items():
        by_version.setdefault(version, []).append(tile)
    wanted = " OR ".join(f"(version = {v} AND tile IN ({', '.join(repr(t) for t in sorted(ts))}))"
                         for v, ts in sorted(by_version.items()))
    return cells.where(wanted)


def nearest_with_index(points: DataFrame, path: str, *, point_keys: list[str], tag: str = "region") -> DataFrame:
    """point_keys + (d2, tag): as :func:`nearest.nearest_by_grid`, from the stored index.

    ``points``: unique point_keys + (x, y).
    """
    spark = points.sparkSession
    done = [c for c in commits(spark, path) if c["tiles"]]
    pts = points.select(*point_keys, F.col("x").alias("_px"), F.col("y").alias("_py"))
    if not done:
        return pts.limit(0).select(*point_keys, F.lit(None).cast("double").alias("d2"),
                                   F.lit(None).cast("int").alias(tag))
    cells = _stored_cells(spark, path, done)
    top, levels = done[0]["top"], done[0]["levels"]
    size = [top / N._BRANCH ** k for k in range(levels + 1)]
    low = _merged(cells.where("level = 0 AND tile = 'top'").drop("version", "tile", "level"))
    # Level 0 has few cells; with the points they give the joint extent.
    ext = (low.selectExpr("_lx0 AS x0", "_lx1 AS x1", "_ly0 AS y0", "_ly1 AS y1")
           .unionByName(pts.selectExpr("_px AS x0", "_px AS x1", "_py AS y0", "_py AS y1"))
           .agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
           .first())
    diag = math.hypot(ext["x1"] - ext["x0"], ext["y1"] - ext["y0"])
    above = [low]
    while size[0] < diag:
        size.insert(0, size[0] * N._BRANCH)
        up = above[0].withColumn("cx", F.floor(F.col("cx") / N._BRANCH)).withColumn("cy", F.floor(F.col("cy") / N._BRANCH))
        above.insert(0, _merged(up))

    def at(k: int) -> DataFrame:
        if k < len(above):
            return above[k]
        return cells.where(F.col("level") == k - len(above) + 1).drop("version", "tile", "level")

    versions = ", ".join(str(c["version"]) for c in done)
    pieces = (spark.read.schema("cx bigint, cy bigint, _tag int, ax double, ay double, bx double, by double, "
                                "version int, tile string").parquet(f"{path}/pieces")
              .where(f"version IN ({versions})").drop("version", "tile"))
    return N.descend(pts, size, at, pieces, point_keys=point_keys, group_cols=[], tag=tag)


def nearest_region_indexed(points: DataFrame, path: str) -> DataFrame:
    """(code, region, dist) from an index of region boundaries; one row per point row."""
    pts = N._row_points(points.select("code", "x", "y"))
    res = nearest_with_index(pts, path, point_keys=["_row", "code"])
    return res.select("code", "region", F.sqrt("d2").alias("dist"))


def add_boundaries(spark: SparkSession, path: str, boundaries: DataFrame, load: str, **options) -> bool:
    """Add a vertex table's features to the index."""
    return add_segments(spark, path, boundary_segments(boundaries), load, **options)
