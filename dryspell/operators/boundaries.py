"""Boundary vertex tables: segments, ring closure, per-region counts.

Vertices are rows (region, feature_id, seq, x, y) with ``seq`` dense from 0
within a feature. Consecutive vertices are paired by an equi-join on
``seq + 1`` rather than a window, so a feature with millions of vertices is
spread over many tasks instead of being sorted in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.operators._exec import broadcast_checked

FEATURE = ["region", "feature_id"]


def first_features(boundaries: DataFrame) -> DataFrame:
    """Only the lowest feature_id of each region (the reference measures just that one)."""
    first = boundaries.groupBy("region").agg(F.min("feature_id").alias("feature_id"))
    return boundaries.join(broadcast_checked(first), FEATURE, "left_semi")


def segments(boundaries: DataFrame, features: str = "all") -> DataFrame:
    """(region, feature_id, seq, ax, ay, bx, by): one row per polyline segment."""
    v = first_features(boundaries) if features == "first" else boundaries
    if features not in ("all", "first"):
        raise ValueError("features must be 'all' or 'first'")
    a = v.select(*FEATURE, "seq", F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = v.select(*FEATURE, (F.col("seq") - 1).alias("seq"), F.col("x").alias("bx"), F.col("y").alias("by"))
    return a.join(b, [*FEATURE, "seq"])


def close_rings(boundaries: DataFrame) -> DataFrame:
    """Append each feature's first vertex after its last one (polyline -> ring).

    A feature needs at least 2 vertices (a closed ring of at least 3
    coordinates); shorter features are dropped, as in the reference.
    """
    ends = (boundaries.groupBy(*FEATURE)
            .agg(F.count(F.lit(1)).alias("_n"), F.max("seq").alias("_last"),
                 F.min_by(F.struct("x", "y"), "seq").alias("_first"))
            .where(F.col("_n") >= 2))
    closing = ends.select(*FEATURE, (F.col("_last") + 1).alias("seq"),
                          F.col("_first.x").alias("x"), F.col("_first.y").alias("y"))
    # One row per feature: broadcast where it fits, so a feature's vertices stay spread.
    kept = boundaries.join(broadcast_checked(ends.select(*FEATURE)), FEATURE, "left_semi")
    return kept.select(*FEATURE, "seq", "x", "y").unionByName(closing)


def features_per_region(boundaries: DataFrame) -> DataFrame:
    """(region, features): number of distinct features per region."""
    return (boundaries.select(*FEATURE).distinct()
            .groupBy("region").agg(F.count(F.lit(1)).alias("features")))
