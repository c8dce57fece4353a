"""Order inside groups without one task per group.

The reference sorts a station's whole series in one reducer. Here rows are
range-partitioned over (group, order, row), so a group of any size is cut into
ranges of about equal size; a rank is the row's place in its range plus the rows
of its group in earlier ranges, a prefix sum over one count per (group, range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.operators._exec import broadcast_checked, materialize


def ranges_of(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """``df`` written in ``n`` ranges of (group, order), with ``_range`` and ``_at``, a row's place in the whole order."""
    # The row's own id ends the key: many equal rows are cut as well.
    keyed = df.withColumn("_in", F.monotonically_increasing_id())
    ranged = (keyed.repartitionByRange(n, *group, *order, "_in").sortWithinPartitions(*group, *order, "_in")
              .withColumn("_at", F.monotonically_increasing_id()).drop("_in"))
    return materialize(ranged, "ranked-ranges").withColumn("_range", F.shiftright("_at", 33))


def rank_in_group(df: DataFrame, group: list[str], order: list[str], *, ranges: int | None = None,
                  rank: str = "rank") -> DataFrame:
    """``df`` with ``rank``: the row's place, from 1, among its group's rows by ``order`` (nulls first).

    Rows equal in all of ``order`` take consecutive ranks, in the order they are read.
    ``ranges`` is the number of range partitions (the session's shuffle partitions by
    default). No window or sort holds more than a range.
    """
    if rank in df.columns:
        raise ValueError(f"{rank} is a column of the table")
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = ranges_of(df, group, order, n)
    counts = placed.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1))
    offsets = broadcast_checked(counts.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), "_range",
                                              (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
                                .withColumnRenamed("_range", "_r"))
    same = " AND ".join([f"`{g}` <=> _g{i}" for i, g in enumerate(group)] + ["_range = _r"])
    return (placed.join(offsets, F.expr(same))
            .select(*df.columns, (F.col("_at") + F.col("_shift")).alias(rank)))
