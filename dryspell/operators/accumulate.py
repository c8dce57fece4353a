"""Daily -> yearly and monthly accumulations (reference stage 2).

The reference groups twice on the same key (row counts, precipitation sums)
and joins the results. One aggregate computes both with map-side partial
aggregation, so a hot station-year only ever sends one partial row per task.
The join form is kept for parity testing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell import schemas as S


def _valid(daily: DataFrame, keys: list[str], min_year: int) -> DataFrame:
    cond = F.col("year") >= F.lit(min_year)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return daily.where(cond)


def yearly(daily: DataFrame, *, min_days: int | None = S.MIN_DAYS,
           min_year: int = S.MIN_YEAR) -> DataFrame:
    """(code, year, days, precip): rows counted and summed per station-year.

    ``days`` counts rows, not distinct days (two rows for a day count twice).
    Station-years with fewer than ``min_days`` rows are dropped; ``None``
    keeps all.
    """
    keys = ["code", "year"]
    out = (_valid(daily, keys, min_year).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("days"), F.sum("precip").alias("precip")))
    return out if min_days is None else out.where(F.col("days") >= F.lit(min_days))


def monthly(daily: DataFrame, *, min_year: int = S.MIN_YEAR) -> DataFrame:
    """(code, year, month, days, precip); no completeness rule."""
    keys = ["code", "year", "month"]
    return (_valid(daily, keys, min_year).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("days"), F.sum("precip").alias("precip")))


def accumulate_by_join(daily: DataFrame, keys: list[str], *, min_days: int | None,
                       min_year: int = S.MIN_YEAR) -> DataFrame:
    """The reference's shape: count aggregate (filtered) joined to a sum aggregate."""
    base = _valid(daily, keys, min_year)
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("days"))
    if min_days is not None:
        counts = counts.where(F.col("days") >= F.lit(min_days))
    sums = base.groupBy(*keys).agg(F.sum("precip").alias("precip"))
    return counts.join(sums, keys, "inner").select(*keys, "days", "precip")


def completeness_report(daily: DataFrame, *, min_days: int = S.MIN_DAYS,
                        min_year: int = S.MIN_YEAR) -> DataFrame:
    """One row: station-years before and after the completeness rule."""
    per_group = yearly(daily, min_days=None, min_year=min_year)
    return per_group.agg(F.count(F.lit(1)).alias("station_years"),
                         F.count_if(F.col("days") >= F.lit(min_days)).alias("complete_station_years"))


def day_bit(day: str):
    """A day of the month as one bit of a BIGINT: ORed, the bits of a month's distinct days."""
    return F.expr(f"shiftleft(1L, CAST({day} AS INT))")


# Days of a year as bits: two months of 32 bits in each of six words.
_DAY_WORDS = 6


def yearly_distinct_days(daily: DataFrame, *, min_days: int | None = S.MIN_DAYS,
                         min_year: int = S.MIN_YEAR) -> DataFrame:
    """(code, year, days, distinct_days, precip): rows and distinct days side by side.

    A day with two rows counts twice in ``days`` and once in ``distinct_days``, which
    the completeness rule reads here. Days are bits of six words a station-year,
    merged with OR: the aggregate keeps a fixed-size state and combines before the
    shuffle, where COUNT(DISTINCT) would send every day. A row without a month or
    day counts as a row, not as a day; a month or day out of range fails.
    """
    keys = ["code", "year"]
    place = F.expr("(month - 1) * 32 + day")
    checked = F.when(F.expr("month NOT BETWEEN 1 AND 12 OR day NOT BETWEEN 1 AND 31"),
                     F.raise_error(F.lit("month or day out of range")).cast("int")).otherwise(place)
    rows = _valid(daily, keys, min_year).select(*keys, "precip", checked.alias("_d"))
    words = [F.expr(f"bit_or(CASE WHEN _d div 64 = {w} THEN shiftleft(1L, CAST(_d % 64 AS INT)) END)").alias(f"_w{w}")
             for w in range(_DAY_WORDS)]
    distinct = sum((F.coalesce(F.bit_count(f"_w{w}"), F.lit(0)) for w in range(_DAY_WORDS)), F.lit(0))
    out = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("days"), F.sum("precip").alias("precip"), *words)
           .select(*keys, "days", distinct.alias("distinct_days"), "precip"))
    return out if min_days is None else out.where(F.col("distinct_days") >= F.lit(min_days))
