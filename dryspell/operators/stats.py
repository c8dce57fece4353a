"""Zone statistics and the Standardized Precipitation Index (reference stage 4).

One parameterised implementation serves both reference scripts (administrative
regions and natural zones); they differ only in the lookup and the optional
year filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.codes import canonical_code
from dryspell.functions.values import standardize
from dryspell.operators._exec import broadcast_checked, materialize
from dryspell.operators.median import exact_median


def attach_zone(df: DataFrame, lookup: DataFrame, *, on_missing: str = "error",
                key: str = "code") -> DataFrame:
    """Add ``zone`` from a (code, zone) lookup with unique codes.

    ``on_missing``: ``error`` fails the job on the first code absent from the
    lookup (the reference's KeyError), ``zero`` gives zone 0, ``drop`` drops
    the row. The lookup is broadcast after a size check.
    """
    small = broadcast_checked(lookup.select(F.col("code").alias(key), F.col("zone")))
    if on_missing == "drop":
        return df.join(small, key, "inner")
    joined = df.join(small, key, "left")
    if on_missing == "zero":
        fill = F.lit(0)
    elif on_missing == "error":
        fill = F.raise_error(F.concat(F.lit("station code missing from zone lookup: "),
                                      F.col(key).cast("string"))).cast("int")
    else:
        raise ValueError(f"on_missing must be error, zero or drop, not {on_missing!r}")
    return joined.withColumn("zone", F.coalesce(F.col("zone"), fill))


def with_zone(yearly: DataFrame, lookup: DataFrame, *, on_missing: str = "error",
              min_year_exclusive: int | None = None) -> DataFrame:
    """Yearly table -> (code, year, precip, zone)."""
    y = yearly.select("code", "year", "precip")
    if min_year_exclusive is not None:
        y = y.where(F.col("year") > F.lit(min_year_exclusive))
    return attach_zone(y, lookup, on_missing=on_missing).select("code", "year", "precip", "zone")


def median_by_zone_year(yz: DataFrame, **median_opts) -> DataFrame:
    """(zone, year, median) over the stations' yearly totals; exact."""
    return exact_median(yz, ["zone", "year"], "precip", out="median", **median_opts)


def mean_std_by_zone(yz: DataFrame) -> DataFrame:
    """(zone, mean, std) over all station-years of a zone; std is the population one."""
    return yz.groupBy("zone").agg(F.avg("precip").alias("mean"),
                                  F.stddev_pop("precip").alias("std"))


def spi(yz: DataFrame, **median_opts) -> DataFrame:
    """(zone, year, spi) = (median(zone, year) - mean(zone)) / std(zone).

    The narrow (zone, year, precip) table is written once to the shared
    checkpoint folder and both statistics read it.
    """
    narrow = materialize(yz.select("zone", "year", "precip"), "zone-yearly")
    return spi_of(median_by_zone_year(narrow, materialize_input=False, **median_opts), mean_std_by_zone(narrow))


def spi_of(medians: DataFrame, moments: DataFrame) -> DataFrame:
    """SPI from finished (zone, year, median) and (zone, mean, std) tables.

    Both are small aggregates; the join is planned from their measured sizes
    by adaptive execution. A zone with zero spread gives NULL.
    """
    return (medians.join(moments, "zone")
            .select("zone", "year", standardize("median", "mean", "std").alias("spi")))


def station_annual_mean(yearly: DataFrame, *, min_year_exclusive: int | None = None) -> DataFrame:
    """(code, annual_mean): mean yearly total per station."""
    y = yearly
    if min_year_exclusive is not None:
        y = y.where(F.col("year") > F.lit(min_year_exclusive))
    return y.groupBy("code").agg(F.avg("precip").alias("annual_mean"))


def station_climatology(yearly: DataFrame, stations: DataFrame, lookup: DataFrame, *,
                        min_year_exclusive: int | None = None) -> DataFrame:
    """(code, annual_mean, lat, lon, zone); stations missing from the lookup get zone 0.

    Station codes are canonicalised on both sides (the reference joins the
    raw code here, which loses zero-padded stations). As in the reference, every
    row of the station table counts: a code that repeats gives a row for each.
    """
    means = station_annual_mean(yearly, min_year_exclusive=min_year_exclusive)
    coords = broadcast_checked(stations.select(canonical_code("code").alias("code"), "lat", "lon"))
    located = means.join(coords, "code")
    return (attach_zone(located, lookup, on_missing="zero")
            .select("code", "annual_mean", "lat", "lon", "zone"))
