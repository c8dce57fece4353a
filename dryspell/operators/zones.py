"""Station -> natural zone by latitude band (reference stage 3a)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.functions.codes import canonical_code
from dryspell.functions.zones import natural_zone_name, zone_number


def natural_zones(stations: DataFrame, bands=S.NATURAL_BANDS) -> DataFrame:
    """(code, zone_name) for stations inside a band; one CASE, one pass."""
    named = (stations.select("code", F.col("lat").cast("double").alias("_lat"))
             .select("code", natural_zone_name("_lat", bands).alias("zone_name")))
    return named.where(F.col("zone_name").isNotNull())


def natural_zones_union(stations: DataFrame, bands=S.NATURAL_BANDS) -> DataFrame:
    """Same result as :func:`natural_zones`, built as the reference does:
    one filter and literal per band, then a bag union (duplicates kept)."""
    lat = F.col("lat").cast("double")
    parts = []
    for name, upper, lower, lower_incl in bands:
        low = (lat >= F.lit(lower)) if lower_incl else (lat > F.lit(lower))
        parts.append(stations.where((lat <= F.lit(upper)) & low)
                     .select("code", F.lit(name).alias("zone_name")))
    return reduce(DataFrame.unionByName, parts)


def zone_lookup_from_names(named: DataFrame) -> DataFrame:
    """(code, zone_name) -> (code, zone) with unique canonical codes; unknown names -> 0.

    A code that repeats keeps its largest zone number, so a lookup never
    multiplies the rows it is joined to.
    """
    return (named.select(canonical_code("code").alias("code"), zone_number("zone_name").alias("zone"))
            .groupBy("code").agg(F.max("zone").alias("zone")))
