"""Joins on the station code between tables stored by that code.

A table written in buckets of its code, sorted within them, is read in the layout
that a join or a grouping on the code needs: two such tables of equal bucket
numbers are merged bucket by bucket with no exchange, however large both are. The
reference joins the yearly table with a lookup and with coordinates again and
again; here the shuffle is paid once, when a table is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.codes import canonical_code
from dryspell.session import scratch_path

#: Buckets of a stored table; all that are joined need the same number.
BUCKETS = 64


def store_by_code(df: DataFrame, name: str, *, path: str | None = None, buckets: int = BUCKETS,
                  key: str = "code", mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` as table ``name`` under ``path`` and read it back.

    One file a bucket: rows are dealt by the key before the write, by the hash that
    the buckets use. The table's layout is kept in the session's catalog; a station
    code with a third of all rows makes one large bucket, as it would one large
    partition of a shuffle join.
    """
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .option("path", path or scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def fresh_table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


def climatology_of_stored(yearly: DataFrame, stations: DataFrame, lookup: DataFrame) -> DataFrame:
    """(code, annual_mean, lat, lon, zone) from stored tables, by merge joins without an exchange.

    All three hold canonical codes. As :func:`stats.station_climatology`: a station row each,
    zone 0 where the lookup has none.
    """
    means = yearly.groupBy("code").agg(F.avg("precip").alias("annual_mean"))
    return (means.join(stations.select("code", "lat", "lon").hint("merge"), "code")
            .join(lookup.select("code", "zone").hint("merge"), "code", "left")
            .select("code", "annual_mean", "lat", "lon", F.coalesce("zone", F.lit(0)).alias("zone")))


def store_for_climatology(yearly: DataFrame, stations: DataFrame, lookup: DataFrame,
                          buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables stored by canonical code under fresh names."""
    places = stations.select(canonical_code("code").alias("code"), "lat", "lon")
    return tuple(store_by_code(df, fresh_table_name(stem), buckets=buckets)
                 for df, stem in ((yearly, "yearly"), (places, "stations"), (lookup, "lookup")))
