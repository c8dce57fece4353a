"""Accumulations kept up to date: a mergeable state, rewritten only where new data falls.

The state has one row per station and month: rows, precipitation and a bitmap of
the days seen. All three merge (sum, sum, OR), and yearly and monthly totals, by
rows or by distinct days, follow from it without the daily table.

A state folder holds ``data/version=<n>/year=<y>`` and ``commits/version=<n>``. A
load reads the present state of the years it touches, merges, writes those years
under a new version and then commits the version with one small file that names the
load and its years. Other years stay where they are. A year is read from its
latest committed version, so a load that dies leaves nothing that is read, and a
load whose name is committed is not applied again. One load runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.operators import accumulate
from dryspell.operators._exec import materialize, release_after

STATE = "code string, month int, days bigint, precip double, day_bits bigint, year int"
COMMIT = "load string, years array<int>, version int"


def month_state(daily: DataFrame, *, min_year: int = S.MIN_YEAR) -> DataFrame:
    """(code, month, days, precip, day_bits, year): the mergeable totals of a daily table."""
    keys = ["code", "year", "month"]
    return (accumulate._valid(daily, keys, min_year).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("days"), F.sum("precip").alias("precip"),
                 F.bit_or(accumulate.day_bit("day")).alias("day_bits"))
            .select("code", "month", "days", "precip", "day_bits", "year"))


def merged(states: DataFrame) -> DataFrame:
    """One row per station and month of several states."""
    return (states.groupBy("code", "year", "month")
            .agg(F.sum("days").alias("days"), F.sum("precip").alias("precip"), F.bit_or("day_bits").alias("day_bits"))
            .select("code", "month", "days", "precip", "day_bits", "year"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(load, years, version) of every committed load."""
    if not _exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(f"{path}/commits")


def _versions(spark: SparkSession, path: str) -> dict[int, int]:
    """The latest committed version of each year: one number a year reaches the driver."""
    rows = (commits(spark, path).select("version", F.explode("years").alias("year"))
            .groupBy("year").agg(F.max("version").alias("version")).collect())
    return {r["year"]: r["version"] for r in rows}


def read_state(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The committed state, or that of some years; only their folders are read."""
    at = {y: v for y, v in _versions(spark, path).items() if years is None or y in set(years)}
    by_version: dict[int, list[int]] = {}
    for year, version in at.items():
        by_version.setdefault(version, []).append(year)
    out = spark.createDataFrame([], STATE)
    if not by_version:
        return out
    state = spark.read.schema(STATE + ", version int").parquet(f"{path}/data")
    # Both are partition columns: the condition prunes folders.
    wanted = " OR ".join(f"(version = {v} AND year IN ({', '.join(map(str, sorted(ys)))}))"
                         for v, ys in sorted(by_version.items()))
    return state.where(wanted).select(*out.columns)


def apply_load(spark: SparkSession, path: str, daily: DataFrame, load: str, *, min_year: int = S.MIN_YEAR) -> bool:
    """Merge a daily table into the state under ``path``; False if the load was committed before."""
    done = commits(spark, path)
    if not done.where(F.col("load") == load).isEmpty():
        return False
    version = (done.agg(F.max("version")).first()[0] or 0) + 1
    with release_after():
        delta = materialize(month_state(daily, min_year=min_year), "state-delta")
        years = sorted(r["year"] for r in delta.select("year").distinct().collect())
        if years:
            both = merged(read_state(spark, path, years).unionByName(delta))
            # A year of any size is written by as many tasks as adaptive execution finds it worth.
            (both.hint("rebalance", "year").write.mode("overwrite").partitionBy("year")
             .parquet(f"{path}/data/version={version}"))
    (spark.createDataFrame([(load, years)], "load string, years array<int>").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/commits/version={version}"))
    return True


def yearly_of(state: DataFrame, *, min_days: int | None = S.MIN_DAYS, distinct: bool = False) -> DataFrame:
    """(code, year, days, distinct_days, precip); the rule counts rows, or distinct days."""
    out = (state.groupBy("code", "year")
           .agg(F.sum("days").alias("days"), F.sum(F.bit_count("day_bits")).cast("int").alias("distinct_days"),
                F.sum("precip").alias("precip")))
    return out if min_days is None else out.where(F.col("distinct_days" if distinct else "days") >= F.lit(min_days))


def monthly_of(state: DataFrame) -> DataFrame:
    """(code, year, month, days, distinct_days, precip)."""
    return state.select("code", "year", "month", "days", F.bit_count("day_bits").alias("distinct_days"), "precip")
