"""End-to-end jobs: the reference's scripts as Spark jobs with typed outputs.

Each job reads files, composes the operators and writes its results (Parquet
by default, the reference's tab-separated text with ``fmt="tsv"``). Run them
from ``python -m dryspell.plans.jobs <job> ...``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from dryspell import schemas as S
from dryspell.operators import accumulate, nearest, stats
from dryspell.operators._exec import materialize, release_after
from dryspell.operators.ingest import daily_from_matrix, matrix_heads
from dryspell.operators.zones import natural_zones, zone_lookup_from_names
from dryspell.sources import readers, sinks


# Folders of the five statistics tables, as the reference names them.
STATISTICS_FOLDERS = {"yearly": "yearly-data-with-zone", "median": "median-year-zone", "moments": "mean-std-zone",
                      "spi": "yearly-spi-by-zone", "climatology": "mean-yearly-precip-lat-lon-zone"}


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    if fmt == "tsv":
        sinks.write_tsv(df, path, mode=mode)
    else:
        sinks.write_table(df, path, mode=mode)


def preprocess(spark: SparkSession, matrix_path: str, out: str, *, fmt: str = "parquet",
               mode: str = "errorifexists", header_out: str | None = None,
               header_in: str | None = None) -> None:
    """Stage 1: raw matrix text -> clean daily table (Parquet partitioned by year).

    ``header_out`` also writes the files' head lines (small); a later run over
    the same files may pass them as ``header_in``. A file that they lack fails
    the job.
    """
    with release_after():
        lines = readers.read_matrix_lines(spark, matrix_path)
        heads = None
        if header_in:
            heads = spark.read.parquet(header_in)
        elif header_out:
            matrix_heads(lines).write.mode(mode).parquet(header_out)
            heads = spark.read.parquet(header_out)
        daily = daily_from_matrix(lines, heads=heads)
        if fmt == "parquet":
            # Matrix lines are date-ordered, so a task holds few years; sorting
            # inside each task by (year, code) keeps files per task and year few
            # and gives row groups narrow code ranges for later pushdown.
            daily = daily.sortWithinPartitions("year", "code")
        if fmt == "parquet":
            sinks.write_table(daily, out, mode=mode, partition_by="year")
        else:
            sinks.write_daily_tsv(daily, out, mode=mode)


def yearly(spark: SparkSession, daily_path: str, out: str, *, min_days: int = S.MIN_DAYS,
           fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Stage 2a: station-year totals with the completeness rule."""
    daily = readers.read_daily(spark, daily_path, fmt="parquet" if fmt == "parquet" else "tsv")
    y = accumulate.yearly(daily, min_days=min_days)
    if fmt == "tsv":
        sinks.write_keyed_tsv(y, out, ["code", "year"], ["days", "precip"], mode=mode)
    else:
        sinks.write_table(y, out, mode=mode)


def monthly(spark: SparkSession, daily_path: str, out: str, *, fmt: str = "parquet",
            mode: str = "errorifexists") -> None:
    """Stage 2b: station-month totals."""
    daily = readers.read_daily(spark, daily_path, fmt="parquet" if fmt == "parquet" else "tsv")
    m = accumulate.monthly(daily)
    if fmt == "tsv":
        sinks.write_keyed_tsv(m, out, ["code", "year", "month"], ["days", "precip"], mode=mode)
    else:
        sinks.write_table(m, out, mode=mode)


def natural_zone_table(spark: SparkSession, stations_path: str, out: str, *,
                       fmt: str = "tsv", mode: str = "errorifexists") -> None:
    """Stage 3a: station -> natural-zone name."""
    _write(natural_zones(readers.read_stations(spark, stations_path)), out, fmt, mode)


def region_table(spark: SparkSession, stations_path: str, boundaries_path: str, out: str, *,
                 features: str = "all", utm_zone: int | None = S.UTM_ZONE,
                 boundaries_fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Stage 3b: station -> nearest administrative region, written as ``code,region``."""
    with release_after():
        pts = nearest.project_stations(readers.read_stations(spark, stations_path), utm_zone)
        bnd = readers.read_boundaries(spark, boundaries_path, fmt=boundaries_fmt)
        assigned = nearest.nearest_region(pts, bnd, features=features)
        assigned.select("code", "region").write.mode(mode).csv(out)


def zone_statistics(spark: SparkSession, yearly_path: str, stations_path: str, out_dir: str, *,
                    lookup_path: str, kind: str = "region", yearly_fmt: str = "parquet",
                    fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Stage 4: the five statistics tables for regions or natural zones.

    ``kind="region"`` reads a ``code,zone`` lookup; ``kind="natural"`` reads
    the ``code<TAB>zone name`` lookup and keeps years after 1960.
    """
    if yearly_fmt == "parquet":
        yearly_df = spark.read.schema(S.YEARLY).parquet(yearly_path)
    else:
        yearly_df = readers.read_yearly_keyed(spark, yearly_path)
    if kind == "natural":
        lookup = readers.read_zone_name_lookup(spark, lookup_path)
        min_year = S.NATURAL_MIN_YEAR_EXCLUSIVE
    else:
        lookup = readers.read_zone_lookup(spark, lookup_path)
        min_year = None
    with release_after():
        yz = stats.with_zone(yearly_df, lookup, on_missing="error", min_year_exclusive=min_year)
        # Each table is computed once: later ones read what the earlier ones wrote.
        folder = {k: os.path.join(out_dir, v) for k, v in STATISTICS_FOLDERS.items()}
        narrow = materialize(yz, "zone-statistics")
        _write(narrow, folder["yearly"], fmt, mode)
        medians = materialize(stats.median_by_zone_year(narrow, materialize_input=False), "zone-medians")
        _write(medians, folder["median"], fmt, mode)
        moments = materialize(stats.mean_std_by_zone(narrow), "zone-moments")
        _write(moments, folder["moments"], fmt, mode)
        _write(stats.spi_of(medians, moments), folder["spi"], fmt, mode)
        clim = stats.station_climatology(yearly_df, readers.read_stations(spark, stations_path), lookup,
                                         min_year_exclusive=min_year)
        _write(clim, folder["climatology"], fmt, mode)


def natural_lookup_from_stations(spark: SparkSession, stations_path: str) -> DataFrame:
    """(code, zone) numbers straight from the station file (stage 3a + name map)."""
    return zone_lookup_from_names(natural_zones(readers.read_stations(spark, stations_path)))


def main(argv: list[str] | None = None) -> None:
    from dryspell.session import build_session

    p = argparse.ArgumentParser(prog="dryspell")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("preprocess"); a.add_argument("matrix"); a.add_argument("out")
    a = sub.add_parser("yearly"); a.add_argument("daily"); a.add_argument("out")
    a.add_argument("--min-days", type=int, default=S.MIN_DAYS)
    a = sub.add_parser("monthly"); a.add_argument("daily"); a.add_argument("out")
    a = sub.add_parser("natural-zones"); a.add_argument("stations"); a.add_argument("out")
    a = sub.add_parser("regions"); a.add_argument("stations"); a.add_argument("boundaries"); a.add_argument("out")
    a.add_argument("--features", default="all", choices=["all", "first"])
    a = sub.add_parser("statistics"); a.add_argument("yearly"); a.add_argument("stations")
    a.add_argument("lookup"); a.add_argument("out_dir")
    a.add_argument("--kind", default="region", choices=["region", "natural"])
    args = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session()
    if args.job == "preprocess":
        preprocess(spark, args.matrix, args.out)
    elif args.job == "yearly":
        yearly(spark, args.daily, args.out, min_days=args.min_days)
    elif args.job == "monthly":
        monthly(spark, args.daily, args.out)
    elif args.job == "natural-zones":
        natural_zone_table(spark, args.stations, args.out)
    elif args.job == "regions":
        region_table(spark, args.stations, args.boundaries, args.out, features=args.features)
    else:
        zone_statistics(spark, args.yearly, args.stations, args.out_dir, lookup_path=args.lookup, kind=args.kind)


if __name__ == "__main__":
    main()
