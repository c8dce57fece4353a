"""Query catalogue: one Spark query per operator, each with a DuckDB oracle.

Every query reads the driver tables through :mod:`dryspell.plans.views` and
runs over the whole tables. Floating outputs that two engines may compute in
a different operation order are rounded identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.functions.codes import canonical_code, composite_key, key_part
from dryspell.functions.values import date_label_parts, is_missing, parse_value
from dryspell.functions.zones import zone_label, zone_number
from dryspell.operators import accumulate, boundaries as B, incremental, nearest as N, report as R, stats as ST
from dryspell.operators import colocated, seasonal, segment_index
from dryspell.operators._exec import materialize
from dryspell.operators.containment import containing_region
from dryspell.operators.ingest import daily_from_matrix, station_filter, unpivot_wide
from dryspell.operators.ranking import rank_in_group
from dryspell.operators.zones import natural_zones, natural_zones_union
from dryspell.plans import jobs
from dryspell.plans import views as V
from dryspell.session import scratch_path
from dryspell.sources import readers, sinks, wkt

Query = Callable[[SparkSession, str], DataFrame]


def _r(c, d):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- ingest

def q_fix_code(spark, sf):
    s = V.stations(spark, sf)
    raw = (s.select(F.col("code").alias("raw_code"))
           .unionByName(s.select(F.col("name").alias("raw_code")))
           .unionByName(s.select(F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("raw_code")))
           .unionByName(s.select(F.concat(F.lit("00B"), F.col("s_suppkey").cast("string")).alias("raw_code"))))
    return raw.select("raw_code", canonical_code("raw_code").alias("code"))


def q_station_filter(spark, sf):
    s = V.stations(spark, sf)
    valid = (F.col("lat") > F.lit(S.VALID_LAT_MIN)) & (F.col("lon") > F.lit(S.VALID_LON_MIN))
    return (s.where(station_filter("institution", "lat", "lon") & valid)
            .select("code", "institution", "lat", "lon"))


def q_sentinel_filter(spark, sf):
    li = V.table(spark, sf, "lineitem")
    text = (F.when(F.col("l_linenumber") == 7, F.lit("-9999.000"))
            .when((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 5), F.lit("-9999.7"))
            .when((F.col("l_linenumber") == 5) & (F.col("l_quantity") < 5), F.lit("-9998.9"))
            .otherwise(F.col("l_quantity").cast("string")))
    cells = li.select(V.padded_code(F.col("l_suppkey")).alias("code"),
                      F.to_date("l_shipdate").alias("date"), text.alias("v"))
    return cells.where(~is_missing("v")).select("code", "date", parse_value("v").alias("precip"))


def q_date_parts(spark, sf):
    raw = V.daily_raw(spark, sf).where(~is_missing("value"))
    label = F.date_format("date", "yyyy-MM-dd")
    y, m, d = date_label_parts(label)
    return raw.select("code", label.alias("label"), y.alias("year"), m.alias("month"), d.alias("day"))


def q_matrix_melt(spark, sf):
    return daily_from_matrix(readers.read_matrix_lines(spark, V.write_matrix_files(spark, sf)))


def q_wide_unpivot(spark, sf):
    monthly = accumulate.monthly(V.daily(spark, sf))
    months = list(range(1, 13))
    wide = monthly.groupBy("code", "year").pivot("month", months).agg(F.first("precip"))
    long = unpivot_wide(wide, ["code", "year"], [str(m) for m in months], "month", "precip")
    return long.select("code", "year", F.col("month").cast("int").alias("month"), "precip")


# ---------------------------------------------------------------- accumulation

def q_yearly_accumulation(spark, sf):
    return V.yearly(spark, sf)


def q_yearly_selfjoin(spark, sf):
    return accumulate.accumulate_by_join(V.daily(spark, sf), ["code", "year"], min_days=V.VIEW_MIN_DAYS)


def q_monthly_accumulation(spark, sf):
    return accumulate.monthly(V.daily(spark, sf))


def q_monthly_selfjoin(spark, sf):
    return accumulate.accumulate_by_join(V.daily(spark, sf), ["code", "year", "month"], min_days=None)


def q_completeness_report(spark, sf):
    return accumulate.completeness_report(V.daily(spark, sf), min_days=V.VIEW_MIN_DAYS)


def q_yearly_distinct_days(spark, sf):
    d = accumulate.yearly_distinct_days(V.daily(spark, sf), min_days=None)
    return d.select("*", (F.col("days") >= V.VIEW_MIN_DAYS).alias("complete_by_rows"),
                    (F.col("distinct_days") >= V.VIEW_MIN_DAYS).alias("complete_by_days"))


def _loaded_state(spark, sf):
    """The daily table loaded in two parts, the second of them twice."""
    path, daily = scratch_path(spark, "month-state"), V.daily(spark, sf)
    early, late = daily.where(f"day <= {V.LOAD_SPLIT_DAY}"), daily.where(f"day > {V.LOAD_SPLIT_DAY}")
    for part, load in ((early, "early"), (late, "late"), (late, "late")):
        incremental.apply_load(spark, path, part, load)
    return incremental.read_state(spark, path)


def q_incremental_yearly(spark, sf):
    return incremental.yearly_of(_loaded_state(spark, sf), min_days=V.VIEW_MIN_DAYS)


def q_incremental_monthly(spark, sf):
    return incremental.monthly_of(_loaded_state(spark, sf))


def q_rank_in_zone(spark, sf):
    daily = V.daily(spark, sf)
    zoned = ST.attach_zone(daily, V.natural_lookup(spark, sf), on_missing="zero")
    return rank_in_group(zoned.select("zone", "year", "month", "day", "code", "precip"), ["zone"],
                         ["year", "month", "day", "code", "precip"])


def _seasonal_sums(spark, sf):
    sums = seasonal.running_sums(V.monthly_excess(spark, sf), V.SEASON_MONTHS)
    return ST.attach_zone(sums, V.region_lookup(spark, sf), on_missing="error")


def q_running_sums(spark, sf):
    return _seasonal_sums(spark, sf)


def q_seasonal_spi(spark, sf):
    sums = materialize(_seasonal_sums(spark, sf), "seasonal-sums")
    s = seasonal.seasonal_spi(sums, ["zone", "month"])
    return s.select("code", "zone", "year", "month", "total", _r("spi", 5).alias("spi"))


def q_gamma_fit(spark, sf):
    keys = ["zone", "month"]
    fit = seasonal.gamma_fit(seasonal.gamma_moments(_seasonal_sums(spark, sf), keys), keys)
    return fit.select(*keys, _r("zero_share", 6).alias("zero_share"), _r("shape", 6).alias("shape"),
                      _r("scale", 6).alias("scale"))


def q_colocated_climatology(spark, sf):
    stored = colocated.store_for_climatology(V.yearly(spark, sf), V.repeated_stations(spark, sf),
                                             V.partial_lookup(spark, sf), buckets=8)
    c = colocated.climatology_of_stored(*stored)
    return c.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone")


def q_composite_key_roundtrip(spark, sf):
    keyed = V.yearly(spark, sf).select(composite_key("code", "year").alias("key"), "days", "precip")
    return keyed.select("key", canonical_code(key_part("key", 1)).alias("code"),
                        key_part("key", 2).cast("int").alias("year"), "days", "precip")


# ---------------------------------------------------------------- zones and statistics

def q_natural_zone(spark, sf):
    return natural_zones(V.station_file(spark, sf))


def q_natural_zone_union(spark, sf):
    return natural_zones_union(V.station_file(spark, sf))


def q_zone_number_map(spark, sf):
    names = (natural_zones(V.station_file(spark, sf)).select("zone_name")
             .unionByName(V.table(spark, sf, "nation").select(F.col("n_name").alias("zone_name"))))
    z = zone_number("zone_name")
    return names.select("zone_name", z.alias("zone"), zone_label(z).alias("zone_label"))


def _yz_region(spark, sf):
    return ST.with_zone(V.yearly(spark, sf), V.region_lookup(spark, sf), on_missing="error")


def _yz_natural(spark, sf):
    return ST.with_zone(V.yearly(spark, sf), V.natural_lookup(spark, sf), on_missing="error",
                        min_year_exclusive=V.VIEW_NATURAL_MIN_YEAR_EXCLUSIVE)


def q_yearly_with_zone(spark, sf):
    return _yz_region(spark, sf)


def q_zone_lookup_default(spark, sf):
    codes = V.stations(spark, sf).select(canonical_code("code").alias("code"))
    return ST.attach_zone(codes, V.natural_lookup(spark, sf), on_missing="zero")


def q_median_by_zone_year(spark, sf):
    return ST.median_by_zone_year(_yz_region(spark, sf))


def q_mean_std_by_zone(spark, sf):
    m = ST.mean_std_by_zone(_yz_region(spark, sf))
    return m.select("zone", _r("mean", 6).alias("mean"), _r("std", 6).alias("std"))


def q_spi_by_region(spark, sf):
    return ST.spi(_yz_region(spark, sf)).select("zone", "year", _r("spi", 6).alias("spi"))


def q_spi_by_natural_zone(spark, sf):
    return ST.spi(_yz_natural(spark, sf)).select("zone", "year", _r("spi", 6).alias("spi"))


def q_station_annual_mean(spark, sf):
    m = ST.station_annual_mean(V.yearly(spark, sf))
    return m.select("code", _r("annual_mean", 6).alias("annual_mean"))


def q_natural_median(spark, sf):
    return ST.median_by_zone_year(_yz_natural(spark, sf))


def q_natural_mean_std(spark, sf):
    m = ST.mean_std_by_zone(_yz_natural(spark, sf))
    return m.select("zone", _r("mean", 6).alias("mean"), _r("std", 6).alias("std"))


def q_natural_climatology(spark, sf):
    c = ST.station_climatology(V.yearly(spark, sf), V.station_file(spark, sf), V.natural_lookup(spark, sf),
                               min_year_exclusive=V.VIEW_NATURAL_MIN_YEAR_EXCLUSIVE)
    return c.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone")


def _climatology(spark, sf):
    return ST.station_climatology(V.yearly(spark, sf), V.station_file(spark, sf), V.partial_lookup(spark, sf))


def q_station_climatology_repeated(spark, sf):
    c = ST.station_climatology(V.yearly(spark, sf), V.repeated_stations(spark, sf), V.region_lookup(spark, sf))
    return c.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone")


def q_station_climatology(spark, sf):
    c = _climatology(spark, sf)
    return c.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone")


# ---------------------------------------------------------------- plot data

def q_spi_series_flags(spark, sf):
    s = R.spi_series(ST.spi(_yz_region(spark, sf)), recent=V.VIEW_RECENT)
    return s.select("zone", "year", _r("spi", 6).alias("spi"), "is_drought", "is_recent")


def q_spi_preview(spark, sf):
    top = R.preview(ST.spi(_yz_region(spark, sf)), ["zone", "year"], 5)
    return top.select("zone", "year", _r("spi", 6).alias("spi"))


def q_zone_histogram(spark, sf):
    h = R.zone_histogram(_yz_region(spark, sf))
    return h.select("zone", "bin", _r("bin_lo", 6).alias("bin_lo"), _r("bin_hi", 6).alias("bin_hi"),
                    "count", _r("density", 12).alias("density"))


def q_normal_fit_curve(spark, sf):
    yz = materialize(_yz_region(spark, sf).select("zone", "precip"), "zone-precip")
    c = R.normal_fit_curve(yz, ST.mean_std_by_zone(yz))
    return c.select("zone", "i", _r("x", 6).alias("x"), _r("pdf", 12).alias("pdf"))


def q_latitude_profile(spark, sf):
    p = R.latitude_profile(_climatology(spark, sf), highlight_zone=V.VIEW_HIGHLIGHT)
    return p.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone",
                    "zone_label", "highlighted")


def q_latitude_profile_labelled(spark, sf):
    p = R.latitude_profile(_climatology(spark, sf), labels=V.VIEW_LABELS)
    return p.select("code", _r("annual_mean", 6).alias("annual_mean"), "lat", "lon", "zone",
                    "zone_label", "highlighted")


def q_distinct_zones(spark, sf):
    return R.distinct_zones(_climatology(spark, sf))


# ---------------------------------------------------------------- regions

def _points(spark, sf):
    return N.project_stations(V.station_file(spark, sf))


def q_utm_project(spark, sf):
    p = _points(spark, sf)
    return p.select("code", _r("x", 3).alias("x"), _r("y", 3).alias("y"))


def q_point_boundary_distance(spark, sf):
    own = V.stations(spark, sf).select("code", (F.col("s_nationkey") % V.REGIONS).cast("int").alias("region"))
    d = N.distance_to_own_region(_points(spark, sf).join(own, "code"), V.boundaries(spark, sf))
    return d.select("code", "region", _r("dist", 3).alias("dist"))


def q_nearest_region(spark, sf):
    d = N.nearest_region(_points(spark, sf), V.boundaries(spark, sf))
    return d.select("code", "region", _r("dist", 3).alias("dist"))


def q_nearest_region_first_feature(spark, sf):
    d = N.nearest_region(_points(spark, sf), V.boundaries(spark, sf), features="first")
    return d.select("code", "region", _r("dist", 3).alias("dist"))


def _nearest_repeated(spark, sf):
    return N.nearest_region(N.project_stations(V.repeated_stations(spark, sf)), V.boundaries(spark, sf))


def q_nearest_region_repeated(spark, sf):
    return _nearest_repeated(spark, sf).select("code", "region", _r("dist", 3).alias("dist"))


def q_stations_per_region(spark, sf):
    return N.stations_per_region(_nearest_repeated(spark, sf))


def q_features_per_region(spark, sf):
    return B.features_per_region(V.boundaries(spark, sf))


def q_close_rings(spark, sf):
    return B.close_rings(V.boundaries(spark, sf))


def q_nearest_region_indexed(spark, sf):
    path, lines = scratch_path(spark, "segment-index"), V.boundaries(spark, sf)
    segment_index.add_boundaries(spark, path, lines.where("region % 2 = 0"), "first")
    segment_index.add_boundaries(spark, path, lines.where("region % 2 = 1"), "second")
    d = segment_index.nearest_region_indexed(_points(spark, sf), path)
    return d.select("code", "region", _r("dist", 3).alias("dist"))


def q_containing_region(spark, sf):
    return containing_region(V.points_and_vertices(spark, sf, _points(spark, sf)),
                             B.close_rings(V.boundaries(spark, sf)))


# ---------------------------------------------------------------- sources and sinks

def q_tsv_roundtrip(spark, sf):
    path = scratch_path(spark, "yearly-tsv")
    sinks.write_keyed_tsv(V.yearly(spark, sf), path, ["code", "year"], ["days", "precip"])
    return readers.read_yearly_keyed(spark, path)


def q_station_csv_read(spark, sf):
    path = scratch_path(spark, "stations-csv")
    st = V.station_file(spark, sf).withColumn("name", F.concat_ws(", ", "name", "source"))
    # A blank line after every line, as the station file may hold.
    st.write.option("header", True).option("lineSep", "\n\n").csv(path)
    return readers.read_stations(spark, path)


def q_monthly_tsv_roundtrip(spark, sf):
    path = scratch_path(spark, "monthly-tsv")
    sinks.write_keyed_tsv(accumulate.monthly(V.daily(spark, sf)), path, ["code", "year", "month"],
                          ["days", "precip"])
    text = spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("key"))
    back = readers.read_monthly_keyed(spark, path)
    key = F.concat_ws("##", "code", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return back.withColumn("key", key).join(text, "key").select("key", "code", "year", "month", "days", "precip")


def q_region_table_write(spark, sf):
    folder = scratch_path(spark, "region-table")
    V.station_file(spark, sf).write.option("header", True).csv(f"{folder}/stations")
    V.boundaries(spark, sf).write.parquet(f"{folder}/boundaries")
    jobs.region_table(spark, f"{folder}/stations", f"{folder}/boundaries", f"{folder}/out")
    return readers.read_zone_lookup(spark, f"{folder}/out")


def q_boundary_table_read(spark, sf):
    path = scratch_path(spark, "boundaries-csv")
    V.boundaries(spark, sf).write.option("header", True).csv(path)
    return readers.read_boundaries(spark, path, fmt="csv")


def q_boundary_wkt_read(spark, sf):
    path = scratch_path(spark, "boundaries-wkt")
    lines = V.boundaries(spark, sf).where(f"feature_id < {V.SINGLE_FROM}")
    sinks.write_tsv(wkt.wkt_of_features(lines, V.FEATURES_PER_TEXT), path)
    return wkt.read_boundaries_wkt(spark, path)


def q_region_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "boundaries-by-region")
    sinks.write_partitioned(V.boundaries(spark, sf), path, by="region")
    return readers.read_boundaries(spark, path).select("region", "feature_id", "seq", "x", "y")


def q_daily_tsv_roundtrip(spark, sf):
    path = scratch_path(spark, "daily-tsv")
    sinks.write_daily_tsv(V.daily(spark, sf), path)
    return readers.read_daily(spark, path, fmt="tsv")


def q_zone_lookup_roundtrip(spark, sf):
    path = scratch_path(spark, "region-lookup-csv")
    st = V.stations(spark, sf)
    raw = st.select("code", (F.col("s_nationkey") % V.REGIONS).cast("int").alias("zone"))
    raw.write.csv(path)
    return readers.read_zone_lookup(spark, path)


def q_zone_name_lookup_roundtrip(spark, sf):
    path = scratch_path(spark, "natural-zones-tsv")
    sinks.write_tsv(natural_zones(V.station_file(spark, sf)), path)
    return readers.read_zone_name_lookup(spark, path)


def q_result_tsv_read(spark, sf):
    path = scratch_path(spark, "spi-tsv")
    sinks.write_tsv(ST.spi(_yz_region(spark, sf)), path)
    back = readers.read_result_tsv(spark, path, "zone INT, year INT, spi DOUBLE")
    return back.select("zone", "year", _r("spi", 6).alias("spi"))


def q_spi_series_one_zone(spark, sf):
    s = R.spi_series(ST.spi(_yz_region(spark, sf)), zone=3, recent=V.VIEW_RECENT)
    return s.select("zone", "year", _r("spi", 6).alias("spi"), "is_drought", "is_recent")


def q_boundary_region_filter(spark, sf):
    path = scratch_path(spark, "boundaries-by-region")
    sinks.write_partitioned(V.boundaries(spark, sf), path, by="region")
    return (readers.read_boundaries(spark, path).where(F.col("region") == 13)
            .select("region", "feature_id", "seq", "x", "y"))


QUERIES: dict[str, Query] = {
    "fix_code": q_fix_code,
    "station_filter": q_station_filter,
    "sentinel_filter": q_sentinel_filter,
    "date_parts": q_date_parts,
    "matrix_melt": q_matrix_melt,
    "wide_unpivot": q_wide_unpivot,
    "yearly_accumulation": q_yearly_accumulation,
    "yearly_selfjoin": q_yearly_selfjoin,
    "monthly_accumulation": q_monthly_accumulation,
    "monthly_selfjoin": q_monthly_selfjoin,
    "completeness_report": q_completeness_report,
    "composite_key_roundtrip": q_composite_key_roundtrip,
    "natural_zone": q_natural_zone,
    "natural_zone_union": q_natural_zone_union,
    "zone_number_map": q_zone_number_map,
    "yearly_with_zone": q_yearly_with_zone,
    "zone_lookup_default": q_zone_lookup_default,
    "median_by_zone_year": q_median_by_zone_year,
    "mean_std_by_zone": q_mean_std_by_zone,
    "spi_by_region": q_spi_by_region,
    "spi_by_natural_zone": q_spi_by_natural_zone,
    "station_annual_mean": q_station_annual_mean,
    "station_climatology": q_station_climatology,
    "spi_series_flags": q_spi_series_flags,
    "spi_preview": q_spi_preview,
    "zone_histogram": q_zone_histogram,
    "normal_fit_curve": q_normal_fit_curve,
    "latitude_profile": q_latitude_profile,
    "natural_median": q_natural_median,
    "natural_mean_std": q_natural_mean_std,
    "natural_climatology": q_natural_climatology,
    "station_climatology_repeated": q_station_climatology_repeated,
    "latitude_profile_labelled": q_latitude_profile_labelled,
    "nearest_region_repeated": q_nearest_region_repeated,
    "monthly_tsv_roundtrip": q_monthly_tsv_roundtrip,
    "region_table_write": q_region_table_write,
    "distinct_zones": q_distinct_zones,
    "utm_project": q_utm_project,
    "point_boundary_distance": q_point_boundary_distance,
    "nearest_region": q_nearest_region,
    "nearest_region_first_feature": q_nearest_region_first_feature,
    "stations_per_region": q_stations_per_region,
    "features_per_region": q_features_per_region,
    "close_rings": q_close_rings,
    "tsv_roundtrip": q_tsv_roundtrip,
    "station_csv_read": q_station_csv_read,
    "boundary_table_read": q_boundary_table_read,
    "region_partitioned_roundtrip": q_region_partitioned_roundtrip,
    "daily_tsv_roundtrip": q_daily_tsv_roundtrip,
    "zone_lookup_roundtrip": q_zone_lookup_roundtrip,
    "zone_name_lookup_roundtrip": q_zone_name_lookup_roundtrip,
    "result_tsv_read": q_result_tsv_read,
    "spi_series_one_zone": q_spi_series_one_zone,
    "boundary_region_filter": q_boundary_region_filter,
    "yearly_distinct_days": q_yearly_distinct_days,
    "incremental_yearly": q_incremental_yearly,
    "incremental_monthly": q_incremental_monthly,
    "rank_in_zone": q_rank_in_zone,
    "containing_region": q_containing_region,
    "nearest_region_indexed": q_nearest_region_indexed,
    "running_sums": q_running_sums,
    "gamma_fit": q_gamma_fit,
    "seasonal_spi": q_seasonal_spi,
    "colocated_climatology": q_colocated_climatology,
    "boundary_wkt_read": q_boundary_wkt_read,
}
