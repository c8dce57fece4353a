"""Independent DuckDB SQL for every catalogue query (the correctness oracle).

Written directly against the driver tables, re-deriving the views in SQL, so a
mistake in a Spark operator cannot leak into its own check.
"""

from __future__ import annotations

import math


def _canon(c: str) -> str:
    return f"regexp_replace({c}, '^0+([0-9]+)$', '\\1')"


def _pad(k: str) -> str:
    t = f"CAST({k} AS VARCHAR)"
    return f"CASE WHEN length({t}) < 8 THEN lpad({t}, 8, '0') ELSE {t} END"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


VIEWS = f"""
stn AS (
  SELECT s_suppkey, s_nationkey,
         {_pad('s_suppkey')} AS code,
         CASE s_suppkey % 5 WHEN 0 THEN 'GHCN' WHEN 1 THEN 'DGA' ELSE 'DMC' END AS institution,
         'src-' || CAST(s_nationkey AS VARCHAR) AS source,
         s_name AS name,
         CAST(s_nationkey * 100 AS DOUBLE) AS altitude,
         -17.0 - (s_acctbal + 1000.0) / 11000.0 * 40.0 AS lat,
         -64.0 - CAST(s_suppkey % 14 AS DOUBLE) AS lon,
         CAST(s_nationkey AS VARCHAR) AS basin_code,
         'basin ' || CAST(s_nationkey AS VARCHAR) AS basin_name,
         CAST(s_suppkey % 7 AS VARCHAR) AS subbasin_code,
         'subbasin ' || CAST(s_suppkey % 7 AS VARCHAR) AS subbasin_name,
         '1992-01-01' AS obs_start, '1998-12-31' AS obs_end,
         CAST(s_suppkey % 1000 AS INTEGER) AS obs_count, 'n/a' AS auto_start
  FROM supplier),
stn_ok AS (
  SELECT * FROM stn
  WHERE institution <> 'GHCN' AND lon > -76.0 AND lon < -66.0 AND lat > -55.0 AND lat < -18.0),
daily_raw AS (
  SELECT l_suppkey AS s_suppkey, {_pad('l_suppkey')} AS code, CAST(CASE WHEN l_linenumber = 6 AND l_quantity < 10 THEN l_shipdate - INTERVAL 100 YEAR
                   ELSE l_shipdate END AS DATE) AS date,
         CASE WHEN l_linenumber = 7 THEN CAST(-9999.0 AS DOUBLE) ELSE l_quantity END AS value
  FROM lineitem),
daily_obs AS (
  SELECT * FROM daily_raw WHERE CAST(trunc(value) AS BIGINT) <> -9999),
daily AS (
  SELECT {_canon('code')} AS code, CAST(year(date) AS INTEGER) AS year,
         CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, value AS precip
  FROM daily_obs WHERE s_suppkey IN (SELECT s_suppkey FROM stn_ok)),
yearly AS (
  SELECT code, year, count(*) AS days, sum(precip) AS precip
  FROM daily WHERE year >= 1900 GROUP BY code, year HAVING count(*) >= 75),
monthly AS (
  SELECT code, year, month, count(*) AS days, sum(precip) AS precip
  FROM daily WHERE year >= 1900 GROUP BY code, year, month),
region_lookup AS (
  SELECT {_canon('code')} AS code, CAST(s_nationkey % 16 AS INTEGER) AS zone FROM stn),
natural_named AS (
  SELECT code,
         CASE WHEN lat <= -17.8 AND lat > -28.0 THEN 'Norte Grande'
              WHEN lat <= -28.0 AND lat > -32.0 THEN 'Norte Chico'
              WHEN lat <= -32.0 AND lat > -37.0 THEN 'Centro'
              WHEN lat <= -37.0 AND lat > -43.5 THEN 'Sur'
              WHEN lat <= -43.5 AND lat >= -56.0 THEN 'Austral' END AS zone_name
  FROM stn),
natural_zone AS (SELECT code, zone_name FROM natural_named WHERE zone_name IS NOT NULL),
natural_lookup AS (
  SELECT {_canon('code')} AS code,
         CAST(CASE zone_name WHEN 'Norte Grande' THEN 1 WHEN 'Norte Chico' THEN 2 WHEN 'Centro' THEN 3
                             WHEN 'Sur' THEN 4 WHEN 'Austral' THEN 5 ELSE 0 END AS INTEGER) AS zone
  FROM natural_zone),
yz_region AS (
  SELECT y.code, y.year, y.precip, l.zone FROM yearly y JOIN region_lookup l ON y.code = l.code),
yz_natural AS (
  SELECT y.code, y.year, y.precip, l.zone FROM yearly y JOIN natural_lookup l ON y.code = l.code
  WHERE y.year > 1996),
med_region AS (SELECT zone, year, median(precip) AS median FROM yz_region GROUP BY zone, year),
ms_region AS (SELECT zone, avg(precip) AS mean, stddev_pop(precip) AS std FROM yz_region GROUP BY zone),
spi_region AS (
  SELECT m.zone, m.year, (m.median - s.mean) / nullif(s.std, 0) AS spi
  FROM med_region m JOIN ms_region s ON m.zone = s.zone),
med_natural AS (SELECT zone, year, median(precip) AS median FROM yz_natural GROUP BY zone, year),
ms_natural AS (SELECT zone, avg(precip) AS mean, stddev_pop(precip) AS std FROM yz_natural GROUP BY zone),
clim AS (
  SELECT a.code, a.annual_mean, s.lat, s.lon, coalesce(l.zone, 0) AS zone
  FROM (SELECT code, avg(precip) AS annual_mean FROM yearly GROUP BY code) a
  JOIN (SELECT {_canon('code')} AS code, lat, lon FROM stn) s ON a.code = s.code
  LEFT JOIN (SELECT {_canon('code')} AS code, CAST(s_nationkey % 16 AS INTEGER) AS zone FROM stn
             WHERE s_suppkey % 9 <> 0) l ON a.code = l.code),
stn_rep AS (
  SELECT code || '#1' AS code, lat, lon FROM stn
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR) || '#2', lat - 0.25, lon FROM stn WHERE s_suppkey % 4 = 0),
bnd_v AS (
  SELECT CAST(s_suppkey % 16 AS INTEGER) AS region, (s_suppkey // 16) * 4 + j AS v, s_acctbal
  FROM supplier CROSS JOIN (SELECT unnest(range(0, 4)) AS j) r),
bnd AS (
  SELECT region, CAST(v // 8 AS INTEGER) AS feature_id, CAST(v % 8 AS INTEGER) AS seq,
         200000.0 + CAST(v % 8 AS DOUBLE) * 30000.0 + CAST((v // 8) % 4 AS DOUBLE) * 250000.0 AS x,
         8000000.0 - CAST(region AS DOUBLE) * 280000.0
                   - CAST(floor(CAST(v // 8 AS DOUBLE) / 4.0) AS DOUBLE) * 20000.0
                   - CAST(v % 8 AS DOUBLE) * 2000.0 - s_acctbal AS y
  FROM bnd_v
  UNION ALL
  SELECT CAST(s_suppkey % 16 AS INTEGER), CAST(1000000000 + s_suppkey AS INTEGER), 0, 300000.0,
         7000000.0 - s_acctbal FROM supplier WHERE s_suppkey % 10 = 0),
seg AS (
  SELECT a.region, a.feature_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS bby
  FROM bnd a JOIN bnd b
    ON a.region = b.region AND a.feature_id = b.feature_id AND b.seq = a.seq + 1)
"""


def _utm_sql() -> str:
    f = 1.0 / 298.257223563
    n = f / (2.0 - f)
    big_a = 6378137.0 / (1.0 + n) * (1.0 + n ** 2 / 4.0 + n ** 4 / 64.0)
    a1 = n / 2.0 - 2.0 * n ** 2 / 3.0 + 5.0 * n ** 3 / 16.0
    a2 = 13.0 * n ** 2 / 48.0 - 3.0 * n ** 3 / 5.0
    a3 = 61.0 * n ** 3 / 240.0
    c = 2.0 * math.sqrt(n) / (1.0 + n)
    ka = 0.9996 * big_a
    t_expr = f"sinh(atanh(sin(radians(lat))) - {_d(c)} * atanh({_d(c)} * sin(radians(lat))))"
    return f"""
utm_t AS (
  SELECT code, {t_expr} AS t, radians(lon - CAST(-69.0 AS DOUBLE)) AS d
  FROM stn WHERE lat > -80.0 AND lon > -180.0),
utm_xe AS (
  SELECT code, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1.0 + t * t)) AS eta FROM utm_t),
pts AS (
  SELECT code,
    500000.0 + {_d(ka)} * (eta + {_d(a1)} * cos(2.0 * xi) * sinh(2.0 * eta)
                               + {_d(a2)} * cos(4.0 * xi) * sinh(4.0 * eta)
                               + {_d(a3)} * cos(6.0 * xi) * sinh(6.0 * eta)) AS x,
    10000000.0 + {_d(ka)} * (xi + {_d(a1)} * sin(2.0 * xi) * cosh(2.0 * eta)
                                + {_d(a2)} * sin(4.0 * xi) * cosh(4.0 * eta)
                                + {_d(a3)} * sin(6.0 * xi) * cosh(6.0 * eta)) AS y
  FROM utm_xe)"""


def _pair_d2(segs: str) -> str:
    return f"""
  SELECT code, region, feature_id,
         (px - (ax + u * (bx - ax))) * (px - (ax + u * (bx - ax)))
       + (py - (ay + u * (bby - ay))) * (py - (ay + u * (bby - ay))) AS d2
  FROM (
    SELECT p.code, p.x AS px, p.y AS py, s.region, s.feature_id, s.ax, s.ay, s.bx, s.bby,
           CASE WHEN (s.bx - s.ax) * (s.bx - s.ax) + (s.bby - s.ay) * (s.bby - s.ay) = 0 THEN 1.0
                ELSE greatest(0.0, least(1.0, ((p.x - s.ax) * (s.bx - s.ax) + (p.y - s.ay) * (s.bby - s.ay))
                     / ((s.bx - s.ax) * (s.bx - s.ax) + (s.bby - s.ay) * (s.bby - s.ay)))) END AS u
    FROM pts p CROSS JOIN {segs} s)"""


GEO = _utm_sql() + f""",
seg_first AS (
  SELECT * FROM seg s
  WHERE s.feature_id = (SELECT min(b.feature_id) FROM bnd b WHERE b.region = s.region)),
pair_all AS ({_pair_d2('seg')}),
pair_first AS ({_pair_d2('seg_first')}),
region_d2 AS (SELECT code, region, min(d2) AS d2 FROM pair_all GROUP BY code, region),
nearest_all AS (
  SELECT code, region, d2 FROM (
    SELECT code, region, d2, row_number() OVER (PARTITION BY code ORDER BY d2, region) AS rn
    FROM pair_all) WHERE rn = 1),
nearest_first AS (
  SELECT code, region, d2 FROM (
    SELECT code, region, d2, row_number() OVER (PARTITION BY code ORDER BY d2, region) AS rn
    FROM pair_first) WHERE rn = 1)
"""


def _with(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip().rstrip(",") for b in blocks) + "\n"


def _hist_sql(bins: int = 25) -> str:
    edge = (lambda i: f"(CASE WHEN {i} = {bins} THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END)")
    return f"""
rng AS (
  SELECT zone, n, lo, hi, (hi - lo) / {bins}.0 AS step FROM (
    SELECT zone, count(precip) AS n,
           CASE WHEN min(precip) = max(precip) THEN min(precip) - 0.5 ELSE min(precip) END AS lo,
           CASE WHEN min(precip) = max(precip) THEN max(precip) + 0.5 ELSE max(precip) END AS hi
    FROM yz_region GROUP BY zone)),
b0 AS (
  SELECT y.zone, y.precip AS v, r.lo, r.hi, r.step,
         least(CAST(floor((y.precip - r.lo) * ({bins}.0 / (r.hi - r.lo))) AS BIGINT), {bins - 1}) AS i0
  FROM yz_region y JOIN rng r ON y.zone = r.zone),
b1 AS (SELECT *, CASE WHEN v < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT zone, CASE WHEN v >= {edge('(i1 + 1)')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM b1),
cnt AS (SELECT zone, bin, count(*) AS c FROM b2 GROUP BY zone, bin),
spine AS (SELECT r.*, CAST(unnest(range(0, {bins})) AS BIGINT) AS bin FROM rng r),
hist AS (
  SELECT s.zone, CAST(s.bin AS INTEGER) AS bin,
         {edge('s.bin').replace('hi', 's.hi').replace('step', 's.step').replace('lo', 's.lo')} AS bin_lo,
         {edge('(s.bin + 1)').replace('hi', 's.hi').replace('step', 's.step').replace('lo', 's.lo')} AS bin_hi,
         coalesce(c.c, 0) AS count, s.n
  FROM spine s LEFT JOIN cnt c ON s.zone = c.zone AND s.bin = c.bin)
"""


def _curve_sql(points: int = 100, margin: float = 0.05) -> str:
    return f"""
crng AS (
  SELECT zone, lo - (hi - lo) * {margin!r} AS x0, hi + (hi - lo) * {margin!r} AS x1 FROM rng),
grid AS (
  SELECT c.zone, m.mean, m.std, c.x0, c.x1, CAST(unnest(range(0, {points})) AS INTEGER) AS i
  FROM crng c JOIN ms_region m ON c.zone = m.zone),
curve AS (
  SELECT zone, i, x, exp(-(((x - mean) / nullif(std, 0)) * ((x - mean) / nullif(std, 0))) / 2.0)
                     / {_d(math.sqrt(2.0 * math.pi))} / nullif(std, 0) AS pdf
  FROM (SELECT *, CASE WHEN i = {points - 1} THEN x1
                       ELSE CAST(i AS DOUBLE) * ((x1 - x0) / {points - 1}.0) + x0 END AS x FROM grid))
"""


SQL: dict[str, str] = {}

SQL["fix_code"] = _with(VIEWS) + f"""
SELECT raw_code, {_canon('raw_code')} AS code FROM (
  SELECT code AS raw_code FROM stn
  UNION ALL SELECT name FROM stn
  UNION ALL SELECT lpad(CAST(s_nationkey AS VARCHAR), 3, '0') FROM stn
  UNION ALL SELECT '00B' || CAST(s_suppkey AS VARCHAR) FROM stn)"""

SQL["station_filter"] = _with(VIEWS) + """
SELECT code, institution, lat, lon FROM stn_ok WHERE lat > -80.0 AND lon > -180.0"""

SQL["sentinel_filter"] = _with(VIEWS) + f"""
SELECT code, date, CAST(v AS DOUBLE) AS precip FROM (
  SELECT {_pad('l_suppkey')} AS code, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_linenumber = 7 THEN '-9999.000'
              WHEN l_linenumber = 6 AND l_quantity < 5 THEN '-9999.7'
              WHEN l_linenumber = 5 AND l_quantity < 5 THEN '-9998.9'
              ELSE CAST(l_quantity AS VARCHAR) END AS v
  FROM lineitem)
WHERE CAST(trunc(CAST(v AS DOUBLE)) AS BIGINT) <> -9999"""

SQL["date_parts"] = _with(VIEWS) + """
SELECT code, strftime(date, '%Y-%m-%d') AS label,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day
FROM daily_obs"""

SQL["matrix_melt"] = _with(VIEWS) + f"""
SELECT {_canon('s.code')} AS code, CAST(year(d.date) AS INTEGER) AS year,
       CAST(month(d.date) AS INTEGER) AS month, CAST(day(d.date) AS INTEGER) AS day, sum(d.value) AS precip
FROM daily_obs d JOIN stn_ok s ON d.s_suppkey = s.s_suppkey
GROUP BY s.code, d.date"""

SQL["wide_unpivot"] = _with(VIEWS) + "SELECT code, year, month, precip FROM monthly"
SQL["yearly_accumulation"] = _with(VIEWS) + "SELECT code, year, days, precip FROM yearly"
SQL["yearly_selfjoin"] = SQL["yearly_accumulation"]
SQL["monthly_accumulation"] = _with(VIEWS) + "SELECT code, year, month, days, precip FROM monthly"
SQL["monthly_selfjoin"] = SQL["monthly_accumulation"]
SQL["completeness_report"] = _with(VIEWS) + """
SELECT count(*) AS station_years, count(*) FILTER (WHERE days >= 75) AS complete_station_years
FROM (SELECT code, year, count(*) AS days FROM daily WHERE year >= 1900 GROUP BY code, year)"""
SQL["composite_key_roundtrip"] = _with(VIEWS) + """
SELECT code || '##' || CAST(year AS VARCHAR) AS key, code, year, days, precip FROM yearly"""

SQL["natural_zone"] = _with(VIEWS) + "SELECT code, zone_name FROM natural_zone"
SQL["natural_zone_union"] = SQL["natural_zone"]
SQL["zone_number_map"] = _with(VIEWS) + """
SELECT zone_name, zone,
       CASE zone WHEN 1 THEN 'Norte Grande' WHEN 2 THEN 'Norte Chico' WHEN 3 THEN 'Centro'
                 WHEN 4 THEN 'Sur' WHEN 5 THEN 'Austral' END AS zone_label
FROM (SELECT zone_name,
             CAST(CASE zone_name WHEN 'Norte Grande' THEN 1 WHEN 'Norte Chico' THEN 2 WHEN 'Centro' THEN 3
                                 WHEN 'Sur' THEN 4 WHEN 'Austral' THEN 5 ELSE 0 END AS INTEGER) AS zone
      FROM (SELECT zone_name FROM natural_zone UNION ALL SELECT n_name FROM nation))"""

SQL["yearly_with_zone"] = _with(VIEWS) + "SELECT code, year, precip, zone FROM yz_region"
SQL["zone_lookup_default"] = _with(VIEWS) + f"""
SELECT s.code, coalesce(l.zone, 0) AS zone
FROM (SELECT {_canon('code')} AS code FROM stn) s LEFT JOIN natural_lookup l ON s.code = l.code"""
SQL["median_by_zone_year"] = _with(VIEWS) + "SELECT zone, year, median FROM med_region"
SQL["mean_std_by_zone"] = _with(VIEWS) + """
SELECT zone, round(mean, 6) AS mean, round(std, 6) AS std FROM ms_region"""
SQL["spi_by_region"] = _with(VIEWS) + "SELECT zone, year, round(spi, 6) AS spi FROM spi_region"
SQL["spi_by_natural_zone"] = _with(VIEWS) + """
SELECT m.zone, m.year, round((m.median - s.mean) / nullif(s.std, 0), 6) AS spi
FROM med_natural m JOIN ms_natural s ON m.zone = s.zone"""
SQL["station_annual_mean"] = _with(VIEWS) + """
SELECT code, round(avg(precip), 6) AS annual_mean FROM yearly GROUP BY code"""
SQL["station_climatology"] = _with(VIEWS) + """
SELECT code, round(annual_mean, 6) AS annual_mean, lat, lon, zone FROM clim"""

SQL["spi_series_flags"] = _with(VIEWS) + """
SELECT zone, year, round(spi, 6) AS spi, spi <= -1.0 AS is_drought,
       year BETWEEN 1997 AND 1998 AS is_recent
FROM spi_region"""
SQL["spi_preview"] = _with(VIEWS) + """
SELECT zone, year, round(spi, 6) AS spi FROM spi_region ORDER BY zone, year LIMIT 5"""
SQL["zone_histogram"] = _with(VIEWS, _hist_sql()) + """
SELECT zone, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, count,
       round(count / (bin_hi - bin_lo) / n, 12) AS density
FROM hist"""
SQL["normal_fit_curve"] = _with(VIEWS, _hist_sql(), _curve_sql()) + """
SELECT zone, i, round(x, 6) AS x, round(pdf, 12) AS pdf FROM curve"""
SQL["latitude_profile"] = _with(VIEWS) + """
SELECT code, round(annual_mean, 6) AS annual_mean, lat, lon, zone,
       'Zone ' || CAST(zone AS VARCHAR) AS zone_label, zone = 3 AS highlighted
FROM clim"""
SQL["distinct_zones"] = _with(VIEWS) + "SELECT DISTINCT zone FROM clim"

SQL["utm_project"] = _with(VIEWS, GEO) + "SELECT code, round(x, 3) AS x, round(y, 3) AS y FROM pts"
SQL["point_boundary_distance"] = _with(VIEWS, GEO) + """
SELECT s.code, CAST(s.s_nationkey % 16 AS INTEGER) AS region, round(sqrt(d2), 3) AS dist
FROM stn s JOIN pts p ON s.code = p.code
LEFT JOIN region_d2 d ON d.code = s.code AND d.region = s.s_nationkey % 16"""
SQL["nearest_region"] = _with(VIEWS, GEO) + """
SELECT code, region, round(sqrt(d2), 3) AS dist FROM nearest_all"""
SQL["nearest_region_first_feature"] = _with(VIEWS, GEO) + """
SELECT code, region, round(sqrt(d2), 3) AS dist FROM nearest_first"""
GEO_REPEATED = GEO.replace("FROM stn WHERE", "FROM stn_rep WHERE")
SQL["nearest_region_repeated"] = _with(VIEWS, GEO_REPEATED) + """
SELECT split_part(code, '#', 1) AS code, region, round(sqrt(d2), 3) AS dist FROM nearest_all"""
SQL["stations_per_region"] = _with(VIEWS, GEO_REPEATED) + """
SELECT region, count(*) AS stations FROM nearest_all GROUP BY region"""
SQL["features_per_region"] = _with(VIEWS) + """
SELECT region, count(DISTINCT feature_id) AS features FROM bnd GROUP BY region"""
SQL["close_rings"] = _with(VIEWS) + """
SELECT region, feature_id, seq, x, y FROM bnd b
WHERE 2 <= (SELECT count(*) FROM bnd c WHERE c.region = b.region AND c.feature_id = b.feature_id)
UNION ALL
SELECT b.region, b.feature_id, e.last + 1 AS seq, b.x, b.y
FROM bnd b JOIN (SELECT region, feature_id, max(seq) AS last, count(*) AS n FROM bnd GROUP BY region, feature_id) e
  ON b.region = e.region AND b.feature_id = e.feature_id
WHERE b.seq = 0 AND e.n >= 2"""

SQL["tsv_roundtrip"] = SQL["yearly_accumulation"]
SQL["station_csv_read"] = _with(VIEWS) + """
SELECT code, institution, source, name || ', ' || source AS name, altitude, lat, lon, basin_code,
       basin_name, subbasin_code, subbasin_name, obs_start, obs_end, obs_count, auto_start
FROM stn"""
SQL["boundary_table_read"] = _with(VIEWS) + "SELECT region, feature_id, seq, x, y FROM bnd"
SQL["region_partitioned_roundtrip"] = SQL["boundary_table_read"]

SQL["daily_tsv_roundtrip"] = _with(VIEWS) + "SELECT code, year, month, day, precip FROM daily"
SQL["zone_lookup_roundtrip"] = _with(VIEWS) + "SELECT code, zone FROM region_lookup"
SQL["zone_name_lookup_roundtrip"] = _with(VIEWS) + "SELECT code, zone FROM natural_lookup"
SQL["result_tsv_read"] = SQL["spi_by_region"]
SQL["spi_series_one_zone"] = _with(VIEWS) + """
SELECT zone, year, round(spi, 6) AS spi, spi <= -1.0 AS is_drought,
       year BETWEEN 1997 AND 1998 AS is_recent
FROM spi_region WHERE zone = 3"""
SQL["boundary_region_filter"] = _with(VIEWS) + "SELECT region, feature_id, seq, x, y FROM bnd WHERE region = 13"

SQL["natural_median"] = _with(VIEWS) + "SELECT zone, year, median FROM med_natural"
SQL["natural_mean_std"] = _with(VIEWS) + """
SELECT zone, round(mean, 6) AS mean, round(std, 6) AS std FROM ms_natural"""
SQL["natural_climatology"] = _with(VIEWS) + f"""
SELECT a.code, round(a.annual_mean, 6) AS annual_mean, s.lat, s.lon, coalesce(l.zone, 0) AS zone
FROM (SELECT code, avg(precip) AS annual_mean FROM yearly WHERE year > 1996 GROUP BY code) a
JOIN (SELECT {_canon('code')} AS code, lat, lon FROM stn) s ON a.code = s.code
LEFT JOIN natural_lookup l ON a.code = l.code"""
SQL["station_climatology_repeated"] = _with(VIEWS) + f"""
SELECT a.code, round(a.annual_mean, 6) AS annual_mean, s.lat, s.lon, coalesce(l.zone, 0) AS zone
FROM (SELECT code, avg(precip) AS annual_mean FROM yearly GROUP BY code) a
JOIN (SELECT {_canon("split_part(code, '#', 1)")} AS code, lat, lon FROM stn_rep) s ON a.code = s.code
LEFT JOIN region_lookup l ON a.code = l.code"""
SQL["latitude_profile_labelled"] = _with(VIEWS) + """
SELECT code, round(annual_mean, 6) AS annual_mean, lat, lon, zone,
       CASE zone WHEN 1 THEN 'first' WHEN 3 THEN 'third' ELSE 'Zone ' || CAST(zone AS VARCHAR) END AS zone_label,
       false AS highlighted
FROM clim"""
SQL["monthly_tsv_roundtrip"] = _with(VIEWS) + """
SELECT code || '##' || CAST(year AS VARCHAR) || '##' || lpad(CAST(month AS VARCHAR), 2, '0') AS key,
       code, year, month, days, precip FROM monthly"""
SQL["region_table_write"] = _with(VIEWS, GEO) + f"""
SELECT {_canon('code')} AS code, region AS zone FROM nearest_all"""

SQL["yearly_distinct_days"] = _with(VIEWS) + """
SELECT code, year, count(*) AS days, CAST(count(DISTINCT (month, day)) AS INTEGER) AS distinct_days,
       sum(precip) AS precip, count(*) >= 75 AS complete_by_rows, count(DISTINCT (month, day)) >= 75 AS complete_by_days
FROM daily WHERE year >= 1900 GROUP BY code, year"""
SQL["incremental_yearly"] = _with(VIEWS) + """
SELECT code, year, count(*) AS days, CAST(count(DISTINCT (month, day)) AS INTEGER) AS distinct_days,
       sum(precip) AS precip
FROM daily WHERE year >= 1900 GROUP BY code, year HAVING count(*) >= 75"""
SQL["incremental_monthly"] = _with(VIEWS) + """
SELECT code, year, month, count(*) AS days, CAST(count(DISTINCT day) AS INTEGER) AS distinct_days,
       sum(precip) AS precip
FROM daily WHERE year >= 1900 GROUP BY code, year, month"""
SQL["rank_in_zone"] = _with(VIEWS) + """
SELECT zone, year, month, day, code, precip,
       row_number() OVER (PARTITION BY zone ORDER BY year, month, day, code, precip) AS rank
FROM (SELECT d.*, coalesce(l.zone, 0) AS zone FROM daily d LEFT JOIN natural_lookup l ON d.code = l.code)"""
SQL["containing_region"] = _with(VIEWS, GEO) + """,
ring AS (
  SELECT region, feature_id, ax, ay, bx, bby FROM seg
  UNION ALL
  SELECT b.region, b.feature_id, b.x, b.y, f.x, f.y
  FROM bnd b JOIN bnd f ON f.region = b.region AND f.feature_id = b.feature_id AND f.seq = 0
  JOIN (SELECT region, feature_id, max(seq) AS last FROM bnd GROUP BY region, feature_id) e
    ON e.region = b.region AND e.feature_id = b.feature_id AND e.last = b.seq
  WHERE e.last >= 1),
spot AS (
  SELECT code, x, y FROM pts
  UNION ALL
  SELECT 'v-' || region || '-' || feature_id || '-' || seq, x, y FROM bnd WHERE feature_id < 1000000000),
hit AS (
  SELECT p.code, r.region FROM spot p CROSS JOIN ring r GROUP BY p.code, r.region
  HAVING sum(CASE WHEN (r.ay <= p.y) <> (r.bby <= p.y)
                   AND p.x < r.ax + (p.y - r.ay) * (r.bx - r.ax) / (r.bby - r.ay) THEN 1 ELSE 0 END) % 2 = 1
      OR bool_or((r.bx - r.ax) * (p.y - r.ay) - (r.bby - r.ay) * (p.x - r.ax) = 0
                 AND p.x BETWEEN least(r.ax, r.bx) AND greatest(r.ax, r.bx)
                 AND p.y BETWEEN least(r.ay, r.bby) AND greatest(r.ay, r.bby)))
SELECT p.code, h.region FROM spot p LEFT JOIN (SELECT code, min(region) AS region FROM hit GROUP BY code) h
  ON h.code = p.code"""


def _quantile_sql(p: str) -> str:
    """AS 241 in DuckDB, from the published coefficients listed with the Spark expression."""
    from dryspell.functions import distributions as D

    def poly(coefficients, x):
        return "(" + " + ".join(f"{_d(c)} * pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"

    def ratio(pair, x):
        return f"{poly(pair[0], x)} / {poly(pair[1], x)}"

    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * "
            f"{ratio(D.CENTRAL, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')} "
            f"ELSE sign({p} - 0.5) * CASE WHEN {r} <= 5 THEN {ratio(D.MIDDLE, f'({r} - 1.6)')} "
            f"ELSE {ratio(D.TAIL, f'({r} - 5.0)')} END END")


SEASON = """
excess AS (
  SELECT m.code, l.zone, m.year, m.month, m.year * 12 + m.month - 1 AS t, greatest(m.precip - 30.0, 0.0) AS precip
  FROM monthly m JOIN region_lookup l ON l.code = m.code),
season AS (
  SELECT a.code, a.zone, a.year, a.month, CASE WHEN count(*) = 3 THEN sum(b.precip) END AS total
  FROM excess a JOIN excess b ON b.code = a.code AND b.t BETWEEN a.t - 2 AND a.t
  GROUP BY a.code, a.zone, a.year, a.month),
moments AS (
  SELECT zone, month, count(*) AS n, count(*) FILTER (WHERE total <= 0) AS zeros,
         avg(total) FILTER (WHERE total > 0) AS mean, avg(ln(total)) FILTER (WHERE total > 0) AS log_mean
  FROM season WHERE total IS NOT NULL GROUP BY zone, month),
fit0 AS (SELECT zone, month, zeros / n AS zero_share, mean, n - zeros AS positive, ln(mean) - log_mean AS a FROM moments),
fit AS (
  SELECT zone, month, zero_share,
         CASE WHEN positive >= 2 AND a > 1e-12 THEN (1 + sqrt(1 + 4 * a / 3)) / (4 * a) END AS shape, mean
  FROM fit0),
level AS (
  SELECT s.*, f.shape, f.zero_share, s.total / (f.mean / f.shape) AS x
  FROM season s LEFT JOIN fit f ON f.zone = s.zone AND f.month = s.month),
share AS (
  SELECT *, CASE WHEN x IS NULL THEN NULL WHEN x <= 0 THEN zero_share
                 ELSE zero_share + (1 - zero_share) * least(1.0, list_sum(list_transform(
                        range(0, CAST(ceil(x + 12 * sqrt(x) + 80) AS BIGINT)),
                        lambda n: exp((shape + n) * ln(x) - x - lgamma(shape + 1 + n))))) END AS h0 FROM level),
held AS (SELECT *, least(greatest(h0, pow(2.0, -53)), 1 - pow(2.0, -53)) AS h FROM share)
"""
SQL["nearest_region_indexed"] = SQL["nearest_region"]
SQL["running_sums"] = _with(VIEWS, SEASON) + "SELECT code, zone, year, month, total FROM season"
SQL["gamma_fit"] = _with(VIEWS, SEASON) + """
SELECT zone, month, round(zero_share, 6) AS zero_share, round(shape, 6) AS shape, round(mean / shape, 6) AS scale FROM fit"""
SQL["seasonal_spi"] = _with(VIEWS, SEASON) + f"""
SELECT code, zone, year, month, total, round(CASE WHEN h0 IS NULL THEN NULL ELSE {_quantile_sql('h')} END, 5) AS spi
FROM held"""
SQL["colocated_climatology"] = _with(VIEWS) + f"""
SELECT a.code, round(a.annual_mean, 6) AS annual_mean, s.lat, s.lon, coalesce(l.zone, 0) AS zone
FROM (SELECT code, avg(precip) AS annual_mean FROM yearly GROUP BY code) a
JOIN (SELECT {_canon("split_part(code, '#', 1)")} AS code, lat, lon FROM stn_rep) s ON a.code = s.code
LEFT JOIN (SELECT {_canon('code')} AS code, CAST(s_nationkey % 16 AS INTEGER) AS zone FROM stn
           WHERE s_suppkey % 9 <> 0) l ON a.code = l.code"""
SQL["boundary_wkt_read"] = _with(VIEWS) + "SELECT region, feature_id, seq, x, y FROM bnd WHERE feature_id < 1000000000"
