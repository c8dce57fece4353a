"""Table schemas and the reference's fixed values.

Column names are ours (English); the positions match the reference files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's for identical results ---
# Number of metadata lines at the top of the raw matrix (the code skips 15).
N_META_LINES = 15
# Institution excluded from the daily table.
EXCLUDED_INSTITUTIONS = ("GHCN",)
# Continental bounding box, every bound exclusive: lat in (-55, -18), lon in (-76, -66).
BBOX = {"lat_min": -55.0, "lat_max": -18.0, "lon_min": -76.0, "lon_max": -66.0}
# Missing-value sentinel; a value is missing when int(float(v)) equals it.
SENTINEL = -9999
# First year kept by the accumulations (year >= 1900).
MIN_YEAR = 1900
# Completeness rule: a station-year needs at least 346 observed rows.
MIN_DAYS = 346
# Natural-zone path keeps years strictly after 1960.
NATURAL_MIN_YEAR_EXCLUSIVE = 1960
# Coordinate validity guard of the region notebook: lat > -80 and lon > -180.
VALID_LAT_MIN = -80.0
VALID_LON_MIN = -180.0
# Natural zones by latitude: (name, upper bound inclusive, lower bound, lower inclusive).
NATURAL_BANDS = (
    ("Norte Grande", -17.8, -28.0, False),
    ("Norte Chico", -28.0, -32.0, False),
    ("Centro", -32.0, -37.0, False),
    ("Sur", -37.0, -43.5, False),
    ("Austral", -43.5, -56.0, True),
)
# Zone name -> number; any other name maps to 0.
NATURAL_ZONE_NUMBERS = {"Norte Grande": 1, "Norte Chico": 2, "Centro": 3, "Sur": 4, "Austral": 5}
UNKNOWN_ZONE = 0
# Drought threshold drawn on the SPI plots, and the highlighted recent period.
DROUGHT_SPI = -1.0
RECENT_YEARS = (2009, 2018)
# Histogram and fitted-curve resolution of the plots.
HIST_BINS = 25
CURVE_POINTS = 100
# Default axes margin of the plotting library (x limits = data range +- 5 %).
PLOT_MARGIN = 0.05
# Projection of the boundary file: WGS84, UTM zone 19 south.
WGS84_A = 6378137.0
WGS84_INV_F = 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
UTM_ZONE = 19
# --- end of fixed values ---

# Station metadata file (15 columns, header line).
STATIONS = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("institution", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("basin_code", T.StringType()),
    T.StructField("basin_name", T.StringType()),
    T.StructField("subbasin_code", T.StringType()),
    T.StructField("subbasin_name", T.StringType()),
    T.StructField("obs_start", T.StringType()),
    T.StructField("obs_end", T.StringType()),
    T.StructField("obs_count", T.IntegerType()),
    T.StructField("auto_start", T.StringType()),
])
STATION_FIELDS = tuple(f.name for f in STATIONS.fields)

# Daily long table (TSV in the reference, Parquet here).
DAILY = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("precip", T.DoubleType()),
])

YEARLY = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("days", T.LongType()),
    T.StructField("precip", T.DoubleType()),
])

MONTHLY = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("days", T.LongType()),
    T.StructField("precip", T.DoubleType()),
])

# Yearly table as the reference writes it: "code##year", days, precip.
YEARLY_KEYED = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("days", T.LongType()),
    T.StructField("precip", T.DoubleType()),
])

ZONE_LOOKUP = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("zone", T.IntegerType()),
])

ZONE_NAME_LOOKUP = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("zone_name", T.StringType()),
])

# Boundary vertices: one row per vertex, seq dense from 0 within a feature.
BOUNDARIES = T.StructType([
    T.StructField("region", T.IntegerType()),
    T.StructField("feature_id", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])
