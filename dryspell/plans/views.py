"""Station, daily, lookup and boundary views derived from the driver tables.

The driver's tables hold no rainfall, so the catalogue derives inputs with the
shapes of the reference's files: suppliers become stations, line items become
daily observations, nations become region boundaries. All parameters are
scale-independent, so every view grows with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.functions.codes import canonical_code
from dryspell.functions.values import is_missing
from dryspell.operators import accumulate
from dryspell.operators._exec import broadcast_checked
from dryspell.operators.ingest import station_filter
from dryspell.operators.zones import natural_zones, zone_lookup_from_names
from dryspell.session import scratch_path

# View parameters (ours, not the reference's).
CODE_WIDTH = 8                 # zero-padded station codes, as in the raw files
REGIONS = 16                   # administrative regions 0..15
VIEW_MIN_DAYS = 75             # completeness rule sized to the synthetic density
VIEW_NATURAL_MIN_YEAR_EXCLUSIVE = 1996  # the dates span the 1990s
MATRIX_BLOCK = 64              # stations per matrix file (column split)
FEATURE_VERTICES = 8           # vertices per boundary feature
SINGLE_FROM = 1_000_000_000    # feature ids of single vertices
VERTICES_PER_SUPPLIER = 4      # boundary vertices contributed by each supplier
SENTINEL_ROW = 7               # l_linenumber that marks a missing observation
OLD_ROW, OLD_BELOW = 6, 10     # such lines of a small quantity lie a century earlier
VIEW_RECENT = (1997, 1998)     # the plots' recent period, inside the synthetic dates
VIEW_HIGHLIGHT = 3             # zone drawn apart on the latitude profile
VIEW_LABELS = {1: "first", 3: "third"}
UNLISTED_EVERY = 9             # such stations are missing from the partial lookup
LOAD_SPLIT_DAY = 15            # days after it come with the second load
SEASON_MONTHS = 3              # months of a running sum
DRY_BELOW = 30.0               # a month's total up to this counts as dry in the seasonal view
FEATURES_PER_TEXT = 3          # boundary features in one multi-line text
REPEATED_EVERY = 4             # such stations appear twice, the second time without zeros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded_code(key) -> F.Column:
    k = key.cast("string")
    return F.when(F.length(k) < CODE_WIDTH, F.lpad(k, CODE_WIDTH, "0")).otherwise(k)


def padded_code_sql(key: str) -> str:
    """SQL text of :func:`padded_code` for a column name."""
    k = f"CAST({key} AS STRING)"
    return f"CASE WHEN length({k}) < {CODE_WIDTH} THEN lpad({k}, {CODE_WIDTH}, '0') ELSE {k} END"


# The views are written as SQL text: one JVM call per projection keeps plan
# construction cheap (each view is rebuilt by every catalogue query).

def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station metadata (the 15-column station file) plus the supplier key."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "s_nationkey",
        f"{padded_code_sql('s_suppkey')} AS code",
        "CASE WHEN s_suppkey % 5 = 0 THEN 'GHCN' WHEN s_suppkey % 5 = 1 THEN 'DGA' ELSE 'DMC' END AS institution",
        "concat('src-', CAST(s_nationkey AS STRING)) AS source",
        "s_name AS name",
        "CAST(s_nationkey * 100 AS DOUBLE) AS altitude",
        "-17.0D - (s_acctbal + 1000.0D) / 11000.0D * 40.0D AS lat",
        "-64.0D - CAST(s_suppkey % 14 AS DOUBLE) AS lon",
        "CAST(s_nationkey AS STRING) AS basin_code",
        "concat('basin ', CAST(s_nationkey AS STRING)) AS basin_name",
        "CAST(s_suppkey % 7 AS STRING) AS subbasin_code",
        "concat('subbasin ', CAST(s_suppkey % 7 AS STRING)) AS subbasin_name",
        "'1992-01-01' AS obs_start",
        "'1998-12-31' AS obs_end",
        "CAST(s_suppkey % 1000 AS INT) AS obs_count",
        "'n/a' AS auto_start",
    )


def station_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the 15 station-file columns."""
    return stations(spark, sf_dir).select(*S.STATION_FIELDS)


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, code, date, value) before any cleaning; line 7 is a missing day, some days lie before 1900."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS s_suppkey",
        f"{padded_code_sql('l_suppkey')} AS code",
        f"CASE WHEN l_linenumber = {OLD_ROW} AND l_quantity < {OLD_BELOW} THEN add_months(to_date(l_shipdate), -1200)"
        " ELSE to_date(l_shipdate) END AS date",
        f"CASE WHEN l_linenumber = {SENTINEL_ROW} THEN -9999.0D ELSE l_quantity END AS value",
    )


def kept_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations passing the institution and bounding-box filters."""
    st = stations(spark, sf_dir)
    return st.where(station_filter("institution", "lat", "lon"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean daily long table (stage-1 output): (code, year, month, day, precip)."""
    kept = broadcast_checked(kept_stations(spark, sf_dir).select("s_suppkey"))
    raw = daily_raw(spark, sf_dir).where(~is_missing("value"))
    return (raw.join(kept, "s_suppkey", "left_semi")
            .select(canonical_code("code").alias("code"),
                    F.year("date").alias("year"), F.month("date").alias("month"),
                    F.dayofmonth("date").alias("day"), F.col("value").alias("precip")))


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulate.yearly(daily(spark, sf_dir), min_days=VIEW_MIN_DAYS)


def monthly_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, year, month, precip): monthly totals above DRY_BELOW, so that some seasons are dry."""
    return accumulate.monthly(daily(spark, sf_dir)).selectExpr(
        "code", "year", "month", f"greatest(precip - {DRY_BELOW}D, 0.0D) AS precip")


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, zone): administrative region per station (the region file)."""
    st = stations(spark, sf_dir)
    return st.select(canonical_code("code").alias("code"),
                     (F.col("s_nationkey") % REGIONS).cast("int").alias("zone"))


def partial_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region lookup without every UNLISTED_EVERY-th station."""
    st = stations(spark, sf_dir).where(f"s_suppkey % {UNLISTED_EVERY} <> 0")
    return st.select(canonical_code("code").alias("code"),
                     (F.col("s_nationkey") % REGIONS).cast("int").alias("zone"))


def repeated_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, lat, lon): the station file with some codes repeated, unpadded, at another place."""
    st = stations(spark, sf_dir)
    again = st.where(f"s_suppkey % {REPEATED_EVERY} = 0").selectExpr(
        "CAST(s_suppkey AS STRING) AS code", "lat - 0.25D AS lat", "lon")
    return st.select("code", "lat", "lon").unionByName(again)


def natural_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, zone): natural zone number per station inside a latitude band."""
    return zone_lookup_from_names(natural_zones(station_file(spark, sf_dir)))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region boundary vertices (UTM metres), VERTICES_PER_SUPPLIER per supplier.

    Supplier keys are dense from 0. Supplier k belongs to region k % 16 and
    has rank k div 16 inside it, so its vertices' index in the region,
    rank * VERTICES_PER_SUPPLIER + j, is dense from 0; features of
    FEATURE_VERTICES vertices and their ``seq`` follow by arithmetic (no
    window). Vertex counts grow with the table. Every tenth supplier also adds
    a feature of a single vertex, which is no line.
    """
    v = (table(spark, sf_dir, "supplier")
         .selectExpr(f"CAST(s_suppkey % {REGIONS} AS INT) AS region", "s_suppkey div 16 AS _rank", "s_acctbal",
                     f"explode(sequence(0, {VERTICES_PER_SUPPLIER - 1})) AS _j")
         .selectExpr("region", f"_rank * {VERTICES_PER_SUPPLIER} + _j AS _v", "s_acctbal"))
    single = table(spark, sf_dir, "supplier").where("s_suppkey % 10 = 0").selectExpr(
        f"CAST(s_suppkey % {REGIONS} AS INT) AS region", f"CAST({SINGLE_FROM} + s_suppkey AS INT) AS feature_id",
        "0 AS seq", "300000.0D AS x", "7000000.0D - s_acctbal AS y")
    return v.selectExpr(
        "region",
        f"CAST(_v div {FEATURE_VERTICES} AS INT) AS feature_id",
        f"CAST(_v % {FEATURE_VERTICES} AS INT) AS seq",
        f"200000.0D + CAST(_v % {FEATURE_VERTICES} AS INT) * 30000.0D"
        f" + (CAST(_v div {FEATURE_VERTICES} AS INT) % 4) * 250000.0D AS x",
        f"8000000.0D - region * 280000.0D - floor(CAST(_v div {FEATURE_VERTICES} AS INT) / 4) * 20000.0D"
        f" - CAST(_v % {FEATURE_VERTICES} AS INT) * 2000.0D - s_acctbal AS y",
    ).unionByName(single)


def points_and_vertices(spark: SparkSession, sf_dir: str, points: DataFrame) -> DataFrame:
    """(code, x, y): points, plus the boundary vertices themselves, which lie on ring edges."""
    vertices = boundaries(spark, sf_dir).where(f"feature_id < {SINGLE_FROM}").selectExpr(
        "concat_ws('-', 'v', region, feature_id, seq) AS code", "x", "y")
    return points.select("code", "x", "y").unionByName(vertices)


def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw station-by-day matrix text, split column-wise into blocks.

    Each block (a virtual file of at most MATRIX_BLOCK stations) has the 15
    metadata lines followed by one line per day ``YYYY-MM-DD`` on which any
    of its stations reported; a cell is the day's total, or a sentinel
    (``-9999`` / ``-9999.000``) when the station has none.
    Output: (block, line_no, value) like :func:`read_matrix_lines`.
    """
    st = stations(spark, sf_dir).select(
        "*", F.floor(F.col("s_suppkey") / MATRIX_BLOCK).cast("long").alias("block_no"),
        F.pmod(F.col("s_suppkey"), F.lit(MATRIX_BLOCK)).cast("int").alias("pos"))
    positions = (st.groupBy("block_no")
                 .agg(F.array_sort(F.collect_list("pos")).alias("positions")))
    fields = [F.struct(F.lit(i).alias("field"), F.col(name).cast("string").alias("text"))
              for i, name in enumerate(S.STATION_FIELDS)]
    meta_cells = st.select("block_no", "pos", F.explode(F.array(*fields)).alias("f"))
    meta = (meta_cells.groupBy("block_no", F.col("f.field").alias("field"))
            .agg(F.map_from_entries(F.collect_list(F.struct("pos", "f.text"))).alias("cells"))
            .join(positions, "block_no")
            .select("block_no", F.col("field").cast("long").alias("line_no"),
                    F.concat_ws(",", F.element_at(F.array(*[F.lit(n) for n in S.STATION_FIELDS]), F.col("field") + 1),
                                F.transform("positions", lambda p: F.coalesce(F.col("cells")[p], F.lit(""))))
                    .alias("value")))

    raw = daily_raw(spark, sf_dir).where(~is_missing("value"))
    day_cells = (raw.groupBy("s_suppkey", "date").agg(F.sum("value").alias("total"))
                 .join(st.select("s_suppkey", "block_no", "pos"), "s_suppkey")
                 .select("block_no", "pos", F.date_format("date", "yyyy-MM-dd").alias("label"),
                         F.col("total").cast("string").alias("text")))
    days = (day_cells.groupBy("block_no", "label")
            .agg(F.map_from_entries(F.collect_list(F.struct("pos", "text"))).alias("cells"))
            .join(positions, "block_no")
            .select("block_no", F.lit(S.N_META_LINES).cast("long").alias("line_no"),
                    F.concat_ws(",", F.col("label"),
                                F.transform("positions", lambda p: F.coalesce(
                                    F.col("cells")[p],
                                    F.when(p % 2 == 0, F.lit("-9999")).otherwise(F.lit("-9999.000")))))
                    .alias("value")))
    return (meta.unionByName(days)
            .select(F.concat(F.lit("block-"), F.col("block_no").cast("string")).alias("block"),
                    "line_no", "value"))


def write_matrix_files(spark: SparkSession, sf_dir: str) -> str:
    """Write :func:`matrix_lines` as one text file per block (metadata lines first).

    Returns the folder, to be read back with ``readers.read_matrix_lines``.
    """
    path = scratch_path(spark, "matrix")
    (matrix_lines(spark, sf_dir)
     .repartition("block").sortWithinPartitions("block", "line_no")
     .select("block", "value")
     .write.partitionBy("block").text(path))
    return path
