"""Plot-ready tables (reference stage 5): the data behind each figure.

Histogram bin assignment follows the published numpy algorithm (equal-width
bins over [min, max], last bin closed, edge corrections against the
``linspace`` edges), and the fitted curve spans the plot's default x limits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.functions.values import is_drought, is_recent, normal_pdf
from dryspell.operators._exec import materialize, size_checked

def spi_series(spi: DataFrame, zone: int | None = None, *, threshold: float = S.DROUGHT_SPI,
               recent: tuple[int, int] = S.RECENT_YEARS) -> DataFrame:
    """(zone, year, spi, is_drought, is_recent), ordered by zone and year."""
    df = spi if zone is None else spi.where(F.col("zone") == F.lit(zone))
    return (df.select("zone", "year", "spi",
                      is_drought("spi", threshold).alias("is_drought"),
                      is_recent("year", recent).alias("is_recent"))
            .orderBy("zone", "year"))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a bounded top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def _ranges(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Per group: histogram range [lo, hi] (widened by 0.5 when flat), step and size."""
    r = df.groupBy(group).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"),
                              F.count(value).alias("_n"))
    flat = F.col("_mn") == F.col("_mx")
    return (r.where(F.col("_n") > 0)
            .select(group, "_n",
                    F.when(flat, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                    F.when(flat, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
            .withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))))


def _edge(i, bins: int):
    """Bin edge i as ``linspace`` computes it: i * step + lo, the last edge exactly hi."""
    return F.when(i == F.lit(bins), F.col("_hi")).otherwise(i.cast("double") * F.col("_step") + F.col("_lo"))


def zone_histogram(df: DataFrame, *, group: str = "zone", value: str = "precip",
                   bins: int = S.HIST_BINS, materialize_input: bool = True) -> DataFrame:
    """(zone, bin, bin_lo, bin_hi, count, density) with every bin present.

    density = count / bin width / group size, so density x width sums to 1.
    The narrow input is read twice (ranges, then bins); with
    ``materialize_input`` it is written once to the shared checkpoint folder.
    """
    df = df.select(group, value)
    if materialize_input:
        df = materialize(df, "histogram-input")
    ranges, small = size_checked(_ranges(df, group, value, bins))
    v = F.col(value)
    rows = df.where(v.isNotNull()).join(F.broadcast(ranges) if small else ranges, group)
    norm = F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))
    i0 = F.least(F.floor((v - F.col("_lo")) * norm), F.lit(bins - 1))
    i1 = F.when(v < _edge(i0, bins), i0 - 1).otherwise(i0)
    i2 = F.when((v >= _edge(i1 + 1, bins)) & (i1 != F.lit(bins - 1)), i1 + 1).otherwise(i1)
    counts = (rows.select(group, i2.cast("int").alias("bin"))
              .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("count")))
    spine = ranges.select(group, "_n", "_lo", "_hi", "_step",
                          F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = spine.join(counts, [group, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    lo_e = _edge(F.col("bin"), bins)
    hi_e = _edge(F.col("bin") + 1, bins)
    return out.select(group, "bin", lo_e.alias("bin_lo"), hi_e.alias("bin_hi"),
                      F.col("count").cast("long").alias("count"),
                      (F.col("count") / (hi_e - lo_e) / F.col("_n")).alias("density"))


def normal_fit_curve(df: DataFrame, stats: DataFrame, *, group: str = "zone", value: str = "precip",
                     points: int = S.CURVE_POINTS, margin: float = S.PLOT_MARGIN,
                     bins: int = S.HIST_BINS) -> DataFrame:
    """(zone, i, x, pdf): the normal density with the zone's mean/std on an
    evenly spaced grid across the histogram's x limits (data range +- margin)."""
    ranges = _ranges(df, group, value, bins)
    width = F.col("_hi") - F.col("_lo")
    grid = (ranges.join(stats.select(group, "mean", "std"), group)
            .select(group, "mean", "std",
                    (F.col("_lo") - width * margin).alias("_x0"),
                    (F.col("_hi") + width * margin).alias("_x1"),
                    F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")))
    step = (F.col("_x1") - F.col("_x0")) / F.lit(float(points - 1))
    x = F.when(F.col("i") == F.lit(points - 1), F.col("_x1")).otherwise(F.col("i").cast("double") * step + F.col("_x0"))
    return grid.withColumn("x", x).select(group, "i", "x", normal_pdf("x", "mean", "std").alias("pdf"))


def latitude_profile(climatology: DataFrame, labels: dict | None = None,
                     highlight_zone: int | None = None) -> DataFrame:
    """Climatology rows with a zone label and a highlight flag (scatter-plot data)."""
    if labels:
        m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
        label = F.coalesce(F.try_element_at(m, F.col("zone")), F.concat(F.lit("Zone "), F.col("zone").cast("string")))
    else:
        label = F.concat(F.lit("Zone "), F.col("zone").cast("string"))
    hl = (F.col("zone") == F.lit(highlight_zone)) if highlight_zone is not None else F.lit(False)
    return climatology.select("code", "annual_mean", "lat", "lon", "zone",
                              label.alias("zone_label"), hl.alias("highlighted"))


def distinct_zones(df: DataFrame) -> DataFrame:
    """Sorted distinct zones."""
    return df.select("zone").distinct().orderBy("zone")
