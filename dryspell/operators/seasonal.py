"""Seasonal SPI: running k-month sums against a gamma distribution per zone and calendar month.

Every step is an aggregate or column math. The fit needs four sums per (zone,
calendar month): values, their total, the total of the logarithms of the positive
ones, and zeros. They combine before the shuffle and merge across tables, so a
zone with a third of all station-months sends one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.functions.distributions import LARGE_SHAPE, gamma_cdf_sql, normal_quantile_sql
from dryspell.operators._exec import broadcast_checked


def running_sums(monthly: DataFrame, k: int) -> DataFrame:
    """(code, year, month, total): precipitation of the k months that end with each month.

    ``monthly`` has one row per (code, year, month). ``total`` is NULL where one of the
    k months is missing, a year's end being no gap. A station has at most as many
    rows as its record has months, which bounds the window.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    place = monthly.select("code", "year", "month", "precip",
                           (F.col("year") * 12 + F.col("month") - 1).cast("int").alias("_t"))
    span = Window.partitionBy("code").orderBy("_t").rangeBetween(-(k - 1), 0)
    total = F.when(F.count("precip").over(span) == k, F.sum("precip").over(span))
    return place.select("code", "year", "month", total.alias("total"))


def gamma_moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    """keys + (n, zeros, positive, log_total): mergeable sums of the totals that are known."""
    return (sums.where(F.col("total").isNotNull()).groupBy(*keys)
            .agg(F.count("*").alias("n"), F.count_if(F.col("total") <= 0).alias("zeros"),
                 F.sum(F.when(F.col("total") > 0, F.col("total"))).alias("positive"),
                 F.sum(F.when(F.col("total") > 0, F.ln("total"))).alias("log_total")))


def gamma_fit(moments: DataFrame, keys: list[str]) -> DataFrame:
    """keys + (zero_share, shape, scale): Thom's closed form of the maximum likelihood.

    Shape and scale are NULL where fewer than two positive values, or no spread, leave
    nothing to fit.
    """
    n = "nullif(n - zeros, 0)"
    found = moments.selectExpr(*keys, "n", "zeros", "zeros / n AS zero_share", f"positive / {n} AS mean",
                               f"ln(positive / {n}) - log_total / {n} AS a")
    fits = "n - zeros >= 2 AND a > 1e-12D"
    shape = "(1.0D + sqrt(1.0D + 4.0D * a / 3.0D)) / (4.0D * a)"
    return found.selectExpr(*keys, "zero_share", f"CASE WHEN {fits} THEN {shape} END AS shape",
                            f"CASE WHEN {fits} THEN mean / ({shape}) END AS scale")


def seasonal_spi(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``sums`` (code, year, month, total and other ``keys``) with ``spi``, fitted per ``keys``.

    H = zero_share + (1 - zero_share) * P(shape, total / scale); spi is its normal
    quantile. NULL where the total or the fit is. H is kept half a rounding step away
    from 0 and 1. The fitted table has a row per key: it is broadcast after a count.
    """
    fit = broadcast_checked(gamma_fit(gamma_moments(sums, keys), keys))
    x = "(total / scale)"
    # A shape this large is nearly normal: the cube root of a gamma value is, closely.
    root = f"(pow({x} / shape, 1.0D / 3.0D) - (1.0D - 1.0D / (9.0D * shape))) * sqrt(9.0D * shape)"
    h = "least(greatest(h, pow(2.0D, -53)), 1.0D - pow(2.0D, -53))"
    shared = (sums.join(fit, keys, "left")
              .withColumn("h", F.expr(f"CASE WHEN total IS NULL OR shape IS NULL THEN NULL WHEN shape > {LARGE_SHAPE!r}D "
                                      "AND zero_share = 0.0D THEN NULL ELSE zero_share + (1.0D - zero_share) * "
                                      f"({gamma_cdf_sql('shape', x)}) END")))
    nearly_normal = f"total > 0.0D AND zero_share = 0.0D AND shape > {LARGE_SHAPE!r}D"
    spi = F.expr(f"CASE WHEN {nearly_normal} THEN {root} WHEN h IS NULL THEN NULL ELSE {normal_quantile_sql(h)} END")
    return shared.select(*sums.columns, spi.alias("spi"))
