"""Value, date and index expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dryspell import schemas as S

DATE_LABEL_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_value(text: Column | str) -> Column:
    """Text -> finite double; under ANSI mode a malformed value fails the job, and so do NaN and infinity."""
    v = _c(text).cast("double")
    odd = F.isnan(v) | (F.abs(v) == F.lit(math.inf))
    return F.when(odd, F.raise_error(F.concat(F.lit("value is not a finite number: "),
                                              _c(text).cast("string"))).cast("double")).otherwise(v)


def is_missing(value: Column | str, sentinel: int = S.SENTINEL) -> Column:
    """True when the value truncates (toward zero) to the sentinel, or is NULL.

    ``int(float(v)) == -9999`` drops every value in (-10000, -9999], e.g.
    -9999.7, while -9998.9 is kept. Written as a range test on the double, so
    no integer cast can overflow on large values. Text that is no number is not
    missing (:func:`parse_value` fails on it).
    """
    v = _c(value).try_cast("double")
    if sentinel > 0:
        hit = (v >= F.lit(float(sentinel))) & (v < F.lit(float(sentinel + 1)))
    elif sentinel < 0:
        hit = (v > F.lit(float(sentinel - 1))) & (v <= F.lit(float(sentinel)))
    else:
        hit = (v > F.lit(-1.0)) & (v < F.lit(1.0))
    return F.coalesce(hit, _c(value).isNull())


def is_date_label(label: Column | str) -> Column:
    return _c(label).rlike(DATE_LABEL_PATTERN)


def date_label_parts(label: Column | str) -> tuple[Column, Column, Column]:
    """``YYYY-MM-DD`` -> (year, month, day) as INT, by splitting the text."""
    c = _c(label)
    return (F.split_part(c, F.lit("-"), F.lit(1)).cast("int"),
            F.split_part(c, F.lit("-"), F.lit(2)).cast("int"),
            F.split_part(c, F.lit("-"), F.lit(3)).cast("int"))


def standardize(x: Column | str, mu: Column | str, sd: Column | str) -> Column:
    """(x - mu) / sd; NULL where sd is 0 (the reference divides by zero)."""
    return (_c(x) - _c(mu)) / F.nullif(_c(sd), F.lit(0.0))


def normal_pdf(x: Column | str, mu: Column | str, sd: Column | str) -> Column:
    """Normal density; NULL where sd is 0 or NULL."""
    s = F.nullif(_c(sd), F.lit(0.0))
    z = (_c(x) - _c(mu)) / s
    return F.exp(-(z * z) / 2.0) / (s * math.sqrt(2.0 * math.pi))


def is_drought(spi: Column | str, threshold: float = S.DROUGHT_SPI) -> Column:
    return _c(spi) <= F.lit(threshold)


def is_recent(year: Column | str, years: tuple[int, int] = S.RECENT_YEARS) -> Column:
    return _c(year).between(years[0], years[1])
