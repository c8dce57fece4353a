"""Zone classification and naming expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dryspell import schemas as S


def natural_zone_name(lat: str, bands=S.NATURAL_BANDS) -> Column:
    """Latitude column -> natural-zone name; NULL outside every band.

    Each band is (name, upper, lower, lower_inclusive): upper bound inclusive,
    lower bound exclusive unless flagged.
    """
    whens = []
    for name, upper, lower, lower_incl in bands:
        low = f"{lat} >= {lower!r}D" if lower_incl else f"{lat} > {lower!r}D"
        whens.append(f"WHEN {lat} <= {upper!r}D AND {low} THEN '{name}'")
    return F.expr("CASE " + " ".join(whens) + " END")


def _number_map(numbers: dict) -> Column:
    return F.create_map(*[x for k, v in numbers.items() for x in (F.lit(k), F.lit(v))])


def zone_number(name: Column | str, numbers: dict = S.NATURAL_ZONE_NUMBERS,
                default: int = S.UNKNOWN_ZONE) -> Column:
    """Zone name -> number; unknown (or NULL) names map to ``default``."""
    c = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.try_element_at(_number_map(numbers), c), F.lit(default)).cast("int")


def zone_label(zone: Column | str, numbers: dict = S.NATURAL_ZONE_NUMBERS) -> Column:
    """Inverse of :func:`zone_number`; NULL for numbers without a name."""
    c = F.col(zone) if isinstance(zone, str) else zone
    inverse = {v: k for k, v in numbers.items()}
    return F.try_element_at(_number_map(inverse), c)
