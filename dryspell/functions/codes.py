"""Station-code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEP = "##"


def canonical_code(code: Column | str) -> Column:
    """All-digit codes lose their leading zeros ("0012" -> "12", "000" -> "0").

    Codes with any non-digit character are returned unchanged, so
    "00B6-0360" stays as it is. The regex works on text, so codes longer than
    a 64-bit integer are safe.
    """
    c = F.col(code) if isinstance(code, str) else code
    return F.regexp_replace(c, r"^0+(?=[0-9]+$)", "")


def composite_key(*parts: Column | str) -> Column:
    """``code##year[##month]`` text key; NULL when any part is NULL."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(KEY_SEP))
        pieces.append(c.cast("string"))
    return F.concat(*pieces)


def key_part(key: Column | str, index: int) -> Column:
    """1-based field of a ``##`` composite key."""
    c = F.col(key) if isinstance(key, str) else key
    return F.split_part(c, F.lit(KEY_SEP), F.lit(index))
