"""Column-expression building blocks (pure ``Column -> Column`` functions)."""

from dryspell.functions.codes import canonical_code, composite_key, key_part
from dryspell.functions.values import (
    date_label_parts, is_date_label, is_drought, is_missing, is_recent,
    normal_pdf, parse_value, standardize,
)
from dryspell.functions.zones import natural_zone_name, zone_label, zone_number
from dryspell.functions.geo import segment_distance_sq, utm_easting_northing

__all__ = [
    "canonical_code", "composite_key", "key_part",
    "date_label_parts", "is_date_label", "is_drought", "is_missing", "is_recent",
    "normal_pdf", "parse_value", "standardize",
    "natural_zone_name", "zone_label", "zone_number",
    "segment_distance_sq", "utm_easting_northing",
]
