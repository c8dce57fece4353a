"""Readers and writers for the reference's file formats."""

from dryspell.sources.readers import (
    read_boundaries, read_daily, read_matrix_lines, read_result_tsv,
    read_stations, read_yearly_keyed, read_monthly_keyed, read_zone_lookup,
    read_zone_name_lookup,
)
from dryspell.sources.sinks import (
    write_daily_tsv, write_keyed_tsv, write_partitioned, write_table, write_tsv,
)

__all__ = [
    "read_boundaries", "read_daily", "read_matrix_lines", "read_result_tsv",
    "read_stations", "read_yearly_keyed", "read_monthly_keyed",
    "read_zone_lookup", "read_zone_name_lookup",
    "write_daily_tsv", "write_keyed_tsv", "write_partitioned", "write_table", "write_tsv",
]
