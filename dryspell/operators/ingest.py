"""Raw station-by-day matrix -> clean daily long table (reference stage 1).

The reference transposes the whole matrix with a ``groupByKey`` per station
and then melts it. Here each text line is split once and ``posexplode``d into
(label, column, value) cells; station metadata (the first lines of each file,
its head) becomes a small per-column table that is joined back by column
position. The transpose is never materialised: the melt needs no shuffle.

Nothing is dropped silently: a line that is neither a day nor one of its
file's head lines, a file without a head, a line of another width than its
head and a value that is not a finite number all fail the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.functions.codes import canonical_code
from dryspell.functions.values import date_label_parts, is_date_label, is_missing, parse_value
from dryspell.operators._exec import broadcast_checked
from dryspell.sources.readers import read_matrix_heads

# Metadata line ordinals used by the melt (positions in the station schema).
_FIELD_CODE = S.STATION_FIELDS.index("code")
_FIELD_INSTITUTION = S.STATION_FIELDS.index("institution")
_FIELD_LAT = S.STATION_FIELDS.index("lat")
_FIELD_LON = S.STATION_FIELDS.index("lon")


def _width(line: str):
    """Values of a line after its label: its commas, counted without splitting it."""
    return F.expr(f"length({line}) - length(replace({line}, ',', ''))")


def _cells(lines: DataFrame, *cols: str) -> DataFrame:
    """Lines -> one row per matrix cell: (*cols, label, pos, v).

    Each line is split exactly once; ``posexplode_outer`` walks the array
    (label included) without the non-empty filter Spark would infer for
    ``posexplode``, which would split the line again.
    """
    parts = lines.select(*cols, F.split(F.col("value"), ",", -1).alias("_parts"))
    return (parts.select(*cols, F.element_at("_parts", 1).alias("label"),
                         F.posexplode_outer("_parts").alias("_i", "v"))
            .where(F.col("_i") > 0)
            .select(*cols, "label", (F.col("_i") - 1).alias("pos"), "v"))


def matrix_heads(lines: DataFrame, n_meta: int = S.N_META_LINES) -> DataFrame:
    """(block, field, value): the first ``n_meta`` lines of each file.

    Lines read from files are not scanned for this: one job reads the start of
    every file. Only for a DataFrame without files (already in memory) are the
    heads taken from its rows, by line number.
    """
    files = lines.inputFiles()
    if files:
        return read_matrix_heads(lines.sparkSession, files, n_meta)
    first = F.row_number().over(Window.partitionBy("block").orderBy("line_no"))
    return (lines.select("block", "value", (first - 1).alias("field")).where(F.col("field") < n_meta)
            .select("block", "field", "value"))


def matrix_stations(heads: DataFrame) -> DataFrame:
    """Per matrix column: (block, pos, raw_code, institution, lat_text, lon_text)."""
    cells = _cells(heads, "block", "field")

    def pick(i: int, name: str):
        return F.max(F.when(F.col("field") == i, F.col("v"))).alias(name)

    return (cells.where(F.col("field").isin(_FIELD_CODE, _FIELD_INSTITUTION, _FIELD_LAT, _FIELD_LON))
            .groupBy("block", "pos")
            .agg(pick(_FIELD_CODE, "raw_code"), pick(_FIELD_INSTITUTION, "institution"),
                 pick(_FIELD_LAT, "lat_text"), pick(_FIELD_LON, "lon_text")))


def _head_rules(heads: DataFrame, n_meta: int) -> DataFrame:
    """Per file: its head lines and its width; a head that is short, ragged or holds a day fails."""
    width = _width("value")
    label = F.substring_index("value", ",", 1)
    rules = heads.groupBy("block").agg(
        F.collect_set("value").alias("head"), F.count("*").alias("n"),
        F.min(width).alias("width"), F.max(width).alias("widest"),
        F.count_if(is_date_label(label)).alias("days"))
    sound = (F.col("n") == n_meta) & (F.col("width") == F.col("widest")) & (F.col("days") == 0)
    failed = F.raise_error(F.concat(F.lit(f"matrix file does not begin with {n_meta} metadata lines of one width: "),
                                    F.col("block")))
    return rules.select("block", "head", F.when(sound, F.col("width")).otherwise(failed.cast("int")).alias("width"))


def _day_lines(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """(block, value) of the day lines; any other line must be blank or of its file's head."""
    label = F.substring_index(F.col("value"), ",", 1)
    at = F.concat(F.lit(" in "), F.col("block"), F.lit(": "), F.substring("value", 1, 80))
    width = _width("value")
    keep = (F.when(F.col("head").isNull(),
                   F.raise_error(F.concat(F.lit("no header for the matrix file"), at)).cast("boolean"))
            .when(is_date_label(label), F.when(width == F.col("width"), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("day line of another width than the head"), at)).cast("boolean")))
            .when(F.trim("value") == "", F.lit(False))
            .when(F.array_contains("head", F.col("value")), F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("line is neither a day nor metadata"), at)).cast("boolean")))
    return lines.join(rules, "block", "left").where(keep).select("block", "value")


def station_filter(institution: str, lat: str, lon: str,
                   exclude_institutions=S.EXCLUDED_INSTITUTIONS, bbox=S.BBOX):
    """Keep stations not from an excluded institution and strictly inside the box (column names).

    The institution test comes first and short-circuits, so coordinates of
    excluded stations are never parsed (as in the reference).
    """
    excluded = ", ".join("'" + i.replace("'", "''") + "'" for i in exclude_institutions)
    la, lo = f"CAST({lat} AS DOUBLE)", f"CAST({lon} AS DOUBLE)"
    return F.expr(
        f"NOT coalesce({institution} IN ({excluded}), false)"
        f" AND ({lo} > {bbox['lon_min']!r}D AND {lo} < {bbox['lon_max']!r}D"
        f" AND {la} > {bbox['lat_min']!r}D AND {la} < {bbox['lat_max']!r}D)")


def daily_from_matrix(lines: DataFrame, *, n_meta: int = S.N_META_LINES,
                      exclude_institutions=S.EXCLUDED_INSTITUTIONS, bbox=S.BBOX,
                      sentinel: int = S.SENTINEL, heads: DataFrame | None = None) -> DataFrame:
    """Matrix lines (block, line_no, value) -> (code, year, month, day, precip).

    Drops stations of excluded institutions and outside the bounding box before
    any of their cells is parsed, canonicalises codes, and removes sentinel
    values. ``heads`` is the output of :func:`matrix_heads`, written once, for
    later runs over the same files.
    """
    if heads is None:
        heads = matrix_heads(lines, n_meta)
    rules = broadcast_checked(_head_rules(heads, n_meta))   # counted first: a bad head fails as such
    kept = (matrix_stations(heads).where(station_filter("institution", "lat_text", "lon_text",
                                                        exclude_institutions, bbox))
            .select("block", "pos", canonical_code("raw_code").alias("code")))
    kept = broadcast_checked(kept)
    days = _day_lines(lines, rules)
    # The sentinel test never fails on a malformed value, wherever Spark places
    # it; the strict cast is a projection above the join, so only cells of kept
    # stations are parsed.
    day_cells = _cells(days, "block").join(kept, ["block", "pos"]).where(~is_missing(F.col("v"), sentinel))
    year, month, day = date_label_parts("label")
    return day_cells.select("code", year.alias("year"), month.alias("month"), day.alias("day"),
                            parse_value("v").alias("precip"))


def unpivot_wide(wide: DataFrame, ids: list[str], value_cols: list[str],
                 variable: str, value: str, drop_nulls: bool = True) -> DataFrame:
    """Wide frame (one column per period or station) -> long rows (narrow, no shuffle)."""
    long = wide.unpivot(ids, value_cols, variable, value)
    return long.where(F.col(value).isNotNull()) if drop_nulls else long
