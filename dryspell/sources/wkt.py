"""Boundary lines in well-known text -> the vertex table, by built-in functions.

Grammar (any case, any blanks): ``LINESTRING (x y, x y, ...)`` and ``MULTILINESTRING
((x y, ...), (x y, ...))`` of two or more two-dimensional positions a line, and
either with ``EMPTY``. Any other text fails the job and is named in the error: no
row is skipped. The text is cut at its brackets and commas first and only single
positions meet a pattern with groups, so a line of millions of vertices is parsed
in bounded stack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBER = r"[-+]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][-+]?[0-9]+)?"
WKT_LINES = "region int, feature_id int, wkt string"


def _fail(message: str, text: str) -> str:
    return f"raise_error(concat('{message}: ', coalesce(substring({text}, 1, 120), 'NULL')))"


def vertices_of_wkt(lines: DataFrame) -> DataFrame:
    """(region, feature_id, wkt) -> (region, feature_id, seq, x, y).

    The lines of a multi-line become features of their own, numbered on from the row's
    ``feature_id``; vertices are numbered from 0 within each.
    """
    # Blanks next to brackets and commas mean nothing.
    tight = r"regexp_replace(trim(BOTH ' \t\r\n' FROM wkt), '\\s*([(),])\\s*', '$1')"
    text = lines.selectExpr("region", "feature_id", f"{tight} AS w", "wkt")
    head = r"upper(trim(regexp_extract(w, '^([A-Za-z]+)(\\s+[Ee][Mm][Pp][Tt][Yy])?', 0)))"
    body = r"substring(w, length(regexp_extract(w, '^[A-Za-z]+', 0)) + 1)"
    kinds = text.selectExpr("region", "feature_id", "wkt", f"regexp_replace({head}, '\\\\s+', ' ') AS kind",
                            f"{body} AS body")
    line = "kind = 'LINESTRING' AND body LIKE '(%)'"
    several = "kind = 'MULTILINESTRING' AND body LIKE '((%))'"
    empty = r"(kind IN ('LINESTRING EMPTY', 'MULTILINESTRING EMPTY') AND body RLIKE '^\\s+[A-Za-z]+$')"
    cut = (f"CASE WHEN {line} THEN array(substring(body, 2, length(body) - 2)) "
           f"WHEN {several} THEN split(substring(body, 3, length(body) - 4), '\\\\),\\\\(', -1) "
           f"WHEN {empty} THEN array() "
           f"ELSE CAST({_fail('not a line or multi-line', 'wkt')} AS ARRAY<STRING>) END")
    parts = kinds.selectExpr("region", "feature_id", "wkt", f"posexplode({cut}) AS (part, line)")
    cells = parts.selectExpr("region", "feature_id + part AS feature_id", "wkt", "split(line, ',', -1) AS cells")
    checked = f"CASE WHEN size(cells) >= 2 THEN cells ELSE CAST({_fail('line of one position', 'wkt')} AS ARRAY<STRING>) END"
    spots = cells.selectExpr("region", "feature_id", f"posexplode({checked}) AS (seq, cell)")
    pattern = rf"^{_NUMBER}\\s+{_NUMBER}$"
    sound = f"CASE WHEN cell RLIKE '{pattern}' THEN cell ELSE {_fail('not a position of two numbers', 'cell')} END"
    spots = spots.selectExpr("region", "feature_id", "seq", rf"split({sound}, '\\s+') AS xy")
    return spots.selectExpr("region", "feature_id", "seq", "CAST(xy[0] AS DOUBLE) AS x", "CAST(xy[1] AS DOUBLE) AS y")


def read_boundaries_wkt(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (region, first feature number, text) lines -> the vertex table."""
    lines = (spark.read.schema(WKT_LINES).option("sep", "\t").option("mode", "FAILFAST")
             .option("ignoreLeadingWhiteSpace", True).option("maxCharsPerColumn", -1).csv(path))
    return vertices_of_wkt(lines)


def wkt_of_features(boundaries: DataFrame, features_per_text: int = 1) -> DataFrame:
    """(region, feature_id, wkt): up to ``features_per_text`` consecutive features as one text.

    The inverse of :func:`vertices_of_wkt` for features numbered without gaps. A text is
    one value, so its lines' vertices meet in one row.
    """
    spot = F.struct("seq", F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string")).alias("xy"))
    lines = (boundaries.groupBy("region", "feature_id").agg(F.array_sort(F.collect_list(spot)).alias("spots"))
             .select("region", "feature_id", F.concat(F.lit("("), F.concat_ws(", ", F.col("spots.xy")), F.lit(")"))
                     .alias("line")))
    grouped = (lines.groupBy("region", F.floor(F.col("feature_id") / features_per_text).alias("_g"))
               .agg(F.array_sort(F.collect_list(F.struct("feature_id", "line"))).alias("lines")))
    return grouped.select("region", F.col("lines")[0]["feature_id"].alias("feature_id"),
                          F.when(F.size("lines") == 1, F.concat(F.lit("LINESTRING "), F.col("lines")[0]["line"]))
                          .otherwise(F.concat(F.lit("MULTILINESTRING ("), F.concat_ws(", ", F.col("lines.line")),
                                              F.lit(")"))).alias("wkt"))
