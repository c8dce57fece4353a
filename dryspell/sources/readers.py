"""Readers (scans). Every reader declares its schema; nothing is inferred."""

from __future__ import annotations

import json
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell import schemas as S
from dryspell.functions.codes import canonical_code, key_part
from dryspell.functions.values import is_date_label
from dryspell.functions.zones import zone_number
from dryspell.operators._exec import materialize
from dryspell.sources import matrix_heads


def read_matrix_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw station-by-day matrix text -> (block, line_no, value).

    ``block`` is the source file, so a directory of column-split matrix
    files (each with its own metadata lines) melts correctly. ``line_no``
    increases with the position inside a file split; the metadata lines sit in
    a file's first split, so their relative order is the file order.
    """
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("block"),
                    F.monotonically_increasing_id().alias("line_no"),
                    F.col("value")))


def read_matrix_heads(spark: SparkSession, files: list[str], n: int = S.N_META_LINES) -> DataFrame:
    """(block, field, value): the first ``n`` lines of each matrix file, written once.

    One job for any number of files: the list is dealt to tasks, which read their
    files' starts and stop (see :mod:`dryspell.sources.matrix_heads`). Files in a store
    that only Spark opens are scanned by Spark for lines that are no day's.
    """
    if not files:
        return spark.createDataFrame([], matrix_heads.SCHEMA)
    if {urlsplit(f).scheme for f in files} <= set(matrix_heads.SCHEMES):
        if not getattr(spark, "_knows_matrix_heads", False):
            spark.dataSource.register(matrix_heads.MatrixHeads)
            spark._knows_matrix_heads = True
        heads = (spark.read.format("matrix_heads").option("files", json.dumps(files)).option("lines", str(n)).load())
    else:
        heads = scan_matrix_heads(spark, files)
    return materialize(heads, "matrix-heads")


def scan_matrix_heads(spark: SparkSession, files: list[str]) -> DataFrame:
    """(block, field, value) of the lines of files' first splits that are neither blank nor a day's."""
    label = F.substring_index("value", ",", 1)
    lines = (spark.read.text(files)
             .select(F.col("_metadata.file_path").alias("block"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("line"), "value")
             .where((F.col("start") == 0) & (F.trim("value") != "") & ~is_date_label(label)))
    place = F.row_number().over(Window.partitionBy("block").orderBy("line")) - 1
    return lines.select("block", place.alias("field"), "value")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station metadata CSV with a header line; quoted fields and blank lines are handled."""
    return (spark.read.schema(S.STATIONS)
            .option("header", True).option("mode", "FAILFAST")
            .csv(path))


def _tsv(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    return (spark.read.schema(schema).option("sep", "\t")
            .option("mode", "FAILFAST").csv(path))


def read_daily(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Daily long table; Parquet (our format, partitioned by year) or the reference's TSV.

    Columns always come back in schema order (Spark appends partition
    columns last otherwise).
    """
    if fmt == "parquet":
        return spark.read.schema(S.DAILY).parquet(path).select(*S.DAILY.fieldNames())
    return _tsv(spark, S.DAILY, path)


def read_yearly_keyed(spark: SparkSession, path: str) -> DataFrame:
    """``code##year<TAB>days<TAB>precip`` -> (code, year, days, precip), code canonical."""
    raw = _tsv(spark, S.YEARLY_KEYED, path)
    return raw.select(canonical_code(key_part("key", 1)).alias("code"),
                      key_part("key", 2).cast("int").alias("year"),
                      "days", "precip")


def read_monthly_keyed(spark: SparkSession, path: str) -> DataFrame:
    """``code##year##month<TAB>days<TAB>precip`` -> typed monthly table."""
    raw = _tsv(spark, S.YEARLY_KEYED, path)
    return raw.select(canonical_code(key_part("key", 1)).alias("code"),
                      key_part("key", 2).cast("int").alias("year"),
                      key_part("key", 3).cast("int").alias("month"),
                      "days", "precip")


def _last_wins(df: DataFrame, value: str) -> DataFrame:
    """One row per code; for a repeated code the value of the later line wins."""
    return (df.withColumn("_line", F.monotonically_increasing_id())
              .groupBy("code").agg(F.max_by(value, "_line").alias(value)))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``code,zone`` lookup (the region assignment output) -> (code, zone)."""
    raw = spark.read.schema(S.ZONE_LOOKUP).option("mode", "FAILFAST").csv(path)
    return _last_wins(raw.select(canonical_code("code").alias("code"), "zone"), "zone")


def read_zone_name_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``code<TAB>zone name`` lookup -> (code, zone) with names mapped to numbers."""
    raw = _tsv(spark, S.ZONE_NAME_LOOKUP, path)
    named = raw.select(canonical_code("code").alias("code"),
                       zone_number("zone_name").alias("zone"))
    return _last_wins(named, "zone")


def read_boundaries(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Boundary vertex table (region, feature_id, seq, x, y).

    Columns come back in that order even from a ``partitionBy("region")``
    folder, where Spark would otherwise append the partition column last.
    """
    reader = spark.read.schema(S.BOUNDARIES)
    if fmt == "parquet":
        df = reader.parquet(path)
    elif fmt == "json":
        df = reader.json(path)
    else:
        df = reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return df.select(*S.BOUNDARIES.fieldNames())


def read_result_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Any result table written as header-less TSV, with named columns."""
    return (spark.read.schema(schema).option("sep", "\t")
            .option("mode", "FAILFAST").csv(path))
