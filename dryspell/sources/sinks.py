"""Writers (sinks). Parquet is the default; TSV reproduces the reference's text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.codes import composite_key


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: str | list[str] | None = None) -> None:
    """Parallel Parquet write; fails if the target exists unless ``mode`` says otherwise."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    """Tab-separated text, one part file per task."""
    df.write.mode(mode).option("sep", "\t").option("header", header).csv(path)


def _text_dates(df: DataFrame) -> DataFrame:
    """Month and day as two digits, as the reference's text carries them."""
    for c in ("month", "day"):
        if c in df.columns:
            df = df.withColumn(c, F.lpad(F.col(c).cast("string"), 2, "0"))
    return df


def write_daily_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Reference text layout: ``code<TAB>year<TAB>month<TAB>day<TAB>precip``."""
    write_tsv(_text_dates(df.select("code", "year", "month", "day", "precip")), path, mode=mode)


def write_keyed_tsv(df: DataFrame, path: str, key_cols: list[str], value_cols: list[str],
                    mode: str = "errorifexists") -> None:
    """Reference text layout: ``code##year[##month]<TAB>days<TAB>precip``."""
    write_tsv(_text_dates(df).select(composite_key(*key_cols).alias("key"), *value_cols), path, mode=mode)


def write_partitioned(df: DataFrame, path: str, by: str = "region",
                      mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """One directory per value of ``by`` in a single pass (the reference loops 16 times)."""
    writer = df.write.mode(mode).partitionBy(by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
