"""Matrix files arriving in a folder -> a daily Parquet table, each file once.

Each matrix file carries its own head lines, and the file source hands a file
to exactly one micro-batch, so every micro-batch melts independently with the
same batch operator. The query's checkpoint, which the caller names and keeps
across restarts, holds the list of files seen. A micro-batch writes a folder of
its own (``batch=<id>``) and overwrites it, so a batch that is replayed after a
failure replaces what its first attempt left: no file is in the table twice.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dryspell import schemas as S
from dryspell.operators._exec import release_after
from dryspell.operators.ingest import daily_from_matrix
from dryspell.sources.readers import read_matrix_lines


def write_batch(batch: DataFrame, batch_id: int, daily_out: str, n_meta: int = S.N_META_LINES) -> None:
    """Melt the files that one micro-batch names (block) into ``daily_out/batch=<id>``."""
    spark = batch.sparkSession
    files = sorted(unquote(r["block"]) for r in batch.select("block").distinct().collect())
    if not files:
        return
    with release_after():
        daily = daily_from_matrix(read_matrix_lines(spark, files), n_meta=n_meta)
        daily.write.mode("overwrite").partitionBy("year").parquet(f"{daily_out}/batch={batch_id}")


def start_daily_ingest(spark: SparkSession, matrix_dir: str, daily_out: str, *, checkpoint: str,
                       available_now: bool = True, max_files_per_trigger: int | None = None,
                       n_meta: int = S.N_META_LINES) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what exists and stops.

    ``checkpoint`` belongs to this stream alone and must outlive the session.
    """
    # The stream carries file names only: a file's bytes are not read for it. Each batch
    # then reads its files as a batch job does, once for the heads and once for the melt.
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    names = reader.load(matrix_dir).select(F.col("_metadata.file_path").alias("block"))
    writer = (names.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, daily_out, n_meta))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
