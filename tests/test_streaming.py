"""Incremental matrix ingest: files are melted once each, across restarts."""

import os

from dryspell.sources import readers
from dryspell.streaming import start_daily_ingest

META = ["code", "institution", "source", "name", "altitude", "lat", "lon", "basin_code", "basin_name",
        "subbasin_code", "subbasin_name", "obs_start", "obs_end", "obs_count", "auto_start"]


def _matrix(path, code, value):
    vals = {"code": code, "institution": "DGA", "lat": "-30.0", "lon": "-70.0"}
    lines = [f"{f},{vals.get(f, 'x')}" for f in META] + [f"2010-05-06,{value}", "2010-05-07,-9999"]
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_ingests_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    out = os.path.join(tmp_dir, "daily")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _matrix(os.path.join(src, "a.txt"), "0001", "4.5")
    start_daily_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    _matrix(os.path.join(src, "b.txt"), "0002", "1.0")
    start_daily_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    rows = sorted((r.code, r.year, r.day, r.precip) for r in readers.read_daily(spark, out).collect())
    assert rows == [("1", 2010, 6, 4.5), ("2", 2010, 6, 1.0)]


def test_restart_in_a_new_session_and_replayed_batch(spark, tmp_dir):
    """A new session goes on from the checkpoint, and a batch that is run again replaces itself."""
    from pyspark.sql import functions as F

    from dryspell.streaming.matrix_files import write_batch
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("in", "daily", "ckpt"))
    os.makedirs(src)
    _matrix(os.path.join(src, "a.txt"), "0001", "4.5")
    start_daily_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    again = spark.newSession()
    start_daily_ingest(again, src, out, checkpoint=ckpt).awaitTermination()
    assert readers.read_daily(again, out).count() == 1
    lines = spark.read.text(os.path.join(src, "a.txt")).select(F.col("_metadata.file_path").alias("block"), "value")
    write_batch(lines, 0, out)
    write_batch(lines, 0, out)
    rows = [(r.code, r.year, r.day, r.precip) for r in readers.read_daily(spark, out).collect()]
    assert rows == [("1", 2010, 6, 4.5)]
