"""Physical helpers shared by the operators."""

from __future__ import annotations

import logging
import threading
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.session import scratch_path

log = logging.getLogger(__name__)

# Bounds for replicating a table to every executor. Tables checked here are
# keyed by station, zone or matrix column and a few columns wide.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


# Tables persisted by size checks and written by materialize. Each open
# release_after block has its own lists, per thread, so a stream's batch or a job
# releases what it made itself and nothing that another query reads.
_HELD = threading.local()


def _lists() -> list[list[DataFrame]]:
    if not hasattr(_HELD, "lists"):
        _HELD.lists, _HELD.written = [[]], []
    return _HELD.lists


@contextmanager
def release_after():
    """At the end of the block, unpersist the tables that size checks in it persisted
    and delete those that :func:`materialize` wrote in it.

    For jobs, which have written their results by then; a query that returns a
    lazy DataFrame must not be wrapped.
    """
    lists = _lists()
    lists.append([])
    _HELD.written.append([])
    try:
        yield
    finally:
        for held in lists.pop():
            held.unpersist()
        for spark, path in _HELD.written.pop():
            _delete(spark, path)


def _delete(spark, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path:
            _delete(df.sparkSession, path)


def release_checked() -> None:
    """Unpersist what this thread's size checks persisted in the innermost open block."""
    held = _lists()[-1]
    while held:
        held.pop().unpersist()


def _cached_bytes(cached: DataFrame) -> int | None:
    """In-memory size Spark measured while materialising a persisted table, or None."""
    try:
        return int(cached._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # noqa: BLE001 - a size that cannot be read counts as too large
        return None


def size_checked(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                 max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Persist ``small`` (memory and disk) and report whether it may be broadcast.

    The table is counted in full (so the cache is complete and every later
    use reads the same rows); it fits when both its row count and the
    in-memory size Spark measured are within the bounds; a size that cannot be
    read does not fit.
    """
    cached = small.persist(StorageLevel.MEMORY_AND_DISK)
    _lists()[-1].append(cached)
    rows = cached.count()
    size = _cached_bytes(cached)
    fits = rows <= max_rows and size is not None and size <= max_bytes
    if not fits:
        log.warning("table of %d rows / %s bytes exceeds the broadcast bound; using a shuffle join",
                    rows, size)
    return cached, fits


def broadcast_checked(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` only after proving it has at most ``max_rows`` rows.

    Over the bound the plain (persisted) DataFrame is returned and Spark plans
    a shuffle join, with adaptive skew handling.
    """
    cached, fits = size_checked(small, max_rows, max_bytes)
    return F.broadcast(cached) if fits else cached


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Used where an intermediate is read several times (it is computed once) and
    to cut lineage: a lost executor re-reads the files instead of recomputing
    the upstream plan. Columnar files keep later reads pruned and vectorised.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _lists()
    if _HELD.written:
        _HELD.written[-1].append((spark, path))
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    # The schema is known: no job looks it up in the files' footers.
    out = (spark.read if partition_by else spark.read.schema(df.schema)).parquet(path)
    out._written_at = path
    return out
