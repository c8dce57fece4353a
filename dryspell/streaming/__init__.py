"""Incremental execution of the batch operators over arriving files.

The reference is batch-only. The one incremental path kept here runs stage 1
(matrix -> daily) as a Structured Streaming file source, so matrix files that
land in a folder are melted once each and appended to the daily table.
"""

from dryspell.streaming.matrix_files import start_daily_ingest

__all__ = ["start_daily_ingest"]
