"""Helpers shared by the text operators.

Text work runs inside Spark tasks on Arrow batches. A batch is cut into slices
of a bounded number of bytes (one row at least), and each slice is handled as
one flat ``uint8`` buffer plus row offsets: words, lines and n-grams are then
numpy expressions over the buffer instead of per-row Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once inside a task (a longer text is one slice); with one more the table of powers is full.
SLICE_BYTES = (1 << 20) - 1
#: Most bytes of an Arrow batch, and Spark's setting of it: a task holds a batch in its JVM and in its Python worker.
BATCH_BYTES = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Odd multiplier of the rolling polynomial hash and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def bound_batches(spark) -> None:
    """Have Spark cut texts into batches of BATCH_BYTES (64 MB by default), unless the session has a bound of its own."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def fresh(name: str, taken) -> str:
    """``name``, prefixed until it clashes with no column in ``taken`` (case-insensitive)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def doc_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id BIGINT, text STRING): extra or clashing columns never reach an operator."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


def id_bucket(modulus: int, id_col: str = "doc_id"):
    """crc32(doc_id as text) mod ``modulus`` (null ids: bucket 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus),
                      F.lit(0))


def give_back() -> None:
    """Return freed memory to the system: a worker's allocators would keep it while later stages run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass    # not glibc


#: What operators hold in this process over their tasks: owner, and how to let go of it.
_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, let_go: Callable[[], None]) -> None:
    """Have what ``owner`` holds over its tasks freed when a task of another operator begins in this process."""
    _HELD[owner] = let_go


def make_room(owner: str | None = None) -> None:
    """Free what operators other than ``owner`` hold."""
    others = [x for x in _HELD if x != owner]
    for x in others:
        _HELD.pop(x)()
    if others:
        give_back()


def tidy(run: Callable, owner: str | None = None) -> Callable:
    """The function of a ``mapInArrow`` that gives its memory back at a task's end, and at its start what others hold."""
    def whole(batches):
        make_room(owner)
        yield from run(batches)
        give_back()
    return whole


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row, n = 0, len(col)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield row, end, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of ``is_word``; runs never cross a row."""
    n = len(is_word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = is_word.copy()
    begin[1:] &= ~is_word[:-1]
    rows = offsets[:-1]
    at = rows[rows < n]
    begin[at] = is_word[at]
    stop = is_word.copy()
    stop[:-1] &= ~is_word[1:]
    last = offsets[1:] - 1
    at = last[last >= 0]
    stop[at] = is_word[at]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown by doubling and reused."""
    have = _POWERS.get("n", 0)
    if have < n:
        size = 1 << max(16, int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for key, root in (("b", _BASE), ("i", _INVERSE)):
                out = np.ones(size, dtype=_U)
                filled, step = 1, root
                while filled < size:
                    take = min(filled, size - filled)
                    out[filled:filled + take] = out[:take] * _U(step)
                    filled += take
                    step = (step * step) & 0xFFFFFFFFFFFFFFFF
                _POWERS[key] = out
        if size <= 1 << 22:
            _POWERS["n"] = size
        else:
            out = _POWERS.pop("b"), _POWERS.pop("i")
            _POWERS["n"] = 0
            return out
    return _POWERS["b"], _POWERS["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(31))
        h = h * _U(0x7FB5D329728EA185)
        h = h ^ (h >> _U(27))
        h = h * _U(0x81DADEF4BC2DD44D)
        return h ^ (h >> _U(33))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, by one rolling polynomial over the buffer."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * power[:len(data)], out=prefix[1:])
        return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(_U))


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k consecutive word hashes from each position (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        h = words[:n].copy()
        for i in range(1, k):
            h = h * _U(0xD6E8FEB86659FD93) + words[i:i + n]
        return mix(h)


def word_rows(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each row, plus the total: CSR bounds of the words by row."""
    return np.searchsorted(starts, offsets, side="left")


def append_columns(df: DataFrame, text_col: str,
                   make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                   fields: list[T.StructField], owner: str | None = None) -> DataFrame:
    """Every row and column of ``df`` plus columns computed from its text, map-side.

    ``make`` runs once per task and returns the batch function; ``owner`` names what it
    holds over tasks (:func:`hold`). New names that
    clash with a column of ``df`` must be made unique by the caller (:func:`fresh`).
    """
    schema = T.StructType([*df.schema.fields, *fields])
    at = [f.name for f in df.schema.fields].index(text_col)
    names = [f.name for f in schema.fields]

    def run(batches):
        fn = make()
        for batch in batches:
            for part in parts(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(part.column(at))], names=names)

    return df.mapInArrow(tidy(run, owner), schema)


#: Bytes of text in a part of a batch whose results are held at once.
PART_BYTES = 4 << 20


def parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about PART_BYTES of text in column ``at`` (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    row = 0
    while row < batch.num_rows:
        done = size[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(size, done + PART_BYTES, side="right")))
        yield batch.slice(row, end - row)
        row = end


def bounded_sample(labelled: DataFrame, per_class: int, seed: int = 7) -> tuple[DataFrame, dict]:
    """At most 2 x ``per_class`` (doc_id, label) rows of each label, and the label counts.

    ``labelled`` has doc_id and label. Rows are taken by a hash of the id at a
    rate that gives about ``per_class`` of each label, so the choice does not
    depend on the row order. Rows with a null id or label are ignored.
    """
    rows = labelled.where("doc_id IS NOT NULL AND label IS NOT NULL")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30))
    out = None
    for label, n in sorted(counts.items(), key=lambda x: str(x[0])):
        part = (rows.where((F.col("label") == F.lit(label))
                           & (spread < F.lit(int(min(1.0, per_class / n) * (1 << 30)) + 1)))
                .limit(2 * per_class))
        out = part if out is None else out.unionByName(part)
    return (rows.limit(0) if out is None else out), counts


#: Bits of a bitmap that thins rows inside a scan (fixed: 2 MB).
KEY_BITS = 24


def key_bitmap(keys: DataFrame, col: str) -> np.ndarray:
    """Packed bits of 64-bit keys' leading bits; at most 2^KEY_BITS numbers reach the driver, however many keys."""
    got = (keys.select(F.shiftrightunsigned(col, 64 - KEY_BITS).cast("int").alias("b"))
           .distinct().toArrow()["b"].to_numpy())
    bits = np.zeros(1 << KEY_BITS, dtype=bool)
    bits[got] = True
    return np.packbits(bits, bitorder="little")


def maybe_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned keys may be among the bitmap's (false ones are few, missed ones none)."""
    place = (keys >> _U(64 - KEY_BITS)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k consecutive word hashes from each position, at a cost that does not grow with k."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    power, inverse = _powers(len(words) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(words) + 1, dtype=_U)
        np.cumsum(words * power[:len(words)], out=prefix[1:])
        return mix((prefix[k:] - prefix[:n]) * inverse[:n])
