"""Removal of word sequences that occur more than once, by difference-cover anchors.

A window is ``window`` consecutive words of one document; every word that some
repeated window covers goes, in all its places. Hashing all windows would shuffle
several times the text. Instead:

1. *Anchors.* Only positions whose number modulo ``PERIOD`` is in ``COVER`` hash a
   shorter run of ``window - PERIOD + 1`` words. Every difference modulo the period
   is a difference of two cover positions, so two equal windows, wherever they lie
   in their documents, hold an aligned pair of equal anchors within reach.
2. *Extension.* Only windows that hold an anchor met elsewhere are hashed, to 128
   bits, and a window met elsewhere marks its words.
3. Marks become spans per text, and each text drops them.

An anchor or window that a task meets twice in its part of the text is known to
repeat at once: it crosses the shuffle as one row a part, and its other places
as spans. So a passage that a third of all documents hold, or a text that says one
word for ever, makes as many rows as there are parts, not places. Places travel as
(doc_id, hash of the text): rows equal in both are alike in their result.

Defined cases: a null text has no words; a null id is kept; equal rows are
separate documents, so their windows repeat; a window may overlap its other place;
texts of fewer than ``window`` words lose nothing; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from dryspell.llm.common import doc_table, mix, parts, span_hash, spans, text_slices, window_hash, word_rows
from dryspell.operators._exec import broadcast_checked, materialize

#: A perfect difference set; each difference modulo 21 occurs once.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)

WINDOW = 35

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_IN_COVER = np.isin(np.arange(PERIOD), COVER)

PLACES = "key bigint, doc_id bigint, th bigint, lo int, hi int"
SEEN = "k1 bigint, k2 bigint, rid bigint, lo int, hi int"


def _words(data: np.ndarray, offsets: np.ndarray):
    """Word hashes of a slice, the first word of each row (and the total), and each word's start and end."""
    starts, ends = spans(_IS_WORD[data], offsets)
    return span_hash(data, starts, ends), word_rows(starts, offsets), starts, ends


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs(rows: np.ndarray, pos: np.ndarray, gap: int = 1):
    """(row, first, last) of the runs of positions at most ``gap`` apart, from places sorted by row and position."""
    if len(pos) == 0:
        return rows, pos, pos
    new = np.ones(len(pos), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (pos[1:] > pos[:-1] + gap)
    at = np.flatnonzero(new)
    return rows[at], pos[at], pos[np.append(at[1:], len(pos)) - 1]


def _told(keys: np.ndarray):
    """Which of equal keys comes first, and which keys are not alone."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.ones(len(keys), dtype=bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    size = np.diff(np.append(np.flatnonzero(begins), len(keys)))
    first = np.zeros(len(keys), dtype=bool)
    first[order[begins]] = True
    several = np.zeros(len(keys), dtype=bool)
    several[order] = np.repeat(size > 1, size)
    return first, several


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """PLACES of the cover positions' anchors.

    ``hi`` is -1 where the anchor was met once in its part; else the places from
    ``lo`` to ``hi`` are known to repeat.
    """
    size = window - PERIOD + 1

    def run(batches):
        for batch in batches:
            for part in parts(batch, 2):
                ids, ths = part.column(0), part.column(1).to_numpy()
                for a, z, data, offsets in text_slices(part.column(2)):
                    words, bounds, _, _ = _words(data, offsets)
                    if len(words) < window:
                        continue
                    length = np.diff(bounds)
                    doc = np.repeat(np.arange(z - a), length)
                    pos = np.arange(len(words)) - bounds[doc]
                    at = np.flatnonzero(_IN_COVER[pos % PERIOD] & (pos + size <= length[doc])
                                        & (length[doc] >= window))
                    if len(at) == 0:
                        continue
                    keys, doc, pos = window_hash(words, size)[at], doc[at], pos[at]
                    first, several = _told(keys)
                    # Windows that hold anchors at most a period apart are one run. Known runs need
                    # no key; they are spread by their place.
                    known, lo, hi = _runs(doc[~first], pos[~first], PERIOD)
                    spread = mix(ths[a + known].view(np.uint64) ^ lo.astype(np.uint64))
                    yield _places(ids, ths, a, np.concatenate([keys[first], spread]),
                                  np.concatenate([doc[first], known]), np.concatenate([pos[first], lo]),
                                  np.concatenate([np.where(several[first], pos[first], -1), hi]))

    return rows.mapInArrow(run, PLACES)


def _places(ids, ths, a, keys, doc, lo, hi):
    return pa.RecordBatch.from_arrays(
        [_signed(keys), ids.take(pa.array(a + doc)), pa.array(ths[a + doc]), pa.array(lo.astype(np.int32)),
         pa.array(hi.astype(np.int32))], names=["key", "doc_id", "th", "lo", "hi"])


def _repeated(places: DataFrame, keys: list[str]) -> DataFrame:
    """The places known to repeat, and those whose key another place has."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return (places.withColumn("n", n).where("n > 1 OR hi >= 0")
            .select(*(c for c in places.columns if c not in keys and c != "hi"),
                    F.greatest("lo", "hi").alias("hi")))


def _merged(rows: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """(keys, spans): the union of [lo - before, hi + after] of each text, as packed little-endian int32 pairs.

    Rows are dealt by text, sorted, and merged as they stream; a text's spans are
    at most as many as its words.
    """
    schema = ", ".join(f"{k} bigint" for k in keys) + ", spans binary"

    def run(batches):
        open_key, open_spans = None, None

        def packed(key, some):
            return pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()) for k in key] + [pa.array([some.astype("<i4").tobytes()], pa.binary())],
                names=[*keys, "spans"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [batch.column(i) for i in range(len(keys))]
            known = [c.is_null().to_numpy(zero_copy_only=False) for c in columns]
            values = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns]
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = np.logical_or.reduce([(v[1:] != v[:-1]) | (k[1:] != k[:-1]) for v, k in zip(values, known)])
            low = batch.column(len(keys)).to_numpy().astype(np.int64) - before
            high = batch.column(len(keys) + 1).to_numpy().astype(np.int64) + after
            np.maximum(low, 0, out=low)
            text = np.cumsum(new) - 1
            # Places are sorted by lo within a text: a span ends where lo passes all hi so far.
            shift = int(high.max()) + 2
            reach = np.maximum.accumulate(high + text * shift) - text * shift
            begins = new.copy()
            begins[1:] |= low[1:] > reach[:-1] + 1
            at = np.flatnonzero(begins)
            ends = np.append(at[1:], batch.num_rows) - 1
            got = np.stack([low[at], reach[ends]], axis=1)
            heads = np.flatnonzero(new)
            edges = np.searchsorted(at, np.append(heads, batch.num_rows))
            keyed = list(zip(*(c.take(pa.array(heads)).to_pylist() for c in columns)))
            blobs = [got[edges[i]:edges[i + 1]] for i in range(len(heads))]
            if open_key is not None:
                if keyed[0] == open_key:
                    blobs[0] = _joined(open_spans, blobs[0])
                else:
                    yield packed(open_key, open_spans)
            open_key, open_spans = keyed[-1], blobs[-1]
            if len(keyed) > 1:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*keyed[:-1])]
                    + [pa.array([b.astype("<i4").tobytes() for b in blobs[:-1]], pa.binary())],
                    names=[*keys, "spans"])
        if open_key is not None:
            yield packed(open_key, open_spans)

    return (rows.select(*keys, "lo", "hi").repartition(*keys).sortWithinPartitions(*keys, "lo")
            .mapInArrow(run, schema))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = np.concatenate([a, b])
    reach = np.maximum.accumulate(both[:, 1])
    begins = np.ones(len(both), dtype=bool)
    begins[1:] = both[1:, 0] > reach[:-1] + 1
    at = np.flatnonzero(begins)
    return np.stack([both[at, 0], reach[np.append(at[1:], len(both)) - 1]], axis=1)


def _span_mask(blobs: list, bounds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which words (or windows) of a slice's texts the texts' packed spans cover; positions past a text's end are cut."""
    change = np.zeros(int(bounds[-1]) + 1, dtype=np.int32)
    for i, blob in enumerate(blobs):
        if blob:
            pair = np.frombuffer(blob, dtype="<i4").reshape(-1, 2).astype(np.int64)
            end = np.minimum(pair[:, 1] + 1, lengths[i])
            keep = pair[:, 0] < end
            np.add.at(change, bounds[i] + pair[keep, 0], 1)
            np.add.at(change, bounds[i] + end[keep], -1)
    return np.cumsum(change[:-1]) > 0


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """SEEN rows of the candidate windows: rows are (rid, text, spans of window starts)."""
    def run(batches):
        for batch in batches:
            for part in parts(batch, 1):
                rids, blobs = part.column(0).to_numpy(), part.column(2).to_pylist()
                for a, z, data, offsets in text_slices(part.column(1)):
                    words, bounds, _, _ = _words(data, offsets)
                    if len(words) < window:
                        continue
                    length = np.diff(bounds)
                    at = np.flatnonzero(_span_mask(blobs[a:z], bounds, length - window + 1))
                    if len(at) == 0:
                        continue
                    one, two = window_hash(words, window)[at], window_hash(mix(~words), window)[at]
                    doc = np.searchsorted(bounds, at, side="right") - 1
                    pos = at - bounds[doc]
                    first, several = _told(one ^ mix(two))
                    # Repeats within the part: the first place carries the key, all are known spans.
                    sent = np.flatnonzero(first)
                    known, lo, hi = _runs(doc[~first], pos[~first])
                    # Known runs need no key; they are spread by their place.
                    spread = mix(mix(rids[a + known].astype(np.uint64)) ^ lo.astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [_signed(np.concatenate([one[sent], spread])),
                         _signed(np.concatenate([two[sent], mix(spread)])),
                         pa.array(rids[a + np.concatenate([doc[sent], known])]),
                         pa.array(np.concatenate([pos[sent], lo]).astype(np.int32)),
                         pa.array(np.concatenate([np.where(several[sent], pos[sent], -1), hi]).astype(np.int32))],
                        names=["k1", "k2", "rid", "lo", "hi"])

    return rows.mapInArrow(run, SEEN)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, th, spans): packed spans of the words that repeated windows cover, by text.

    ``docs`` has doc_id, th (a hash of the text) and text.
    """
    if window < PERIOD:
        raise ValueError(f"a window needs at least {PERIOD} words")
    shared = _repeated(_anchors(docs.select("doc_id", "th", "text"), window), ["key"])
    nominated = materialize(_merged(shared, ["doc_id", "th"], PERIOD - 1, 0)
                            .withColumn("rid", F.monotonically_increasing_id()), "substring-candidates")
    mine, theirs = docs.alias("d"), broadcast_checked(nominated).alias("c")
    rows = (mine.join(theirs, F.expr("d.doc_id <=> c.doc_id AND d.th = c.th"))
            .select("c.rid", "d.text", "c.spans"))
    met = _repeated(_windows(rows, window), ["k1", "k2"])
    marked = _merged(met, ["rid"], 0, window - 1)
    return materialize(marked.join(nominated.select("rid", "doc_id", "th"), "rid")
                       .select("doc_id", "th", "spans"), "substring-spans")


def remove_repeats(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each document's words outside repeated windows, joined by single spaces."""
    docs = doc_table(df).withColumn("th", F.xxhash64("text"))
    spans_of = broadcast_checked(repeated_spans(docs, window)).alias("s")
    rows = (docs.alias("d").join(spans_of, F.expr("d.doc_id <=> s.doc_id AND d.th = s.th"), "left")
            .select("d.doc_id", "d.text", "s.spans"))

    def run(batches):
        for batch in batches:
            for part in parts(batch, 1):
                blobs = part.column(2).to_pylist()
                for a, z, data, offsets in text_slices(part.column(1)):
                    yield _kept(part.column(0).slice(a, z - a), blobs[a:z], data, offsets)

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def _kept(ids: pa.Array, blobs: list, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    is_word = _IS_WORD[data]
    starts, ends = spans(is_word, offsets)
    bounds = word_rows(starts, offsets)
    length = np.diff(bounds)
    gone = _span_mask(blobs, bounds, length)
    counts = np.concatenate([[0], np.cumsum(gone)])
    # The bytes of the kept words, each with the blank after it (if its text has one) as a space.
    change = np.zeros(len(data) + 2, dtype=np.int8)
    change[starts[~gone]] += 1
    change[ends[~gone] + 1] -= 1
    row_ends = np.zeros(len(data) + 1, dtype=bool)
    row_ends[offsets] = True
    # A word at its text's end has no blank of its own to keep.
    last = ends[~gone][row_ends[ends[~gone]]]
    change[last] -= 1
    change[last + 1] += 1
    keep = np.cumsum(change[:len(data)]) > 0
    body = np.where(is_word, data, np.uint8(32))[keep]
    edges = np.concatenate([[0], np.cumsum(keep)])[offsets]
    begin, end = edges[:-1], edges[1:].copy()
    full = end > begin
    end[full] -= body[end[full] - 1] == 32
    raw = body.tobytes()
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(length.astype(np.int64)), pa.array((counts[bounds[1:]] - counts[bounds[:-1]]).astype(np.int64)),
         pa.array([raw[b:e].decode() for b, e in zip(begin.tolist(), end.tolist())], pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept"])


def oracle_sql(window: int = WINDOW) -> str:
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - {window} + 2)) AS p FROM d WHERE len(w) >= {window}),
h AS (SELECT p.r, p.p, md5(array_to_string(w[p.p:p.p + {window - 1}], ' ')) AS h FROM p JOIN d ON p.r = d.r),
s AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS n FROM h) WHERE n > 1),
g AS (SELECT DISTINCT r, unnest(range(p, p + {window})) AS i FROM s),
k AS (SELECT r, list(i) AS gone FROM g GROUP BY r),
f AS (SELECT doc_id, w, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN w
                  ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
                                                  lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
      FROM d LEFT JOIN k ON d.r = k.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM f"""
