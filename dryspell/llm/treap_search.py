"""Ranked lexical search over K2-treaps of the term-document grid.

The grid has a row for every query term and a column for every document; a cell
holds the term's impact on the document's score. A block of documents becomes one
K2-treap: a quadtree over the grid in which a node keeps the largest impact below
it and a four-bit mask of its non-empty quadrants; children are found by counting
bits, so empty cells take no space. An item descends on the paths of all its rows
at once: an entry of its frontier is a range of documents with the node each row
is at, and the sum of the nodes' maxima bounds the score of every document in the
range. The best entries are split first; a range of one document has its exact
score, and ranges that cannot reach the k-th score met so far are dropped. That
score is carried from block to block of a task.

Rows are ordered by weight, so that the rows that share a node near the root have
like maxima. Scores are 64-bit integers: the sum, over the item's terms with
repeats, of w * ((10^9 * tf) div (1000 * tf + 12 * m)).

The texts are read once: each document's count of terms and of every query term
goes to a table of about a tenth of the text. Document frequencies, the number of
documents and their length come from that table; blocks are runs of its rows, so
no posting is shuffled, and a task returns k rows an item.

The items are the stated query set. They are sent to all tasks in chunks of at
most ``CHUNK_BYTES`` of text; more items take more passes.

Defined cases: a document without terms (null, empty, only signs) takes no part; an
item without terms gets no rows; every item row is ranked for itself, repeated
ids included; null document ids are ranked after others on equal scores; rows equal
in id and text tie; a score of 0 is no hit; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.llm.common import LOWER, doc_table, parts, span_hash, spans, text_slices, word_rows
from dryspell.operators._exec import materialize

#: Documents in a block, and bytes of item text sent to the tasks at once.
BLOCK_DOCS = 8192
CHUNK_BYTES = 16 << 20
#: Entries of a frontier that are split at once.
SPLIT = 256

_IS_TERM = np.ones(256, dtype=bool)
_IS_TERM[:128] = [chr(c).isalnum() for c in range(128)]

_BITS = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)

POSTINGS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
HITS = "item int, doc_id bigint, score bigint"


def _terms(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, and each term's start and end."""
    starts, ends = spans(_IS_TERM[data], offsets)
    return LOWER[data], starts, ends


class Vocabulary:
    """The distinct terms of a chunk of items, and each item's terms with their repeats."""

    def __init__(self, texts: list):
        self.items, words = [], {}
        for text in texts:
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            low, starts, ends = _terms(data, np.array([0, len(data)]))
            raw, counts = low.tobytes(), {}
            for s, e in zip(starts.tolist(), ends.tolist()):
                t = words.setdefault(raw[s:e], len(words))
                counts[t] = counts.get(t, 0) + 1
            self.items.append((np.fromiter(counts.keys(), np.int64, len(counts)),
                               np.fromiter(counts.values(), np.int64, len(counts))))
        self.size = len(words)
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1].astype(np.int64)
        self.data = np.frombuffer(b"".join(words), dtype=np.uint8)
        keys = span_hash(self.data, self.begin, self.begin + self.length)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        if np.any(self.keys[1:] == self.keys[:-1]):
            raise ValueError("two query terms have one hash")

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(which words are query terms, which term): found by hash, then compared byte by byte."""
        if self.size == 0 or len(starts) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = span_hash(low, starts, ends)
        slot = np.minimum(np.searchsorted(self.keys, keys), self.size - 1)
        at = np.flatnonzero(self.keys[slot] == keys)
        term = self.order[slot[at]]
        size = ends[at] - starts[at]
        same = size == self.length[term]
        at, term, size = at[same], term[same], size[same]
        if len(at) == 0:
            return at, term
        first = np.concatenate([[0], np.cumsum(size)])[:-1]
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        differs = low[np.repeat(starts[at], size) + step] != self.data[np.repeat(self.begin[term], size) + step]
        equal = ~np.logical_or.reduceat(differs, first)
        return at[equal], term[equal]


def postings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), and the query terms each document holds with their counts."""
    def run(batches):
        for batch in batches:
            for part in parts(batch, 1):
                for a, z, data, offsets in text_slices(part.column(1)):
                    low, starts, ends = _terms(data, offsets)
                    bounds = word_rows(starts, offsets)
                    at, term = vocabulary.find(low, starts, ends)
                    doc = np.searchsorted(bounds, at, side="right") - 1
                    cell, tf = np.unique(doc * max(1, vocabulary.size) + term, return_counts=True)
                    doc, term = np.divmod(cell, max(1, vocabulary.size))
                    off = pa.array(np.searchsorted(doc, np.arange(z - a + 1)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(a, z - a), pa.array(np.diff(bounds).astype(np.int64)),
                         pa.ListArray.from_arrays(off, pa.array(term.astype(np.int32))),
                         pa.ListArray.from_arrays(off, pa.array(tf.astype(np.int32)))],
                        names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, POSTINGS).where("n > 0")


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x (below 2^31) moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class K2Treap:
    """Compressed quadtree over (row, column, value > 0) cells, with the largest value of every node.

    Nodes of all levels are numbered from the root: ``mask`` has bit 2 * (row half)
    + (column half) for each non-empty quadrant, whose node is ``child`` plus the
    number of lower set bits.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        high = int(max(rows.max(initial=0), columns.max(initial=0)))
        self.height = max(1, high.bit_length())
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes)
        codes, best = codes[order], values[order].astype(np.int64)
        levels = [(np.zeros(len(codes), np.uint8), np.zeros(len(codes), np.int64), best)]
        for _ in range(self.height):
            quadrant = (codes & np.uint64(3)).astype(np.uint8)
            codes = codes >> np.uint64(2)
            begins = np.ones(len(codes), dtype=bool)
            begins[1:] = codes[1:] != codes[:-1]
            at = np.flatnonzero(begins)
            if len(at):
                mask = np.bitwise_or.reduceat(np.left_shift(np.uint8(1), quadrant), at)
                best = np.maximum.reduceat(best, at)
            else:
                mask = np.zeros(0, np.uint8)
            levels.append((mask, at, best))
            codes = codes[at]
        levels.reverse()
        sizes = np.cumsum([0] + [len(level[0]) for level in levels])
        self.mask = np.concatenate([level[0] for level in levels])
        self.best = np.concatenate([level[2] for level in levels])
        self.child = np.concatenate([level[1] + sizes[min(i + 1, len(levels) - 1)] for i, level in enumerate(levels)])
        self.size = len(codes)

    def top(self, rows: np.ndarray, repeats: np.ndarray, k: int, met: np.ndarray, split: int = SPLIT):
        """(columns, scores) of all columns that may be among the k best, given the best scores ``met`` elsewhere.

        Columns whose score equals the k-th are all returned, so that ties can be settled by id.
        """
        none = np.zeros(0, np.int64)
        if self.size == 0 or len(rows) == 0:
            return none, none
        met = np.sort(met)[::-1][:k]
        floor = met[k - 1] if len(met) == k else 1
        # The frontier: entries, and for each a run of (position among rows, node).
        bound = np.array([int((repeats * self.best[0]).sum())])
        start, level = np.array([0]), np.array([0])
        count = np.array([len(rows)])
        path, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        found, scores = [], []
        while len(bound):
            chosen = np.zeros(len(bound), dtype=bool)
            if len(bound) > split:
                chosen[np.argpartition(-bound, split)[:split]] = True
            else:
                chosen[:] = True
            mine = np.repeat(chosen, count)
            e_start, e_level, e_count = start[chosen], level[chosen], count[chosen]
            p, x = path[mine], node[mine]
            entry = np.repeat(np.arange(len(e_start)), e_count)
            down = self.height - 1 - e_level
            masks = self.mask[x]
            half = (rows[p] >> down[entry]) & 1
            starts, levels, bounds, counts, paths, nodes = [], [], [], [], [], []
            for side in (0, 1):
                quadrant = 2 * half + side
                has = (masks >> quadrant.astype(np.uint8)) & 1 > 0
                lower = masks[has] & ((1 << quadrant[has]) - 1)
                below = self.child[x[has]] + _BITS[lower]
                value = np.concatenate([[0], np.cumsum(self.best[below] * repeats[p[has]])])
                n = np.bincount(entry[has], minlength=len(e_start))
                edge = np.concatenate([[0], np.cumsum(n)])
                total = value[edge[1:]] - value[edge[:-1]]
                starts.append(e_start + (side << down))
                levels.append(e_level + 1)
                bounds.append(total)
                counts.append(n)
                paths.append(p[has])
                nodes.append(below)
            n_start, n_level = np.concatenate(starts), np.concatenate(levels)
            n_bound, n_count = np.concatenate(bounds), np.concatenate(counts)
            leaf = (n_level == self.height) & (n_bound >= floor)
            if leaf.any():
                found.append(n_start[leaf])
                scores.append(n_bound[leaf])
                met = np.sort(np.concatenate([met, n_bound[leaf]]))[::-1][:k]
                if len(met) == k:
                    floor = max(floor, met[k - 1])
            fresh = (n_level < self.height) & (n_bound >= floor)
            old = ~chosen & (bound >= floor)
            path = np.concatenate([path[np.repeat(old, count)], np.concatenate(paths)[np.repeat(fresh, n_count)]])
            node = np.concatenate([node[np.repeat(old, count)], np.concatenate(nodes)[np.repeat(fresh, n_count)]])
            bound = np.concatenate([bound[old], n_bound[fresh]])
            start = np.concatenate([start[old], n_start[fresh]])
            level = np.concatenate([level[old], n_level[fresh]])
            count = np.concatenate([count[old], n_count[fresh]])
        if not found:
            return none, none
        found, scores = np.concatenate(found), np.concatenate(scores)
        keep = scores >= floor
        return found[keep], scores[keep]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    m = 100 - 25 + (25 * n * n_docs) // total
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _search(table: DataFrame, vocabulary: Vocabulary, n_docs: int, total: int, df: np.ndarray, k: int) -> DataFrame:
    """HITS: each task's k best documents of every item."""
    weight = weights(n_docs, df)
    # A row of the grid for each term, heavy ones first.
    row_of = np.empty(vocabulary.size, dtype=np.int64)
    row_of[np.argsort(-weight, kind="stable")] = np.arange(vocabulary.size)
    items = [(row_of[terms], repeats) for terms, repeats in vocabulary.items]
    none = np.zeros(0, np.int64)

    def run(batches):
        best = [(none, none, none)] * len(items)          # score, null id, id

        def block(held):
            ids = pa.concat_arrays([b.column(0) for b in held])
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            n = np.concatenate([b.column(1).to_numpy() for b in held])
            lists = pa.concat_arrays([b.column(2) for b in held])
            column = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = pa.concat_arrays([b.column(3) for b in held]).flatten().to_numpy().astype(np.int64)
            value = impacts(weight[term], tf, n[column], n_docs, total)
            # Documents of like length are neighbours.
            place = np.empty(len(n), dtype=np.int64)
            back = np.argsort(n, kind="stable")
            place[back] = np.arange(len(n))
            solid = value > 0
            treap = K2Treap(row_of[term[solid]], place[column[solid]], value[solid])
            for i, (rows, repeats) in enumerate(items):
                score, gone, doc = best[i]
                found, more = treap.top(rows, repeats, k, score)
                if len(found):
                    at = back[found]
                    score, gone, doc = (np.concatenate([score, more]), np.concatenate([gone, null[at]]),
                                        np.concatenate([doc, ids[at]]))
                    top = np.lexsort((doc, gone, -score))[:k]
                    best[i] = score[top], gone[top], doc[top]

        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, BLOCK_DOCS - size)
                held.append(batch.slice(0, take))
                batch, size = batch.slice(take), size + take
                if size == BLOCK_DOCS:
                    block(held)
                    held, size = [], 0
        if held:
            block(held)
        for i, (score, gone, doc) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), i, np.int32)), pa.array(doc, mask=gone.astype(bool)), pa.array(score)],
                    names=["item", "doc_id", "score"])

    return table.mapInArrow(run, HITS)


def search(df: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every row of ``items``."""
    spark, docs = df.sparkSession, doc_table(df)
    asked = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    out = None
    for c in range(chunks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == c).collect()
        part = _search_chunk(spark, docs, rows, k)
        out = part if out is None else out.unionByName(part)
    return out


def _search_chunk(spark, docs: DataFrame, rows: list, k: int) -> DataFrame:
    vocabulary = Vocabulary([r["text"] for r in rows])
    table = materialize(postings(docs, vocabulary), "treap-postings")
    # At most a row a query term reaches the driver.
    counted = table.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
    df = np.zeros(vocabulary.size, dtype=np.int64)
    got = table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).toArrow()
    df[got["t"].to_numpy()] = got["c"].to_numpy()
    hits = _search(table, vocabulary, counted["docs"], counted["total"] or 1, df, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id bigint")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))


def oracle_sql(k: int = 20) -> str:
    terms = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
l AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
q AS (SELECT i, item_id, t, CAST(count(*) AS BIGINT) AS c FROM (
        SELECT i, item_id, unnest(w) AS t FROM (
          SELECT row_number() OVER () AS i, item_id, {terms} AS w FROM benchmark)) GROUP BY i, item_id, t),
p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM l) GROUP BY r, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * CAST(docs AS DOUBLE) + 2) / (2 * df + 1))) AS BIGINT) AS w FROM f, g),
s AS (SELECT q.i, q.item_id, l.doc_id, l.r,
             CAST(sum(q.c * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * l.n * g.docs) // g.total))))
                  AS BIGINT) AS score
      FROM q JOIN p ON p.t = q.t JOIN w ON w.t = q.t JOIN l ON l.r = p.r, g GROUP BY q.i, q.item_id, l.doc_id, l.r),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {k}"""
