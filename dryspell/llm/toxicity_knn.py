"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples are a bounded, documented sample of labelled documents. Terms are
words and their four-letter stems, hashed; the vocabulary keeps every term that
separates the sample's labels significantly (chi-square), however many there are,
and inverse document frequencies
come from counts over *all* documents, which Spark sums. The examples form a sparse
inverted index cut into blocks; every (term, block) holds its largest weight, so
a query's dot product with the block maxima bounds its cosine with every example
of a block. Blocks are visited from the highest bound down and a query stops
when its bound cannot beat its k-th neighbour: the k nearest are exact.

The neighbours vote, weighted by cosine (the complement of the distance) and by
how rare their label is in the sample against the labelled table; a logistic map
fitted on the examples' own leave-one-out votes calibrates the score. The
nearest examples' ids and cosines are returned as evidence.

Defined cases: null or empty text, or one with no vocabulary term, has no
neighbour and gets the calibrated score of an empty vote; of equal cosines the
smaller example id counts as nearer; without both labels every score is the
share of label 1 (0 without labels); an empty table gives no rows; repeated rows
are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.common import (LOWER, append_columns, bounded_sample, doc_table, fresh, mix,
                                 span_hash, spans, text_slices, tidy, word_rows)

#: Examples of each label, about (at most twice that).
EXAMPLES_PER_CLASS = 1500
#: Least chi-square of a term: one in a hundred reaches it by chance.
SIGNIFICANT = 6.63
#: Neighbours that vote, and examples in a block of the index.
NEIGHBOURS = 15
BLOCK = 32
#: Bytes of a stem.
STEM = 4

_WORD = np.zeros(256, dtype=bool)
_WORD[97:123] = True
_WORD[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each term, term hash): words and the stems of longer words."""
    low = LOWER[data]
    start, end = spans(_WORD[low], offsets)
    row = np.searchsorted(offsets, start, side="right") - 1
    whole = span_hash(low, start, end)
    long = end - start > STEM
    stem = mix(span_hash(low, start[long], start[long] + STEM))
    return np.concatenate([row, row[long]]), np.concatenate([whole, stem])


def counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with their counts."""
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row)))


def lookup(vocabulary: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which terms are known, their column); ``vocabulary`` is sorted."""
    if len(vocabulary) == 0:
        return np.zeros(len(term), bool), np.zeros(len(term), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
    return vocabulary[at] == term, at


def unit_vectors(vocabulary: np.ndarray, idf: np.ndarray, rows: int, row: np.ndarray, term: np.ndarray,
                 tf: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit (1 + ln tf) idf vectors of ``rows`` texts as (columns, weights), without ``tf`` from repeated terms."""
    known, col = lookup(vocabulary, term)
    row, col = row[known], col[known]
    if tf is None:
        row, col, tf = counted(row, col)
    else:
        order = np.lexsort((col, row))
        row, col, tf = row[order], col[order], tf[known][order]
    weight = (1 + np.log(tf)) * idf[col]
    cut = np.searchsorted(row, np.arange(rows + 1))
    out = []
    for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
        w = weight[a:z]
        out.append((col[a:z], w / np.sqrt(w @ w) if z > a else w))
    return out


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after another, and how many each has."""
    n = end - start
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum())), n


@dataclass
class Index:
    """Block-max inverted index of the examples; arrays of bounded size."""

    ids: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    vectors: list            # the examples, in block order
    of_term: np.ndarray      # first (term, block) pair of each term, and the total
    block: np.ndarray        # of each pair: its block, largest weight and first posting (and the total)
    largest: np.ndarray
    first: np.ndarray
    place: np.ndarray        # of each posting: the example's place and weight
    value: np.ndarray

    @staticmethod
    def build(ids, label, weight, vectors, vocabulary: int) -> Index:
        # Examples with the same strongest term stand together, so block maxima stay tight.
        strongest = np.array([c[w.argmax()] if len(c) else vocabulary for c, w in vectors])
        order = np.lexsort((ids, strongest))
        held = [vectors[i] for i in order]
        term = np.concatenate([c for c, _ in held]).astype(np.int64)
        place = np.repeat(np.arange(len(held)), [len(c) for c, _ in held])
        value = np.concatenate([w for _, w in held])
        by = np.lexsort((place, term))
        term, place, value = term[by], place[by], value[by]
        block = place // BLOCK
        new = np.ones(len(term), dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        return Index(ids[order], label[order], weight[order], held, np.searchsorted(term[at], np.arange(vocabulary + 1)),
                     block[at], np.maximum.reduceat(value, at) if len(at) else value, np.append(at, len(term)), place, value)

    def _scored(self, pairs, w, wanted) -> np.ndarray:
        """Cosines of the examples of the wanted blocks, by place; others 0."""
        some = wanted[self.block[pairs]]
        pairs, w = pairs[some], w[some]
        at, n = _ranges(self.first[pairs], self.first[pairs + 1])
        return np.round(np.bincount(self.place[at], weights=np.repeat(w, n) * self.value[at], minlength=len(self.ids)), 12)

    def nearest(self, queries, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(position, cosine) of each query's k nearest examples with a positive cosine.

        Missing ones have position -1. ``skip`` leaves out one position per query.
        """
        n = len(queries)
        pos, sim = np.full((n, k), -1), np.zeros((n, k))
        blocks, first = -(-len(self.ids) // BLOCK), -(-k // BLOCK) + 1
        for i, (cols, w) in enumerate(queries):
            if len(cols) == 0:
                continue
            pairs, count = _ranges(self.of_term[cols], self.of_term[cols + 1])
            w = np.repeat(w, count)
            bound = np.bincount(self.block[pairs], weights=w * self.largest[pairs], minlength=blocks)
            wanted = np.zeros(blocks, dtype=bool)
            wanted[np.argsort(-bound, kind="stable")[:first]] = True
            score = self._scored(pairs, w, wanted)
            if skip is not None:
                score[skip[i]] = 0
            # The k-th cosine so far; a bound equal to it may still hide a smaller id.
            least = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else 0.0
            rest = ~wanted & (bound > 0) & (bound >= least - 1e-9)
            if rest.any():
                score += self._scored(pairs, w, rest)
                if skip is not None:
                    score[skip[i]] = 0
                least = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else 0.0
            keep = np.flatnonzero((score > 0) & (score >= least))
            keep = keep[np.lexsort((self.ids[keep], -score[keep]))][:k]
            pos[i, :len(keep)], sim[i, :len(keep)] = keep, score[keep]
        return pos, sim

    def vote(self, pos: np.ndarray, sim: np.ndarray) -> np.ndarray:
        """Log-odds of the cosine-weighted vote, pulled to 0 when little is near."""
        w = np.where(pos >= 0, sim ** 2 * self.weight[pos], 0)
        yes = (w * (self.label[pos] == 1)).sum(axis=1)
        no = (w * (self.label[pos] == 0)).sum(axis=1)
        return np.log(yes + 0.05) - np.log(no + 0.05)


@dataclass
class Model:
    vocabulary: np.ndarray
    idf: np.ndarray
    index: Index | None
    slope: float
    intercept: float
    prior: float


def _logistic(x, y, w, steps=60):
    """Slope and intercept by Newton steps, lightly regularised."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    c = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        g = a.T @ (w * (y - p)) - 1e-3 * c
        h = (a * (w * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        c = c + np.clip(step, -2, 2)
    return float(c[0]), float(c[1])


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that hold each vocabulary term, and all documents; one row per term and task."""
    def run(batches):
        df, rows = np.zeros(len(vocabulary) + 1, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in text_slices(batch.column(0)):
                row, term = terms(data, offsets)
                known, col = lookup(vocabulary, term)
                pair = np.unique(row[known] * len(vocabulary) + col[known])
                df[:-1] += np.bincount(pair % max(1, len(vocabulary)), minlength=len(vocabulary))
        df[-1] = rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], names=["term", "n"])

    got = (doc_table(docs).select("text").mapInArrow(tidy(run), "term bigint, n bigint")
           .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    df = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    df[got["term"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, labelled: DataFrame, per_class: int = EXAMPLES_PER_CLASS) -> Model:
    """Build the index from about ``per_class`` documents of each label.

    ``labelled`` has doc_id and label (0/1); idf counts read every document.
    The driver receives the examples' distinct hashed terms, no text.
    """
    sample, counts = bounded_sample(labelled, per_class)
    n = {int(k): v for k, v in counts.items()}
    prior = n.get(1, 0) / max(1, sum(n.values()))
    flat = Model(np.zeros(0, np.uint64), np.zeros(0), None, 0.0, 0.0, prior)
    if n.get(0, 0) == 0 or n.get(1, 0) == 0:
        return flat
    rows = doc_table(docs).join(F.broadcast(sample.dropDuplicates(["doc_id"])), "doc_id")

    def run(batches):
        for batch in batches:
            ids, labels = batch.column("doc_id"), batch.column("label")
            for row, end, data, offsets in text_slices(batch.column("text")):
                r, t, c = counted(*terms(data, offsets))
                at = np.searchsorted(r, np.arange(end - row + 1))
                cut = list(zip(at[:-1], at[1:]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, end - row), labels.slice(row, end - row),
                     pa.array([t[a:b].view(np.int64) for a, b in cut], pa.list_(pa.int64())),
                     pa.array([c[a:b].astype(np.int32) for a, b in cut], pa.list_(pa.int32()))],
                    names=["doc_id", "label", "term", "tf"])

    got = (rows.select("doc_id", F.col("label").cast("int").alias("label"), "text")
           .mapInArrow(tidy(run), "doc_id bigint, label int, term array<bigint>, tf array<int>")
           .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id").combine_chunks())
    ids, label = got["doc_id"].to_numpy(), got["label"].to_numpy()
    if len(set(label.tolist())) < 2:
        return flat
    size = pc.list_value_length(got["term"]).to_numpy()
    row = np.repeat(np.arange(len(ids)), size)
    term = pc.list_flatten(got["term"]).to_numpy().view(np.uint64)
    tf = pc.list_flatten(got["tf"]).to_numpy().astype(np.int64)

    every, col = np.unique(term, return_inverse=True)
    yes = np.bincount(col[label[row] == 1], minlength=len(every)).astype(float)
    no = np.bincount(col[label[row] == 0], minlength=len(every)).astype(float)
    m1, m0 = float((label == 1).sum()), float((label == 0).sum())
    a, b, c, d = yes, no, m1 - yes, m0 - no
    chi = (m1 + m0) * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * m1 * m0, 1e-9)
    # Terms of one or two examples, or that lean the wrong way by chance, do not enter.
    words = every[(a + b >= 3) & (chi >= SIGNIFICANT)]
    if len(words) == 0:
        return flat
    df, rows_all = document_frequencies(docs, words)
    idf = np.log((1 + rows_all) / (1 + df)) + 1
    vectors = unit_vectors(words, idf, len(ids), row, term, tf)
    share = np.array([n[0], n[1]], dtype=float) / (n[0] + n[1])
    weight = np.sqrt(share / (np.array([m0, m1]) / (m0 + m1)))[label]
    index = Index.build(ids, label, weight, vectors, len(words))
    slope_x = index.vote(*index.nearest(index.vectors, NEIGHBOURS, np.arange(len(index.ids))))
    slope, intercept = _logistic(slope_x, index.label.astype(float), index.weight)
    return Model(words, idf, index, slope, intercept, prior)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus score, predicted, evidence (example ids) and similarity."""
    taken = docs.columns
    fields = [T.StructField(fresh("score", taken), T.DoubleType()),
              T.StructField(fresh("predicted", taken), T.IntegerType()),
              T.StructField(fresh("evidence", taken), T.ArrayType(T.LongType())),
              T.StructField(fresh("similarity", taken), T.ArrayType(T.DoubleType()))]

    def make():
        index, v = model.index, len(model.vocabulary)

        def batch(col):
            p, ids, sims = [], [], []
            for first, end, data, offsets in text_slices(col):
                rows = end - first
                if index is None:
                    p += [model.prior] * rows
                    ids += [[]] * rows
                    sims += [[]] * rows
                    continue
                queries = unit_vectors(model.vocabulary, model.idf, rows, *terms(data, offsets))
                pos, sim = index.nearest(queries, NEIGHBOURS)
                logit = model.slope * index.vote(pos, sim) + model.intercept
                p += (1 / (1 + np.exp(-np.clip(logit, -30, 30)))).tolist()
                ids += [index.ids[x[x >= 0]].tolist() for x in pos]
                sims += [s[x >= 0].tolist() for s, x in zip(sim, pos)]
            score_ = np.array(p, dtype=float)
            return [pa.array(score_), pa.array((score_ >= 0.5).astype(np.int32)),
                    pa.array(ids, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float64()))]

        return batch

    return append_columns(docs, text_col, make, fields)
