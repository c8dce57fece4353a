"""Quality classifier: a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are measured on its bytes (share
of letters, capitals, digits, punctuation, symbols, repeated words, lengths)
and those of its two neighbours are added, so the field sees context in the
emissions as well as in the transitions. Weights are fitted by gradient ascent
on the conditional likelihood of a bounded, documented sample of labelled
documents (a document's label stands for all its lines). Scoring runs
forward-backward over each whole document and averages the marginals of "good"
weighted by line length.

Defined cases: null text is empty; an empty text is one empty line and gets a
score; a text of one line has no neighbours (zeros); without labels of both
kinds every score is the share of label 1 (0.5 without labels); an empty table
gives no rows; repeated rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.common import (append_columns, bounded_sample, doc_table, fresh, span_hash,
                                 spans, text_slices, word_rows)

#: Labelled documents of each label that the model is fitted on, about (at most twice that).
SAMPLE_PER_CLASS = 1500
#: Most lines in a row that one sampled document gives to the fit, from a place set by its
#: bytes; scoring uses all lines of all documents.
FIT_LINES = 64
#: Measures of one line.
MEASURES = 13

_KIND = np.zeros(256, dtype=np.uint8)      # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 stop, 6 symbol, 7 high
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 7
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:?!'\"()-"]] = 5
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end byte of each line, first line of each row plus the total)."""
    breaks = np.flatnonzero(data == 10)
    # A row with m newlines has m + 1 lines, an empty row one.
    before = np.searchsorted(breaks, offsets)
    rows = len(offsets) - 1
    first = before + np.arange(rows + 1)
    starts = np.empty(first[-1], dtype=np.int64)
    ends = np.empty(first[-1], dtype=np.int64)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    starts[first[:-1]] = offsets[:-1]
    slot = np.arange(len(breaks)) + owner
    starts[slot + 1] = breaks + 1
    ends[first[1:] - 1] = offsets[1:]
    ends[slot] = breaks
    return starts, ends, first


def line_measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x MEASURES, bytes of each line, first line of each row plus the total)."""
    starts, ends, first = line_bounds(data, offsets)
    size = ends - starts
    n = len(starts)
    kind = _KIND[data]

    def total(flag):
        c = np.zeros(len(flag) + 1, dtype=np.int32)
        np.cumsum(flag, out=c[1:])
        return (c[ends] - c[starts]).astype(np.float64)

    share = np.maximum(size, 1)
    out = np.zeros((n, MEASURES))
    lower, upper, high = total(kind == 1), total(kind == 2), total(kind == 7)
    for i, v in enumerate((lower, upper, total(kind == 3), total(kind == 4), total(kind == 5), total(kind == 6), high)):
        out[:, i] = v / share
    out[:, 7] = total(data == 33) / share
    out[:, 8] = np.log1p(size) / 6
    ws, we = spans(kind != 4, offsets)
    line = np.searchsorted(starts, ws, side="right") - 1
    words = np.bincount(line, minlength=n)[:n]
    out[:, 9] = np.log1p(words) / 4
    out[:, 10] = np.minimum(size / np.maximum(words, 1), 40) / 10
    if len(ws):
        h = span_hash(data, ws, we) ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        new = np.ones(len(h), dtype=bool)
        order = np.argsort(h, kind="stable")
        new[order[1:]] = h[order[1:]] != h[order[:-1]]
        fresh_words = np.bincount(line, weights=new, minlength=n)[:n]
        out[:, 11] = 1 - fresh_words / np.maximum(words, 1)
    out[:, 12] = (size == 0)
    return out, size, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[previous, own, next] measures and a bias; none crosses a document."""
    prev, nxt = np.zeros_like(x), np.zeros_like(x)
    prev[1:], nxt[:-1] = x[:-1], x[1:]
    prev[first[:-1]] = 0
    nxt[first[1:] - 1] = 0
    return np.concatenate([prev, x, nxt, np.ones((len(x), 1))], axis=1)


def _packed(first: np.ndarray):
    """Documents from most to fewest lines, and how many have a line t."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1), side="right")
    return order, alive


def _log2(a, b):
    return np.logaddexp(a, b)


def forward_backward(emit: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Marginal P(good) per line, P(pair) sums, and the log partition of each document.

    ``emit`` is the score of "good" against "bad" per line; all documents
    advance together, line by line.
    """
    order, alive = _packed(first)
    e = np.stack([np.zeros_like(emit), emit], axis=1)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    for t, m in enumerate(alive):
        at = first[order[:m]] + t
        if t == 0:
            alpha[at] = e[at]
        else:
            p = alpha[at - 1]
            alpha[at, 0] = _log2(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0])
            alpha[at, 1] = _log2(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + e[at, 1]
    for t in range(len(alive) - 2, -1, -1):
        at = first[order[:alive[t + 1]]] + t
        nb = beta[at + 1] + e[at + 1]
        beta[at, 0] = _log2(nb[:, 0] + trans[0, 0], nb[:, 1] + trans[0, 1])
        beta[at, 1] = _log2(nb[:, 0] + trans[1, 0], nb[:, 1] + trans[1, 1])
    last = first[1:] - 1
    z = _log2(alpha[last, 0], alpha[last, 1])
    diff = (alpha + beta)[:, 1] - (alpha + beta)[:, 0]
    good = 1 / (1 + np.exp(-np.clip(diff, -700, 700)))
    return good, alpha, beta, e, z


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    trans: np.ndarray
    prior: float


def fit_arrays(x: np.ndarray, first: np.ndarray, label: np.ndarray, doc_weight: np.ndarray,
               steps: int = 250, rate: float = 0.08, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the mean conditional log-likelihood; ``label`` is per document."""
    owner = np.repeat(np.arange(len(label)), np.diff(first))
    y = label[owner].astype(float)
    # Every document counts alike, however many lines it has.
    size = np.diff(first)
    lw = (doc_weight / size)[owner]
    lw = lw / doc_weight.sum()
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, trans)]
    inner = np.ones(len(x), dtype=bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    for step in range(1, steps + 1):
        good, alpha, beta, e, z = forward_backward(x @ w, trans, first)
        gw = x.T @ ((y - good) * lw) - ridge * w
        gt = -ridge * trans
        for a in (0, 1):
            for b in (0, 1):
                p = np.exp(np.minimum(0, alpha[at, a] + trans[a, b] + e[at + 1, b] + beta[at + 1, b] - z[owner[at]]))
                gt[a, b] += (((y[at] == a) & (y[at + 1] == b)) * lw[at]).sum() - (p * lw[at]).sum()
        for p, g, (m, v) in zip((w, trans), (gw, gt), state):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w, trans


def fit(docs: DataFrame, labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on about ``per_class`` documents of each label.

    ``labelled`` has doc_id and label (0/1). The driver receives line measures
    of the sample (at most 4 x per_class documents of FIT_LINES lines), no text.
    """
    sample, counts = bounded_sample(labelled, per_class)
    n = {int(k): v for k, v in counts.items()}
    prior = n.get(1, 0) / max(1, sum(n.values())) if n else 0.5
    flat = Model(np.zeros(MEASURES), np.ones(MEASURES), None, np.zeros((2, 2)), prior)
    if n.get(0, 0) == 0 or n.get(1, 0) == 0:
        return flat
    # Bounded by the sample, so this broadcast has a proven size.
    rows = doc_table(docs).join(F.broadcast(sample.dropDuplicates(["doc_id"])), "doc_id")

    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for row, end, data, offsets in text_slices(batch.column("text")):
                x, _, first = line_measures(data, offsets)
                spare = np.maximum(0, np.diff(first) - FIT_LINES)
                a = first[:-1] + (np.diff(offsets) * 7919) % (spare + 1)
                keep = [x[i:min(j, i + FIT_LINES)] for i, j in zip(a, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.astype(np.float32).ravel() for k in keep], pa.list_(pa.float32())),
                     pa.array(labels[row:end], pa.int32())], names=["x", "label"])

    got = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        run, "x array<float>, label int").toArrow().combine_chunks()
    label = got["label"].to_numpy()
    if len(set(label.tolist())) < 2:
        return flat
    lines = pc.list_value_length(got["x"]).to_numpy() // MEASURES
    first = np.concatenate([[0], np.cumsum(lines)])
    x = pc.list_flatten(got["x"]).to_numpy().astype(float).reshape(-1, MEASURES)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    # The sample is balanced; the square root of the true odds keeps scores near
    # their frequencies without losing the rare label.
    share = np.array([n[0], n[1]], dtype=float) / (n[0] + n[1])
    have = np.array([(label == 0).sum(), (label == 1).sum()]) / len(label)
    w, trans = fit_arrays(with_neighbours((x - mean) / scale, first), first, label,
                          np.sqrt(share / have)[label])
    return Model(mean, scale, w, trans, prior)


def line_marginals(model: Model, data: np.ndarray, offsets: np.ndarray):
    """(P(good) of each line, bytes of each line, first line of each row)."""
    x, size, first = line_measures(data, offsets)
    if model.weights is None:
        return np.full(len(size), model.prior), size, first
    x = np.clip((x - model.mean) / model.scale, -8, 8)
    return forward_backward(with_neighbours(x, first) @ model.weights, model.trans, first)[0], size, first


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus score, predicted, n_lines and n_bad_lines."""
    taken = docs.columns
    fields = [T.StructField(fresh("score", taken), T.DoubleType()),
              T.StructField(fresh("predicted", taken), T.IntegerType()),
              T.StructField(fresh("n_lines", taken), T.LongType()),
              T.StructField(fresh("n_bad_lines", taken), T.LongType())]

    def make():
        def batch(col):
            parts = [np.zeros((0, 3))]
            for _, _, data, offsets in text_slices(col):
                good, size, first = line_marginals(model, data, offsets)
                weight = size + 1.0
                at = first[:-1]
                parts.append(np.stack([np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at),
                                       np.diff(first), np.add.reduceat(good < 0.5, at, dtype=np.int64)], axis=1))
            all_ = np.concatenate(parts)
            p = np.clip(all_[:, 0], 0, 1)
            return [pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(all_[:, 1].astype(np.int64)),
                    pa.array(all_[:, 2].astype(np.int64))]

        return batch

    return append_columns(docs, text_col, make, fields)


def label_lines(docs: DataFrame, model: Model) -> DataFrame:
    """One row per line: doc_id, line (from 0), p_good and good."""
    def run(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1)):
                good, _, first = line_marginals(model, data, offsets)
                size = np.diff(first)
                ids = batch.column(0).slice(row, end - row).take(pa.array(np.repeat(np.arange(end - row), size)))
                line = np.arange(len(good)) - np.repeat(first[:-1], size)
                yield pa.RecordBatch.from_arrays([ids, pa.array(line), pa.array(good), pa.array(good >= 0.5)],
                                                 names=["doc_id", "line", "p_good", "good"])

    return doc_table(docs).mapInArrow(run, "doc_id bigint, line bigint, p_good double, good boolean")
