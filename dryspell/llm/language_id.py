"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary n-gram classifier
(log-odds of hashed byte trigrams between the languages whose bit is 1 and the
others) is fitted from counts over *all* training rows, which Spark sums. A
text's bit margin is the mean log-odds over its trigrams; loss-weighted
decoding adds each bit's logistic loss, weighted by how well the bit separates
its two groups, and takes the codeword of least loss. A small gap between the
two best codewords marks the text ambiguous.

Defined cases: a null text or one without a letter is ``und`` with score 0; an
empty table gives no rows; repeated rows are scored one by one; without any
training row every text is ``und``. Rows with a null language train nothing. Of
equal losses the language that sorts first wins.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.common import LOWER, append_columns, fresh, text_slices

#: Hash bits of the trigram table: the model has (languages + bits) x 2^BITS numbers.
BITS = 13
#: Trigrams' mean log-odds are multiplied by this before the logistic loss.
SHARPNESS = 8.0
#: Gap between the best two codewords' probabilities under which a text is ambiguous.
AMBIGUOUS = 0.2

_FOLD = LOWER.copy()
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed trigram around each byte; outside a row, and for non-letters, a space."""
    mid = _FOLD[data]
    left, right = np.empty_like(mid), np.empty_like(mid)
    if len(mid):
        left[1:], right[:-1] = mid[:-1], mid[1:]
        full = offsets[1:] > offsets[:-1]
        left[offsets[:-1][full]] = 32
        right[offsets[1:][full] - 1] = 32
    h = left.astype(np.uint32) * np.uint32(0x01000193)
    h ^= mid.astype(np.uint32) * np.uint32(0x9E3779B1)
    h += right.astype(np.uint32) * np.uint32(0x85EBCA77)
    h *= np.uint32(0xC2B2AE3D)
    return h >> np.uint32(32 - BITS)


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """k codewords of +-1: every split of the classes up to 7, else random ones kept far apart."""
    if k <= 7:
        rows = [(1, *s) for s in itertools.product((1, -1), repeat=max(0, k - 1))]
        words = np.array([r for r in rows if -1 in r] or [(1,) * k], dtype=np.int8)
        return words.T.copy()
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(64):
        words = rng.choice(np.array([1, -1], np.int8), size=(k, 12 * math.ceil(math.log2(k))))
        near = min(int((words[i] != words[j]).sum()) for i, j in itertools.combinations(range(k), 2))
        if near > apart and (np.abs(words.sum(axis=0)) < k).all():
            best, apart = words, near
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray      # languages x bits, +-1
    weights: np.ndarray    # bits x 2^BITS
    reliability: np.ndarray


def count_trigrams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) of all rows with a language, pre-aggregated in each task."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for row, end, data, offsets in text_slices(batch.column(0)):
                names, code = np.unique(langs[row:end].astype(str), return_inverse=True)
                key = np.repeat(code << BITS, np.diff(offsets)) + trigrams(data, offsets)
                counts = np.bincount(key, minlength=len(names) << BITS).reshape(len(names), -1)
                for name, c in zip(names, counts):
                    total[str(name)] = total.get(str(name), 0) + c
        for name, c in total.items():
            at = np.flatnonzero(c)
            if len(at) == 0:
                at = np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))],
                names=["lang", "gram", "n"])

    return (rows.mapInArrow(run, "lang string, gram int, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit from every row of ``training``; the driver gets languages x 2^BITS counts at most."""
    rows = count_trigrams(training, text_col, lang_col).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), 1 << BITS))
    place = {name: i for i, name in enumerate(languages)}
    np.add.at(counts, (rows["lang"].map(place).to_numpy(dtype=np.int64), rows["gram"].to_numpy(dtype=np.int64)),
              rows["n"].to_numpy(dtype=np.float64))
    if not languages:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((0, 1 << BITS)), np.zeros(0))
    words = codewords(len(languages))
    # Each language counts alike within its side of a bit, however many rows it has.
    share = (counts + 0.05) / (counts + 0.05).sum(axis=1, keepdims=True)
    weights, reliability = [], []
    for bit in words.T:
        up = share[bit == 1].mean(axis=0) if (bit == 1).any() else np.full(1 << BITS, 1.0)
        down = share[bit == -1].mean(axis=0) if (bit == -1).any() else up
        w = np.log(up) - np.log(down)
        # Centred so that the two sides' mean margins lie at equal distances from 0.
        a, b = (up * w).sum() / up.sum(), (down * w).sum() / down.sum()
        weights.append(w - (a + b) / 2)
        reliability.append(max(1e-6, (a - b) / 2))
    reliability = np.array(reliability)
    return Model(languages, words, np.array(weights), reliability / reliability.max())


def _decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its probability and the gap to the next, from rows x bits margins."""
    z = SHARPNESS * margin[:, None, :] * model.words[None, :, :]
    loss = (np.logaddexp(0.0, -z) * model.reliability).sum(axis=2)
    p = np.exp(loss.min(axis=1, keepdims=True) - loss)
    p /= p.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    ranked = np.sort(p, axis=1)
    gap = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0.0)
    return best, p[np.arange(len(p)), best], gap


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score and ambiguous (names made unique)."""
    taken = docs.columns
    fields = [T.StructField(fresh("lang_pred", taken), T.StringType()),
              T.StructField(fresh("score", taken), T.DoubleType()),
              T.StructField(fresh("ambiguous", taken), T.BooleanType())]

    def make():
        weights = model.weights.astype(np.float32)
        names = np.array([*model.languages, "und"], dtype=object)

        def batch(col):
            lang, score, odd = [], [], []
            for row, end, data, offsets in text_slices(col):
                n = end - row
                size = np.diff(offsets)
                full = np.flatnonzero(size)
                letters = np.zeros(n, dtype=bool)
                if len(full):
                    at = offsets[:-1][full]
                    ascii_letter = (data | 32) - np.uint8(97) < 26
                    letters[full] = np.add.reduceat(ascii_letter, at, dtype=np.int64) > 0
                    high = np.add.reduceat(data > 127, at, dtype=np.int64) > 0
                    for i in full[high & ~letters[full]]:
                        text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "ignore")
                        letters[i] = any(c.isalpha() for c in text)
                best, p, gap = np.full(n, len(names) - 1), np.zeros(n), np.ones(n)
                if len(full) and model.languages:
                    grams = trigrams(data, offsets)
                    margin = np.stack([np.add.reduceat(w[grams], at, dtype=np.float64) for w in weights], axis=1)
                    best[full], p[full], gap[full] = _decode(model, margin / size[full][:, None])
                best[~letters], p[~letters], gap[~letters] = len(names) - 1, 0.0, 1.0
                lang += list(names[best])
                score += p.tolist()
                odd += (gap < AMBIGUOUS).tolist()
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(odd, pa.bool_())]

        return batch

    return append_columns(docs, text_col, make, fields)
