"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are joined to those of the training texts. A
bitmap of fixed size over the items' gram hashes thins the texts' grams inside
the scan, so only grams that an item may hold reach the join. A gram is rare if
few documents hold it, counted over the whole corpus; one rare seed makes a
candidate (document, item, diagonal band), and so do several common ones on one
band. Whether a text can reach the threshold does not depend on those: pairs of
words, next to each other or one apart, vote for (document, item, two bands), and
all that have the votes an alignment at the threshold must have are candidates
too, however many documents share them (:func:`voted`). Each candidate's
window of the text is aligned with the item, word by word; the local alignment
score over the item's perfect score tells copies, edited ones too, from chance.

Items whose threshold one word reaches (of two words at a half) are sought by each of
their words; all others of two words or more by their pairs, so that no item is too
short for its parts to be found. Candidates carry no item text: the items' words go
to the tasks once, if their size allows, else with the candidates of each text.

Defined cases: null or empty texts and items match nothing; an item of fewer
than n words is one gram besides; repeated rows are scored one by one; of equal scores
the smallest item id is reported (null ids last); an empty table of documents
gives no rows, an empty benchmark finds nothing; items with equal texts all
count; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.common import LOWER, fresh, gram_hash, mix, parts, span_hash, spans, text_slices, tidy
from dryspell.operators._exec import broadcast_checked, materialize

#: Words of a seed gram.
N = 4
#: A gram that more documents hold is common.
RARE = 20
#: Common seeds on one band that make a candidate.
COMMON_SEEDS = 3
#: Bits of the thinning bitmap (fixed: 2 MB).
BITMAP_BITS = 24
#: Alignment scores, and the share of an item's perfect score from which a text is contaminated.
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5

#: Word pairs of items that a task holds at once; more items take more scans.
VOTE_GRAMS = 1 << 20
#: Bytes of item texts that every task holds; beyond, they travel with the candidates.
ITEM_BYTES = 64 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[97:123] = True
_WORD[48:58] = True
_WORD[128:] = True
_U = np.uint64


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each row plus the total)."""
    low = LOWER[data]
    start, end = spans(_WORD[low], offsets)
    return span_hash(low, start, end), np.searchsorted(start, offsets)


def _grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of the n-grams inside the rows; a shorter row is no gram."""
    h = gram_hash(words, n)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = np.flatnonzero(row[:len(h)] == row[n - 1:]) if len(h) else np.zeros(0, np.int64)
    return row[keep], keep - first[row[keep]], h[keep]


def item_grams(items: DataFrame, n: int, threshold: float = THRESHOLD, id_col: str = "item_id",
               text_col: str = "text") -> DataFrame:
    """(item_id, n_words, gram, at, k) per gram of k words: n, fewer for shorter items, 1 where one word suffices."""
    def run(batches):
        for batch in batches:
            for a, z, data, offsets in text_slices(batch.column(1)):
                words, first = words_of(data, offsets)
                row, at, h = _grams(words, first, n)
                count = np.diff(first)
                short = np.flatnonzero((count > 0) & (count < n))
                single = np.flatnonzero(one_word_suffices(count, threshold)[np.repeat(np.arange(len(count)), count)])
                owner = np.repeat(np.arange(len(count)), count)[single]
                k = np.concatenate([np.full(len(row), n), count[short], np.ones(len(single), np.int64)])
                row = np.concatenate([row, short, owner])
                at = np.concatenate([at, np.zeros(len(short), np.int64), single - first[owner]])
                h = np.concatenate([h, np.array([short_gram(words[first[i]:first[i + 1]]) for i in short],
                                                dtype=_U), mix(gram_hash(words[single], 1) ^ _U(1))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + a)), pa.array(count[row]), pa.array(h.view(np.int64)),
                     pa.array(at), pa.array(k)], names=["item_id", "n_words", "gram", "at", "k"])

    return (items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(tidy(run), "item_id bigint, n_words bigint, gram bigint, at bigint, k bigint").distinct())


def one_word_suffices(n_words: np.ndarray, threshold: float) -> np.ndarray:
    """Items of which a single matching word reaches the threshold."""
    return (n_words > 0) & (n_words * threshold <= 1 + 1e-9)


def short_gram(words: np.ndarray) -> np.uint64:
    return mix(gram_hash(words, len(words)) ^ _U(len(words)))[0]


def _bitmap(grams: DataFrame) -> np.ndarray:
    """Bits of the items' grams; at most 2^BITMAP_BITS numbers reach the driver, however many items."""
    got = (grams.select(F.shiftrightunsigned("gram", 64 - BITMAP_BITS).cast("int").alias("b"))
           .distinct().toArrow()["b"].to_numpy())
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    bits[got] = True
    return np.packbits(bits)


def seeds(docs: DataFrame, grams: DataFrame, n: int, rkey: str, text_col: str) -> DataFrame:
    """(rkey, item_id, n_words, diagonal, gram) where a text and an item share a gram."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(grams))
    lengths = sorted(r["k"] for r in grams.where(F.col("k") < n).select("k").distinct().collect())

    def run(batches):
        known = np.unpackbits(bitmap.value).astype(bool)
        for batch in batches:
            for a, z, data, offsets in text_slices(batch.column(1)):
                words, first = words_of(data, offsets)
                for k in [n, *lengths]:
                    row, at, h = _grams(words, first, k)
                    if k < n:
                        h = mix(h ^ _U(k))
                    keep = known[(h >> _U(64 - BITMAP_BITS)).astype(np.int64)]
                    row, at, h = row[keep], at[keep], h[keep]
                    if k == 1 and len(row):      # a text's first place of a word is as good as any
                        first_at = np.sort(np.unique(np.stack([row.astype(_U), h]), axis=1, return_index=True)[1])
                        row, at, h = row[first_at], at[first_at], h[first_at]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row + a)), pa.array(h.view(np.int64)), pa.array(at)],
                        names=["rkey", "gram", "p"])

    hits = docs.select(rkey, text_col).mapInArrow(tidy(run), "rkey bigint, gram bigint, p bigint")
    return (hits.join(broadcast_checked(grams.drop("k")), "gram")
            .select("rkey", "item_id", "n_words", (F.col("p") - F.col("at")).alias("diagonal"), "gram"))


def _pairs(words: np.ndarray, first: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of each word with the d-th after it in its row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    k = np.flatnonzero(row[:-d] == row[d:]) if len(row) > d else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        return row[k], k - first[row[k]], mix(words[k] * _U(0xD6E8FEB86659FD93) + words[k + d])


def needed_votes(n_words: np.ndarray, threshold: float) -> np.ndarray:
    """Least votes of an item of ``n_words`` words in an alignment that reaches the threshold.

    With m matches, c0 neighbouring ones next to each other and c1 with one other
    word between them on either side, the score is at most 2 m - c1 - 2 (m - 1 - c0
    - c1) = 2 + 2 c0 + c1. So pairs next to each other in both have two votes, pairs
    at most one apart have one.
    """
    return np.maximum(1, np.ceil(2 * threshold * n_words - 2 - 1e-9)).astype(np.int64)


def _item_pairs(part: DataFrame) -> tuple[np.ndarray, ...]:
    """Pairs (hash in order, item, place, distance) of the items (item_id, text), and their word counts."""
    got = part.toArrow()
    ids, hashes, owner, place, apart, count = got["item_id"].to_pylist(), [], [], [], [], []
    for i, text in enumerate(got["text"].to_pylist()):
        raw = np.frombuffer(text.encode(), np.uint8)
        words, first = words_of(raw, np.array([0, len(raw)]))
        count.append(len(words))
        for d in (1, 2):
            _, at, h = _pairs(words, first, d)
            hashes.append(h)
            owner.append(np.full(len(h), i))
            place.append(at)
            apart.append(np.full(len(h), d))
    if not hashes:
        return ids, np.array(count, dtype=np.int64), *(np.zeros(0, np.int64),) * 4
    h, owner, place, apart = map(np.concatenate, (hashes, owner, place, apart))
    order = np.argsort(h, kind="stable")
    return ids, np.array(count), h[order], owner[order], place[order], apart[order]


def _votes(words: np.ndarray, first: np.ndarray, items: tuple, bands: int, need: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, item, band) with enough votes on the diagonals of a band and the ``bands`` after it."""
    _, count, grams, owner, place, apart = items
    row, item, at, diagonal, weight = [], [], [], [], []
    for d in (1, 2):
        r, p, h = _pairs(words, first, d)
        lo, hi = np.searchsorted(grams, h, "left"), np.searchsorted(grams, h, "right")
        some = np.flatnonzero(hi > lo)
        n = (hi - lo)[some]
        k = np.repeat(lo[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row.append(np.repeat(r[some], n))
        item.append(owner[k])
        at.append(place[k])
        diagonal.append(np.repeat(p[some], n) - place[k])
        weight.append(np.where((apart[k] == 1) & (d == 1), 2, 1))
    row, item, at, diagonal, weight = map(np.concatenate, (row, item, at, diagonal, weight))
    if len(row) == 0:
        return row, item, row
    most = float(len(first)) * len(count) * (float(np.abs(diagonal).max()) + bands + 4) * (count.max() + 1) * 4
    if most >= 2.0 ** 63:
        raise OverflowError("too many texts, items and words at once to pack into 64 bits")
    # A place of the item votes once in a window, with its best pair.
    own, low = diagonal // count[item], -(bands + 2)
    place_of = (row * len(count) + item) * (int(own.max()) - low + 2)
    keys = np.concatenate([place_of + own - b - low for b in range(bands + 1)])
    again = bands + 1
    at, weight = np.tile(at, again), np.tile(weight, again)
    wide = int(count.max())
    code = np.unique((keys * wide + at) * 4 + weight)
    spot, vote = code >> 2, code & 3
    last = np.append(spot[1:] != spot[:-1], True)
    key, vote = spot[last] // wide, vote[last]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total, key = np.add.reduceat(vote, cut), key[cut]
    span = int(own.max()) - low + 2
    which = key // span % len(count)
    keep = total >= need[which]
    return key[keep] // span // len(count), which[keep], key[keep] % span + low


def voted(docs: DataFrame, items: DataFrame, rkey: str, text_col: str, threshold: float) -> DataFrame:
    """(rkey, item_id, n_words, band) of every item that may reach the threshold with two words or more from the band on.

    An alignment at the threshold has at most 2 - 2 ``threshold`` of the item's
    words as gaps, which bounds how far its diagonals are apart. Items are dealt
    to scans in parts of bounded size.
    """
    items = items.where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    scans = max(1, -(-size // VOTE_GRAMS))        # two pairs a word, two characters a word at least
    bands = max(1, int(np.ceil(2 - 2 * threshold - 1e-9)))
    out = None
    for i in range(scans):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(scans)) == i)
        held = docs.sparkSession.sparkContext.broadcast(_item_pairs(part))

        def run(batches, held=held):
            ids, count = held.value[:2]
            need = needed_votes(count, threshold)
            for batch in batches if len(held.value[2]) else ():
                for a, z, data, offsets in text_slices(batch.column(1), 1 << 18):
                    words, first = words_of(data, offsets)
                    row, item, band = _votes(words, first, held.value, bands, need)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row + a)), pa.array([ids[v] for v in item], pa.int64()),
                         pa.array(count[item]), pa.array(band)], names=["rkey", "item_id", "n_words", "band"])

        found = docs.select(F.col(rkey).alias("rkey"), text_col).mapInArrow(
            tidy(run), "rkey bigint, item_id bigint, n_words bigint, band bigint")
        out = found if out is None else out.unionByName(found)
    return out


def candidates(found: DataFrame, n: int = N) -> DataFrame:
    """(rkey, item_id, n_words, band): a band of diagonals is as wide as the item."""
    df = found.groupBy("gram", "rkey").agg(F.lit(1).alias("x")).groupBy("gram").agg(F.count("*").alias("df"))
    bands = found.withColumn("band", F.floor(F.col("diagonal") / F.col("n_words")))
    # Counts per band and gram first: a gram is joined to its frequency once per band.
    votes = bands.groupBy("rkey", "item_id", "n_words", "band", "gram").agg(F.lit(1).alias("x"))
    return (votes.join(df, "gram").groupBy("rkey", "item_id", "n_words", "band")
            .agg(F.count(F.when(F.col("df") <= RARE, 1)).alias("rare"), F.count("*").alias("seeds"))
            .where((F.col("rare") > 0) | (F.col("seeds") >= F.least(F.lit(COMMON_SEEDS), F.greatest(F.lit(1), F.col("n_words") - (n - 1)))))
            .select("rkey", "item_id", "n_words", "band"))


def _align(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """(best local score of x in y, end in y, exclusive; the first of equal ends)."""
    if len(x) == 0 or len(y) == 0:
        return 0, 0
    step = np.arange(len(y) + 1) * -GAP
    row, best, end = np.zeros(len(y) + 1, dtype=np.int64), 0, 0
    for w in x:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(y == w, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + step) - step
        top = int(row.max())
        if top > best or (top == best and best and int(row.argmax()) < end):
            best, end = top, int(row.argmax())
    return best, end


def smith_waterman(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment of item x within words y."""
    score, end = _align(x, y)
    if score == 0:
        return 0, 0, 0
    _, back = _align(x[::-1], y[:end][::-1])
    return score, end - back, end


def scan(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = N,
         text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus contaminated, overlap_score, item_id, start_word, end_word, items.

    ``items`` lists the ids of all items that reach the threshold.
    """
    taken = docs.columns
    rkey, found = fresh("rkey", taken), fresh("candidates", taken)
    id_col = "doc_id" if "doc_id" in taken else None
    keyed = docs.withColumn(rkey, F.xxhash64(*([F.col(id_col)] if id_col else []), F.col(text_col)))
    grams = item_grams(items, n, threshold, item_id, item_text)
    hits = materialize(seeds(keyed, grams, n, rkey, text_col), "decontaminate-seeds")
    named = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    bodies = (named.where("text IS NOT NULL").distinct()
              .select(F.col("item_id").alias("i_id"), F.xxhash64("item_id", "text").alias("ikey"), F.col("text").alias("body")))
    both = candidates(hits, n).unionByName(voted(keyed, named, rkey, text_col, threshold)).distinct()
    # Item texts of a proven size go to the tasks by key; larger ones travel with the candidates.
    size = bodies.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    carried = size > ITEM_BYTES
    table = {} if carried else {r["ikey"]: r["body"] for r in bodies.select("ikey", "body").collect()}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    body = F.col("body") if carried else F.lit(None).cast("string").alias("body")
    cands = (both.join(bodies if carried else bodies.drop("body"), F.expr("item_id <=> i_id"))
             .groupBy(F.col("rkey").alias(rkey))
             .agg(F.collect_set(F.struct("item_id", "band", "ikey", body)).alias(found)))
    joined = keyed.join(broadcast_checked(cands), rkey, "left")

    names = [fresh(c, taken) for c in ("contaminated", "overlap_score", "item_id", "start_word", "end_word", "items")]
    types = [T.BooleanType(), T.DoubleType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.LongType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, t) for c, t in zip(names, types)]])
    at = taken.index(text_col)

    def run(batches):
        held: dict[int, np.ndarray] = {}

        def item_words(candidate: dict) -> np.ndarray:
            key = candidate["ikey"]
            if key not in held:
                if len(held) > 10_000:
                    held.clear()
                raw = np.frombuffer((candidate["body"] if carried else shared.value[key]).encode(), np.uint8)
                held[key] = words_of(raw, np.array([0, len(raw)]))[0]
            return held[key]

        for batch in (p for b in batches for p in parts(b, at)):
            out = [(False, 0.0, None, None, None, [])] * batch.num_rows
            column, lists = batch.column(at), batch.column(len(taken))
            for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
                raw = np.frombuffer((column[i].as_py() or "").encode(), np.uint8)
                text, _ = words_of(raw, np.array([0, len(raw)]))
                best, reached = (0.0, None, None, None), set()
                todo = sorted(lists[i].as_py(), key=lambda c: (c["item_id"] is None, c["item_id"] or 0, c["band"], c["ikey"]))
                for c in todo:
                    x = item_words(c)
                    # The band's diagonals, an item's length before and two after.
                    lo = max(0, (c["band"] - 1) * len(x))
                    hi = min(len(text), (c["band"] + 3) * len(x))
                    score, start, end = smith_waterman(x, text[lo:hi])
                    share = score / (MATCH * len(x)) if len(x) else 0.0
                    if share > best[0]:
                        best = (share, c["item_id"], lo + start, lo + end)
                    if share >= threshold:
                        reached.add(c["item_id"])
                out[i] = (best[0] >= threshold, *best, sorted(v for v in reached if v is not None))
            columns = list(zip(*out)) if out else [[]] * 6
            arrow = [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(taken)],
                                              *[pa.array(v, t) for v, t in zip(columns, arrow)]],
                                             names=schema.fieldNames())

    return joined.select(*[F.col(c) for c in taken], F.col(found)).mapInArrow(tidy(run), schema)
