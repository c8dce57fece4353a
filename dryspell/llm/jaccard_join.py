"""Exact n-gram Jaccard self-join by token-combination prefixes.

A text's set is its distinct word n-grams, as 64-bit hashes; texts with the same
set are one node. Grams are ordered by (class, hash), the class *frequent* being
a bit of a fixed-size bitmap that counts over all texts set; rare grams come
first. Two sets that reach the threshold differ from either in at most
``n - least`` grams, so a prefix worth one unit more must share something:

* a rare or common gram is worth one unit and is indexed by itself;
* frequent grams are dealt into small subclasses; m of them in one subclass are
  worth m - 1 units and are indexed by their pairs, and the prefix is extended
  until the units suffice.

Subclasses depend on a band of set sizes; linked sets lie in the same or in
neighbouring bands, so a set indexes its pairs under its own band and the next.
Candidates pass a size test and a parity-sketch test (both can only reject
non-links) and are verified on the whole sets. Links become components without
expanding groups of copies (:mod:`dryspell.llm.components`).

Defined cases: null or empty text has no words, an empty set (size 0) and is
its own component; a text shorter than n words is one gram; repeated rows and
exact copies share a component; a null id keeps its row, but only ids name
components (null if a component has none); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dryspell.llm.common import LOWER, doc_table, fresh, gram_hash, mix, span_hash, spans, text_slices, tidy
from dryspell.llm.components import drop_shuffles, link_buckets
from dryspell.operators._exec import broadcast_checked, materialize, release

#: Words of a gram, and the threshold as percent of the union.
N = 4
PERCENT = 85
#: Distinct sets that hold a gram, from which it is common, and frequent.
COMMON, FREQUENT = 6, 64
#: Bits of the class bitmaps (fixed: 8 MB each at most).
MAP_BITS = 26
#: Grams that a task sorts at once to count them.
WINDOW = 1 << 21
#: Least bits of a counter's block, and most bits of a counter within it.
BLOCK_BITS, SPAN_BITS = 8, 22
#: Frequent prefix grams of one subclass, about.
SUBCLASS = 4
#: Least bits of a parity sketch.
SKETCH = 512

_WORD = np.ones(256, dtype=bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_U = np.uint64


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram hash) of each row's distinct grams, sorted."""
    low = LOWER[data]
    start, end = spans(_WORD[low], offsets)
    words = span_hash(low, start, end)
    first = np.searchsorted(start, offsets)
    count = np.diff(first)
    grams = gram_hash(words, n)
    row = np.repeat(np.arange(len(count)), count)
    inside = np.zeros(len(words), dtype=bool)
    inside[:len(grams)] = row[:len(grams)] == row[n - 1:] if len(grams) else False
    keep = np.flatnonzero(inside)
    rows, hashes = [row[keep]], [grams[keep]]
    for i in np.flatnonzero((count > 0) & (count < n)):
        w = words[first[i]:first[i + 1]]
        rows.append(np.array([i]))
        hashes.append(mix(gram_hash(w, len(w)) ^ _U(0xA5A5A5A5A5A5A5A5)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def set_ids(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, 64-bit id) of each row's set; the empty set's id is 0."""
    size = np.bincount(row, minlength=rows)
    with np.errstate(over="ignore"):
        total = np.zeros(rows, dtype=_U)
        full = np.flatnonzero(size)
        if len(full):
            at = np.searchsorted(row, full)
            total[full] = mix(np.add.reduceat(mix(h ^ _U(0x3C6EF372FE94F82B)), at) * _U(0xD6E8FEB86659FD93)
                              + np.bitwise_xor.reduceat(h, at) + size[full].astype(_U))
    return size, total.view(np.int64)


def least_overlap(n, percent: int):
    """Fewest common grams of a set of n and any set it links with."""
    return (percent * n + 99) // 100


def band(n: int, percent: int) -> int:
    """Index of the size band of n; linked sizes lie in the same or neighbouring bands."""
    return int(np.floor(np.log(n) / np.log(100 / percent) + 1e-9))


def subclasses(k: int, percent: int) -> int:
    """Frequent subclasses under band k."""
    size = (100 / percent) ** k
    return max(1, int(size * (100 - percent) / 100 / SUBCLASS))


def signatures(h: np.ndarray, rare: int, percent: int) -> np.ndarray:
    """Index entries of one set; ``h`` is in global order, its first ``rare`` grams are not frequent."""
    n = len(h)
    need = n - least_overlap(n, percent) + 1
    if rare >= need:
        return h[:need]
    out = [h[:rare]]
    often = h[rare:]
    own = band(n, percent)
    for k in (own, own + 1):
        g = subclasses(k, percent)
        sub = (mix(often ^ _U(0x5851F42D4C957F2D)) % _U(g)).astype(np.int64)
        firsts = np.zeros(len(often), dtype=bool)
        firsts[np.unique(sub, return_index=True)[1]] = True
        worth = rare + np.cumsum(~firsts)
        # Always found: at most one gram of a subclass is worth nothing, and there are
        # fewer subclasses than grams that must be common.
        stop = int(np.searchsorted(worth, need)) + 1
        part, s = often[:stop], sub[:stop]
        order = np.argsort(s, kind="stable")
        cut = np.flatnonzero(np.diff(s[order])) + 1
        for members in np.split(order, cut):
            i, j = np.triu_indices(len(members), 1)
            m = part[np.sort(members)]
            with np.errstate(over="ignore"):
                out.append(mix(m[i] * _U(0x9E3779B97F4A7C15) + m[j] + _U(k) * _U(0xD6E8FEB86659FD93)))
    return np.unique(np.concatenate(out))


def sketch(h: np.ndarray) -> bytes:
    """Parities of the grams by their low bits, at least as many as there are grams."""
    bits = max(SKETCH, 1 << int(len(h) - 1).bit_length())
    odd = np.bincount((h & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A sketch brought down to ``size`` bytes."""
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def count_bits(docs: DataFrame) -> int:
    """Bits of a gram's counter: about four counters a gram, however many there are."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(np.clip(np.ceil(np.log2(max(1, size))), 18, 44))


#: Steps of this size or more take several tokens; the token itself counts nothing.
FAR = 0xFFFF


def stepped(place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of each block and the total): steps between rising places, anew from each of ``at``."""
    step = np.diff(place, prepend=0)
    step[at] = place[at]
    end = np.cumsum(step // FAR + 1)
    tokens = np.full(int(end[-1]) if len(end) else 0, FAR, dtype="<u2")
    tokens[end - 1] = step % FAR
    return tokens, np.append((end - step // FAR - 1)[at], len(tokens))


def places(tokens: np.ndarray) -> np.ndarray:
    """The places of a block's tokens."""
    return np.cumsum(tokens, dtype=np.int64)[tokens != FAR]


def gram_classes(docs: DataFrame, n: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(map bits, common, frequent): packed bitmaps over the leading bits of a gram's hash.

    A gram counts once for each distinct set (of a task). Counters are dealt to
    reducers in blocks: 2^BLOCK_BITS of them, and more once a block had over
    2^SPAN_BITS counters, so a reducer's memory is fixed. A window sends each block
    the steps between its counters, two bytes a gram. The driver gets two bitmaps of
    fixed size.
    """
    docs = doc_table(docs).select("text")
    bits = count_bits(docs)
    map_bits = min(MAP_BITS, bits)
    span = min(bits - BLOCK_BITS, SPAN_BITS)

    def send(batches):
        held, size, seen = [], 0, set()

        def close():
            # One entry a counter and window, however hot the gram; repeats go along as counts.
            h, count = np.unique(np.concatenate(held) >> _U(64 - bits), return_counts=True)
            block = (h >> _U(span)).astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(h) else np.zeros(0, int)
            place = (h & _U((1 << span) - 1)).astype(np.int64)
            tokens, first = stepped(place, at)
            again = np.flatnonzero(count > 1)
            more = np.zeros(len(again), dtype=[("at", "<u4"), ("n", "<u4")])
            more["at"], more["n"] = place[again], count[again] - 1
            return pa.RecordBatch.from_arrays(
                [pa.array(block[at]), cut(tokens, first),
                 cut(more, np.searchsorted(again, np.append(at, len(h))))], names=["block", "counters", "more"])

        def cut(values, at):
            offsets = (np.asarray(at, dtype=np.int64) * values.itemsize).tobytes()
            return pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                         [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())]).cast(pa.binary())

        for batch in batches:
            for a, z, data, offsets in text_slices(batch.column(0)):
                row, h = gram_sets(data, offsets, n)
                _, ids = set_ids(row, h, z - a)
                fresh = np.zeros(z - a, dtype=bool)
                for i, v in enumerate(ids.tolist()):
                    if v not in seen:
                        seen.add(v)
                        fresh[i] = True
                held.append(h[fresh[row]])
                size += len(held[-1])
                if size >= WINDOW:
                    yield close()
                    held, size = [], 0
                    if len(seen) > 1_000_000:
                        seen.clear()
        if size:
            yield close()

    def count(key, rows):
        total = np.zeros(1 << span, dtype=np.int64)
        for c, m in zip(rows["counters"], rows["more"]):
            total[places(np.frombuffer(c.as_buffer(), "<u2"))] += 1
            m = np.frombuffer(m.as_buffer(), [("at", "<u4"), ("n", "<u4")])
            total[m["at"]] += m["n"]
        at = np.flatnonzero(total >= COMMON)
        place = ((key[0].as_py() << span) + at) >> (bits - map_bits)
        return pa.table([pa.array(place >> 16), pa.array((place & 0xFFFF).astype(np.int32)),
                         pa.array(total[at] >= FREQUENT)], names=["part", "bit", "frequent"])

    def draw(key, rows):
        maps = np.zeros((2, 1 << 16), dtype=bool)
        bit = rows["bit"].to_numpy()
        maps[0, bit] = True
        maps[1, bit[rows["frequent"].to_numpy()]] = True
        return pa.table([pa.array([key[0].as_py()], pa.int64())]
                        + [pa.array([np.packbits(m, bitorder="little").tobytes()], pa.binary()) for m in maps],
                        names=["part", "common", "frequent"])

    counted = (docs.mapInArrow(tidy(send), "block bigint, counters binary, more binary")
               .groupBy("block").applyInArrow(count, "part bigint, bit int, frequent boolean"))
    # As a table: the counters' shuffle goes with the plan that wrote it.
    drawn = materialize(counted.groupBy("part").applyInArrow(draw, "part bigint, common binary, frequent binary"), "gram-classes")
    out = [np.zeros((1 << map_bits) // 8, dtype=np.uint8) for _ in range(2)]
    for r in drawn.collect():
        for m, name in zip(out, ("common", "frequent")):
            m[r["part"] * 8192:(r["part"] + 1) * 8192] = np.frombuffer(r[name], np.uint8)
    release(drawn)
    return map_bits, out[0], out[1]


def bits_of(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def index_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, rkey, sid, n, sketch, fold, sigs) per row; a set's sketches and entries come once per task."""
    classes = docs.sparkSession.sparkContext.broadcast(gram_classes(docs, n))
    drop_shuffles(docs.sparkSession)

    def run(batches):
        map_bits, common, frequent = classes.value
        seen = set()
        for batch in batches:
            for a, z, data, offsets in text_slices(batch.column(2)):
                row, h = gram_sets(data, offsets, n)
                size, ids = set_ids(row, h, z - a)
                place = (h >> _U(64 - map_bits)).astype(np.int64)
                kind = bits_of(common, place).astype(np.int8) + bits_of(frequent, place)
                order = np.lexsort((h, kind, row))
                h, kind = h[order], kind[order]
                first = np.concatenate([[0], np.cumsum(size)])
                rare = np.concatenate([[0], np.cumsum(kind < 2)])
                rare = rare[first[1:]] - rare[first[:-1]]
                sketches, folds, entries = [], [], []
                for i, v in enumerate(ids.tolist()):
                    s = h[first[i]:first[i + 1]]
                    # A set all of whose grams must be shared, by one of the same size, is linked by its id.
                    if v in seen or size[i] == 0 or size[i] * 100 // percent == size[i]:
                        sketches.append(None)
                        folds.append(None)
                        entries.append(None)
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(v)
                    sketches.append(sketch(s))
                    folds.append(folded(np.frombuffer(sketches[-1], np.uint8), SKETCH // 8).view(np.int64))
                    entries.append(signatures(s, int(rare[i]), percent).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a), pa.array(ids), pa.array(size.astype(np.int64)),
                     pa.array(sketches, pa.binary()), pa.array(folds, pa.list_(pa.int64())),
                     pa.array(entries, pa.list_(pa.int64()))],
                    names=["doc_id", "rkey", "sid", "n", "sketch", "fold", "sigs"])

    return materialize(keyed_texts(docs).mapInArrow(
        tidy(run), "doc_id bigint, rkey bigint, sid bigint, n bigint, sketch binary, fold array<bigint>, sigs array<bigint>"), "jaccard-index")


def _sets_of(docs: DataFrame, index: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sid, grams) of the wanted sids, each from the whole text of one row that has it; other texts are not cut."""
    chosen = broadcast_checked(index.select("sid", "rkey").join(wanted, "sid").groupBy("sid")
                               .agg(F.min("rkey").alias("rkey")).select("rkey").distinct())

    def run(batches):
        for batch in batches:
            for a, z, data, offsets in text_slices(batch.column(0)):
                row, h = gram_sets(data, offsets, n)
                size, ids = set_ids(row, h, z - a)
                first = np.concatenate([[0], np.cumsum(size)])
                keep = np.flatnonzero(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[keep]), pa.array([h[first[i]:first[i + 1]].view(np.int64) for i in keep],
                                                   pa.list_(pa.int64()))], names=["sid", "grams"])

    rows = keyed_texts(docs).join(chosen, "rkey", "left_semi").select("text")
    return rows.mapInArrow(tidy(run), "sid bigint, grams array<bigint>").dropDuplicates(["sid"])


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, rkey, text): rows that agree in id and text have one rkey."""
    return doc_table(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("rkey"), "text")


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow a link."""
    s = sketches.select("sid", "n", "sketch")
    joined = (pairs.join(s.toDF("a", "na", "ka"), "a")
              .join(s.toDF("b", "nb", "kb"), "b")
              .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            # 100 (s - d) >= percent (s + d) for the size s of both sets together and difference d.
            most = (na + nb) * (100 - percent) // (100 + percent)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("ka"), batch.column("kb"))):
                x = np.frombuffer(x.as_buffer(), np.uint8)
                y = np.frombuffer(y.as_buffer(), np.uint8)
                size = min(len(x), len(y))
                keep[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum() <= most[i]
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(at)),
                                              batch.column("b").take(pa.array(at))], names=["a", "b"])

    return joined.mapInArrow(tidy(run), "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets reach the threshold."""
    joined = (pairs.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b"))

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = batch.column("ga")[i].values.to_numpy()
                y = batch.column("gb")[i].values.to_numpy()
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)],
                                             names=["a", "b"])

    return joined.select("a", "b", "ga", "gb").mapInArrow(tidy(run), "a bigint, b bigint")


def _rooted(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, rkey, n, root) per row; rows are linked, over any links, iff their roots are equal."""
    docs = doc_table(docs)
    index = index_sets(docs, n, percent)
    sketches = materialize(index.where("sketch IS NOT NULL").select("sid", "n", "sketch", "fold")
                           .dropDuplicates(["sid"]), "jaccard-sketches")
    rows = index.where("sigs IS NOT NULL").select(F.explode("sigs").alias("sig"), F.col("sid").alias("id"))

    def verify(pairs: DataFrame) -> DataFrame:
        near = materialize(_near(pairs, sketches, percent), "jaccard-near")
        if near.isEmpty():
            return near
        wanted = materialize(near.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "jaccard-wanted")
        sets = materialize(_sets_of(docs, index, wanted, n), "jaccard-sets")
        links = materialize(_verified(near, sets, percent), "jaccard-links")
        release(near, wanted, sets)
        drop_shuffles(docs.sparkSession)
        return links

    folds = [f"k{i}" for i in range(SKETCH // 64)]
    features = sketches.select(F.col("sid").alias("id"), "n", *[F.col("fold")[i].alias(c) for i, c in enumerate(folds)])

    def allowed(x: str, y: str) -> str:
        """The size test, and no more differing parities than a link has differing grams."""
        differ = " + ".join(f"bit_count({x}.{c} ^ {y}.{c})" for c in folds)
        return (f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
                f" AND {differ} <= ({x}.n + {y}.n) * {100 - percent} div {100 + percent}")

    root = link_buckets(rows, verify, features, allowed)
    release(sketches)
    return (index.select("doc_id", "rkey", "sid", "n")
            .join(root.select(F.col("id").alias("sid"), "root"), "sid", "left")
            .select("doc_id", "rkey", "n", F.coalesce("root", "sid").alias("root")))


def join(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    named = _rooted(docs, n, percent)
    least = named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (named.join(least, "root", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def copies(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, bool]:
    """(rkey) of the rows that :func:`keep_one` drops, and whether rows repeat in id and text."""
    named = materialize(_rooted(docs, n, percent), "jaccard-rooted")
    place = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "rkey")
    full = named.where("n > 0")
    kept = full.groupBy("root").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
    gone = (full.join(kept.where("kept <> last").select("root", F.col("kept.rkey").alias("k")), "root")
            .where("rkey <> k").select("rkey").distinct())
    return gone, not named.groupBy("rkey").agg(F.count("*").alias("c")).where("c > 1").isEmpty()


def row_key() -> Column:
    """The rkey of a row."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def keep_one(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null ids last).

    Rows with an empty set all stay, but rows that agree in id and text are one.
    """
    gone, repeated = copies(docs, n, percent)
    key = fresh("rkey", docs.columns)
    keyed = docs.withColumn(key, row_key())
    left = keyed.join(broadcast_checked(gone.withColumnRenamed("rkey", key)), key, "left_anti")
    if repeated:
        left = left.dropDuplicates([key])
    return left.select(*docs.columns)
