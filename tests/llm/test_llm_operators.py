"""The ten operators against brute force, the tokenizer library, DuckDB and held-out labels."""

import hashlib
import itertools
import json
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dryspell.llm import (bpe, common, components, decontaminate, jaccard_join, language_id, license_scan, line_crf,
                          line_dedup, queries, topk, toxicity_knn, warc)
from dryspell.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORDS = ["river", "stone", "garden", "winter", "letter", "market", "silver", "bridge", "window", "forest",
         "copper", "harvest", "lantern", "meadow", "orchard", "pepper", "quiver", "ribbon", "saddle", "thistle"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def edge_rows(rng):
    """Nulls, empty and one-word texts, a long text, copies and a repeated row."""
    base = prose(rng, 60)
    long = prose(rng, 30000)
    return [(None, "text without an id " + prose(rng, 20), "en", None, None), (1, None, None, None, None),
            (2, "", "en", "s", 0), (3, "word", "en", "s", 4), (4, base, "en", "s", 1), (5, base, "en", "s", 1),
            (5, base, "en", "s", 1), (6, base.replace("river", "brook", 1), "en", "s", 1),
            (7, long, "en", "s", 1), (8, " \n\t ", None, "s", 5), (9, "é中\U0001f642 " + base[:40], "fr", "s", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(random.Random(5)), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """Extra columns named as the operators' own results and keys."""
    for c in ("score", "predicted", "rkey", "gone", "kept_share", "removed_lines", "n_tokens", "lang_pred",
              "contaminated", "candidates", "items", "item_id", "sid", "sig", "root"):
        df = df.withColumn(c, F.lit("x"))
    return df


def against_duckdb(spark, name, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name]).fetchdf()
    got = queries.QUERIES[name](spark, sf).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda df: sorted(tuple(None if pd.isna(v) else v for v in r)
                             for r in df[cols].astype(object).itertuples(index=False, name=None))
    key = lambda r: tuple(map(str, r))
    assert sorted(rows(got), key=key) == sorted(rows(want), key=key)


# 1, 9, 10: classifiers

@pytest.mark.parametrize("name,label,modulus,held", [("op1_quality", "quality", 3, 1), ("op9_toxicity", "toxic", 5, 0)])
def test_classifier_separates_held_out_labels(spark, name, label, modulus, held):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    assert len(got) == len(docs)
    bucket = pd.Series({i: zlib.crc32(str(i).encode()) % modulus for i in docs.doc_id})
    assert (got.held_out == (bucket.reindex(got.index) == held)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")[label]
    both = got[got.held_out].join(labels, how="inner")
    assert (both.predicted == both[label]).mean() >= 0.95


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 1, 5, 8])
    emit, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    good = line_crf.forward_backward(emit, trans, first)[0]
    for a, z in zip(first[:-1], first[1:]):
        total, ones = 0.0, np.zeros(z - a)
        for y in itertools.product((0, 1), repeat=z - a):
            s = np.exp(sum(emit[a + i] * v for i, v in enumerate(y))
                       + sum(trans[u, v] for u, v in zip(y, y[1:])))
            total += s
            ones += s * np.array(y)
        assert np.allclose(good[a:z], ones / total)


def test_crf_gradient_raises_likelihood_and_line_labels(spark, edge):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(40, 3)), np.ones((40, 1))], axis=1)
    first = np.arange(0, 41, 4)
    label = (x[first[:-1], 0] > 0).astype(int)
    w, trans = line_crf.fit_arrays(x, first, label, np.ones(10), steps=150)
    good = line_crf.forward_backward(x @ w, trans, first)[0]
    assert (((good.reshape(10, 4).mean(axis=1)) >= 0.5) == label).mean() >= 0.9
    model = line_crf.Model(np.zeros(line_crf.MEASURES), np.ones(line_crf.MEASURES), None, np.zeros((2, 2)), 0.7)
    lines = line_crf.label_lines(edge, model).toPandas()
    assert len(lines) == sum((r[1] or "").count("\n") + 1 for r in edge_rows(random.Random(5)))


def test_classifiers_on_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, 1), (9, 0), (None, 1)], "doc_id bigint, label int")
    none = labels.limit(0)
    for module in (line_crf, toxicity_knn):
        for lab in (labels, none, labels.where("label = 1")):
            model = module.fit(edge, lab)
            got = module.score(clashing(edge), model)
            assert set(clashing(edge).columns) <= set(got.columns)
            scores = [r[-3 if module is line_crf else -3] for r in got.collect()]
            assert got.count() == edge.count() and len(scores) == edge.count()
            assert module.score(empty, model).count() == 0
            flat = module.score(edge, model).toPandas()
            assert flat.score.between(0, 1).all() and flat.score.notna().all()
    model = language_id.fit(edge)
    got = language_id.predict(edge, model).toPandas()
    assert got[got.doc_id.isin([1, 2, 8])].lang_pred.eq("und").all()
    assert got[got.doc_id.isin([1, 2, 8])].score.eq(0).all()
    assert language_id.predict(clashing(edge), model).count() == edge.count()
    assert language_id.predict(empty, model).count() == 0
    assert set(language_id.predict(edge, language_id.fit(empty)).toPandas().lang_pred) == {"und"}


def test_toxicity_vocabulary_has_no_cap(spark):
    """Every significant term enters, and the neighbours of the model are those of dense vectors over all of them."""
    rng = random.Random(6)
    bad, good = ([f"{p}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)] for p in ("zz", "qq"))
    rows = [(i, " ".join(rng.sample(bad if i % 2 else good, 80) + rng.sample(WORDS, 5))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)], "doc_id bigint, label int")
    model = toxicity_knn.fit(docs, labels)
    assert len(model.vocabulary) > 1100
    dense = np.zeros((len(model.index.ids), len(model.vocabulary)))
    for i, (c, w) in enumerate(model.index.vectors):
        dense[i, c] = w
    got = {r["doc_id"]: r for r in toxicity_knn.score(docs, model).collect()}
    for i, text in rows[240:]:
        raw = np.frombuffer(text.encode(), np.uint8)
        (c, w), = toxicity_knn.unit_vectors(model.vocabulary, model.idf, 1, *toxicity_knn.terms(raw, np.array([0, len(raw)])))
        s = np.round(dense[:, c] @ w, 12)
        want = sorted((-v, j) for v, j in zip(s, model.index.ids) if v > 0)[:toxicity_knn.NEIGHBOURS]
        assert got[i]["evidence"] == [j for _, j in want] and got[i]["predicted"] == i % 2


def test_language_prediction_equals_plain_decoding(spark, edge):
    """Loss-weighted decoding by loops over texts, bits and languages."""
    rng = random.Random(30)
    alphabets = {"aa": "abcdei", "bb": "mnopqr", "cc": "stuvwx", "dd": "acemqs"}
    text_of = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(n))
    rows = [(i, text_of(a, 30), lang) for i, (lang, a) in enumerate(list(alphabets.items()) * 6)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    asked = [(i, text_of(alphabets[rng.choice(sorted(alphabets))], rng.randint(1, 12))) for i in range(60)]
    asked += [(100, text_of("abcmno", 20)), (101, "?!"), (102, None), (103, "é"), (104, "123 4")]
    got = {r["doc_id"]: r for r in language_id.predict(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()}
    assert model.languages == sorted(alphabets)
    for i, text in asked:
        if not any(c.isalpha() for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        grams = language_id.trigrams(raw, np.array([0, len(raw)])).tolist()
        margin = [sum(float(w[g]) for g in grams) / len(raw) for w in model.weights.astype(np.float32)]
        loss = [sum(r * math.log(1 + math.exp(-language_id.SHARPNESS * m * bit))
                    for r, m, bit in zip(model.reliability, margin, word)) for word in model.words]
        p = [math.exp(min(loss) - v) for v in loss]
        p = sorted((v / sum(p) for v in p), reverse=True)
        assert got[i]["lang_pred"] == model.languages[loss.index(min(loss))]
        assert got[i]["score"] == pytest.approx(p[0], abs=1e-6)
        assert got[i]["ambiguous"] == (p[0] - p[1] < language_id.AMBIGUOUS) or abs(p[0] - p[1] - language_id.AMBIGUOUS) < 1e-6


def test_language_codes(spark):
    for k in (2, 3, 4, 7, 12):
        words = language_id.codewords(k)
        assert len(words) == k
        assert min((words[i] != words[j]).sum() for i, j in itertools.combinations(range(k), 2)) >= max(1, 2 ** (min(k, 7) - 2) if k <= 7 else 8)
    got = queries.QUERIES["op10_language"](spark, SF).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang.reindex(held.index)).mean() >= 0.98


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)

    def sparse(n, share):
        v = rng.random((n, 40)) * (rng.random((n, 40)) < share)
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    pairs = lambda m: [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in m]
    vectors, q = sparse(150, 0.15), sparse(60, 0.1)
    vectors[10:30] = vectors[10]
    q[0] = 0
    ids = rng.permutation(1000)[:150]
    index = toxicity_knn.Index.build(ids, rng.integers(0, 2, 150), np.ones(150), pairs(vectors), 40)
    exact = np.round(q @ vectors.T, 12)
    for k in (1, 7, 140):
        pos, sim = index.nearest(pairs(q), k)
        for i in range(60):
            want = sorted((-s, ids[j]) for j, s in enumerate(exact[i]) if s > 0)[:k]
            assert [w[1] for w in want] == [index.ids[j] for j in pos[i] if j >= 0]
            assert np.allclose([-w[0] for w in want], sim[i][pos[i] >= 0])
    own = np.arange(150)
    pos, _ = index.nearest(index.vectors, 5, own)
    assert not (pos == own[:, None]).any()


# 2: BPE

@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def test_bpe_equals_library(encoder):
    library = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(2)
    letters = ("abcdefghijklmnopqrstuvwxyz'sSTe  \n\t.,!0123éßİΣσ²½Ⅷ中文"
               "\U0001f642́‍\x1c\x1f\x85\xa0 ᠎    　ǅﬁÅ")
    texts = ["", " ", "a" * 3000, "ab" * 700, "<|endoftext|>a<|startoftext|>", "<|ENDOFTEXT|> x", "it's we'll I'D"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["".join(rng.choice("aeinst") for _ in range(rng.randint(200, 900))) for _ in range(10)]
    texts += pd.read_parquet(f"{SF}/documents.parquet").text.dropna().tolist()[:60]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = encoder.encode(t).tolist()
        assert got == want, t[:80]
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_bpe_stream_is_bounded_and_stable(encoder):
    rng = random.Random(9)
    for alphabet in ("ab", "aeinst", "thequickbrown"):
        word = "".join(rng.choice(alphabet) for _ in range(4000))
        parts = list(encoder.stream(word))
        assert len(parts) > 10                 # tokens leave before the word ends
        assert [t for p in parts for t in p] == [int(i) for i in encoder.encode(word)]
        read = 0
        for i, p in enumerate(parts[:-1]):     # what is out lags at most the computed lookahead
            read += sum(len(encoder.text[t].removesuffix("</w>")) for t in p)
            assert (i + 1) * bpe.EMIT_EVERY - read <= encoder.lookahead + encoder.longest + bpe.EMIT_EVERY


def vocabulary_of(rng, alphabet, merges):
    """JSON of a small random vocabulary whose words end in </w>."""
    tokens = [*alphabet, *(c + "</w>" for c in alphabet)]
    rules = []
    while len(rules) < merges:
        a, b = rng.choice([t for t in tokens if not t.endswith("</w>")]), rng.choice(tokens)
        if (a, b) not in rules and a + b not in tokens:
            rules.append((a, b))
            tokens.append(a + b)
    return json.dumps({"model": {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": [" ".join(r) for r in rules]},
                       "added_tokens": []}), rules, tokens


def merged(word, rules, tokens):
    parts = [*word[:-1], word[-1] + "</w>"]
    while True:
        ranks = [(rules.index((a, b)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in rules]
        if not ranks:
            return [tokens.index(p) for p in parts]
        i = min(ranks)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_bpe_lookahead_is_sufficient_for_any_merge_list(monkeypatch):
    """Tokens that leave at the computed lookahead are those of the whole word, checked at every symbol."""
    monkeypatch.setattr(bpe, "EMIT_EVERY", 1)
    rng = random.Random(12)
    for trial in range(60):
        source, rules, tokens = vocabulary_of(rng, "abc"[:rng.randint(1, 3)], rng.randint(0, 14))
        made = bpe.Bpe(source)
        alphabet = sorted({t for t in tokens if len(t) == 1})
        for _ in range(25):
            word = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 70)))
            want = merged(word, rules, tokens)
            assert [t for p in made.stream(word) for t in p] == want, (rules, word)
            assert made.encode_word(word) == want, (rules, word)


def test_bpe_text_streams_in_any_slices_and_constant_memory(encoder, monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice(WORDS) + rng.choice(["", ".", "'s", "é", "\n"]) for _ in range(3000)) + " end"
    whole = b"".join(i for i, _ in encoder.encoder().all(text)), b"".join(t for _, t in encoder.encoder().all(text))
    for size in (1, 7, 1000):
        monkeypatch.setattr(bpe, "SLICE", size)
        parts = list(encoder.encoder().all(text))
        assert (b"".join(i for i, _ in parts), b"".join(t for _, t in parts)) == whole
    monkeypatch.setattr(bpe, "SLICE", 1 << 14)
    peaks = []
    for times in (40, 400):
        long = (text + " ") * times
        tracemalloc.start()
        held = tokens = 0
        stream = encoder.encoder()
        for ids, _ in stream.all(long):
            tokens += len(ids)
            held = max(held, len(stream.rest))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert tokens == times * len(whole[0]) and held < 100
    assert peaks[1] < 1.2 * peaks[0] + 100_000


def test_encoder_is_held_over_its_own_tasks_only():
    with open(VOCABULARY, encoding="utf-8") as f:
        source = f.read()
    first = bpe.loaded(source)
    assert list(common.tidy(iter, bpe.OWNER)([1])) == [1] and bpe.loaded(source) is first
    assert list(common.tidy(iter)([1])) == [1] and not bpe._LOADED


def test_decoder_is_incremental(encoder):
    text = "héllo wörld 中\U0001f642 end"
    ids = encoder.encode(text).tolist()
    whole = encoder.decoder().feed(ids)
    assert whole == "héllo wörld 中 \U0001f642 end " or whole.replace(" ", "") == text.replace(" ", "")
    one = encoder.decoder()
    assert "".join(one.feed([i]) for i in ids) + one.finish() == whole
    broken = encoder.decoder()
    assert broken.feed([encoder.ids[encoder.letters[0xE4]]]) + broken.finish() == "�"


def test_bpe_query_and_edges(spark, edge, empty):
    library = Tokenizer.from_file(VOCABULARY)
    got = bpe.encode_documents(clashing(edge), VOCABULARY, with_ids=True)
    assert got.count() == edge.count() and bpe.encode_documents(empty, VOCABULARY).count() == 0
    for r in bpe.encode_documents(edge, VOCABULARY).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# 3: Jaccard

def brute_components(rows, n, percent):
    word = re.compile("[^\x20\x09-\x0d]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = word.findall((text or "").translate(lower))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(j)] = find(i)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None and (least[find(i)] is None or d < least[find(i)]):
            least[find(i)] = d
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_rows(rng, groups=12, copies=9, frequent=None):
    rows = []
    for g in range(groups):
        base = prose(rng, rng.choice([6, 9, 30, 60, 150])).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(w + ([frequent] if frequent and rng.random() < 0.5 else []))))
    return rows


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, monkeypatch, n, percent):
    rng = random.Random(n)
    rows = near_rows(rng, frequent=prose(rng, 40)) + [(r[0], r[1]) for r in edge_rows(rng) if r[0] != 7]
    rows = [(None if i is None else i, t) for i, t in rows]
    want = brute_components(rows, n, percent)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("sid", F.lit("x"))
    for limit in (jaccard_join.FREQUENT, 2):       # 2: all shared grams are of the frequent class
        monkeypatch.setattr(jaccard_join, "COMMON", min(limit, 6))
        monkeypatch.setattr(jaccard_join, "FREQUENT", limit)
        got = jaccard_join.join(df, n, percent).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_prefix_entries_meet_for_every_link():
    rng = np.random.default_rng(4)
    for trial in range(300):
        size = int(rng.integers(6, 120))
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        other = base.copy()
        for _ in range(int(rng.integers(0, max(2, size // 10)))):
            other[rng.integers(size)] = rng.integers(0, 1 << 63, dtype=np.uint64)
        other = other[:int(rng.integers(int(size * 0.86) + 1, size + 1))]
        x, y = np.unique(base), np.unique(other)
        common = len(np.intersect1d(x, y))
        if np.array_equal(x, y) or 100 * common < 85 * (len(x) + len(y) - common):
            continue
        def entry(s):
            heavy = s % np.uint64(7) != 0
            order = np.lexsort((s, heavy))
            return jaccard_join.signatures(s[order], int((~heavy).sum()), 85)
        assert len(np.intersect1d(entry(x), entry(y))), trial


def test_keep_one_and_empty(spark, edge, empty):
    kept = jaccard_join.keep_one(clashing(edge), 5, 80)
    assert kept.columns == clashing(edge).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([None, 1, 2, 3, 4, 7, 8, 9], key=str)
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.keep_one(empty, 5, 80).count() == 0


def test_components_on_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(500, 501), (501, 500), (7, 7)]
    got = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[i] for i in range(100, 180)}) == 1
    assert got[500] == got[501] and len(set(got.values())) == 3


def test_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(components, "SMALL_BUCKET", 8)
    monkeypatch.setattr(components, "CENTRES", (2, 3))
    rng = random.Random(8)
    rows = [(rng.randrange(6), i) for i in range(120)] + [(99, i) for i in range(0, 120, 2)]
    df = spark.createDataFrame(rows, "sig bigint, id bigint")
    linked = lambda a, b: (a * 31 + b * 31) % 11 == 0
    got = {r["id"]: r["root"] for r in components.link_buckets(
        df, lambda p: p.where("(a * 31 + b * 31) % 11 = 0"), spark.range(120).selectExpr("id", "id AS f"),
        lambda x, y: f"({x}.f + {y}.f) % 11 <> 5").collect()}
    parent = {i: i for i in range(120)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    by = defaultdict(list)
    for s, i in rows:
        by[s].append(i)
    for ids in by.values():
        for a, b in itertools.combinations(sorted(set(ids)), 2):
            if linked(a, b):
                parent[find(b)] = find(a)
    for a, b in itertools.combinations(range(120), 2):
        assert (find(a) == find(b)) == (got.get(a, ("own", a)) == got.get(b, ("own", b)))


def test_a_pair_of_many_buckets_is_made_once(spark, monkeypatch):
    """Twelve unequal buckets share 20 ids; a bucket of two has its pair tested by the star."""
    made, plain = [], components._pairs

    def counted(left, right, condition):
        out = plain(left, right, condition)
        if "x.id < y.id" in condition:
            made.append(out.count())
        return out
    monkeypatch.setattr(components, "_pairs", counted)
    rows = [(s, i) for s in range(12) for i in [*range(20), 100 + s]] + [(50, 300), (50, 301)]
    components.link_buckets(spark.createDataFrame(rows, "sig bigint, id bigint"), lambda p: p.where("a < 0"),
                            spark.range(400).select("id"), lambda x, y: "true")
    assert sum(made) == 20 * 19 // 2 + 12 * 20


@pytest.mark.parametrize("alike, stars", [(False, 2), (True, 4)])
def test_stars_end_where_rows_are_unlike(spark, monkeypatch, alike, stars):
    """200 ids share a bucket, whose only link is of ids 3 and 196: all pairs are tested after one star more, or three."""
    monkeypatch.setattr(components, "SMALL_BUCKET", 8)
    monkeypatch.setattr(components, "CENTRES", (2, 3, 4))
    made, plain = [], components._star

    def counted(rows, turn, centres, allowed):
        made.append(centres)
        return plain(rows, turn, centres, allowed)
    monkeypatch.setattr(components, "_star", counted)
    got = components.link_buckets(
        spark.range(200).selectExpr("5 AS sig", "id"), lambda p: p.where("a = 3 AND b = 196"),
        spark.range(200).selectExpr("id", "id AS f"), lambda x, y: "true" if alike else f"{x}.f + {y}.f = 199").collect()
    assert len(made) == stars
    assert sorted(r["id"] for r in got) == [3, 196] and len({r["root"] for r in got}) == 1


# 4: WARC

def test_shuffle_files_go_once_their_table_is_written(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    components.drop_shuffles(spark)
    before = shuffled()
    made = components.materialize(spark.range(1000).repartition(4, "id"), "shuffled")
    assert shuffled() - before
    components.drop_shuffles(spark)
    for _ in range(20):      # the cleaner is a thread of its own
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert made.count() == 1000


def test_warc_against_duckdb(spark):
    against_duckdb(spark, "op4_warc")


def test_warc_round_trip_and_edges(spark):
    big = "<p>" + "xé" * 200
    rows = [(3, "http://a/\r\nb é", big), (1, None, big), (1, None, big), (2, "u", None), (4, "u", ""), (5, "u", "short"),
            (6, "u", "short"), (None, "u", big), (7, "u", "z" * 300_000), (8, "u", "HTTP\r\n\r\nContent-Length: 9")]
    rows += [(100 + i, f"http://x/{i}", f"<html>{i} common frame of the page {'w' * (i % 50)}</html>") for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit("x"))
    path = scratch_path(spark, "warc-test")
    records = warc.plan_records(pages)
    dictionary = warc.train_dictionary(pages)
    assert dictionary
    warc.write_archives(records, path, dictionary)
    back = warc.read_archives(spark, path).collect()
    assert len(back) == len(rows)
    html = defaultdict(list)
    for i, _, h in rows:
        html[i].append((h or "").encode())
    for r in back:
        payload = html[r["page_id"]][0]
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        first = r["page_id"] not in (3, None)
        assert r["record_type"] == ("response" if first else "revisit")
        assert r["refers_to"] == (None if first else 1)
        assert (bytes(r["payload"]) == payload) if first else r["payload"] is None
    assert {r["page_id"]: r["url"] for r in back}[3] == "http://a/\r\nb é"
    first = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    assert bytes(first[:4]) == b"\x5d\x2a\x4d\x18"
    none = pages.limit(0)
    assert warc.archive(none, scratch_path(spark, "warc-test")).count() == 0
    assert warc.archive(pages.limit(2), scratch_path(spark, "warc-test")).count() == 2


def test_warc_urls_come_back_and_record_ids_are_unique(spark, monkeypatch):
    urls = ["http://a/b%20c?x=%41", "http://a/ b", " lead", "trail\t", "a\nb: c", "x: y: z", "é中\u2028", "%", "%0D%0A", "\r\n", "", None,
            "http://h/\x00"]
    rows = [(i, u, f"page {i} " * 30) for i, u in enumerate(urls)]
    rows += [(500, "twice", "same payload " * 20)] * 4 + [(501, "v", "same payload " * 20), (None, "n", "nulls " * 40), (None, "n", "nulls " * 40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    path = scratch_path(spark, "warc-ids")
    warc.write_archives(warc.plan_records(pages), path, b"")
    back = warc.read_archives(spark, path).collect()
    assert {r.page_id: r.url for r in back if r.page_id is not None and r.page_id < 100} == {i: u or "" for i, u in enumerate(urls)}
    raw = [rec for r in spark.read.format("binaryFile").load(path).collect() for rec in warc.read_frames(bytes(r.content))]
    ids = [re.search(rb"WARC-Record-ID: (\S+)", r).group(1) for r in raw]
    assert len(set(ids)) == len(raw) == len(rows)
    refers = {m.group(1) for r in raw if (m := re.search(rb"WARC-Refers-To: (\S+)", r))}
    assert refers and refers <= set(ids)
    assert sorted(r.record_type for r in back if r.page_id in (500, 501)) == ["response"] * 4 + ["revisit"]


def test_warc_archives_are_bounded_and_each_has_the_dictionary(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", f"<html>{prose(rng, 60)}</html>") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    dictionary = warc.train_dictionary(pages)
    assert dictionary
    monkeypatch.setattr(warc, "ROW_BYTES", 2000)
    monkeypatch.setattr(warc, "ARCHIVE_ROWS", 3)
    path = scratch_path(spark, "warc-bounded")
    warc.write_archives(warc.plan_records(pages), path, dictionary)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) > 5 and max(r.length for r in files) < len(dictionary) + 3 * 4000
    assert all(bytes(r.content[:4]) == b"\x5d\x2a\x4d\x18" for r in files)
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in warc.read_archives(spark, path).collect()) == [
        (i, h) for i, _, h in rows]


# 5: licenses

def test_license_against_duckdb(spark):
    against_duckdb(spark, "op5_license")


def test_license_edges(spark, edge, empty):
    mit = license_scan.PASSAGES[0][0]
    moved = mit.replace("free of charge", "free of any charge").replace("without restriction", "with restriction")
    rows = [(1, "Released under the MIT License. mit-license"), (2, "x " + moved.upper() + " y"), (3, "general  public\nlicense"),
            (4, None), (5, "mit license"), (5, "mit license"), (6, "mit licensee permit license"), (7, "apacheé license")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("label", F.lit(1)).withColumn("at", F.lit(1))
    got = {}
    for r in license_scan.scan(df).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[5]) == 2
    assert (got[1][0]["n_base"], got[1][0]["first_word"], got[1][0]["last_word"], got[1][0]["base_labels"]) == (2, 3, 5, "mit")
    assert got[2][0]["n_base"] == 0 and got[2][0]["labels"] == "mit" and 0.6 <= got[2][0]["score"] < 1
    assert got[3][0]["base_labels"] == "gpl" and got[4][0]["n_words"] == 0 and got[4][0]["first_word"] is None
    assert got[6][0]["n_base"] == 0 and got[7][0]["n_base"] == 0
    assert license_scan.scan(edge).count() == edge.count() and license_scan.scan(empty).count() == 0


def test_license_in_a_text_of_a_million_words(spark):
    passage = license_scan.PASSAGES[0][0]
    words = ["lorem"] * 1_000_000
    words[500_000:500_000] = passage.split()
    words[900_000:900_000] = ["MIT", "License"]
    got = license_scan.scan(spark.createDataFrame([(1, " ".join(words)), (2, "mit license " * 50_000)], "doc_id bigint, text string"))
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].n_words == len(words) and rows[1].first_word == rows[1].last_word == 900_000
    assert rows[1].labels == "mit" and rows[1].score == 1.0
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word) == (50_000, 0, 99_998)


def test_license_needed_words_leave_no_template_out():
    needed = set(license_scan.needed_words())
    for items, k, least in ((license_scan.PHRASES, 2, 1.0), (license_scan.PASSAGES, license_scan.GRAM, license_scan.COVERAGE)):
        for text, _ in items:
            w = text.split()
            grams = [set(w[i:i + k]) for i in range(len(w) - k + 1)]
            assert sum(not needed & g for g in grams) < least * len(grams)


def test_similar_lines_share_a_prefix_entry():
    """Lines of every length with as many edits as the threshold allows, anywhere."""
    rng = random.Random(21)
    invent = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    for n in [*range(4, 41), 63, 64, 65, 110]:
        for _ in range(12):
            x = [invent() if rng.random() < 0.8 else "ab" for _ in range(n)]
            y = list(x)
            for _ in range(n // 5 + 2):
                kind, p = rng.randrange(3), rng.randrange(len(y))
                new = y[:p] + ([invent()] if kind < 2 else []) + y[p + (kind != 1):]
                if line_dedup.similar(*(line_dedup._words_of(" ".join(w).encode()) for w in (x, new))):
                    y = new
            if len(y) < 4:
                continue
            raw = np.frombuffer("\n".join([" ".join(x), " ".join(y)]).encode(), np.uint8)
            lines = line_dedup.Lines(raw, np.array([0, len(raw)]))
            row, key = line_dedup.prefix_keys(lines, np.array([0, 1]))
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (x, y)


def test_counter_steps_round_trip():
    rng = np.random.default_rng(1)
    for _ in range(100):
        blocks = [np.unique(rng.integers(0, 1 << 22, rng.integers(1, 30))) for _ in range(rng.integers(1, 6))]
        blocks[0] = np.unique(np.concatenate([blocks[0], [0, 65535, 131070, 131071]]))
        at = np.cumsum([0] + [len(b) for b in blocks])[:-1]
        tokens, first = jaccard_join.stepped(np.concatenate(blocks), at)
        for b, a, z in zip(blocks, first[:-1], first[1:]):
            assert (jaccard_join.places(tokens[a:z]) == b).all()


# 6: lines

def test_line_edit_similarity():
    rng = random.Random(6)

    def full(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x):
            new = [i + 1]
            for j, b in enumerate(y):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (a != b)))
            row = new
        return row[-1]
    for _ in range(300):
        x = np.array([rng.randrange(6) for _ in range(rng.randint(0, 30))], dtype=np.uint64)
        y = x.copy() if rng.random() < 0.5 else np.array([rng.randrange(6) for _ in range(rng.randint(0, 30))], dtype=np.uint64)
        y = np.delete(y, [i for i in range(len(y)) if rng.random() < 0.1])
        longer = max(len(x), len(y))
        want = longer == 0 or full(x, y) <= int(0.2 * longer + 1e-9)
        assert line_dedup.similar(x, y) == want


def test_lines_are_aligned_together_as_one_by_one():
    rng = random.Random(7)
    pairs = []
    for n in [*range(0, 60), 200, 511, 512, 700, 3000] * 4:
        x = [rng.randrange(40) for _ in range(n)]
        y = list(x)
        for _ in range(rng.randint(0, n // 4 + 1)):
            p, kind = rng.randrange(len(y) + 1), rng.randrange(3)
            y[p:p + (kind != 0)] = [99] if kind < 2 else []
        pairs.append((np.array(x, np.int64), np.array(y, np.int64)))
    flat = [f for side in zip(*pairs) for f in (np.concatenate(side), np.append(0, np.cumsum([len(w) for w in side])))]
    got = line_dedup.similar_pairs(*flat)
    assert got.tolist() == [line_dedup.similar(x, y) for x, y in pairs] and 0 < got.sum() < len(pairs)


def test_simhash_matches_plain_votes():
    import pyarrow as pa
    from dryspell.llm.common import text_slices
    rng = random.Random(1)
    texts = ["\n".join(prose(rng, rng.randint(0, 40)) for _ in range(5)), "", "a b c d e f", None]
    for _, _, data, offsets in text_slices(pa.array(texts)):
        lines = line_dedup.Lines(data, offsets)
        at = np.flatnonzero(lines.count >= 1)
        got = lines.simhashes(at)
        for i, s in zip(at, got):
            words, size = lines.words[lines.at[i]:lines.at[i + 1]], lines.size[lines.at[i]:lines.at[i + 1]]
            use = words[size > 3] if (size > 3).any() else words
            votes = sum(np.array([1 if int(w) >> b & 1 else -1 for b in range(63, -1, -1)]) for w in use)
            assert int(s) == int("".join("1" if v > 0 else "0" for v in votes), 2)


def test_line_dedup_keeps_first_of_each_group(spark, edge, empty):
    rng = random.Random(12)
    shared, alone = prose(rng, 60), [prose(rng, 30) for _ in range(4)]
    edited = shared.split()
    edited[7] = "otherword"
    digits = re.sub(r"\d", "9", shared).upper() + "!"
    rows = [(1, alone[0] + "\n" + shared), (2, shared + "\n" + alone[1] + "\nshort line"), (3, "short line\n" + " ".join(edited)),
            (4, digits + "\n" + alone[2] + "\n" + alone[2]), (5, alone[3]), (6, None), (7, "")]
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["doc_id"]: r for r in line_dedup.dedup(df).collect()}
    assert got[1]["text"] == rows[0][1] and got[5]["text"] == rows[4][1]
    assert got[2]["text"] == alone[1] + "\nshort line" and got[2]["_removed_lines"] == [0]
    assert got[4]["text"] == alone[2] and got[4]["_removed_lines"] == [0, 2]
    assert got[6]["text"] == "" and got[7]["text"] == ""
    assert got[3]["text"] in ("short line", rows[2][1])     # within three SimHash bits always, else likely
    out = line_dedup.dedup(edge)
    assert out.count() == edge.count() and line_dedup.dedup(empty).count() == 0


def test_line_pairs_within_three_bits_are_candidates():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    other = base.copy()
    for i in range(200):
        for b in rng.choice(64, 3, replace=False):
            other[i] ^= np.uint64(1) << np.uint64(b)
    x, y = line_dedup.block_keys(base), line_dedup.block_keys(other)
    assert (x == y).any(axis=1).all()


def test_line_dedup_finds_every_pair_at_the_threshold(spark):
    """Up to a fifth of the words changed, put in or left out: all copies go, as by brute force."""
    rng = random.Random(33)
    rows, copies = [], 0
    for i in range(120):
        words = prose(rng, rng.choice([5, 7, 10, 12, 20, 30, 60])).split()
        rows.append((i, " ".join(words)))
        for _ in range(2):
            edited = list(words)
            for j in rng.sample(range(len(words)), len(words) // 5):
                edited[j] = "x" + rng.choice("abcdefgh") * 6
            if len(words) > 5 and rng.random() < 0.3:
                edited = words[:len(words) - len(words) // 5]
            copies += 1
            rows.append((1000 + 2 * i + len(rows) % 2, " ".join(edited)))
    rows += [(5000, "of to in at longword"), (5001, "of to in at otherword"), (5002, "la la la la la la"), (5003, "la la la la la")]
    copies += 2
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    words = [line_dedup._words_of(t.encode()) for _, t in rows]
    gone = {r["doc_id"] for r in got if r["removed_lines"]}
    assert len(gone) == copies
    like = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if line_dedup.similar(words[a], words[b])]
    assert len(like) >= copies and all(rows[a][0] in gone or rows[b][0] in gone for a, b in like)


def _like_lines(rng, n):
    """Words of a line, and of one with as many edits as the threshold allows."""
    invent = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    x = [invent() if rng.random() < 0.8 else "ab" for _ in range(n)]
    y = list(x)
    for _ in range(n // 5 + 2):
        kind, p = rng.randrange(3), rng.randrange(len(y))
        new = y[:p] + ([invent()] if kind < 2 else []) + y[p + (kind != 1):]
        if line_dedup.similar(*(line_dedup._words_of(" ".join(w).encode()) for w in (x, new))):
            y = new
    return x, y


def test_entries_of_similar_lines_meet_as_often_as_is_sure():
    """No line with a similar one has fewer entries met than the index asks of it, copies of it or not."""
    rng = random.Random(5)
    for n in [*range(4, 41), 49, 50, 57, 64, 99, 110, 260]:
        for _ in range(8):
            x, y = _like_lines(rng, n)
            if len(y) < 4:
                continue
            raw = np.frombuffer("\n".join([" ".join(x), " ".join(y)]).encode(), np.uint8)
            lines = line_dedup.Lines(raw, np.array([0, len(raw)]))
            row, key, place = line_dedup.prefix_entries(lines, np.array([0, 1]))
            order = np.argsort(key)
            row, key, place = row[order], key[order], place[order]
            found = line_dedup.met(key, line_dedup.length_classes(lines.count)[row], place)
            need = line_dedup.surely_shared((4 * lines.count + 4) // 5)
            assert (np.bincount(row[found], minlength=2) >= need).all(), (x, y)


def test_entries_met_by_length_and_place():
    value = np.array([1, 1, 2, 2, 3, 3, 4, *[5] * 40], dtype=np.uint64)
    n = np.array([50, 55, 50, 70, 50, 50, 50, *[8, 80] * 20])
    place = np.array([10, 20, 10, 10, 10, 200, 10, *[0] * 40], dtype=np.uint8)
    got = line_dedup.met(value, line_dedup.length_classes(n), place)
    assert got.tolist() == [True, True, *[False] * 5, *[True] * 40]
    place[5] = line_dedup.ANYWHERE
    assert line_dedup.met(value, line_dedup.length_classes(n), place)[4:6].all()


def test_unlike_lines_leave_the_index(spark, monkeypatch):
    """Lines that share a phrase and no more are dropped before they are rows, like ones stay, however many share an entry."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    phrase = [word() for _ in range(3)]
    texts = [" ".join([word() for _ in range(20)] + phrase + [word() for _ in range(20)]) for _ in range(60)]
    like = texts[7].split()
    like[3], like[30] = word(), word()
    for hot, window in ((16, 1 << 20), (1, 100)):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        monkeypatch.setattr(line_dedup, "WINDOW", window)
        df = spark.createDataFrame(list(enumerate([*texts, " ".join(like)])), "rkey bigint, text string").repartition(3)
        lines = line_dedup.line_table(df, "text", "rkey", "rkey", 1)
        index = line_dedup.line_index(df, lines, 1)
        assert "Join" not in index._jdf.queryExecution().toString()
        keys = {r["rkey"]: r["key"] for r in lines.collect()}
        got = index.where("sig IS NOT NULL").collect()
        assert {r["id"] for r in got} == {keys[7], keys[60]}
        assert {r["id"] for r in index.where("sig IS NULL").collect()} == {keys[7], keys[60]}


def test_alignment_of_lines_that_share_ends_or_words(monkeypatch):
    """Pairs with like ends, the same words in another order, nothing in common or no words at all."""
    base = np.arange(1, 41, dtype=np.int64) << 30
    pairs = [(base, base), (base, base[::-1]), (base, np.delete(base, 5)), (base, np.delete(base, np.s_[:9])),
             (base, np.append(base[:32], base[:8] + 1)), (base, np.append(base[:31], base[:9] + (1 << 40))),
             (base, np.repeat(base[:1], 40)), (base[:0], base[:0]), (np.tile(base, 30), np.tile(base, 30)[1:]),
             (np.tile(base, 30), np.tile(base[::-1], 30)), (np.repeat(base[:2], 10), np.repeat(base[:2], 9))]
    flat = [f(v) for i in (0, 1) for f, v in ((np.concatenate, [p[i] for p in pairs]),
                                              (np.cumsum, [0, *[len(p[i]) for p in pairs]]))]
    want = [line_dedup.similar(x, y) for x, y in pairs]
    assert line_dedup.similar_pairs(*flat).tolist() == want
    # However many words are compared together, which bounds what is held at once.
    held, plain = [], line_dedup._unlike_words
    monkeypatch.setattr(line_dedup, "_unlike_words", lambda *a: held.append(a[2].sum() + a[5].sum()) or plain(*a))
    monkeypatch.setattr(line_dedup, "WORDS", 100)
    assert line_dedup.similar_pairs(*flat).tolist() == want and len(held) > 5


def test_line_dedup_query_takes_short_lines(spark, tmp_path):
    rows = [(1, "all rights reserved\nalpha beta gamma\n\n!"), (2, "All rights, reserved!\ndelta\n\n!"),
            (3, "delta\none two three four five"), (4, "one two three four")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["removed_lines"] for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: [0]}


# 7: decontamination

def test_alignment_equals_full_table():
    rng = random.Random(3)
    for _ in range(200):
        x = np.array([rng.randrange(5) for _ in range(rng.randint(1, 12))])
        y = np.array([rng.randrange(5) for _ in range(rng.randint(1, 20))])
        h = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, j in itertools.product(range(len(x)), range(len(y))):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if x[i] == y[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        score, start, end = decontaminate.smith_waterman(x, y)
        assert score == h.max() and 0 <= start <= end <= len(y)
        if score:
            assert decontaminate._align(x, y[start:end])[0] == score


def test_decontaminate_copies_edits_and_clean(spark, edge, empty):
    rng = random.Random(4)
    items = [(1, prose(rng, 40)), (2, prose(rng, 25)), (3, None), (4, "two words"), (None, prose(rng, 30))]
    edited = items[0][1].split()
    for i in range(3, 40, 8):
        edited[i] = "changed"
    del edited[20]
    rows = [(10, prose(rng, 100) + " " + items[0][1] + " " + prose(rng, 50)), (11, prose(rng, 30) + " " + " ".join(edited)),
            (12, prose(rng, 300)), (13, None), (14, ""), (15, "here are Two, words in a text"), (16, prose(rng, 5000) + " " + items[1][1].upper())]
    rows += [(100 + i, prose(rng, 20) + " " + items[1][1]) for i in range(60)]       # a passage that many documents hold
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.scan(docs, bench).collect()}
    flagged = {i for i, r in got.items() if r["_contaminated"]}
    assert flagged == {10, 11, 15, 16, *range(100, 160)}
    assert got[10]["_item_id"] == 1 and got[10]["overlap_score"] == 1.0
    assert (got[10]["start_word"], got[10]["end_word"]) == (100, 140)
    assert got[11]["overlap_score"] < 1 and got[16]["start_word"] == 5000
    assert decontaminate.scan(edge, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.scan(empty, bench).count() == 0


def test_decontaminate_finds_edited_and_short_items_in_many_documents(spark):
    """Every document in which an item reaches 0.5, told by aligning all with all, is flagged."""
    rng = random.Random(44)
    invent = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    items = [(i, invent(n)) for i, n in enumerate([2, 3, 4, 5, 15, 15, 17, 24])]
    rows = []
    for i, text in items:
        rows += [(1000 * i + j, invent(rng.randint(0, 60)) + " " + text + " " + invent(30)) for j in range(24)]
        for j in range(24 if i >= 4 else 0):
            words = text.split()
            for p in rng.sample(range(len(words)), len(words) // 4):
                words[p] = invent(1)
            words.insert(rng.randrange(len(words)), invent(1))
            rows.append((1000 * i + 100 + j, invent(rng.randint(0, 60)) + " " + " ".join(words)))
    spread = " ".join(w + " " + invent(1) for w in items[5][1].split())       # no two words next to each other
    rows += [(9000, spread), (9001, invent(200))]
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    of = lambda t: decontaminate.words_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
    for d, text in rows:
        want = {i for i, t in items if decontaminate.smith_waterman(of(t), of(text))[0] >= len(of(t))}
        assert got[d] == want, d
    assert got[9000] == {5} and all(i in got[1000 * i + j] for i in range(8) for j in range(24))


@pytest.mark.parametrize("carried", [False, True])
def test_decontaminate_short_items_are_complete(spark, monkeypatch, carried):
    """Items of 1 to 6 words against all alignments, on a small vocabulary where parts meet everywhere."""
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", -1 if carried else 1 << 20)
    rng = random.Random(71)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta"] + [f"w{i}" for i in range(40)])
    items = [(i, " ".join(word() for _ in range(1 + i % 6))) for i in range(24)]
    items += [(30, "alpha beta gamma"), (31, "delta epsilon"), (31, "other text"), (32, "solo")]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 14)))) for i in range(120)]
    rows += [(900, "alpha zzz gamma"), (901, "delta"), (902, "alpha gamma"), (903, "zzz solo zzz"), (904, "gamma alpha")]
    got = {r["doc_id"]: r for r in decontaminate.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    of = lambda t: decontaminate.words_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
    for d, text in rows:
        share = [(decontaminate.smith_waterman(of(t), of(text))[0] / (2 * len(of(t))), i) for i, t in items]
        assert set(got[d]["items"]) == {i for s, i in share if s >= 0.5}, text
        assert got[d]["contaminated"] == (max(share)[0] >= 0.5)
    assert 30 in got[900]["items"] and 31 in got[901]["items"] and 30 in got[902]["items"] and 32 in got[903]["items"]


# 8: top-k

def test_topk_against_duckdb(spark):
    against_duckdb(spark, "op8_topk")


def test_topk_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 7)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 2)
    monkeypatch.setattr(topk, "SEEDS", 30)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)] + [(200 + i, [1.0] * 6) for i in range(60)]
    rows += [(20, [9.0] * 6), (300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6),
             (304, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (320, [1.0, 2.0]), (321, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1))
    vectors = topk.integer_vectors(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 8).collect()
    whole = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = [int(np.floor(64 * c)) for c in v]
        whole[i] = min(whole.get(i, x), x)
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], x)), i) for i, x in whole.items()
                        if i != q and len(x) == len(whole[q]))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:8])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_topk_scores_beyond_64_bits_fail(spark):
    far = spark.createDataFrame([(20, [1e17, 1.0]), (21, [1e17, 1.0])], "vec_id bigint, embedding array<double>")
    vectors = topk.integer_vectors(far)
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(vectors, vectors.where("vec_id = 20"), 3).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.integer_vectors(spark.createDataFrame([(1, [1e19])], "vec_id bigint, embedding array<double>")).collect()
    wide = spark.createDataFrame([(20, [2.0 ** 24]), (21, [2.0 ** 5]), (22, [-3.0])], "vec_id bigint, embedding array<double>")
    vectors = topk.integer_vectors(wide)
    got = topk.top_k(vectors, vectors.where("vec_id = 20"), 3).collect()
    assert [(r.vec_id, r.score) for r in got] == [(21, 2 ** 41), (22, -192 * 2 ** 30)]


def test_threshold_stops_early():
    """Lists led by one strong row per dimension end before the block is met."""
    n, d = 400, 4
    c = np.tile(np.arange(n)[:, None], (1, d)).astype(np.int64)
    q, i, s = topk.threshold_search(np.arange(n), c, np.array([-1]), np.ones((1, d), np.int64), 3, first=8)
    assert i.tolist() == [399, 398, 397] and s.tolist() == [4 * 399, 4 * 398, 4 * 397]
