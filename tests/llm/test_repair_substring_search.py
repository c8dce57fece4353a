"""Conversation repair, substring dedup and treap search against brute force, DuckDB and edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dryspell.llm import conversation_repair, queries, substring_dedup, treap_search
from test_llm_operators import against_duckdb, clashing, prose

TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


@pytest.mark.parametrize("name", ["op11_conversation", "op12_substring", "op13_search"])
def test_against_duckdb(spark, name):
    against_duckdb(spark, name)


# 11: conversation repair

def turns_brute(rows, planted=True):
    """The contract read literally, with Dijkstra-like relaxation over whole edit strings."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20 if planted else 9
        groups[conv]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        groups[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        known = [t[0] for t in turns if t[0] is not None]
        faults, seen = [], set()
        for _, role, text in turns:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen
                          else "truncated" if marks[-1] not in ".!?" else "")
            seen.add((role, text))
        states = {"": (0, "", ())}            # roles' state -> (cost, audit, repaired)
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

        def better(table, state, value):
            if state not in table or value[:2] < table[state][:2]:
                table[state] = value

        def inserted(states):
            for _ in range(3):
                for state, (cost, audit, done) in list(states.items()):
                    for role in ("user", "assistant"):
                        if role[0] in nexts[state]:
                            better(states, role[0], (cost + 3, audit + "I", (*done, f"{role}:")))
            return states

        for (_, role, text), fault in zip(turns, faults):
            after = {}
            for state, (cost, audit, done) in inserted(states).items():
                better(after, state, (cost + 4, audit + "D", done))
                if fault in ("blank", "duplicate"):
                    continue
                extra = 3 if fault == "truncated" else 0
                if role[:1] and role[0] in nexts[state]:
                    better(after, role[0], (cost + extra, audit + "K", (*done, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in nexts[state]:
                        better(after, new[0], (cost + 3 + extra, audit + "R", (*done, f"{new}:{text}")))
            states = after
        ends = [v for state, v in inserted(states).items() if state in ("", "a")]
        cost, audit, done = min(ends)
        initials = [t[1][:1] for t in turns]
        counts = Counter(faults)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, counts["blank"],
                     counts["duplicate"], counts["truncated"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def some_turns(seed, conversations=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn - 1, turn + 3, None]),
                         rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "usr"]),
                         rng.choice(["Yes.", "No!", "Why?", "and so", " ", "", None, "end. \n", "é中", prose(rng, 3) + "."])))
    return rows


def flat(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("planted", [True, False])
def test_repair_equals_brute_force(spark, planted):
    rows = some_turns(3)
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Hello."), (None, 1, "assistant", "Hello."),
             (10 ** 15, 2 ** 62, "s", "x."), (10 ** 15, -2 ** 62, "user", "y.")]
    df = spark.createDataFrame(rows, TURNS)
    taken = conversation_repair.damage(df) if planted else conversation_repair.undamaged(df)
    got = conversation_repair.summaries(taken)
    assert got.columns == [c.split()[0] for c in conversation_repair.SUMMARY.split(", ")]
    want = turns_brute(rows, planted)
    got = flat(got)
    assert got.keys() == want.keys()
    for conv in want:
        clipped = (min(want[conv][0], 2 ** 63 - 1), *want[conv][1:])
        assert got[conv] == clipped, conv
    clash = conversation_repair.summaries(conversation_repair.undamaged(clashing(df).withColumn("copies", F.lit(5))))
    assert flat(clash) == flat(conversation_repair.summaries(conversation_repair.undamaged(df)))


def test_repaired_turns_spell_the_digest(spark):
    df = conversation_repair.damage(spark.createDataFrame(some_turns(5, 40), TURNS))
    summary = flat(conversation_repair.summaries(df))
    turns = defaultdict(list)
    for r in conversation_repair.repaired_turns(df).orderBy("conv_id", "seq").collect():
        turns[r.conv_id].append(r)
    for conv, row in summary.items():
        kept = [f"{r.role}:{r.text}" for r in turns[conv] if r.role is not None]
        assert "".join(r.edit for r in turns[conv]) == row[6]
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == row[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns[conv] if r.role is not None))


def test_repair_spills_a_giant_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SPILL_BYTES", 1000)
    rng = random.Random(8)
    steps, conversation, plain = (conversation_repair.Steps(), None, None)
    rows = [(t, rng.choice(["user", "assistant"]), f"text {t}.", None, 0) for t in range(3000)]
    rows = [(t, role, text, 1 if role == "user" else 2, fault) for t, role, text, _, fault in rows]
    conversation = conversation_repair.Conversation(1, steps)
    for row in reversed(rows):
        conversation.push(*row)
        assert conversation.size <= 1200
    spilled = conversation.summary()
    assert len(conversation.spilled) > 100
    conversation.close()
    monkeypatch.setattr(conversation_repair, "SPILL_BYTES", 1 << 30)
    plain = conversation_repair.Conversation(1, steps)
    for row in reversed(rows):
        plain.push(*row)
    assert plain.summary() == spilled and not plain.spilled
    want = turns_brute([(1, t, role, text) for t, role, text, _, _ in rows], planted=False)
    assert spilled[1:] == want[1]


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_repair.summaries(conversation_repair.damage(empty)).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(1, dropped, "user", "Hi.")], TURNS)
    assert flat(conversation_repair.summaries(conversation_repair.damage(one))) == {
        1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# 12: substring dedup

def substring_brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    count = Counter(tuple(w[p:p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - window + 1):
            if count[tuple(w[p:p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((str(doc_id), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def substring_rows(rng, window):
    shared = prose(rng, 3 * window)
    exact = prose(rng, window)
    rows = [(i, " ".join([prose(rng, rng.randint(0, 90)), shared[rng.randint(0, 60):], prose(rng, rng.randint(0, 50))]))
            for i in range(12)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, exact), (105, "a " + exact + "\n"),
             (106, exact.rsplit(" ", 1)[0]), (107, "x y " * 200), (108, "z " * (window + 1)), (109, "q " * window),
             (110, prose(rng, 8000)), (110, "same id, other text"), (111, prose(rng, 60)), (None, "no id " + shared),
             (None, prose(rng, 80)), (112, "é中\U0001f642 ok " + prose(rng, 70))]
    return rows + [rows[-4], rows[0], rows[-1]]


@pytest.mark.parametrize("window", [35, 21, 60])
def test_substring_equals_brute_force(spark, window):
    rows = substring_rows(random.Random(window), window)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = substring_dedup.remove_repeats(clashing(df).withColumn("kept", F.lit("x")), window).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == substring_brute(rows, window)


def test_substring_over_many_parts(spark, monkeypatch):
    """Passages whose places lie in several parts and batches, by shuffle joins instead of broadcasts."""
    rng = random.Random(4)
    passage = prose(rng, 50)
    rows = [(i, f"{prose(rng, i % 40)} {passage if i % 3 else ''} {prose(rng, 20)}") for i in range(300)]
    monkeypatch.setattr(substring_dedup, "broadcast_checked", lambda df: df)
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(40)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == substring_brute(rows, 35)


def test_substring_cover_and_empty(spark):
    for d in range(substring_dedup.PERIOD):
        assert any((a - b) % substring_dedup.PERIOD == d for a in substring_dedup.COVER for b in substring_dedup.COVER)
    empty = spark.createDataFrame([], DOCS)
    assert substring_dedup.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(empty, substring_dedup.PERIOD - 1)


def test_substring_merges_spans(spark):
    rows = [(1, 5, 9), (1, 8, 20), (1, 21, 22), (1, 40, 41), (2, 0, 0), (None, 3, 3), (None, 4, 4)]
    df = spark.createDataFrame(rows, "rid bigint, lo int, hi int")
    got = {r.rid: np.frombuffer(r.spans, "<i4").tolist() for r in substring_dedup._merged(df, ["rid"], 2, 0).collect()}
    assert got == {1: [3, 22, 38, 41], 2: [0, 0], None: [1, 4]}


# 13: treap search

def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def search_brute(docs, items, k):
    words = [(i, words_of(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, w in words:
            tf, m = Counter(w), 75 + 25 * len(w) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in words_of(text) if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(str(item_id), rank, str(s[3]), -s[0]) for rank, s in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out)


def search_rows(rng):
    docs = [(i, prose(rng, rng.randint(1, 120))) for i in range(400)]
    docs += [(i, docs[7][1]) for i in range(500, 560)]
    docs += [(600, None), (601, ""), (602, "?! --"), (603, "ÉCOLE école STONE1 stone1"), (604, prose(rng, 9000)),
             (None, docs[7][1]), (None, "stone1"), (7, docs[7][1])]
    items = [(1, docs[7][1]), (2, "stone1 stone1 STONE1 river2"), (3, None), (4, ""), (5, "nowhereword"),
             (6, "école"), (7, prose(rng, 40)), (7, prose(rng, 15)), (None, prose(rng, 10)), (8, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("k,block,split", [(20, 8192, 256), (3, 64, 2), (1000, 100, 16)])
def test_search_equals_brute_force(spark, monkeypatch, k, block, split):
    monkeypatch.setattr(treap_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(treap_search, "CHUNK_BYTES", 1500)
    docs, items = search_rows(random.Random(k))
    got = treap_search.search(clashing(spark.createDataFrame(docs, DOCS)).repartition(3),
                              clashing(spark.createDataFrame(items, ITEMS).withColumnRenamed("item_id", "own")), k,
                              id_col="own").collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == search_brute(docs, items, k)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "stone")], DOCS), spark.createDataFrame([(1, "stone")], ITEMS)
    assert treap_search.search(docs.limit(0), items).count() == 0
    assert treap_search.search(docs, items.limit(0)).count() == 0
    assert treap_search.search(docs, spark.createDataFrame([(1, None)], ITEMS)).count() == 0


def test_treap_nodes_and_pruning():
    rng = np.random.default_rng(2)
    cells = rng.choice(64 * 300, size=2500, replace=False)
    rows, columns, values = cells // 300, cells % 300, rng.integers(1, 1000, 2500)
    grid = np.zeros((64, 300), np.int64)
    grid[rows, columns] = values
    treap = treap_search.K2Treap(rows, columns, values)
    assert treap.best[0] == values.max()
    for asked in ([0], [1, 5, 63], list(range(64)), [9, 9]):
        asked, repeats = np.unique(asked, return_counts=True)
        score = (grid[asked] * repeats[:, None]).sum(axis=0)
        for k, split in itertools.product((1, 10, 400), (1, 8, 256)):
            found, got = treap.top(asked, repeats, k, np.zeros(0, np.int64), split)
            assert (score[found] == got).all() and len(set(found)) == len(found)
            least = np.sort(score)[::-1][min(k, 300) - 1]
            assert set(np.flatnonzero(score >= max(1, least))) <= set(found)
    high = grid.sum(axis=0).max() + 1
    assert len(treap.top(np.arange(64), np.ones(64, int), 5, np.full(5, high))[0]) == 0
