"""Conversation structure repair by secondary-sorted streaming.

Turns are repartitioned by conversation and sorted by turn, last turn first, and
``mapInPandas`` walks them carrying the state of a dynamic program from batch to
batch: for each of four places in the grammar (nothing said, after the system
turn, after a user, after an assistant) the least cost of repairing the turns
seen so far. Each turn leaves one byte, the best edit at each place. At the
conversation's first turn the bytes are walked in reading order from "nothing
said", which gives the cheapest edits and, because every place tries its edits
in ASCII order, the least audit among equally cheap ones.

Edits: Keep (0), Rerole to user or assistant (3), Delete (4; the only one for blank
and duplicate turns), Insert an empty user or assistant turn anywhere (3); a
truncated turn that stays adds 3. The initials of the roles that remain match
``(s?(ua)+)?``.

Only the current conversation's bytes and texts are held; beyond ``SPILL_BYTES``
they go to an unnamed temporary file of the task, so a giant conversation takes
constant memory. The digest of its repaired text and its audit are sequences over
the whole conversation, so its turns pass one task (streamed, never gathered).
Duplicates are told before that by a grouped minimum and a join, both of which
Spark spreads over tasks however large a conversation is.

Defined cases: a null role or text is one space; a null id is a conversation of its
own; a null turn comes first; rows of one turn are ordered by role, then text, and
equal rows are duplicates of the first; any role that starts with another letter
than s, u or a (an empty one too) cannot be kept; a conversation whose turns are
all dropped has zeros, an empty audit and no turns; gaps beyond 64 bits stop at
the largest value; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3

#: Bytes of one conversation's backpointers and texts that stay in memory.
SPILL_BYTES = 8 << 20

#: Places of the grammar and the place that each one's next role leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "DIKR"
#: What the places cost once no turn is left: a lone system turn needs two inserts.
END = (0, 2 * INSERT, INSERT, 0)
#: Kinds of turns: the role's initial (s, u, a, other), plus 4 if truncated; FORCED must go.
FORCED = 8

BLANKS = " \t\n\x0b\x0c\r"

SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string, repaired_sha256 string")
TURNS = "conv_id bigint, seq bigint, edit string, turn bigint, role string, text string"


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows with planted faults; copies is 0, 1 or 2.

    crc32 of ``conv_id:turn`` modulo 20 says which: 0 drops the row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    rows = _plain(df)
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":")
                     for c in ("conv_id", None, "turn")))
    rows = rows.withColumn("fate", F.crc32(key.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate").isin(0, 1), "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))


def _plain(df: DataFrame) -> DataFrame:
    return df.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                     *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


def _judged(rows: DataFrame) -> DataFrame:
    """The rows with ``initial`` (0 to 3), ``fault`` (0 none, 1 blank, 2 duplicate, 3 truncated).

    Equal rows of one turn are told apart in the stream, where they are neighbours.
    """
    initial = F.substring("role", 1, 1)
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumn("same", F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (rows.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("same").alias("s"))
             .agg(F.min(when).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(first, F.expr("conv_id <=> c AND same = s"), "left")
    return rows.select(
        "conv_id", "turn", "role", "text", "copies",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(trimmed == "", 1).when(F.col("first").isNotNull() & (when > F.col("first")), 2)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 3).otherwise(0).alias("fault"))


def step(after: tuple, kind: int) -> tuple[tuple, int]:
    """(costs before a turn, best edits) from the costs after it; two bits of edits a place."""
    base, edits = [], []
    for place in range(4):
        options = [(DELETE + after[place], 0)]
        if kind != FORCED:
            initial, extra = kind & 3, CUT_SHORT if kind & 4 else 0
            if initial == 0 and place == NOTHING:
                options.append((KEEP + extra + after[SYSTEM], 2))
            if (initial, AFTER[place]) in ((1, USER), (2, ASSISTANT)):
                options.append((KEEP + extra + after[AFTER[place]], 2))
            options.append((REROLE + extra + after[AFTER[place]], 3))
        cost, letter = min(options)
        base.append(cost)
        edits.append(letter)
    costs = [0] * 4
    for place in (USER, ASSISTANT):
        costs[place] = min(base[place], INSERT + base[AFTER[place]])
    for place in (NOTHING, SYSTEM):
        costs[place] = min(base[place], INSERT + costs[USER])
    packed = 0
    for place in range(4):
        tries = [(base[place], edits[place]), (INSERT + costs[AFTER[place]], 1)]
        packed |= min(tries)[1] << 2 * place
    return tuple(costs), packed


class Steps(dict):
    """Memory of :func:`step` over costs less their least: few such costs exist, whatever the input."""

    def __missing__(self, key):
        after, kind = key
        costs, packed = step(after, kind)
        least = min(costs)
        self[key] = tuple(c - least for c in costs), least, packed
        return self[key]


class Conversation:
    """One conversation as it streams by from its last turn to its first."""

    def __init__(self, conv_id, steps: Steps):
        self.conv_id, self.steps = conv_id, steps
        self.costs, self.paid = END, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.high = self.low = None
        self.distinct = 0
        self.later = None
        self.chunk, self.size, self.spilled, self.file = [], 0, [], None

    def push(self, turn, role, text, initial, fault) -> None:
        if turn is not None:
            if self.high is None:
                self.high = turn
            if turn != self.low:
                self.distinct += 1
            self.low = turn
        if self.later is not None and (initial, self.later) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.later = initial
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        kind = FORCED if fault in (1, 2) else initial + (4 if fault == 3 else 0)
        self.costs, more, packed = self.steps[self.costs, kind]
        self.paid += more
        if kind == FORCED:
            role = text = ""
        self.chunk.append((packed, turn, role, text))
        self.size += 96 + len(role) + len(text)
        if self.size > SPILL_BYTES:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.spilled.append(self.file.tell())
        pickle.dump(self.chunk, self.file, protocol=pickle.HIGHEST_PROTOCOL)
        self.chunk, self.size = [], 0

    def turns(self) -> Iterator[tuple]:
        """Turns in reading order, as (packed edits, turn, role, text)."""
        yield from reversed(self.chunk)
        for at in reversed(self.spilled):
            self.file.seek(at)
            yield from reversed(pickle.load(self.file))

    def repaired(self) -> Iterator[tuple]:
        """(edit, turn, role, text) of every edit in order; deleted turns have no role."""
        place = NOTHING
        for packed, turn, role, text in self.turns():
            while (letter := packed >> 2 * place & 3) == 1:
                place = AFTER[place]
                yield "I", None, ROLE_OF[place], ""
            if letter == 0:
                yield "D", turn, None, None
            elif letter == 2:
                place = SYSTEM if place == NOTHING and role[:1] == "s" else AFTER[place]
                yield "K", turn, role, text
            else:
                place = AFTER[place]
                yield "R", turn, ROLE_OF[place], text
        while place in (SYSTEM, USER):
            place = AFTER[place]
            yield "I", None, ROLE_OF[place], ""

    def summary(self) -> tuple:
        audit, digest, first = [], hashlib.sha256(), True
        for edit, _, role, text in self.repaired():
            audit.append(edit)
            if role is not None:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.distinct, (1 << 63) - 1)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                self.paid + self.costs[NOTHING], "".join(audit), digest.hexdigest())

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Each conversation once its last row has passed, from rows sorted last turn first."""
    steps, current, held = Steps(), None, None

    def settle(row, following):
        """Push a row, now that the one before it in reading order is known."""
        turn, role, text, copies, initial, fault = row
        again = 2 if fault != 1 else 1
        for _ in range(copies - 1):
            current.push(turn, role, text, initial, again)
        current.push(turn, role, text, initial, again if following == row[:3] else fault)

    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv_known", "conv_id", "turn_known", "turn", "role", "text",
                                               "copies", "initial", "fault")]
        for conv_known, conv_id, turn_known, turn, role, text, copies, initial, fault in zip(*columns):
            conv_id = conv_id if conv_known else None
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    if held is not None:
                        settle(held, None)
                    yield current
                    current.close()
                current, held = Conversation(conv_id, steps), None
            if copies:
                row = (turn if turn_known else None, role, text, copies, initial, fault)
                if held is not None:
                    settle(held, row[:3])
                held = row
    if current is not None:
        if held is not None:
            settle(held, None)
        yield current
        current.close()


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows of one conversation in one partition, last turn first."""
    judged = _judged(rows)
    return (judged.repartition("conv_id")
            .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc_nulls_last("turn"), F.desc("role"),
                                  F.desc("text"))
            .select(F.col("conv_id").isNotNull().alias("conv_known"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
                    F.col("turn").isNotNull().alias("turn_known"), F.coalesce("turn", F.lit(0)).alias("turn"),
                    "role", "text", "copies", "initial", "fault"))


def _framed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("conv_id", "turn"):
        if c in names:
            out[c] = pd.array([r[names.index(c)] for r in rows], dtype="Int64")
    return out


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): faults, cost, audit, digest."""
    names = [f.split()[0] for f in SUMMARY.split(", ")]

    def run(batches):
        rows, size = [], 0
        for conversation in _stream(batches):
            rows.append(conversation.summary())
            size += 256 + len(rows[-1][7])
            if size > 1 << 20:
                yield _framed(rows, names)
                rows, size = [], 0
        if rows:
            yield _framed(rows, names)

    return _sorted(rows).mapInPandas(run, SUMMARY)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The edits of every conversation as rows: conv_id, seq, edit, turn, role, text (null where deleted)."""
    names = [f.split()[0] for f in TURNS.split(", ")]

    def run(batches):
        rows, size = [], 0
        for conversation in _stream(batches):
            for seq, (edit, turn, role, text) in enumerate(conversation.repaired()):
                rows.append((conversation.conv_id, seq, edit, turn, role, text))
                size += 96 + len(text or "")
                if size > 1 << 20:
                    yield _framed(rows, names)
                    rows, size = [], 0
        if rows:
            yield _framed(rows, names)

    return _sorted(rows).mapInPandas(run, TURNS)


def undamaged(df: DataFrame) -> DataFrame:
    """A table of turns as :func:`summaries` and :func:`repaired_turns` take it, without planted faults."""
    return _plain(df).withColumn("copies", F.lit(1))


def oracle_sql() -> str:
    """DuckDB SQL: a recursive query carries (cost, audit, text) of each place forward, turn by turn."""
    blank = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    crc_table = ("list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], "
                 "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")
    # Inserts before a turn, as (from, to, letters, cost, text): none, one, or two (only from nothing or s).
    hops = ("(0,0,'',0,''),(1,1,'',0,''),(2,2,'',0,''),(3,3,'',0,''),(0,2,'I',3,'user:'),(1,2,'I',3,'user:'),"
            "(2,3,'I',3,'assistant:'),(3,2,'I',3,'user:'),(0,3,'II',6,'user:\nassistant:'),"
            "(1,3,'II',6,'user:\nassistant:')")
    return f"""
WITH RECURSIVE t AS (SELECT {crc_table} AS c),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
        FROM conversations),
fated AS (SELECT raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1),
                   lambda i: CAST(ascii(key[i]) AS BIGINT))),
                   lambda a, b: xor(a >> 8, t.c[xor(a & 255, b) + 1])), 4294967295) % 20 AS fate FROM raw, t),
hurt AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text
         FROM fated, range(CASE WHEN fate = 0 THEN 0 WHEN fate = 3 THEN 2 ELSE 1 END)),
seen AS (SELECT *, row_number() OVER w AS i, rtrim(text, {blank}) AS cut, left(role, 1) AS ini,
                lag(left(role, 1)) OVER w AS before
         FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (SELECT *, CASE WHEN cut = '' THEN 1
                          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                          WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 3
                     ELSE 0 END AS fault FROM seen),
hops(f, g, l, c, x) AS (VALUES {hops}),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS place, CAST(0 AS BIGINT) AS cost, '' AS audit,
         CAST(NULL AS VARCHAR) AS body FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, place, cost, best.audit, best.body FROM (
    SELECT conv_id, i, place, min(cost) AS cost,
           arg_min({{'audit': audit, 'body': body}}, {{'cost': cost, 'audit': audit}}) AS best
    FROM (
      SELECT w.conv_id, j.i, e.place, w.cost + hops.c + e.cost AS cost, w.audit || hops.l || e.l AS audit,
             nullif(concat_ws(chr(10), w.body, nullif(hops.x, ''), e.body), '') AS body
      FROM walk w JOIN hops ON hops.f = w.place
      JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1,
      LATERAL (
        SELECT 'D' AS l, 4 AS cost, hops.g AS place, NULL AS body
        UNION ALL
        SELECT 'K', CASE WHEN fault = 3 THEN 3 ELSE 0 END,
               CASE WHEN ini = 's' THEN 1 WHEN ini = 'u' THEN 2 ELSE 3 END, role || ':' || text
        WHERE fault IN (0, 3) AND ((ini = 's' AND hops.g = 0) OR (ini = 'u' AND hops.g <> 2)
                                   OR (ini = 'a' AND hops.g = 2))
        UNION ALL
        SELECT 'R', CASE WHEN fault = 3 THEN 6 ELSE 3 END, CASE WHEN hops.g = 2 THEN 3 ELSE 2 END,
               CASE WHEN hops.g = 2 THEN 'assistant:' ELSE 'user:' END || text
        WHERE fault IN (0, 3)) e)
    GROUP BY conv_id, i, place)),
ends AS (
  SELECT conv_id, arg_min({{'c': cost, 'a': audit, 'b': body}}, {{'c': cost, 'a': audit}}) AS best FROM (
    SELECT w.conv_id, w.cost + h.c AS cost, w.audit || h.l AS audit,
           coalesce(concat_ws(chr(10), w.body, nullif(h.x, '')), '') AS body
    FROM walk w
    JOIN (SELECT c.conv_id, count(j.i) AS n FROM (SELECT DISTINCT conv_id FROM conversations) c
          LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id) z
      ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i
    JOIN hops h ON h.f = w.place AND (h.g = 3 OR (h.f = 0 AND h.g = 0)))
  GROUP BY conv_id),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
                count_if(i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
         FROM judged GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
       sha256(best.b) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""
