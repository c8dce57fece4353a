"""License scan by diagonal voting, in DataFrame functions only.

Every text is cut into words; its rolling word k-grams (hash of the leading
pair, then the words themselves) are joined to the positions of the templates'
k-grams. A hit at text word p and template word t votes for the diagonal p - t.
Votes are summed per (text, template, diagonal), neighbouring diagonals are
merged (an inserted or deleted word moves the diagonal by one), and a merged
group is verified: the share of the template's k-grams it covers and the length
of its span in the text. Phrases are templates too; they need every k-gram on
one diagonal, so a phrase's place is exact.

The template table is fixed and small (a few hundred rows), so its broadcast has
a proven bound. The text side is scanned once and never shuffled: only hits and
one header row per document are.

Defined cases: null text is empty; texts without words or hits give n_base 0,
null places, empty labels and score 0; an empty table gives no rows; rows that
repeat an id (or have none) are reported one by one, each for its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.llm.common import doc_table

#: Words are runs of what this pattern excludes, after A-Z are lower-cased (fixed by the contract).
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWERCASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a template k-gram; a phrase is matched by its word pairs.
GRAM = 4
#: Diagonals at most this far apart are merged.
NEIGHBOUR = 3
#: Least share of a template's k-grams, and largest span as a multiple of its words.
COVERAGE = 0.6
STRETCH = 1.6

#: Base phrases and labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Passages of public license texts, with the labels they give.
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including "
     "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
     "copies of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee "
     "is hereby granted provided that the above copyright notice and this permission notice appear in "
     "all copies", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("boost software license version 1 0", "boost"),
]


def template_rows(phrases=PHRASES, passages=PASSAGES) -> list[tuple]:
    """(template, label, is_base, grams, words, tpos, w0, w1, w2, w3) of every template k-gram."""
    rows = []
    for base, items, k in ((True, phrases, 2), (False, passages, GRAM)):
        for text, label in items:
            w = text.split()
            n = len(w) - k + 1
            if n < 1:
                raise ValueError(f"template shorter than {k} words: {text!r}")
            rows += [(text, label, base, n, len(w), i, *w[i:i + k], *[None] * (4 - k)) for i in range(n)]
    return rows


#: Bits of a word pair's hash by which places are screened (fixed: 64 Ki bits).
PAIR_BITS = 16


def needed_words(phrases=PHRASES, passages=PASSAGES) -> list[str]:
    """Words of which a text must hold one for any template to be found in it.

    Long words of each template, as many as leave too few of its k-grams without one
    to reach the coverage that a span needs. A text without any is no match.
    """
    out = set()
    for items, k, least in ((phrases, 2, 1.0), (passages, GRAM, COVERAGE)):
        for text, _ in items:
            w = text.split()
            grams = [w[i:i + k] for i in range(len(w) - k + 1)]
            for word in sorted(set(w), key=lambda v: (-len(v), v)):
                if sum(not out & set(g) for g in grams) < least * len(grams):
                    break
                out.add(word)
    return sorted(out)


def _pair_bits(rows: DataFrame) -> list[int]:
    """64-bit words with a bit set for each template pair."""
    out = [0] * (1 << PAIR_BITS - 6)
    for r in rows.select("pair").distinct().collect():
        place = r["pair"] & (1 << PAIR_BITS) - 1
        out[place >> 6] |= 1 << (place & 63)
    return [v - (1 << 64) if v >> 63 else v for v in out]


TEMPLATE_SCHEMA = ("template string, label string, is_base boolean, n_grams int, t_words int, tpos int, "
                   "t0 string, t1 string, t2 string, t3 string")


def scan(docs: DataFrame, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spans = matched_spans(docs, phrases, passages)
    base = F.col("is_base")
    per_doc = spans.groupBy("doc_id", "text_hash", "n_words").agg(
        F.max("copies").alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"))
    return (per_doc.select(F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))), "*")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                    F.array_join(F.array_sort("all"), ",").alias("labels"), "score"))


def matched_spans(docs: DataFrame, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """Verified spans (template, label, start, end, coverage) and one header row per distinct document.

    A header has a null template and the number of copies of its row.
    """
    spark = docs.sparkSession
    rows = (spark.createDataFrame(template_rows(phrases, passages), TEMPLATE_SCHEMA)
            .withColumn("pair", F.xxhash64("t0", "t1")))
    templates = F.broadcast(rows)
    words = F.array_remove(F.split(F.translate("text", UPPER, LOWERCASE), SEPARATOR), "")
    cut = (doc_table(docs)
           .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
           .select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("w"))
           .withColumn("n", F.size("w")))
    # Of a text's places only those that may begin a template's gram leave its array: a
    # bit of the word pair's hash tells. A place carries its number above the bit's.
    pair = f"xxhash64(get(w, i), get(w, i + 1)) & {(1 << PAIR_BITS) - 1}"
    bits = F.array(*[F.lit(v) for v in _pair_bits(rows)])
    needed = ", ".join("'" + v.replace("'", "''") + "'" for v in needed_words(phrases, passages))
    cut = (cut.withColumn("bits", bits)
           .withColumn("places", F.expr(f"CASE WHEN n >= 2 AND arrays_overlap(w, array({needed})) THEN "
                                        "filter(transform(sequence(0, n - 2), "
                                        f"i -> shiftleft(CAST(i AS BIGINT), {PAIR_BITS}) | ({pair})), "
                                        f"p -> (shiftrightunsigned(get(bits, CAST(shiftright(p & {(1 << PAIR_BITS) - 1}, 6) AS INT)),"
                                        " CAST(p & 63 AS INT)) & 1L) = 1L) ELSE array() END")))
    # Word 0 is a header that matches no template, so each text has a row to count.
    at = f"CAST(shiftright(p, {PAIR_BITS}) AS INT)"
    gram = ", ".join(f"'w{k}', get(w, {at} + {k})" for k in range(4))
    grams = (cut.select("doc_id", "text_hash", F.col("n").cast("bigint").alias("n_words"),
                        F.expr("explode(concat(array(named_struct('at', 0, 'w0', '', 'w1', '', 'w2', '', 'w3', '')), "
                               f"transform(places, p -> named_struct('at', {at} + 1, {gram}))))").alias("g"))
             .select("doc_id", "text_hash", "n_words", "g.*")
             .withColumn("pair", F.xxhash64("w0", "w1")))
    g, t = grams.alias("g"), templates.alias("t")
    same = ((F.col("g.pair") == F.col("t.pair"))
            & (F.col("g.w0") == F.col("t.t0")) & (F.col("g.w1") == F.col("t.t1"))
            & (F.col("t.t2").isNull() | ((F.col("g.w2") == F.col("t.t2")) & (F.col("g.w3") == F.col("t.t3")))))
    hits = (g.join(t, same, "left").where(F.col("template").isNotNull() | (F.col("at") == 0))
            .withColumn("diagonal", F.col("at") - 1 - F.col("tpos")))
    # One row per (text, template, diagonal, template word): repeated rows meet here.
    votes = hits.groupBy("doc_id", "text_hash", "n_words", "template", "label", "is_base", "n_grams",
                         "t_words", "diagonal", "tpos").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal", "tpos")
    apart = F.when(F.col("is_base"), F.lit(0)).otherwise(F.lit(NEIGHBOUR))
    merged = (votes.withColumn("step", F.when(F.col("diagonal") - F.lag("diagonal").over(order) > apart, 1)
                               .otherwise(0))
              .withColumn("chain", F.sum("step").over(order)))
    word = F.col("diagonal") + F.col("tpos")
    spans = (merged.groupBy("doc_id", "text_hash", "n_words", "template", "label", "is_base", "n_grams",
                            "t_words", "chain")
             .agg(F.max("copies").alias("copies"), F.countDistinct("tpos").alias("covered"),
                  F.min(word).alias("start"), F.max(word).alias("last")))
    k = F.when(F.col("is_base"), F.lit(2)).otherwise(F.lit(GRAM))
    least = F.when(F.col("is_base"), F.lit(1.0)).otherwise(F.lit(COVERAGE))
    spans = (spans.withColumn("coverage", F.col("covered") / F.col("n_grams"))
             .withColumn("end", F.col("last") + k))
    good = ((F.col("coverage") >= least)
            & (F.col("end") - F.col("start") <= F.lit(STRETCH) * F.col("t_words")))
    return (spans.where(F.col("template").isNull() | good)
            .select("doc_id", "text_hash", "n_words", "copies", "template", "label", "is_base",
                    F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"),
                    "coverage"))


def oracle_sql(phrases=PHRASES, passages=PASSAGES) -> str:
    """The same result in DuckDB SQL, by joining the words themselves."""
    def lit(v):
        return "NULL" if v is None else str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in template_rows(phrases, passages))
    return f"""
WITH t(template, label, is_base, n_grams, t_words, tpos, t0, t1, t2, t3) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERCASE}'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT rid, w, unnest(range(len(w))) AS p FROM d),
v AS (SELECT DISTINCT g.rid, t.template, label, is_base, n_grams, t_words, p - tpos AS diagonal, tpos
      FROM g JOIN t ON w[p + 1] = t0 AND w[p + 2] = t1
       AND (t2 IS NULL OR (w[p + 3] = t2 AND w[p + 4] = t3))),
s AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal, tpos)
                          > (CASE WHEN is_base THEN 0 ELSE {NEIGHBOUR} END) THEN 1 ELSE 0 END AS step FROM v),
m AS (SELECT *, sum(step) OVER (PARTITION BY rid, template ORDER BY diagonal, tpos
                                ROWS UNBOUNDED PRECEDING) AS chain FROM s),
c AS (SELECT rid, template, label, is_base, t_words, count(DISTINCT tpos) / n_grams AS coverage,
             min(diagonal + tpos) AS first_at,
             max(diagonal + tpos) + (CASE WHEN is_base THEN 2 ELSE {GRAM} END) AS stop_at
      FROM m GROUP BY rid, template, label, is_base, t_words, n_grams, chain),
k AS (SELECT * FROM c WHERE coverage >= (CASE WHEN is_base THEN 1.0 ELSE {COVERAGE} END)
                        AND stop_at - first_at <= {STRETCH} * t_words)
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words,
       CAST(count(*) FILTER (WHERE k.is_base) AS BIGINT) AS n_base,
       CAST(min(first_at) FILTER (WHERE k.is_base) AS BIGINT) AS first_word,
       CAST(max(first_at) FILTER (WHERE k.is_base) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE k.is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(coverage), 0.0) AS score
FROM d LEFT JOIN k ON d.rid = k.rid GROUP BY d.rid, d.doc_id"""
