"""Exact median per group by a shrinking bracket, bounded in every task.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer, so a group holding a third of the rows would sit in one
task's memory. This operator stays exact and bounded:

1. ``percentile_approx`` (mergeable, bounded memory per group) gives two cuts
   per group, just below and just above the middle.
2. One pass counts each group's values below, at, between and above its cuts
   (partial aggregation, a few comparisons a row). The counts say in which part
   each of the two middle ranks lies. A rank that falls on a cut is answered.
3. The part that holds an open rank is strictly between two known values. While
   it has more than ``max_ranked`` rows, two cuts around the rank's place are
   taken inside it and step 2 is repeated on that part alone; then its rows,
   at most ``max_ranked`` per group, are ranked.

Equal values never pile up in a part, because a part excludes its ends. The cuts
only affect sizes, never the answer. Even counts average the two middle values;
empty groups produce no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.operators._exec import broadcast_checked, materialize

DEFAULT_ACCURACY = 10000
#: Most rows of one group that are sorted in one task.
MAX_RANKED = 1_000_000
#: Places among which a later round's cuts are chosen, and rounds after which what is left is ranked.
GRID = 64
MAX_ROUNDS = 8


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median",
                 accuracy: int = DEFAULT_ACCURACY, max_ranked: int = MAX_RANKED,
                 materialize_input: bool = True) -> DataFrame:
    """Exact median of ``value`` per ``keys`` group, as column ``out``.

    The narrow input (keys, value) is read a few times (cuts, counts, ranks);
    with ``materialize_input`` it is written once to the shared checkpoint
    folder first, so the upstream plan runs only once.
    """
    v = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    if materialize_input:
        v = materialize(v, "median-input")
    near = min(0.25, 2.0 / accuracy)
    cuts = (v.groupBy(*keys).agg(F.percentile_approx("_v", [0.5 - near, 0.5 + near], accuracy).alias("_c"),
                                 F.count("*").alias("_n")))
    middle = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))
    none = F.lit(None).cast("double")
    state = (cuts.select(*keys, none.alias("_a"), none.alias("_b"), F.element_at("_c", 1).alias("_lo"),
                         F.element_at("_c", 2).alias("_hi"), F.explode(middle).alias("_r"))
             .withColumn("_t", F.col("_r")))
    answers = None
    for turn in range(1, MAX_ROUNDS + 1):
        state = broadcast_checked(state)
        found, parts = _narrowed(v, state, keys)
        answers = found if answers is None else answers.unionByName(found)
        largest = parts.agg(F.max("_size")).first()[0]
        if largest is None:
            break
        if largest <= max_ranked or turn == MAX_ROUNDS:
            answers = answers.unionByName(_ranked(v, parts, keys))
            break
        state = _cuts_inside(v, parts, keys, accuracy)
    return answers.groupBy(*keys).agg(F.avg("_val").alias(out))


def _inside(v: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each state's part: values strictly between its ends (null: open)."""
    return (v.join(state, keys)
            .where((F.col("_a").isNull() | (F.col("_v") > F.col("_a")))
                   & (F.col("_b").isNull() | (F.col("_v") < F.col("_b")))))


def _narrowed(v: DataFrame, state: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(answers (keys, _t, _val), parts (keys, _t, _a, _b, _r, _size)) after counting about the cuts."""
    x, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    counts = (_inside(v, state, keys).groupBy(*keys, "_t", "_a", "_b", "_lo", "_hi", "_r")
              .agg(F.count_if(x < lo).alias("_below"), F.count_if(x == lo).alias("_at_lo"),
                   F.count_if((x > lo) & (x < hi)).alias("_mid"),
                   F.count_if((x == hi) & (hi > lo)).alias("_at_hi"), F.count_if(x > hi).alias("_above")))
    counts = materialize(counts, "median-counts")
    e1 = F.col("_below")
    e2 = e1 + F.col("_at_lo")
    e3 = e2 + F.col("_mid")
    e4 = e3 + F.col("_at_hi")
    r = F.col("_r")
    on_lo, on_hi = (r >= e1) & (r < e2), (r >= e3) & (r < e4)
    found = (counts.where(on_lo | on_hi)
             .select(*keys, "_t", F.when(on_lo, lo).otherwise(hi).alias("_val")))
    part = (F.when(r < e1, F.struct(F.col("_a").alias("_a"), lo.alias("_b"), r.alias("_r"), e1.alias("_size")))
            .when(r < e3, F.struct(lo.alias("_a"), hi.alias("_b"), (r - e2).alias("_r"), F.col("_mid").alias("_size")))
            .otherwise(F.struct(hi.alias("_a"), F.col("_b").alias("_b"), (r - e4).alias("_r"),
                                F.col("_above").alias("_size"))))
    parts = counts.where(~(on_lo | on_hi)).select(*keys, "_t", part.alias("_p")).select(*keys, "_t", "_p.*")
    return found, parts


def _cuts_inside(v: DataFrame, parts: DataFrame, keys: list[str], accuracy: int) -> DataFrame:
    """New cuts about the wanted rank of each part, from evenly spaced places of its rows."""
    places = [i / GRID for i in range(GRID + 1)]
    cols = [*keys, "_t", "_a", "_b", "_r", "_size"]
    cut = (_inside(v, broadcast_checked(parts), keys).groupBy(*cols)
           .agg(F.percentile_approx("_v", places, accuracy).alias("_c")))
    at = F.floor(F.col("_r") * GRID / F.col("_size")).cast("int")
    return cut.select(*keys, "_t", "_a", "_b", "_r",
                      F.element_at("_c", F.greatest(F.lit(1), at)).alias("_lo"),
                      F.element_at("_c", F.least(F.lit(GRID + 1), at + 3)).alias("_hi"))


def _ranked(v: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Answers of the parts that are small enough to sort."""
    order = Window.partitionBy(*keys, "_t").orderBy("_v")
    return (_inside(v, broadcast_checked(parts), keys).withColumn("_rn", F.row_number().over(order) - 1)
            .where(F.col("_rn") == F.col("_r")).select(*keys, "_t", F.col("_v").alias("_val")))
