"""Connected components, and exact linking of rows that share signatures.

Nothing here is collected: labels, links and buckets stay tables, and lineage is
cut by writing small Parquet tables to the shared checkpoint folder.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.operators._exec import materialize, release

#: Open buckets of at most this many rows have all their open pairs tested after
#: the first star; larger ones get stars about more and more centres first.
SMALL_BUCKET = 64
CENTRES = (4, 16, 64)
#: Pairs to test per row of the large buckets, up to which no more stars are needed if the last found little.
AT_ONCE = 512
#: Seconds in which Spark's listeners and its cleaner do what they have at hand.
SETTLE = 0.3
#: Smaller buckets of a row that are looked through for a pair that is met there.
BEFORE = 16


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b); ids are linked iff their roots are equal.

    Contraction: each node moves to its neighbour (or itself) of least random
    priority, links are rewritten to the nodes' new places, and rounds go on
    until no link joins two places: about as many rounds as the logarithm of a
    component's diameter, two for a star. Minima are combined before the
    shuffle, so a hub of any degree costs one row per task.
    """
    def rank(c):
        return F.struct(F.xxhash64(c, F.lit(17)).alias("p"), F.col(c).alias("v"))

    first = edges = materialize(links.select("a", "b").where("a <> b").distinct(), "cc-edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = (both.groupBy("a").agg(F.min(rank("b")).alias("n"))
                .select(F.col("a").alias("node"), F.least(F.col("n"), rank("a")).getField("v").alias("to"))
                .where("node <> to"))
        step = materialize(step, "cc-step")
        steps.append(step)
        before = edges
        for end in ("a", "b"):
            edges = (edges.join(step, edges[end] == step["node"], "left")
                     .withColumn(end, F.coalesce("to", end)).select("a", "b"))
        edges = materialize(edges.where("a <> b")
                            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                            "cc-edges")
        if before is not first:
            release(before)
    ids = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    roots = ids.withColumn("root", F.col("id"))
    for step in steps:
        roots = (roots.join(step, roots["root"] == step["node"], "left")
                 .select("id", F.coalesce("to", "root").alias("root")))
    out = materialize(roots, "cc-roots")
    release(first, edges, *steps)
    return out


def _joined(root: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after more links: components of the old roots that the links join."""
    if root is not None and links.isEmpty():
        release(links)
        return root
    if root is None:
        out = components(links)
        release(links)
        return out
    old = root.select(F.col("id").alias("node"), F.col("root").alias("to"))
    ends = links
    for end in ("a", "b"):
        ends = (ends.join(old, ends[end] == old["node"], "left")
                .withColumn(end, F.coalesce("to", end)).select("a", "b"))
    new = components(ends)
    merged = (root.join(new.select(F.col("id").alias("node"), F.col("root").alias("to")),
                        F.col("root") == F.col("node"), "left")
              .select("id", F.coalesce("to", "root").alias("root")))
    # Ids that met no link before are their own old root.
    first = new.join(root.select("id"), "id", "left_anti")
    out = materialize(merged.unionByName(first), "link-roots")
    release(root, links, new)
    return out


def link_buckets(rows: DataFrame, verify: Callable[[DataFrame], DataFrame],
                 features: DataFrame, allowed: Callable[[str, str], str],
                 more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components (id, root) under exact links, of ids that share a ``sig`` in ``rows`` (sig, id).

    ``rows`` are read once, and deleted if they are a written table. ``more`` gives further
    rows of the ids that share a bucket with another.
    ``verify`` takes distinct pairs (a, b) and returns those that are links.
    ``features`` (id, ...) are small columns from which ``allowed(x, y)``, a
    SQL condition on two rows, can tell at once that a pair is no link; it is
    part of the joins that make pairs.

    Ids that are alike share many buckets. A pair is made in the smallest that it
    shares: each row knows its id's smaller buckets (the BEFORE next ones, which
    bounds a row and only lets some pairs be made twice), and a bucket leaves a pair
    alone that shares one of them.

    A bucket's rows are first tested against one of them, a star; what a star has
    joined needs no further test, nor has a bucket of two rows another pair. Then only pairs of one bucket whose
    components still differ are open. Small buckets have all of them tested;
    in large ones each row is tested, in the largest bucket it is in, against a
    few more centres, which joins rows that are alike at a cost in proportion to
    the rows. Where a star finds so little that all pairs of the large buckets are
    expected to give no more allowed ones than there are rows, and are at most AT_ONCE a row, its
    rows are not alike, and the next turn is the last. What stays open after that is
    tested pair by pair: no link that a bucket holds is lost, while copies are never expanded into all pairs.
    """
    # Rows cross one exchange by sig: the distinct rows and the window both need it.
    bucket = Window.partitionBy("sig")
    print_ = [F.count("*").over(bucket).alias("n"), F.min("id").over(bucket).alias("lo"), F.max("id").over(bucket).alias("hi"),
              *(F.bit_xor(F.xxhash64("id", F.lit(i))).over(bucket).alias(f"x{i}") for i in (1, 2))]
    # Copies share many signatures: buckets that hold the same ids become one, named by its ids.
    def merged(rows: DataFrame) -> DataFrame:
        return (rows.repartition("sig").distinct().select("id", *print_).where("lo <> hi")
                .select(F.xxhash64("n", "lo", "hi", "x1", "x2").alias("sig"), "id", F.col("n").alias("n_rows")).distinct())

    mixed, first = merged(rows), None
    if more is not None:
        first = materialize(mixed, "buckets-first")
        mixed = first.unionByName(merged(more(first.select("id").distinct()))).distinct()
    before = Window.partitionBy("id").orderBy("n_rows", "sig").rowsBetween(-BEFORE, -1)
    active = materialize(mixed.join(features, "id").withColumn("root", F.col("id"))
                         .withColumn("before", F.collect_list("sig").over(before)), "buckets")
    release(rows, *[first] * (first is not None))
    drop_shuffles(rows.sparkSession)
    pairs, root, star, unlike = _star(active, 0, 1, allowed), None, None, False
    for turn, centres in enumerate([*CENTRES, None], start=1):
        root = _joined(root, _links(verify, pairs))
        if star is not None:
            release(star)
        sized = _open(active, root)
        release(active)
        drop_shuffles(rows.sparkSession)
        small, large = sized, None
        if centres is not None and not unlike:
            small, large = sized.where(F.col("n_rows") <= SMALL_BUCKET), sized.where(F.col("n_rows") > SMALL_BUCKET)
            n, tests, ids = large.agg(F.count("*"), F.sum(F.col("n_rows") - 1) / 2, F.approx_count_distinct("id")).first()
            large = large if n else None
        pairs = _all_open(small, allowed)
        if large is None:
            root = _joined(root, _links(verify, pairs.distinct()))
            release(sized)
            break
        home = large.groupBy("id").agg(F.max(F.struct("n_rows", "sig")).alias("h")).select("id", F.col("h.sig").alias("sig"))
        star = materialize(_star(large.join(home, ["id", "sig"]), turn, centres, allowed), "star")
        unlike = tests <= AT_ONCE * n and star.count() * tests <= n * ids * centres
        pairs = pairs.union(star).distinct()
        # The large buckets stay a view of the same table, which is read until the next one is written.
        active = large
        active._written_at = sized._written_at
    return root


def drop_shuffles(spark) -> None:
    """Have the files of shuffles that no plan reads any more deleted: Spark does so once the driver's JVM collects the plan.

    A plan that has just run is still held by the events that tell of its end; a second
    collection, a moment later, finds it free.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(SETTLE)


def _links(verify: Callable[[DataFrame], DataFrame], pairs: DataFrame) -> DataFrame:
    """The verified pairs as a written table, which ``verify`` may already have made."""
    found = verify(pairs)
    return found if hasattr(found, "_written_at") else materialize(found.select("a", "b"), "links")


def _open(active: DataFrame, root: DataFrame) -> DataFrame:
    """Rows, with new roots, of the buckets of over two rows (the star has tested the others) that still hold several components."""
    labelled = (active.where("n_rows > 2").drop("root").join(root, "id", "left")
                .withColumn("root", F.coalesce("root", "id")))
    several = (labelled.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where("lo <> hi").select("sig"))
    return materialize(labelled.join(several, "sig"), "open-buckets")


def _star(rows: DataFrame, turn: int, centres: int, allowed: Callable[[str, str], str]) -> DataFrame:
    """Distinct pairs of each bucket's centres, chosen by a hash of the id, with its rows of other components."""
    rows = rows.drop("n_rows", "before")
    centre = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("p"),
                            F.struct([c for c in rows.columns if c != "sig"]).alias("c"))).alias("m")
    # The least of each of as many slots: partial minima, whatever the bucket's size.
    slot = F.pmod(F.xxhash64("id", F.lit(-turn)), F.lit(centres)).alias("slot")
    chosen = rows.groupBy("sig", slot).agg(centre).select("sig", "m.c.*")
    return _pairs(rows, chosen, f"x.id <> y.id AND x.root <> y.root AND {allowed('x', 'y')}").distinct()


def _all_open(rows: DataFrame, allowed: Callable[[str, str], str]) -> DataFrame:
    """Pairs within a bucket whose components differ and that share no smaller bucket."""
    return _pairs(rows, rows, f"x.id < y.id AND x.root <> y.root AND {allowed('x', 'y')}"
                              " AND NOT arrays_overlap(x.before, y.before)")


def _pairs(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    return (left.alias("x").join(right.alias("y"), F.expr(f"x.sig = y.sig AND {condition}"))
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))
