"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target T and size S should be copied T / S times on average.
The whole part is given to every document; the fraction is rounded by the pivotal method:
two documents transfer probability mass, weighted by their sizes so that the expected words
stay exactly the same, until one of them is at 0 or 1.  Documents meet in buckets of about
``FANOUT``; each bucket decides all its documents but one, whose fraction goes up to the
next level, a reduction tree with one root per source.  Only the root's last fraction is
rounded on its own, so a source misses its target by less than one document's size.

All steps are DataFrame functions.  Random choices are hashes of the ids, so reruns agree
whatever the partitioning.

Defined cases.  A null text has size 0.  A null source is a source, the last one.  Rows
with the same doc_id, source and size are one document: they share one decision.  A null
doc_id is an id like any other.  Documents of size 0 are never taken.  An empty table gives
an empty result.  The only rows that meet in one task are one per source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import hash01, staged, words

#: Documents that meet in one bucket of the reduction tree, on average.
FANOUT = 64
#: A source gives at most so many copies of a document.
MAX_COPIES = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0),
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, n_units and target for each source of ``sizes``.

    Sources in code point order, null last, take the weights in turn and share the total
    size.  A target stops at ``max_copies`` times its source's size; what is cut off is
    shared by weight among the others.  With the sources ordered by cap / weight the capped
    ones come first, and the final share is the largest share any prefix leaves.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                            F.count(F.lit(1)).alias("n_units"))
    # one row per source in these windows
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighted = by_source.select(
        "*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (turn + 1).cast("int")).alias("w"),
        (F.col("source_size") * max_copies).cast("double").alias("cap"))
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    shares = weighted.select(
        "*", ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              / F.sum("w").over(after)).alias("share"))
    return shares.select(
        "source", "source_size", "n_units",
        F.least("cap", F.max("share").over(everything) * F.col("w")).alias("target"))


def _settle(level: int, seed: int) -> Column:
    """Fold a bucket's documents ``g`` (id, a: size, p: fraction) pairwise, largest first, so
    that large ones are settled by the many small ones and what is left tends to be small.

    The state carries the one undecided document and the decided ones; ``bump`` is 1 where
    a document gets one more copy.
    """
    def step(acc, x):
        c = acc["cur"]
        # raise c and lower x by what fits, or the other way round
        up = F.least(1.0 - c["p"], x["p"] * x["a"] / c["a"])
        down = F.least(c["p"], (1.0 - x["p"]) * x["a"] / c["a"])
        raise_c = hash01(F.lit(seed), F.lit(level), c["id"], c["a"], x["id"], x["a"]) \
            * (up + down) < down
        c_full = 1.0 - c["p"] <= x["p"] * x["a"] / c["a"]
        c_empty = c["p"] <= (1.0 - x["p"]) * x["a"] / c["a"]
        c_done = (raise_c & c_full) | (~raise_c & c_empty)
        c_p = F.when(raise_c, F.when(c_full, 1.0).otherwise(c["p"] + up)) \
            .otherwise(F.when(c_empty, 0.0).otherwise(c["p"] - down))
        x_p = F.when(raise_c, F.when(c_full, x["p"] - up * c["a"] / x["a"]).otherwise(0.0)) \
            .otherwise(F.when(c_empty, x["p"] + down * c["a"] / x["a"]).otherwise(1.0))
        x_p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), x_p))
        decided = F.when(c_done, F.struct(c["id"].alias("id"), c["s"].alias("s"),
                                          c_p.cast("int").alias("bump"))) \
            .otherwise(F.struct(x["id"].alias("id"), x["s"].alias("s"), x_p.cast("int").alias("bump")))
        left = F.when(c_done, x.withField("p", x_p)).otherwise(c.withField("p", c_p))
        return F.struct(left.alias("cur"), F.concat(acc["out"], F.array(decided)).alias("out"))

    g = F.col("g")
    start = F.struct(F.element_at(g, 1).alias("cur"),
                     F.array().cast("array<struct<id:bigint,s:bigint,bump:int>>").alias("out"))
    return F.aggregate(F.slice(g, 2, F.size(g)), start, step)


def _level(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree: a row per bucket with its decided documents and the one left."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "id", "s"), F.col("n_buckets"))
    grouped = (units.groupBy("source", "n_buckets", bucket.alias("bucket"))
               .agg(F.sort_array(F.collect_list(F.struct("a", "id", "s", "p")), asc=False).alias("g")))
    return staged(grouped.select("source", "n_buckets", _settle(level, seed).alias("f")),
                  f"mix-level{level}")


def copies(docs: DataFrame, seed: int = 17, fanout: int = FANOUT,
           weights: tuple[float, ...] = (1.0, 2.0, 3.0),
           max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target and copies for each row of ``docs``
    (columns doc_id, source, text)."""
    rows = staged(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long")
                              .alias("size")), "mix-sizes")
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    targets = staged(source_targets(
        units.select("source", (F.col("size") * F.col("m")).alias("size")), weights, max_copies),
        "mix-targets")
    per_copy = F.when(F.col("source_size") > 0,
                      F.least(F.lit(float(max_copies)), F.col("target") / F.col("source_size"))
                      ).otherwise(0.0)
    t = targets.withColumnRenamed("source", "t_source")
    ready = units.join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").select(
        "doc_id", "source", "size", "m", "source_size", "target",
        F.floor(per_copy).alias("whole"), (per_copy - F.floor(per_copy)).alias("p"),
        F.greatest(F.lit(1), F.ceil(F.col("n_units") / fanout)).alias("n_buckets"))
    ready = staged(ready, "mix-units")
    open_units = ready.filter("size > 0 AND p > 0").select(
        "source", "n_buckets", F.col("doc_id").alias("id"), F.col("size").alias("s"),
        (F.col("size") * F.col("m")).cast("double").alias("a"), "p")
    # the deepest source decides the number of levels
    most = targets.agg(F.max("n_units")).first()[0] or 0
    depth, decided = 0, []
    while True:
        done = _level(open_units, depth, seed)
        decided.append(done.select("source", F.inline("f.out")))
        left = done.select("source", "n_buckets", "f.cur.*")
        most = -(-most // fanout)
        depth += 1
        if most <= 1:
            break
        open_units = left.withColumn(
            "n_buckets", F.greatest(F.lit(1), F.ceil(F.col("n_buckets") / fanout)))
    # what is left of each source: one document, rounded on its own
    decided.append(left.select("source", "id", "s", (
        hash01(F.lit(seed), F.lit("root"), F.col("id"), F.col("s")) < F.col("p")
    ).cast("int").alias("bump")))
    bumps = reduce(DataFrame.unionByName, decided).select(
        F.col("source").alias("b_source"), F.col("id").alias("b_id"), F.col("s").alias("b_size"),
        "bump")
    given = ready.join(
        bumps, F.col("doc_id").eqNullSafe(F.col("b_id")) & F.col("source").eqNullSafe(
            F.col("b_source")) & (F.col("size") == F.col("b_size")), "left").select(
        F.col("doc_id").alias("g_id"), F.col("source").alias("g_source"),
        F.col("size").alias("g_size"), "source_size", "target",
        (F.col("whole") + F.coalesce("bump", F.lit(0))).cast("int").alias("copies"))
    return rows.join(
        given, F.col("doc_id").eqNullSafe(F.col("g_id")) & F.col("source").eqNullSafe(
            F.col("g_source")) & (F.col("size") == F.col("g_size"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it."""
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    keyed = keyed.select("_row", F.size(words(F.col("_row.text"))).cast("long").alias("_size"))
    taken = copies(docs, **options).filter("copies > 0").select(
        F.col("doc_id").alias("c_id"), F.col("source").alias("c_source"),
        F.col("size").alias("c_size"), "copies").distinct()
    joined = keyed.join(
        taken, F.col("_row.doc_id").eqNullSafe(F.col("c_id")) & F.col("_row.source").eqNullSafe(
            F.col("c_source")) & (F.col("_size") == F.col("c_size")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_n")) \
        .select("_row.*")
