"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words (its weight's share of a budget, never more than
``CAP`` times its size). Document rates stay as close as possible, in relative entropy, to one
copy each, subject to the token constraint of their source and to at most CAP copies:

    minimise sum_i r_i log r_i - r_i   subject to   sum_{i in s} n_i r_i = T_s,   r_i <= CAP

The dual is convex and has one variable per source; its solution tilts rates exponentially,
r_i = min(CAP, exp(lambda_s n_i / mean_s)). Newton iterations solve all sources at once, each a
distributed aggregation over (source, size) counts, kept inside a shrinking bracket. Copies are
rounded over the whole source: in order of size, the expected copies so far are rounded, and a
(source, size) cell gets the difference to the cell before. No prefix is off by more than half a
copy, so a source is off by less than its largest document, however many sizes it has. That rest
is settled with copies of the largest documents that still fit, again and again; and a cell's
copies go to its documents in hash order, so that reruns agree.

DataFrame operations only. Documents of one size in one source are interchangeable, so all but
the first and last step work on the cell counts, whose number is bounded by distinct sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import HOT_SHARE, join_by_key, keep_plan, pick

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
ROUNDS = 60  # Newton iterations at most
TOLERANCE = 1e-9
SETTLING = 8  # corrections of what rounding leaves over
RANKED = 4096  # documents of a cell that are ranked together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, mean, target) per source of ``sizes`` (source, size, m).

    Sources in code-point order (null last) weigh ``weights`` in turn. A target above ``cap``
    times its source stops there and the excess is shared anew, until none is above.
    """
    one = keep_plan(
        sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("docs"))
        .withColumn("_r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)  # one row per source
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_r") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * float(cap)))
    budget = share * float(one.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        full = F.col("limit") <= rate * F.col("weight")
        used, rest = one.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        nxt = (budget - used) / rest if rest else rate
        if nxt <= rate:
            break
        rate = nxt
    return one.select("source", "source_size", (F.col("source_size") / F.col("docs")).alias("mean"),
                      F.least(F.col("limit"), F.lit(rate) * F.col("weight")).alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """(key, tilt) per source key: the dual solution; null where every document gets ``cap`` copies."""
    least = cells.where("size > 0").groupBy("key").agg(F.min("size").alias("n0"))
    state = (targets.join(least, "key").where("target > 0")
             .withColumn("x0", F.col("n0") / F.col("mean"))
             .withColumn("ratio", F.col("target") / F.col("source_size"))
             .withColumn("full", F.col("ratio") >= cap * (1 - 1e-12))
             .select("key", "mean", "target", "full",
                     F.least(F.lit(0.0), F.log("ratio") / F.col("x0")).alias("lo"),
                     F.when(F.col("ratio") <= 1, 0.0).otherwise(F.log(F.lit(float(cap))) / F.col("x0")).alias("hi"),
                     F.log(F.least(F.col("ratio"), F.lit(cap * 0.999))).alias("tilt")))
    state = keep_plan(state.withColumn("tilt", F.greatest("lo", F.least("hi", "tilt"))))
    for _ in range(ROUNDS):
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        sums = (cells.where("size > 0").join(state.where("not full").select("key", "mean", "tilt"), "key").groupBy("key")
                .agg(F.sum(F.col("m") * F.col("size") * F.least(raw, F.lit(float(cap)))).alias("got"),
                     F.sum(F.when(raw < cap, F.col("m") * F.col("size") * x * raw).otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        step = F.col("tilt") - gap / F.col("slope")
        done = F.abs(gap) <= TOLERANCE * F.col("target")
        state = keep_plan(
            state.join(sums, "key", "left").withColumn("_lo", F.coalesce(lo, "lo")).withColumn("_hi", F.coalesce(hi, "hi"))
            .select("key", "mean", "target", "full", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
                    F.when(F.col("full") | done, F.col("tilt"))
                    .when((F.col("slope") > 0) & (step > F.col("_lo")) & (step < F.col("_hi")), step)
                    .otherwise((F.col("_lo") + F.col("_hi")) / 2).alias("tilt"),
                    (F.col("full") | done | (F.col("_hi") - F.col("_lo") < 1e-13)).alias("done")))
        if state.where("not done").isEmpty():
            break
        state = state.drop("done")
    return state.select("key", F.when(~F.col("full"), F.round("tilt", 12)).alias("tilt"))


def rounded(cells: DataFrame, cap: int = CAP) -> DataFrame:
    """``cells`` (key, size, m, target, rate) with ``copies``: whole copies for all m documents together."""
    per = Window.partitionBy("key")
    upward = per.orderBy("size")
    cells = (cells.withColumn("_upto", F.floor(F.sum(F.when(F.col("size") > 0, F.col("rate") * F.col("m")).otherwise(0.0))
                                               .over(upward.rowsBetween(Window.unboundedPreceding, 0)) + 0.5))
             .withColumn("copies", F.least(F.col("m") * cap, F.col("_upto") - F.lag("_upto", 1, 0).over(upward)).cast("long")).drop("_upto"))
    for _ in range(SETTLING):
        gap = F.col("target") - F.col("_taken")
        room = F.when(gap > 0, F.col("m") * cap - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs(gap)) & (room > 0)
        cells = (cells.withColumn("_taken", F.sum(F.col("copies") * F.col("size")).over(per))
                 .withColumn("_pick", F.max(F.when(fits, F.col("size"))).over(per))
                 .withColumn("copies", F.when(
                     F.col("size") == F.col("_pick"),
                     F.col("copies") + F.signum(gap).cast("long") * F.least(room, F.floor(F.abs(gap) / F.col("size")))).otherwise(F.col("copies")))
                 .drop("_taken", "_pick"))
    return cells


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate) for every row of (doc_id, text, source).

    ``size`` counts words, 0 for null, empty and blank texts, whose ``taken`` is 0. A null source is
    a source of its own, last in order. Rows that repeat are documents of their own; among rows
    equal in all of doc_id, size and source it does not matter which gets a copy. A source without words has
    target 0. An empty table gives no rows; other columns are ignored.
    """
    rows = keep_plan(pick(docs, "doc_id", "text", "source").select("doc_id", "source", word_count(F.col("text")).alias("size"))
                     .withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
                     .withColumn("cell", F.xxhash64("key", "size")))
    cells = keep_plan(rows.groupBy("key", "size", "cell").agg(F.count("*").alias("m"), F.first("source").alias("source")))
    targets = keep_plan(source_targets(cells.select("source", "size", "m"), weights, share, cap)
                        .withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source"))
    solved = tilts(cells, targets, cap)
    facts = cells.select("key", "size", "cell", "m").join(targets, "key").join(solved, "key", "left")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("target") <= 0, 0.0).when(F.col("tilt").isNull(), float(cap)).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0)))))
    facts = keep_plan(rounded(facts.withColumn("rate", rate), cap)
                      .select("cell", "m", "source_size", "target", "rate", F.expr("copies div m").alias("each"), F.expr("copies % m").alias("rest")))
    total = rows.count()
    hot = facts.where(F.col("m") * HOT_SHARE > total)
    placed = (join_by_key(rows.select("doc_id", "size", "cell"), facts, "cell", hot)
              .withColumn("_h", F.xxhash64("doc_id", F.lit(11)))
              .withColumn("_part", F.when(F.col("rest") > 0, F.pmod("_h", F.ceil(F.col("m") / F.lit(RANKED)))).otherwise(0)))
    even = placed.where("rest = 0").withColumn("copies", F.col("each"))
    odd = placed.where("rest > 0")
    # ranks inside a cell: a part holds about RANKED documents, and parts follow one another
    parts = odd.groupBy("cell", "_part").agg(F.count("*").alias("_c"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_c").over(
        Window.partitionBy("cell").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    odd = (odd.join(parts, ["cell", "_part"])
           .withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("cell", "_part").orderBy("_h", "doc_id")))
           .withColumn("copies", F.col("each") + (F.col("_rank") <= F.col("rest")).cast("long")))
    cols = ["doc_id", "size", "source_size", "target", "copies", "rate"]
    return (even.select(*cols).unionByName(odd.select(*cols))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"))
