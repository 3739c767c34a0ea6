"""Mixing sources to target weights by entropy balancing.

Each document i gets a rate r_i between 0 and 2 that stays as close as it can,
in (binary) relative entropy, to the mix's overall rate, subject to one token
constraint per source: sum of size_i * r_i = target.  The convex dual has one
variable per source, and its solution is an exponential tilt of the odds,
r_i = 2 * sigmoid(b + lambda_source * size_i / scale).  Newton's method finds the
lambdas of all sources at once; an iteration is one distributed aggregation over
(source, size) counts, the exact statistic of the dual, not over the documents.

Rates become copies by systematic rounding along the sizes of a source, and a
few exact corrections of what rounding left over.  All sums are whole numbers
(thousandths of a token), so reruns agree whatever the order of addition.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, discard, materialize, table

KEY = ["src", "no_src"]  # source with null as '', and whether it was null


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE}]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """``src, no_src, source_size, target`` from ``(src, no_src, size, n)``: water-filling, one row per source.

    Sources that would exceed ``cap`` times their size are those of smallest
    size to weight, so the level at which the rest share is a prefix sum.
    """
    total = sizes.groupBy(*KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    by_name = Window.orderBy("no_src", "src")
    ws = F.array(*[F.lit(float(w)) for w in weights])
    s = total.withColumn("w", F.get(ws, (F.row_number().over(by_name) - 1) % len(weights))).withColumn("most", cap * F.col("source_size"))
    s = s.withColumn("all", share * F.sum("source_size").over(Window.partitionBy()))
    up = Window.orderBy(F.col("most") / F.col("w"), "no_src", "src")
    below = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("full", F.col("most") / F.col("w") * rest + below <= F.col("all"))
    every = Window.partitionBy()
    left = F.col("all") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0.0))
    level = left / F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    return s.select(*KEY, "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.least("most", F.col("w") * level)).alias("target"), "most")


def solve(sizes: DataFrame, goals: DataFrame, base: float, most: float, steps: int = 60) -> DataFrame:
    """``goals`` with ``lam`` and ``scale``: Newton steps on the dual, kept inside a bracket, until within half a token or 1e-6."""
    scale = F.sum(F.col("size") * F.col("n")) / F.sum("n")
    state = sizes.groupBy(*KEY).agg(scale.alias("scale")).join(goals, KEY)
    inner = (F.col("target") > 0) & (F.col("target") < F.col("most") * (1 - 1e-12))
    state = materialize(state.withColumns({"lam": F.lit(0.0), "lo": F.lit(-1e9), "hi": F.lit(1e9), "open": inner}), "mix-dual")
    b = math.log(base / (most - base))
    for _ in range(steps):
        if state.filter("open").isEmpty():
            break
        old = state
        x = F.col("size") / F.col("scale")
        p = 1 / (1 + F.exp(-(F.lit(b) + F.col("lam") * x)))
        tokens = F.col("n") * F.col("size") * most
        milli = lambda c: F.sum(F.round(c * 1000).cast("long"))
        sums = sizes.join(state.filter("open"), KEY).groupBy(*KEY).agg(milli(tokens * p).alias("got"), milli(tokens * x * p * (1 - p)).alias("slope"))
        gap = F.col("got") / 1000 - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        near = F.greatest(F.lit(4.0), 3 * F.abs("lam"))
        step = F.when(F.col("slope") > 0, F.greatest(-near, F.least(near, -gap / (F.col("slope") / 1000)))).otherwise(-near * F.signum(gap))
        new = F.round(F.col("lam") + step, 9)
        new = F.when((new > lo) & (new < hi), new).otherwise(F.round((lo + hi) / 2, 9))
        done = (F.abs(gap) <= F.greatest(F.lit(0.5), 1e-6 * F.col("target"))) | (hi - lo < 2e-9)
        state = state.join(sums, KEY, "left").select(
            *KEY, "scale", "source_size", "target", "most",
            F.when(F.col("open") & ~done, new).otherwise(F.col("lam")).alias("lam"), F.when(F.col("open"), lo).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("open"), hi).otherwise(F.col("hi")).alias("hi"), (F.col("open") & ~F.coalesce(done, F.lit(True))).alias("open"),
        )
        state = materialize(state, "mix-dual")
        discard(old)
    return state


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    fixes: int = 5,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies, taken``, one row per input row.

    Sources in code-point order, null last, weigh ``weights``, repeating, and
    share ``share`` of all words; a target stops at ``most`` times its source.
    ``taken = copies * size`` with copies 0 to ``most``.  A document without
    words has rate and copies 0.  After rounding, a source misses its target by
    less than the smallest document that could still be added or taken away,
    or by what ``fixes`` rounds of correction left.  Rows repeating an id are
    documents of their own; an empty table gives no rows.  Columns ``ties``
    decide between rows of one id and are returned too.
    """
    src = F.col(source_col).cast("string")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(src, F.lit("")).alias("src"), src.isNull().alias("no_src"), n_words(F.col(text_col)).alias("size"), *ties)
    narrow = materialize(narrow, "mix-sizes")
    sizes = materialize(narrow.groupBy(*KEY, "size").agg(F.count("*").alias("n")), "mix-counts")
    goals = materialize(targets(sizes, weights, share, most), "mix-targets")
    dual = solve(sizes.filter("size > 0"), goals.filter("source_size > 0"), share, most)
    b = math.log(share / (most - share))
    tilt = most / (1 + F.exp(-(F.lit(b) + F.col("lam") * F.col("size") / F.col("scale"))))
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= F.col("most") * (1 - 1e-12), float(most)).otherwise(tilt)
    rated = sizes.filter("size > 0").join(dual.select(*KEY, "scale", "target", "most", "lam"), KEY).select(*KEY, "size", "n", "target", rate.alias("rate"))
    along = Window.partitionBy(*KEY).orderBy("size")  # rows are distinct sizes: bounded by the longest document
    part = F.col("n") * F.col("rate") - F.floor(F.col("n") * F.col("rate"))
    rated = rated.withColumn("cum", F.round(F.sum(part).over(along), 6))
    extra = F.floor(F.col("cum") + 0.5) - F.floor(F.coalesce(F.lag("cum").over(along), F.lit(0.0)) + 0.5)
    k = F.least(F.col("n") * most, F.greatest(F.lit(0), F.floor(F.col("n") * F.col("rate")) + extra)).cast("long")
    plan = materialize(rated.withColumn("k", k).drop("cum"), "mix-plan")
    discard(dual, sizes)
    for _ in range(fixes):
        off = plan.groupBy(*KEY).agg(F.round(F.first("target") - F.sum(F.col("k") * F.col("size"))).cast("long").alias("off"))
        room = F.when(F.col("off") > 0, F.col("n") * most - F.col("k")).otherwise(F.col("k"))
        fit = plan.join(off, KEY).filter((room > 0) & (F.col("size") <= F.abs("off")))
        pick = fit.groupBy(*KEY).agg(F.max("size").alias("size"), F.first("off").alias("off"))
        pick = materialize(pick.select(*KEY, "size", F.col("off").alias("fix")), "mix-fix")
        if pick.isEmpty():
            break
        room = F.when(F.col("fix") > 0, F.col("n") * most - F.col("k")).otherwise(F.col("k"))
        move = F.signum("fix") * F.least(room, F.floor(F.abs("fix") / F.col("size")))
        fixed = plan.join(pick, [*KEY, "size"], "left").withColumn("k", (F.col("k") + F.coalesce(move, F.lit(0))).cast("long")).drop("fix")
        old, plan = plan, materialize(fixed, "mix-plan")
        discard(old, pick)
    # Documents of equal source and size share k copies: k div n each, one more for the first k mod n by a hash of the id.
    # Ranks are counted inside sub-buckets of about 256 documents, so that a hot (source, size) is dealt over many tasks.
    each = narrow.join(plan.select(*KEY, "size", "n", "k", "rate"), [*KEY, "size"], "left").withColumn("more", F.coalesce(F.col("k") % F.col("n"), F.lit(0)))
    each = each.withColumn("h", F.xxhash64("doc_id", F.lit("mix"))).withColumn("sub", F.expr("CASE WHEN more > 0 THEN pmod(h, ceil(n / 256)) END"))
    each = materialize(each, "mix-docs")
    discard(narrow, plan)
    whole = F.coalesce(F.floor(F.col("k") / F.col("n")), F.lit(0)).cast("long")
    even = each.filter("more = 0").withColumn("copies", whole)
    odd = each.filter("more > 0")
    group = [*KEY, "size"]
    subs = odd.groupBy(*group, "sub").agg(F.count("*").alias("in_sub"))
    before = Window.partitionBy(*group).orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.withColumn("before", F.coalesce(F.sum("in_sub").over(before), F.lit(0)))
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*group, "sub").orderBy("h", "doc_id", *ties))
    odd = odd.join(subs, [*group, "sub"]).withColumn("copies", whole + F.when(rank <= F.col("more"), 1).otherwise(0))
    done = even.select("doc_id", *KEY, "size", "rate", "copies", *ties).union(odd.select("doc_id", *KEY, "size", "rate", "copies", *ties))
    return done.join(goals, KEY).select(
        "doc_id", "size", "source_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"), "copies", (F.col("copies") * F.col("size")).alias("taken"),
        F.when(~F.col("no_src"), F.col("src")).alias("source"), *ties,
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
