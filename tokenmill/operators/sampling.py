"""Per-group candidate selection: one decode step as a relational job.

Input is a long table ``(group, item, logit)``. Order of the steps (fixed):
repetition penalty -> greedy (T = 0) | temperature -> top-k -> top-p -> softmax -> draw.

Per-group max / sum and the argmax are hash aggregates joined back (a hot group is
pre-aggregated, and AQE splits the skewed join); top-k is ``rank() <= k`` which Spark
limits per partition before the shuffle; top-p and the draw find their cut by histograms
of the probability's bits, so only the rows at the cut of a group are put in order. Every
ordering has an item tie-break, and randomness is an md5 uniform of (seed, group), so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.operators.ordering import md5_uniform
from tokenmill.plans.prefix import grouped_offsets, materialize


def repetition_penalty(df: DataFrame, history: DataFrame, rho: float, group: str = "group_id",
                       item: str = "item_id", logit: str = "logit", signed: bool = False) -> DataFrame:
    """Divide a logit by ``rho`` once per occurrence of the item in the group's history
    (n occurrences -> rho**n). Negative logits therefore move up, as in the reference;
    ``signed=True`` multiplies negative logits instead. rho == 1 is a no-op."""
    if rho == 1.0:
        return df
    counts = history.groupBy(group, item).agg(F.count(F.lit(1)).alias("__n"))
    j = df.join(counts, [group, item], "left")
    f = F.pow(F.lit(float(rho)), F.coalesce(F.col("__n"), F.lit(0)))
    new = (F.when(F.col(logit) < 0, F.col(logit) * f).otherwise(F.col(logit) / f) if signed
           else F.col(logit) / f)
    return j.withColumn(logit, new).drop("__n")


def greedy(df: DataFrame, group: str = "group_id", item: str = "item_id", logit: str = "logit"
           ) -> DataFrame:
    """Argmax per group (lowest item id on ties)."""
    return df.groupBy(group).agg(F.max_by(item, F.struct(F.col(logit), -F.col(item))).alias(item))


def temperature(df: DataFrame, t: float, logit: str = "logit") -> DataFrame:
    """``logit / T`` (T > 0; T == 0 means greedy)."""
    if t <= 0:
        raise ValueError("temperature must be > 0 (use greedy for 0)")
    return df.withColumn(logit, F.col(logit) / F.lit(float(t)))


def softmax(df: DataFrame, group: str = "group_id", logit: str = "logit", out: str = "prob"
            ) -> DataFrame:
    """Max-shifted softmax per group (aggregate + join; no sort)."""
    mx = df.groupBy(group).agg(F.max(logit).alias("__mx"))
    e = df.join(mx, group).withColumn("__e", F.exp(F.col(logit) - F.col("__mx"))).drop("__mx")
    s = e.groupBy(group).agg(F.sum("__e").alias("__s"))
    return e.join(s, group).withColumn(out, F.col("__e") / F.col("__s")).drop("__e", "__s")


def top_k(df: DataFrame, k: int | None, group: str = "group_id", logit: str = "logit") -> DataFrame:
    """Keep logits >= the k-th largest (ties at the threshold all stay). 0/None = off;
    k larger than the group keeps everything."""
    if not k:
        return df
    w = Window.partitionBy(group).orderBy(F.col(logit).desc())
    return df.withColumn("__rk", F.rank().over(w)).where(F.col("__rk") <= k).drop("__rk")


DIGIT, DIGITS = 12, 5  # bits of the probability read by a histogram round, and rounds at most
MAX_WINDOW_ROWS = 65_536  # rows of a group that may meet in one window
MAX_BROADCAST_CUTS = 1_000_000


def _drawable(df: DataFrame, logit: str) -> DataFrame:
    z = F.col(logit)
    return df.where(z.isNotNull() & ~F.isnan(z) & (z > float("-inf")))


def _first_mass(df: DataFrame, group: str, item: str, logit: str, prob: str, mass: Column,
                bound: int) -> DataFrame:
    """Softmax as ``prob``, and of each group the rows before which, in (prob desc, item asc) order,
    less than ``mass`` lies.

    Where no group has more than ``bound`` rows, a window a group is the whole plan. Else radix
    selection: a group of more than ``bound`` rows is narrowed by histograms of its probability
    mass over ``DIGIT`` bits of the probability at a time. The lowest digit with less than ``mass``
    before it holds the cut: rows above it stay, rows below it go, and only its own rows meet the next
    round. What is left, at most ``bound`` rows, is put in order by a window. More rows than that share
    all bits only where they tie; those are numbered over range partitions. No other row is sorted.
    """
    order = [F.col(prob).desc(), F.col(item).asc()]
    window = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum(prob).over(window), F.lit(0.0))
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0]
    df = softmax(df, group, logit, prob)
    if (largest or 0) <= bound:
        return df.withColumn("__before", ahead).where(F.col("__before") < mass).drop("__before")
    bits = DIGIT * DIGITS
    q = F.least((F.col(prob) * float(2 ** bits)).cast("long"), F.lit(2 ** bits - 1))
    rows = materialize(df.withColumn("__q", q), "first_mass")
    cuts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).select(
        group, mass.alias("__mass"), F.lit(bits).alias("__shift"), F.lit(0).cast("long").alias("__head"),
        F.lit(0.0).alias("__base"), (F.col("__n") > bound).alias("__open"))
    cuts = materialize(cuts, "first_mass_cuts")
    closed = cuts.where(~F.col("__open"))
    for shift in range(bits - DIGIT, -1, -DIGIT):
        live = cuts.where("__open")
        if live.isEmpty():
            break
        lane = rows.select(group, prob, "__q").join(_small(live), group).where(
            F.shiftright("__q", shift + DIGIT) == F.col("__head"))
        digits = lane.groupBy(group, "__mass", "__base", F.shiftright("__q", shift).alias("__at")).agg(
            F.sum(prob).alias("__m"), F.count(F.lit(1)).alias("__n"))
        above = Window.partitionBy(group).orderBy(F.col("__at").desc()).rowsBetween(
            Window.unboundedPreceding, -1)  # at most 2^DIGIT rows a group
        before = digits.withColumn("__base", F.col("__base") + F.coalesce(F.sum("__m").over(above), F.lit(0.0)))
        cut = before.where(F.col("__base") < F.col("__mass")).groupBy(group, "__mass").agg(
            F.min(F.struct("__at", "__base", "__n")).alias("__cut"))
        cuts = materialize(cut.select(
            group, "__mass", F.lit(shift).alias("__shift"), F.col("__cut.__at").alias("__head"),
            F.col("__cut.__base").alias("__base"), (F.col("__cut.__n") > bound).alias("__open")),
            "first_mass_cuts")
        closed = closed.unionByName(cuts.where(~F.col("__open")))
    ties = cuts.where("__open")
    at = F.expr("shiftright(__q, __shift)")
    placed = rows.join(_small(closed.unionByName(ties)), group)
    inside = placed.where(at > F.col("__head"))
    edge = placed.where(at == F.col("__head"))
    parts = [edge.where(~F.col("__open")).withColumn("__before", ahead)]
    if not ties.isEmpty():
        parts.append(grouped_offsets(edge.where("__open"), [group], order, prob, "__before"))
    for part in parts:
        inside = inside.unionByName(
            part.where(F.col("__base") + F.col("__before") < F.col("__mass")).drop("__before"))
    return inside.drop("__q", "__mass", "__shift", "__head", "__base", "__open")


def _small(cuts: DataFrame) -> DataFrame:
    """One row a group: broadcast when a count shows that it is small."""
    return F.broadcast(cuts) if cuts.count() <= MAX_BROADCAST_CUTS else cuts


def top_p(df: DataFrame, p: float | None, group: str = "group_id", item: str = "item_id",
          logit: str = "logit", bound: int = MAX_WINDOW_ROWS) -> DataFrame:
    """Nucleus filter over the renormalised probabilities: keep an item while the
    probability mass strictly before it is < p (so at least one item stays). 0/None = off.

    Items of equal probability count in item order. Null and NaN logits and those of minus infinity
    are never kept, nor are rows of a null group; p of 1 or more keeps all others. ``bound`` is the
    number of rows of a group that one task may put in order (see :func:`_first_mass`).
    """
    if not p:
        return df
    kept = _drawable(df, logit).where(F.col(group).isNotNull())
    if p >= 1:
        return kept
    return _first_mass(kept, group, item, logit, "__p", F.lit(float(p)), bound).drop("__p")


def sample_race(df: DataFrame, seed: int, group: str = "group_id", item: str = "item_id",
                logit: str = "logit") -> DataFrame:
    """J6 by exponential races: every item gets an arrival time with rate ``exp(logit)`` from a keyed
    uniform, and the first to arrive is drawn, which happens with probability softmax(logit).

    One aggregate a group and nothing else: no softmax, no order of the items, no join; a hot group
    is reduced before the shuffle. Times are compared as logarithms, so large logits do not
    overflow. Null and NaN logits, and those of minus infinity, are never drawn (a group of none
    else has no row); among equal times the smallest item wins; rows of an item that is repeated
    share their draw.
    """
    u = (md5_uniform(F.lit(seed), F.col(group), F.col(item)) + F.lit(2.0 ** -53))  # inside (0, 1)
    late = F.log(-F.log(u)) - F.col(logit)
    return _drawable(df, logit).groupBy(group).agg(F.min_by(item, F.struct(late, F.col(item))).alias(item))


def sample(df: DataFrame, seed: int, group: str = "group_id", item: str = "item_id",
           logit: str = "logit", bound: int = MAX_WINDOW_ROWS) -> DataFrame:
    """Draw one item per group with probability softmax(logit): the first item (by
    prob desc, item asc) whose inclusive cumulative probability reaches u(seed, group);
    the last item when rounding leaves the total just below u.

    That item is the last one with less than u before it, so it is found by the same selection as
    the nucleus, without an order of all items. Null, NaN and minus infinite logits are never drawn.
    """
    u = F.greatest(md5_uniform(F.lit(seed), F.col(group)), F.lit(5e-324))
    rows = _drawable(df, logit).where(F.col(group).isNotNull())
    reached = _first_mass(rows, group, item, logit, "prob", u, bound)
    return reached.groupBy(group).agg(F.max_by(item, F.struct(-F.col("prob"), F.col(item))).alias(item))


def decode_step(df: DataFrame, history: DataFrame | None = None, rho: float = 1.0,
                t: float = 1.0, k: int | None = None, p: float | None = None, seed: int = 0,
                group: str = "group_id", item: str = "item_id", logit: str = "logit") -> DataFrame:
    """One generation step for every group: penalty -> greedy | T -> top-k -> top-p -> draw."""
    x = df.select(group, item, logit)
    if history is not None:
        x = repetition_penalty(x, history, rho, group, item, logit)
    if t == 0:
        return greedy(x, group, item, logit)
    x = top_p(top_k(temperature(x, t, logit), k, group, logit), p, group, item, logit)
    return sample(x, seed, group, item, logit)


def cut_at_stop(df: DataFrame, ids: str, stops: Sequence, out: str | None = None,
                keep_stop: bool = True) -> DataFrame:
    """Stop each sequence at its own first stop token (unchanged when none occurs)."""
    return df.withColumn(out or ids, A.cut_at_stop(ids, list(stops), keep_stop))
