"""Ordering, splits, batches and step plans.

Every "position in the dataset" comes from the range-partitioned global rank, never
from an unpartitioned window. Randomness is an md5 of (seed, epoch, key), so runs are
reproducible and the same formula works in SQL engines.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.plans.prefix import global_rank

TWO_POW_52 = float(2 ** 52)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_uniform(*parts: str | Column) -> Column:
    """Deterministic uniform in [0, 1): first 13 hex digits of md5(parts joined by ':') / 2^52."""
    s = F.concat_ws(":", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def rank_rows(df: DataFrame, order: Sequence[str | Column], out: str = "rank") -> DataFrame:
    """1-based position in ``order`` (order must be total; add an id tie-break)."""
    return global_rank(df, order, out=out)


def first_n_by_order(df: DataFrame, order: Sequence[str | Column], n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order``; a falsy ``n`` keeps everything."""
    if not n:
        return df
    return rank_rows(df, order, "__r").where(F.col("__r") <= n).drop("__r")


cap_examples = first_n_by_order


def tail_split(df: DataFrame, order: Sequence[str | Column], frac: float = 0.01,
               out: str = "split") -> DataFrame:
    """G1: validation = the last ``max(1, int(frac * n))`` rows, train = the rest.

    n = 1 leaves train empty; n = 0 gives two empty splits.
    """
    ranked = rank_rows(df, order, "__r")
    n = ranked.count()
    n_val = max(1, int(float(frac) * n)) if n else 0
    return ranked.withColumn(
        out, F.when(F.col("__r") > n - n_val, F.lit("validation")).otherwise(F.lit("train"))
    ).drop("__r")


def split_by_document(df: DataFrame, key: str, frac: float = 0.1, seed: int = 0,
                      out: str = "split") -> DataFrame:
    """Whole documents go to one split (u(seed, key) < frac -> validation)."""
    u = md5_uniform(F.lit(seed), key)
    return df.withColumn(out, F.when(u < frac, F.lit("validation")).otherwise(F.lit("train")))


def split_by_content(df: DataFrame, text: str = "text", frac: float = 0.1, seed: int = 0,
                     out: str = "split") -> DataFrame:
    """Equal texts go to one split, whatever their ids: u(seed, digest of the text) < frac."""
    u = md5_uniform(F.lit(seed), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return df.withColumn(out, F.when(u < frac, F.lit("validation")).otherwise(F.lit("train")))


def split_leaks(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys present in both train and validation (must be empty): a semi join."""
    tr = df.where(F.col(split) == "train").select(key).distinct()
    va = df.where(F.col(split) == "validation").select(key).distinct()
    return tr.join(va, key, "left_semi")


def shuffle_order(df: DataFrame, key: str, seed: int, epoch: int = 0,
                  out: str = "shuffle_key") -> DataFrame:
    """A reproducible random order key; sort by (out, key)."""
    return df.withColumn(out, F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)),
                                                 F.col(key).cast("string"))))


ROUNDS, WALKS = 6, 64


def epoch_places(ranked: DataFrame, n: int, seed: int, epochs: int = 1, rank: str = "rank",
                 out: str = "place") -> DataFrame:
    """G4 without a sort: every row once an epoch, with its 0-based ``out`` among the ``n`` rows.

    The place is a keyed permutation of the stored ``rank`` (1..n, see :func:`rank_rows`): rank - 1 is
    a pair (l, r) of an a x b grid, a about sqrt(n) and a * b < n + a; rounds add a keyed md5 of one
    side to the other, which is a bijection of the grid, and a pair beyond n walks on until it is
    inside. At most a * b - n < a pairs lie outside, so ``WALKS`` steps always do for n up to 4096 and
    fail with a chance of n^-32 above, which raises an error rather than repeat a place. All of it is
    local to the row: no exchange for an epoch. n = 0 gives no rows; a null rank gives a null place.
    """
    a = max(isqrt(max(n - 1, 0)) + 1, 1)
    b = max(-(-n // a), 1)

    def drawn(t: Column, v: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), t.cast("string"),
                           v.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")

    def one_round(s: Column, t: Column) -> Column:
        left, right = s["l"], s["r"]
        return F.struct(
            F.when(t % 2 == 0, (left + drawn(t, right)) % a).otherwise(left).alias("l"),
            F.when(t % 2 == 1, (right + drawn(t, left)) % b).otherwise(right).alias("r"))

    def step(x: Column) -> Column:
        # a whole quotient, exact for n below 2^53
        start = F.struct(F.round((x - x % b) / b).cast("long").alias("l"), (x % b).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one_round,
                           lambda s: s["l"] * b + s["r"])

    first = step(F.col(rank).cast("long") - 1)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first,
                         lambda x, _: F.when(x < n, x).otherwise(step(x)))
    rows = ranked.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    placed = rows.withColumn(out, walked)
    return placed.withColumn(out, F.when(F.col(out) >= n, F.raise_error(F.lit("no place found")))
                             .otherwise(F.col(out)))


def assign_batches(df: DataFrame, order: Sequence[str | Column], batch_size: int,
                   drop_last: bool = False, out: str = "batch_id") -> DataFrame:
    """Consecutive groups of ``batch_size`` in ``order``; ``pos_in_batch`` from 0.

    ``drop_last`` drops a final partial batch (pretraining train split).
    """
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    ranked = rank_rows(df, order, "__r")
    if drop_last:
        n = ranked.count()
        ranked = ranked.where(F.col("__r") <= batch_size * (n // batch_size))
    return (ranked.withColumn(out, F.floor((F.col("__r") - 1) / batch_size).cast("long"))
            .withColumn("pos_in_batch", ((F.col("__r") - 1) % batch_size).cast("int"))
            .drop("__r"))


def batch_shape(df: DataFrame, length: str | Column, batch: str = "batch_id",
                static_width: int | None = None) -> DataFrame:
    """Per batch: rows, longest sequence, real tokens, pad waste (dynamic / static)."""
    n = _c(length)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.max(n).alias("max_len"),
            F.sum(n).alias("real_tokens")]
    if static_width is not None:  # rows above the width are cut to it, so they waste nothing
        aggs.append(F.sum(static_width - F.least(n, F.lit(static_width))).alias("static_pad"))
    out = df.groupBy(batch).agg(*aggs)
    return out.withColumn("dynamic_pad", F.col("n_rows") * F.col("max_len") - F.col("real_tokens"))


def plan_steps(batches: DataFrame, epochs: int = 1, batch: str = "batch_id",
               warmup_frac: float = 0.03, evals_per_epoch: int = 10) -> DataFrame:
    """Total steps = batches * epochs, warm-up ``int(0.03 * steps)``,
    evaluation every ``max(1, batches // 10)`` steps."""
    nb = F.count_distinct(batch)
    return batches.agg(nb.alias("n_batches")).select(
        "n_batches",
        (F.col("n_batches") * epochs).alias("total_steps"),
        F.floor(F.col("n_batches") * epochs * F.lit(float(warmup_frac))).cast("long")
        .alias("warmup_steps"),
        F.greatest(F.lit(1), F.floor(F.col("n_batches") / evals_per_epoch)).cast("long")
        .alias("eval_every"))


def cadence(steps: DataFrame, every: int, step: str = "step", skip_zero: bool = False) -> DataFrame:
    """Rows whose step is a multiple of ``every`` (optionally not step 0)."""
    cond = (F.col(step) % every) == 0
    if skip_zero:
        cond = cond & (F.col(step) > 0)
    return steps.where(cond)


def loop_cadence(batches: DataFrame, epochs: int, peek_every: int, eval_every: int,
                 batch: str = "batch_id") -> DataFrame:
    """G8 as the pretraining loop counts: (epoch, step, event) with steps counted from 1 over all epochs.

    ``peek``: one before the first step (step 0) and after every ``peek_every``-th; ``eval``: after
    every ``eval_every``-th, over the first validation batches; ``epoch_end``: after an epoch's last
    step, over all of them, also where an ``eval`` fell on the same step. Rows of ``batches`` that share
    an id are one step, null ids none; without batches only the first peek and the epochs' ends remain.
    """
    ids = batches.where(F.col(batch).isNotNull()).select(batch).distinct()
    n = ids.count()
    every_epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    steps = rank_rows(ids, [batch], "__r").select(every_epoch.alias("epoch"), "__r").select(
        "epoch", (F.col("epoch").cast("long") * n + F.col("__r")).alias("step"))
    one = batches.sparkSession.range(1)
    start = one.select(F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("step"), F.lit("peek").alias("event"))
    ends = one.select(every_epoch.alias("epoch")).select(
        "epoch", ((F.col("epoch") + 1).cast("long") * n).alias("step"), F.lit("epoch_end").alias("event"))
    peeks = cadence(steps, peek_every).withColumn("event", F.lit("peek"))
    evals = cadence(steps, eval_every).withColumn("event", F.lit("eval"))
    return start.unionByName(peeks).unionByName(evals).unionByName(ends)


def subset_batches(df: DataFrame, n: int | None, batch: str = "batch_id") -> DataFrame:
    """The first ``n`` batches (all when ``n`` is None: end of epoch)."""
    return df if n is None else df.where(F.col(batch) < n)
