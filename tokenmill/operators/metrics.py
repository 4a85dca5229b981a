"""Loss and metric reductions.

All are ordinary partial + final hash aggregates. Numerically stable forms:
``softplus(x) = max(x, 0) + log1p(exp(-|x|))``; log-sum-exp is max-shifted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.config import IGNORE_INDEX


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softplus(x: str | Column) -> Column:
    x = _c(x)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def bt_loss(r_chosen: str | Column, r_rejected: str | Column) -> Column:
    """H5 per pair: BCE-with-logits(margin, 1) = softplus(-(r_c - r_r))."""
    return softplus(-(_c(r_chosen) - _c(r_rejected)))


def pairwise_ce(r_chosen: str | Column, r_rejected: str | Column) -> Column:
    """2-class cross-entropy over [r_c, r_r] with class 0 (equals BT loss)."""
    a, b = _c(r_chosen), _c(r_rejected)
    m = F.greatest(a, b)
    return m + F.log(F.exp(a - m) + F.exp(b - m)) - a


def preference_metrics(df: DataFrame, by: Sequence[str] = (), r_chosen: str = "r_chosen",
                       r_rejected: str = "r_rejected", l2: float = 0.0) -> DataFrame:
    """H5-H8: loss, bt, reg (already scaled by lambda), acc (strict >), mean rewards, margin."""
    rc, rr = F.col(r_chosen), F.col(r_rejected)
    aggs = [
        F.avg(bt_loss(rc, rr)).alias("bt"),
        (F.avg(rc * rc + rr * rr) * F.lit(float(l2))).alias("reg"),
        F.avg((rc > rr).cast("double")).alias("acc"),
        F.avg(rc).alias("r_chosen"), F.avg(rr).alias("r_rejected"),
        F.count(F.lit(1)).alias("n_pairs"),
    ]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return (g.withColumn("loss", F.col("bt") + F.col("reg"))
            .withColumn("margin", F.col("r_chosen") - F.col("r_rejected"))
            .withColumn("midpoint", (F.col("r_chosen") + F.col("r_rejected")) / 2))


def pair_verdicts(df: DataFrame, r_chosen: str = "r_chosen", r_rejected: str = "r_rejected"
                  ) -> DataFrame:
    """H9: per pair margin and a strict verdict mark."""
    m = F.col(r_chosen) - F.col(r_rejected)
    return df.withColumn("margin", m).withColumn(
        "verdict", F.when(m > 0, F.lit("✓")).otherwise(F.lit("✗")))


def epoch_mean(per_batch: DataFrame, metrics: Sequence[str], by: Sequence[str] = (),
               weight: str = "n_pairs") -> DataFrame:
    """H4: ``macro`` = mean of batch means (the reference), ``micro`` = row-weighted mean."""
    macro = [F.avg(m).alias(m) for m in metrics]
    micro = [(F.sum(F.col(m) * F.col(weight)) / F.sum(weight)).alias(m) for m in metrics]
    a = (per_batch.groupBy(*by).agg(*macro) if by else per_batch.agg(*macro)).withColumn(
        "mode", F.lit("macro"))
    b = (per_batch.groupBy(*by).agg(*micro) if by else per_batch.agg(*micro)).withColumn(
        "mode", F.lit("micro"))
    return a.unionByName(b)


def accumulate_metrics(records: DataFrame, metrics: Sequence[str], by: Sequence[str] = (),
                       type_col: str | None = "type") -> DataFrame:
    """H10 + L1: unpivot any metric columns, average each key, name it ``type/metric``."""
    ids = list(by) + ([type_col] if type_col else [])
    long = records.unpivot(ids, list(metrics), "metric", "value")
    g = long.groupBy(*ids, "metric").agg(F.avg("value").alias("value"))
    if type_col:
        g = g.withColumn("key", F.concat_ws("/", F.col(type_col), F.col("metric")))
    return g


def log_sum_exp(df: DataFrame, group: Sequence[str], logit: str = "logit") -> DataFrame:
    """Per group max-shifted log-sum-exp (two aggregates and a join, no sort)."""
    g = list(group)
    mx = df.groupBy(*g).agg(F.max(logit).alias("__mx"))
    s = df.join(mx, g).groupBy(*g).agg(
        F.first("__mx").alias("__mx"), F.sum(F.exp(F.col(logit) - F.col("__mx"))).alias("__s"))
    return s.select(*g, (F.log("__s") + F.col("__mx")).alias("lse"))


def token_nll(logits: DataFrame, targets: DataFrame, group: Sequence[str], item: str = "item_id",
              logit: str = "logit", target: str = "target_id") -> DataFrame:
    """H1: cross-entropy per group = logsumexp(logits) - logit[target]."""
    g = list(group)
    lse = log_sum_exp(logits, g, logit)
    tl = logits.join(targets.withColumnRenamed(target, item), g + [item]).select(
        *g, F.col(logit).alias("target_logit"))
    return lse.join(tl, g).withColumn("nll", F.col("lse") - F.col("target_logit"))


def masked_mean(values: str | Column, labels: str | Column, ignore=IGNORE_INDEX) -> Column:
    """H2: mean over positions whose label is not ``ignore`` (null when none)."""
    return F.avg(F.when(_c(labels) != F.lit(ignore), _c(values)))


def perplexity(mean_nll: str | Column) -> Column:
    """H3."""
    return F.exp(_c(mean_nll))


def compare_runs(log: DataFrame, run: str = "run", value: str = "value", bucket: str = "epoch"
                 ) -> DataFrame:
    """(bucket, run, mean_value) for every run of the log."""
    return log.groupBy(bucket, run).agg(F.avg(value).alias("mean_value"))


def runs_side_by_side(log: DataFrame, runs: Sequence[str], values: Sequence[str], run: str = "run",
                      bucket: str = "epoch") -> DataFrame:
    """One row a bucket with ``<run>_<value>``, the mean of every value in every given run, and
    ``<run>_<value>_diff`` against the first run. The runs are named by the caller, so the columns are
    known before the data is read and one aggregate does all. A run without rows in a bucket is null
    there; rows of other runs only keep their bucket."""
    means = [F.avg(F.when(F.col(run) == r, F.col(v))).alias(f"{r}_{v}") for r in runs for v in values]
    table = log.groupBy(bucket).agg(*means)
    return table.select(bucket, *[f"{r}_{v}" for r in runs for v in values], *[
        (F.col(f"{r}_{v}") - F.col(f"{runs[0]}_{v}")).alias(f"{r}_{v}_diff") for r in runs[1:] for v in values])


def first_last(log: DataFrame, run: str = "run", step: str = "step", value: str = "value"
               ) -> DataFrame:
    """First and final value per run."""
    return log.groupBy(run).agg(F.min_by(value, step).alias("first_value"),
                                F.max_by(value, step).alias("final_value"))


def best_step(log: DataFrame, run: str = "run", step: str = "step", value: str = "value"
              ) -> DataFrame:
    """Where the value bottoms (earliest step on ties)."""
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col(step).alias("s")),
                    F.struct(F.col(value), F.col(step)))
    return log.groupBy(run).agg(best.alias("__b")).select(
        run, F.col("__b.s").alias("best_step"), F.col("__b.v").alias("best_value"))


def uniform_baseline(tokens: DataFrame, token: str = "token") -> DataFrame:
    """A uniform guess over V types: loss ln V, perplexity V."""
    return tokens.agg(F.count_distinct(token).alias("vocab_size")).select(
        "vocab_size", F.log(F.col("vocab_size").cast("double")).alias("uniform_loss"),
        F.col("vocab_size").cast("double").alias("uniform_ppl"))
