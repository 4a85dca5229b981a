"""Pairwise ranking model: linear scores and a Bradley-Terry fit (K1-K3).

The reward head of the reference is a bias-free linear map on a pooled vector. Here
vectors are ``array<double>`` columns, scores are built-in ``zip_with`` + ``aggregate``
expressions, and the fit takes Newton steps from moment tables that Spark sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.operators.metrics import preference_metrics
from tokenmill.plans.prefix import global_rank, materialize


def as_double_array(col: str) -> F.Column:
    return F.col(col).cast("array<double>")


def ranking_pairs(vectors: DataFrame, key: str, vec: str, chosen: F.Column, rejected: F.Column
                  ) -> DataFrame:
    """Pair the i-th vector for which ``chosen`` holds with the i-th for which ``rejected`` holds
    (both in ``key`` order); the shorter side is used again from its start until the longer one
    ends, so every vector of either side is in a pair. A rank equi-join, linear in the data.
    Output: (pair_id, chosen, rejected, feature = chosen - rejected)."""
    def side(which, name):
        s = vectors.where(which).select(key, as_double_array(vec).alias(name))
        ranked = global_rank(s.select(key), [key], out="__r")  # the key alone is ranked
        return s.join(ranked, key).drop(key), ranked.count()

    (c, n_c), (r, n_r) = side(chosen, "chosen"), side(rejected, "rejected")
    if n_c >= n_r:
        pairs = c.withColumn("pair_id", F.col("__r")).withColumn(
            "__r", (F.col("__r") - 1) % max(n_r, 1) + 1).join(r, "__r")
    else:
        pairs = r.withColumn("pair_id", F.col("__r")).withColumn(
            "__r", (F.col("__r") - 1) % max(n_c, 1) + 1).join(c, "__r")
    return pairs.select("pair_id", "chosen", "rejected", F.zip_with(
        "chosen", "rejected", lambda a, b: a - b).alias("feature"))


def score_linear(df: DataFrame, vec: str, weights: Sequence[float], out: str = "score"
                 ) -> DataFrame:
    """K1: ``vec . w`` (no bias, no activation)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return df.withColumn(out, A.dot(as_double_array(vec), w))


MAX_DIM = 2048  # the driver holds a d x d system; 32 MB at this bound


def _moments(weights: list[float], d: int):
    """Sums over the pairs of a partition at ``weights``: count, loss, rewards squared, then the
    gradient (d), the Hessian (d x d) of the pair loss and the Gram sum (d x d) of both sides."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        w = np.array(weights)
        acc, gram = np.zeros(3 + d), np.zeros((2, d, d))
        for b in batches:
            c, r = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) for i in (0, 1))
            f = c - r
            m = f @ w
            p = np.exp(-np.logaddexp(0, m))  # sigmoid(-m)
            acc[0] += len(f)
            acc[1] += np.logaddexp(0, -m).sum()
            acc[2] += ((c @ w) ** 2).sum() + ((r @ w) ** 2).sum()
            acc[3:] -= p @ f
            gram[0] += (f * (p * (1 - p))[:, None]).T @ f
            gram[1] += c.T @ c + r.T @ r
        out = np.concatenate([acc, gram.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["m"])
    return run


def fit_bradley_terry(pairs: DataFrame, reward_l2: float = 0.0, weight_l2: float = 0.0,
                      chosen: str = "chosen", rejected: str = "rejected", max_iter: int = 50,
                      tol: float = 1e-9) -> list[float]:
    """K2: weights w of least ``mean(log(1 + exp(-(r_c - r_r))) + reward_l2 * (r_c^2 + r_r^2))
    + weight_l2 / 2 * |w|^2`` with rewards r = w . vector: the reward penalty is a quadratic form in
    the Gram matrix of both sides, so it bounds the scale of the rewards, not of w.

    Damped Newton steps. Each is one pass: tasks reduce their pairs to one row of d x d moments,
    Spark sums the rows by position, and only the sums reach the driver (d at most ``MAX_DIM``).
    A step that raises the loss is halved. Directions that no pair has keep weight zero.

    Pairs with a null vector, a null or non-finite component, or vectors of another length than the
    longest are left out; without pairs the result is empty.
    """
    import numpy as np

    def usable(v: str):
        ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (F.size(v) == F.lit(d)) & ok

    both = pairs.select(as_double_array(chosen).alias("c"), as_double_array(rejected).alias("r"))
    d = both.agg(F.max(F.greatest(F.size("c"), F.size("r")))).first()[0] or 0
    if d <= 0:
        return []
    if d > MAX_DIM:
        raise ValueError(f"vectors of {d} components; at most {MAX_DIM} are supported")
    both = materialize(both.where(usable("c") & usable("r")), "ranking_pairs")

    def at(w):
        rows = both.mapInArrow(_moments([float(x) for x in w], d), "m array<double>")
        sums = rows.select(F.posexplode("m").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
        m = np.zeros(3 + d + 2 * d * d)
        for i, v in sums.collect():  # d x d numbers, whatever the number of pairs
            m[i] = v
        n = m[0]
        if not n:
            return None
        h, g = m[3 + d:3 + d + d * d].reshape(d, d), m[3 + d + d * d:].reshape(d, d)
        loss = (m[1] + reward_l2 * m[2]) / n + weight_l2 / 2 * w @ w
        grad = (m[3:3 + d] + 2 * reward_l2 * g @ w) / n + weight_l2 * w
        return loss, grad, (h + 2 * reward_l2 * g) / n + weight_l2 * np.eye(d)

    w = np.zeros(d)
    now = at(w)
    if now is None:
        return []
    for _ in range(max_iter):
        loss, grad, hess = now
        if np.linalg.norm(grad) <= tol:
            break
        step = np.linalg.lstsq(hess, grad, rcond=1e-12)[0]
        size = 1.0
        while (then := at(w - size * step))[0] > loss + 1e-12 and size > 1e-6:
            size /= 2
        w, now = w - size * step, then
        if abs(loss - then[0]) <= 1e-14 * max(1.0, abs(loss)):
            break
    return [float(x) for x in w]


def evaluate_ranker(pairs: DataFrame, weights: Sequence[float], l2: float = 0.0) -> DataFrame:
    """K3: preference metrics of the linear scorer on (chosen, rejected) pairs."""
    s = score_linear(score_linear(pairs, "chosen", weights, "r_chosen"), "rejected", weights,
                     "r_rejected")
    return preference_metrics(s, l2=l2)
