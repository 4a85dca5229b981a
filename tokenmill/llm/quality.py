"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are labelled rows of quality 1; everything else is unlabelled text. With the
class prior p (share of good text) the risk of a scorer g is

    p * E_pos[loss(+g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)])

which is unbiased but for the clamp at zero that stops overfitting; when the bracket is negative
the step goes against it. The prior is estimated first: over the thresholds t of a plain
positive-against-unlabelled scorer, P_unl(s >= t) / P_pos(s >= t) where its upper confidence bound is smallest.

Features are dense rates of the whole text, taken in one pass over its bytes. The fit uses
samples of at most about ``MAX_FIT`` positives and ``2 * MAX_FIT`` unlabelled rows (a hash of the
id decides; the bound is this parameter); every document is scored.

Defined cases: a null or empty text has all rates zero and gets the score of those rates; rows
with a null or unknown id are scored, never learnt from as positives; repeated ids in labels
count once each; with no positive every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X
from tokenmill.llm.near_dedup import multiset
from tokenmill.plans.prefix import materialize

MAX_FIT = 20_000
REJECT_BELOW = 0.3
_U = np.uint64

#: byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 full stop or comma,
#: 7 ! or ?, 8 quotes, brackets, hyphen, colon, 9 symbols, 10 bar, 11 non-ASCII
_CLASS = np.zeros(256, np.uint8)
for _chars, _c in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
                   ("0123456789", 3), (" \t", 4), ("\n\r", 5), (".,", 6), ("!?", 7),
                   ("'\"()[]-:;", 8), ("#$%&*+/<=>@\\^_`{}~", 9), ("|", 10)):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _c
_CLASS[128:] = 11
N_CLASS = 12
N_FEATURES = N_CLASS + 8


def text_rates(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """[rows, N_FEATURES] rates: byte classes, word shape, repetition."""
    n = len(off) - 1
    size = np.diff(off)
    row = np.repeat(np.arange(n), size)
    by = np.bincount(row * N_CLASS + _CLASS[data], minlength=n * N_CLASS).reshape(n, N_CLASS)
    some = np.maximum(size, 1)[:, None]
    s, e, h, first = X.words(data, off, ~X.SPACE)
    words = np.diff(first)
    wrow = np.repeat(np.arange(n), words)
    nw = np.maximum(words, 1)
    length = e - s
    _, drow, weight = multiset(h, wrow)
    distinct = np.bincount(drow, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, drow, weight)
    sh, srow = X.shingles(h, first, 3)
    _, d3, _ = multiset(sh, srow)
    n3 = np.maximum(np.bincount(srow, minlength=n), 1)
    upper = _CLASS[data[s]] == 2 if len(s) else np.zeros(0, bool)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    capital = np.bincount(wrow, weights=upper, minlength=n)
    out = np.concatenate([
        np.sqrt(by / some),
        (np.bincount(wrow, weights=length, minlength=n) / nw / 10)[:, None],
        (np.bincount(wrow, weights=length > 20, minlength=n) / nw)[:, None],
        (distinct / nw)[:, None], (top / nw)[:, None],
        (np.bincount(d3, minlength=n) / n3)[:, None],
        (np.bincount(wrow, weights=same, minlength=n) / nw)[:, None],
        (capital / nw)[:, None], (np.log1p(words) / 10)[:, None]], axis=1)
    out[words == 0, N_CLASS:] = 0.0
    return out


def _rate_rows(batches):
    for rec, data, off in X.blocks(batches, "__text"):
        f = text_rates(data, off)
        yield pa.RecordBatch.from_arrays(
            [rec.column(0), X.list_array(f.ravel(), np.full(len(f), f.shape[1]), pa.float64())],
            names=["id", "rates"])


def _expand(f: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    z = np.clip((f - mean) / sd, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z * z / 6], axis=1)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _descend(gradient, d: int, steps: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(d), np.zeros(d), np.zeros(d)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Class prior from scores: the ratio of the two survival functions where its bound is least."""
    cut = np.quantile(pos, np.linspace(0.0, 0.95, 96))
    p = np.array([(pos >= c).mean() for c in cut])
    u = np.array([(unl >= c).mean() for c in cut])
    slack = np.sqrt(np.log(20.0) / (2 * len(pos))) + np.sqrt(np.log(20.0) / (2 * len(unl)))
    best = int(np.argmin((u + slack) / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit_pu(pos: np.ndarray, unl: np.ndarray, l2: float = 1e-4, steps: int = 400
           ) -> dict[str, np.ndarray | float]:
    """Non-negative PU fit of a logistic scorer on expanded rates."""
    both = np.concatenate([pos, unl])
    mean, sd = both.mean(axis=0), both.std(axis=0) + 1e-4
    p, u = _expand(pos, mean, sd), _expand(unl, mean, sd)
    plain = _descend(lambda w: (p.T @ -_sigmoid(-(p @ w))) / len(p)
                     + (u.T @ _sigmoid(u @ w)) / len(u) + l2 * w, p.shape[1], 200)
    prior = estimate_prior(p @ plain, u @ plain)

    def gradient(w):
        zp, zu = p @ w, u @ w
        up = prior * (p.T @ -_sigmoid(-zp)) / len(p)
        down = (u.T @ _sigmoid(zu)) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return (up + down if risk >= 0 else -down) + l2 * w

    return {"mean": mean, "sd": sd, "w": _descend(gradient, p.shape[1], steps), "prior": prior}


def hash_share(column: Column, share: float, seed: int) -> Column:
    """True for about ``share`` of the values, decided by all 64 bits of a seeded hash."""
    bound = int(share * 2.0 ** 64) - (1 << 63)
    if bound >= 1 << 63:
        return F.lit(True)
    return F.xxhash64(column, F.lit(seed)) < F.lit(max(bound, -(1 << 63)))


def fold(column: Column, n: int) -> Column:
    return F.pmod(F.crc32(column.cast("string")), F.lit(n))


def fit_quality(rates: DataFrame, labels: DataFrame, train: Column, max_fit: int = MAX_FIT):
    """Fit on ``rates`` (id, rates) and ``labels`` (id, label); ``train`` tells learnable ids."""
    good = rates.where(train).join(
        labels.where("label = 1").select("id").distinct(), "id", "left_semi")
    rest = rates.where(F.coalesce(train, F.lit(True)))

    def sample(df, bound, seed):
        share = min(1.0, bound / max(df.count(), 1))
        key = F.coalesce(F.col("id").cast("string"), F.lit(""))
        return X.collected(df.where(hash_share(key, share, seed)).select("rates"))["rates"].reshape(
            -1, N_FEATURES)

    pos = sample(good, max_fit, 7)
    if not len(pos):
        return None
    return fit_pu(pos, sample(rest, 2 * max_fit, 8))


def _scorer(model):
    def score(rates: pd.Series) -> pd.Series:
        if model is None or not len(rates):
            return pd.Series(np.full(len(rates), 0.5))
        f = np.stack(rates.to_numpy())
        return pd.Series(_sigmoid(_expand(f, model["mean"], model["sd"]) @ model["w"]))
    return F.pandas_udf(score, "double")


def rates_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
    kind = T.StructType([T.StructField("id", src.schema["id"].dataType),
                         T.StructField("rates", T.ArrayType(T.DoubleType()))])
    return X.map_arrow(src, _rate_rows, kind)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every document; labels: (id, label)."""
    rates = materialize(rates_of(docs, id_col, text_col), "rates")
    out = fold(F.col("id"), folds) == held
    model = fit_quality(rates, labels, ~out)
    return rates.select(F.col("id").alias(id_col), F.coalesce(out, F.lit(False)).alias("held_out"),
                        _scorer(model)("rates").alias("score")).withColumn(
        "predicted", (F.col("score") >= REJECT_BELOW).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose score is below the threshold.

    The scorer runs beside the row, so rows with equal or null ids each get their own decision.
    """
    rates = materialize(rates_of(docs, id_col, text_col), "rates")
    model = fit_quality(rates, labels, fold(F.col("id"), folds) != held)
    if model is None:
        return docs

    def keep(batches):
        for rec, data, off in X.blocks(batches, text_col):
            z = _expand(text_rates(data, off), model["mean"], model["sd"]) @ model["w"]
            yield rec.filter(pa.array(_sigmoid(z) >= REJECT_BELOW))
    return X.map_arrow(docs, keep, docs.schema)


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: quality score of every document, learnt from rows with crc32(doc_id) mod 5 <> 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(docs, quality_labels(spark, sf_dir))
