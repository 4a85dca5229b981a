"""Checkable pairwise-ranking queries over ``embeddings`` (K1-K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators import ranking as K
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

DIM = 64
# A fixed probe weight vector (parameter of the K1 query): w_i = (-1)^i / (i + 1).
PROBE = [(-1) ** i / (i + 1) for i in range(DIM)]
PROBE_SQL = "[" + ", ".join(repr(x) for x in PROBE) + "]"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Even labels against odd ones: every vector takes part."""
    emb = table(spark, sf, "embeddings")
    return K.ranking_pairs(emb, "vec_id", "embedding", F.col("label") % 2 == 0, F.col("label") % 2 == 1)


PAIRS_SQL = """
a AS (SELECT embedding AS c, row_number() OVER (ORDER BY vec_id) AS r, count(*) OVER () AS n
      FROM embeddings WHERE label % 2 = 0),
b AS (SELECT embedding AS j, row_number() OVER (ORDER BY vec_id) AS r, count(*) OVER () AS n
      FROM embeddings WHERE label % 2 = 1),
p AS (SELECT c, j FROM a JOIN b ON CASE WHEN a.n >= b.n THEN (a.r - 1) % b.n + 1 = b.r
                                        ELSE (b.r - 1) % a.n + 1 = a.r END)
"""
SCORE_SQL = f"""
WITH w AS (SELECT {PROBE_SQL}::DOUBLE[] AS w)
SELECT vec_id, round(list_reduce(list_transform(range(1, len(embedding) + 1),
                     lambda i: CAST(embedding[i] AS DOUBLE) * w[i]), lambda a, b: a + b), 6) AS score
FROM embeddings, w
"""


@register("score_linear", "K1", SCORE_SQL)
def score_linear(spark: SparkSession, sf: str) -> DataFrame:
    s = K.score_linear(table(spark, sf, "embeddings"), "embedding", PROBE)
    return s.select("vec_id", F.round("score", 6).alias("score"))


def _dot(v: str) -> str:
    return (f"list_reduce(list_transform(range(1, 65), lambda i: CAST({v}[i] AS DOUBLE) * w[i]), "
            "lambda x, y: x + y)")


PROBE_EVAL_SQL = f"""
WITH w AS (SELECT {PROBE_SQL}::DOUBLE[] AS w), {PAIRS_SQL},
s AS (SELECT {_dot("c")} AS rc, {_dot("j")} AS rj FROM p, w)
SELECT CAST(count(*) AS BIGINT) AS n_pairs, round(avg(ln(1 + exp(-(rc - rj)))), 6) AS bt,
       round(avg(CASE WHEN rc > rj THEN 1.0 ELSE 0.0 END), 6) AS acc, round(avg(rc), 6) AS r_chosen,
       round(avg(rj), 6) AS r_rejected
FROM s
"""


@register("ranker_eval", "K3 (fixed probe weights)", PROBE_EVAL_SQL)
def ranker_eval(spark: SparkSession, sf: str) -> DataFrame:
    m = K.evaluate_ranker(_pairs(spark, sf), PROBE)
    return m.select("n_pairs", *[F.round(c, 6).alias(c) for c in ("bt", "acc", "r_chosen", "r_rejected")])


BASELINE_SQL = f"""
WITH {PAIRS_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_pairs, round(ln(2), 6) AS bt, 0.0 AS acc, 0.0 AS r_chosen, 0.0 AS r_rejected
FROM p
"""


@register("ranker_baseline", "K3 (w = 0: all ties, acc 0, bt ln 2)", BASELINE_SQL)
def ranker_baseline(spark: SparkSession, sf: str) -> DataFrame:
    m = K.evaluate_ranker(_pairs(spark, sf), [0.0] * DIM)
    return m.select("n_pairs", F.round("bt", 6).alias("bt"), F.round("acc", 6).alias("acc"),
                    F.round("r_chosen", 6).alias("r_chosen"),
                    F.round("r_rejected", 6).alias("r_rejected"))


def _fit_sql(reward_l2: float, weight_l2: float, steps: int) -> str:
    """The same optimum by another route: accelerated gradient steps from zero, written as a
    recursive query over (step, component, weight, momentum)."""
    return f"""
WITH RECURSIVE {PAIRS_SQL},
q AS MATERIALIZED (SELECT row_number() OVER () AS pair, c, j FROM p),
v AS MATERIALIZED (SELECT pair, unnest(range(1, {DIM + 1})) AS i, unnest(c)::DOUBLE AS c, unnest(j)::DOUBLE AS j FROM q),
n AS MATERIALIZED (SELECT count(*) AS n FROM q),
top AS MATERIALIZED (SELECT (max(s) / 4 + 4 * {reward_l2} * max(t)) + {weight_l2} AS lip
        FROM (SELECT sum((c - j) * (c - j)) AS s, greatest(sum(c * c), sum(j * j)) AS t FROM v GROUP BY pair)),
fit AS (
  SELECT 0 AS step, i::BIGINT AS i, 0.0::DOUBLE AS w, 0.0::DOUBLE AS y FROM range(1, {DIM + 1}) r(i)
  UNION ALL
  SELECT step + 1, i, nw, nw + step / (step + 3.0) * (nw - w) FROM (
    SELECT f.step, f.i, f.w, f.y - (g.g / n.n + {weight_l2} * f.y) / top.lip AS nw
    FROM fit f, n, top, (
      SELECT v.i, sum(-(v.c - v.j) / (1 + exp(m.rc - m.rj)) + 2 * {reward_l2} * (m.rc * v.c + m.rj * v.j)) AS g
      FROM v, (SELECT v.pair, sum(v.c * fit.y) AS rc, sum(v.j * fit.y) AS rj FROM v JOIN fit ON fit.i = v.i
               GROUP BY v.pair) m
      WHERE v.pair = m.pair GROUP BY v.i) g
    WHERE g.i = f.i AND f.step < {steps})),
s AS (SELECT pair, sum(c * w) AS rc, sum(j * w) AS rj FROM v JOIN (SELECT i, w FROM fit WHERE step = {steps}) USING (i)
      GROUP BY pair)
SELECT CAST(count(*) AS BIGINT) AS n_pairs,
       round(avg(ln(1 + exp(rj - rc)) + {reward_l2} * (rc * rc + rj * rj)), 4) AS loss,
       round(avg(ln(1 + exp(rj - rc))), 4) AS bt, round({reward_l2} * avg(rc * rc + rj * rj), 4) AS reg,
       round(avg(rc), 3) AS r_chosen, round(avg(rj), 3) AS r_rejected
FROM s
"""


def _fitted(spark: SparkSession, sf: str, reward_l2: float, weight_l2: float) -> DataFrame:
    pairs = _pairs(spark, sf)
    w = K.fit_bradley_terry(pairs, reward_l2=reward_l2, weight_l2=weight_l2)
    m = K.evaluate_ranker(pairs, w, l2=reward_l2)
    return m.select("n_pairs", *[F.round(c, 4).alias(c) for c in ("loss", "bt", "reg")],
                    *[F.round(c, 3).alias(c) for c in ("r_chosen", "r_rejected")])


@register("ranker_fit", "K2 (penalty on the weights)", _fit_sql(0.0, 1e-3, 1500))
def ranker_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _fitted(spark, sf, 0.0, 1e-3)


@register("ranker_fit_reward", "K2 (penalty on the rewards)", _fit_sql(0.05, 0.0, 600))
def ranker_fit_reward(spark: SparkSession, sf: str) -> DataFrame:
    return _fitted(spark, sf, 0.05, 0.0)
