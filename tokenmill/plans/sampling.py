"""Checkable candidate-selection queries over the events logit table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.functions.text import word_pattern, word_tokens
from tokenmill.operators import sampling as S
from tokenmill.plans.preference import logit_table
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

RX = word_pattern()
UNIFORM = "CAST(('0x' || substr(md5('{seed}:' || group_id), 1, 13)) AS BIGINT) / 4503599627370496.0"


def _logits(spark: SparkSession, sf: str) -> DataFrame:
    return logit_table(spark, sf).select("group_id", "item_id", "logit")


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Items already generated for a group: its click events."""
    lt = logit_table(spark, sf)
    return lt.where(F.col("event_type") == "click").select("group_id", "item_id")


SOFTMAX_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) / 0.7 AS z FROM events),
s AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM g)
SELECT group_id, item_id, round(e / sum(e) OVER (PARTITION BY group_id), 6) AS prob FROM s
"""


@register("softmax_temp", "J3", SOFTMAX_SQL)
def softmax_temp(spark: SparkSession, sf: str) -> DataFrame:
    p = S.softmax(S.temperature(_logits(spark, sf), 0.7))
    return p.select("group_id", "item_id", F.round("prob", 6).alias("prob"))


TOP_K_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) AS z FROM events),
r AS (SELECT *, rank() OVER (PARTITION BY group_id ORDER BY z DESC) AS rk FROM g)
SELECT group_id, item_id, round(z, 6) AS logit FROM r WHERE rk <= 3
"""


@register("top_k", "J4 (ties at the threshold kept)", TOP_K_SQL)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    k = S.top_k(_logits(spark, sf), 3)
    return k.select("group_id", "item_id", F.round("logit", 6).alias("logit"))


TOP_P_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) AS z FROM events),
e1 AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM g),
s1 AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS p0 FROM e1),
c1 AS (SELECT *, coalesce(sum(p0) OVER (PARTITION BY group_id ORDER BY p0 DESC, item_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM s1),
k AS (SELECT group_id, item_id, z FROM c1 WHERE cb < 0.5),
e2 AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM k)
SELECT group_id, item_id, round(e / sum(e) OVER (PARTITION BY group_id), 6) AS prob FROM e2
"""


@register("top_p", "J5 J3 (renormalised nucleus)", TOP_P_SQL)
def top_p(spark: SparkSession, sf: str) -> DataFrame:
    p = S.softmax(S.top_p(_logits(spark, sf), 0.5))
    return p.select("group_id", "item_id", F.round("prob", 6).alias("prob"))


@register("top_p_hot", "J5 (few hot groups: cut found by histogram rounds)", """
WITH g AS (SELECT event_type AS group_id, event_id AS item_id, ln(value + 1) AS z FROM events),
e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM g),
s AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS p FROM e),
c AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY group_id ORDER BY p DESC, item_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM s)
SELECT group_id, item_id, round(z, 6) AS logit FROM c WHERE cb < 0.7
""")
def top_p_hot(spark: SparkSession, sf: str) -> DataFrame:
    hot = logit_table(spark, sf).select(F.col("event_type").alias("group_id"), "item_id", "logit")
    kept = S.top_p(hot, 0.7, bound=64)  # rows that one task may order: rounds run at any size
    return kept.select("group_id", "item_id", F.round("logit", 6).alias("logit"))


GREEDY_SQL = """
SELECT user_id AS group_id, arg_max(event_id, (ln(value + 1), -event_id)) AS item_id FROM events GROUP BY user_id
"""


@register("greedy", "J2", GREEDY_SQL)
def greedy(spark: SparkSession, sf: str) -> DataFrame:
    return S.greedy(_logits(spark, sf))


REP_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) AS z FROM events),
h AS (SELECT user_id AS group_id, event_id AS item_id, count(*) AS n FROM events
      WHERE event_type = 'click' GROUP BY user_id, event_id)
SELECT group_id, item_id, round(z / pow(1.3, coalesce(n, 0)), 6) AS logit
FROM g LEFT JOIN h USING (group_id, item_id)
"""


@register("rep_penalty", "J1", REP_SQL)
def rep_penalty(spark: SparkSession, sf: str) -> DataFrame:
    r = S.repetition_penalty(_logits(spark, sf), _history(spark, sf), 1.3)
    return r.select("group_id", "item_id", F.round("logit", 6).alias("logit"))


@register("rep_penalty_repeat", "J1 (items generated several times)", """
WITH g AS (SELECT user_id AS group_id, event_id % 16 AS item_id, max(ln(value + 1)) AS z FROM events GROUP BY 1, 2),
h AS (SELECT user_id AS group_id, event_id % 16 AS item_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT group_id, item_id, round(z / pow(1.3, coalesce(n, 0)), 6) AS logit FROM g LEFT JOIN h USING (group_id, item_id)
""")
def rep_penalty_repeat(spark: SparkSession, sf: str) -> DataFrame:
    item = (F.col("item_id") % 16).alias("item_id")
    logits = _logits(spark, sf).groupBy("group_id", item).agg(F.max("logit").alias("logit"))
    r = S.repetition_penalty(logits, _history(spark, sf).select("group_id", item), 1.3)
    return r.select("group_id", "item_id", F.round("logit", 6).alias("logit"))


SAMPLE_SQL = f"""
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) AS z0 FROM events),
h AS (SELECT user_id AS group_id, event_id AS item_id, count(*) AS n FROM events
      WHERE event_type = 'click' GROUP BY user_id, event_id),
pz AS (SELECT group_id, item_id, z0 / pow(1.3, coalesce(n, 0)) / 0.8 AS z FROM g LEFT JOIN h USING (group_id, item_id)),
k AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY group_id ORDER BY z DESC) AS rk FROM pz) WHERE rk <= 10),
e1 AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM k),
s1 AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS p0 FROM e1),
c1 AS (SELECT *, coalesce(sum(p0) OVER (PARTITION BY group_id ORDER BY p0 DESC, item_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM s1),
kp AS (SELECT group_id, item_id, z FROM c1 WHERE cb < 0.9),
e2 AS (SELECT *, exp(z - max(z) OVER (PARTITION BY group_id)) AS e FROM kp),
s2 AS (SELECT *, e / sum(e) OVER (PARTITION BY group_id) AS prob FROM e2),
c2 AS (SELECT *, sum(prob) OVER (PARTITION BY group_id ORDER BY prob DESC, item_id ROWS UNBOUNDED PRECEDING) AS cum,
              row_number() OVER (PARTITION BY group_id ORDER BY prob ASC, item_id DESC) = 1 AS is_last,
              {UNIFORM.format(seed=11)} AS u FROM s2)
SELECT group_id, arg_min(item_id, (-prob, item_id)) AS item_id FROM c2 WHERE cum >= u OR is_last GROUP BY group_id
"""


@register("sample", "J6 J1 J3 J4 J5 (full decode step)", SAMPLE_SQL)
def sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.decode_step(_logits(spark, sf), _history(spark, sf), rho=1.3, t=0.8, k=10, p=0.9,
                         seed=11)


RACE_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) / 0.8 AS z FROM events),
u AS (SELECT *, CAST(('0x' || substr(md5('5:' || group_id || ':' || item_id), 1, 13)) AS BIGINT) / 4503599627370496.0
             + power(2.0, -53) AS u FROM g)
SELECT group_id, arg_min(item_id, (ln(-ln(u)) - z, item_id)) AS item_id FROM u GROUP BY group_id
"""


@register("sample_race", "J6 J3 (draw by exponential races)", RACE_SQL)
def sample_race(spark: SparkSession, sf: str) -> DataFrame:
    return S.sample_race(S.temperature(_logits(spark, sf), 0.8), seed=5)


CUT_SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '{RX}') AS a FROM documents),
p AS (SELECT doc_id, a, least(coalesce(list_position(a, '.'), 4611686018427387904),
                             coalesce(list_position(a, '!'), 4611686018427387904)) AS fp FROM t)
SELECT doc_id, CAST(CASE WHEN fp >= 4611686018427387904 THEN len(a) ELSE fp END AS INTEGER) AS n_kept,
       fp < 4611686018427387904 AS stopped
FROM p
"""


@register("cut_stop", "J7", CUT_SQL)
def cut_stop(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", word_tokens("text").alias("tokens"))
    c = d.withColumn("stopped", A.first_stop("tokens", [".", "!"]) > 0)
    c = S.cut_at_stop(c, "tokens", [".", "!"])
    return c.select("doc_id", F.size("tokens").alias("n_kept"), "stopped")
