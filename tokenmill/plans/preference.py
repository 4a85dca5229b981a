"""Checkable preference-pair and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import BOS_TEXT, EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT, PAD_TEXT
from tokenmill.functions import arrays as A
from tokenmill.functions.arrays import join_tokens
from tokenmill.functions.text import word_pattern
from tokenmill.operators import chat as C
from tokenmill.operators import metrics as M
from tokenmill.operators import ordering as O
from tokenmill.operators import preference as P
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

TRX = word_pattern(C.DEFAULT_TEMPLATE.specials)
LAMBDA = 1e-3


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Scored-pairs fixture from ``events``: one pair per event."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("pair_id"),
                     (F.col("value") / 100 - 0.2).alias("r_chosen"),
                     (F.col("user_id") / 150.0 - 0.3).alias("r_rejected"))


PAIRS_SQL = f"""
l AS (SELECT conv_id, max(turn) AS mt, arg_max(role, turn) AS lr, arg_max(text, turn) AS lt
      FROM conversations GROUP BY conv_id),
e AS (SELECT conv_id, mt, lt, row_number() OVER (ORDER BY conv_id) AS r, count(*) OVER () AS n
      FROM l WHERE lr = 'assistant'),
x AS (SELECT a.conv_id AS pair_id, a.mt, b.lt AS rej FROM e a JOIN e b ON b.r = a.r % a.n + 1),
t AS (SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
      WHERE conv_id IN (SELECT conv_id FROM e)
      UNION ALL SELECT c.conv_id, 'rejected', c.turn, c.role, c.text
      FROM conversations c JOIN x ON c.conv_id = x.pair_id WHERE c.turn < x.mt
      UNION ALL SELECT pair_id, 'rejected', mt, 'assistant', rej FROM x),
r AS (SELECT pair_id, side, turn, ['{HEADER_START_TEXT}', role, '{HEADER_END_TEXT}']
             || regexp_extract_all(text, '{TRX}') || ['{EOT_TEXT}'] AS a FROM t),
f AS (SELECT pair_id, side, ['{BOS_TEXT}'] || flatten(list(a ORDER BY turn)) AS fl FROM r GROUP BY pair_id, side)
"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return P.pairs_from_conversations(turns)


PREF_PAIRS_SQL = f"""
WITH {PAIRS_SQL},
ok AS (SELECT pair_id FROM f GROUP BY pair_id HAVING max(len(fl)) <= 512 AND count(*) = 2)
SELECT pair_id, side, CAST(len(fl) AS BIGINT) AS full_len, array_to_string(fl, ' ') AS ids
FROM f WHERE pair_id IN (SELECT pair_id FROM ok)
"""


@register("pref_pairs", "A4 F1 F6 B3", PREF_PAIRS_SQL)
def pref_pairs(spark: SparkSession, sf: str) -> DataFrame:
    enc = P.pair_fits(P.encode_pairs(_pairs(spark, sf), 512), 512)
    return enc.select("pair_id", "side", "full_len", join_tokens("ids").alias("ids"))


PREF_MASK_SQL = f"""
WITH {PAIRS_SQL},
k AS (SELECT pair_id, side, list_slice(fl, greatest(1, len(fl) - 128 + 1), len(fl)) AS ids FROM f),
w AS (SELECT pair_id, max(CASE WHEN side = 'chosen' THEN ids END) AS c, max(CASE WHEN side = 'rejected' THEN ids END) AS rj
      FROM k GROUP BY pair_id),
b AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // 4 AS batch_id FROM w),
z AS (SELECT *, max(len(c)) OVER (PARTITION BY batch_id) AS cw, max(len(rj)) OVER (PARTITION BY batch_id) AS rw FROM b)
SELECT pair_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(cw AS INTEGER) AS chosen_width, CAST(rw AS INTEGER) AS rejected_width,
       array_to_string(list_transform(range(cw), lambda i: CASE WHEN i < len(c) THEN 1 ELSE 0 END), ' ') AS chosen_mask,
       array_to_string(list_transform(range(rw), lambda i: CASE WHEN i < len(rj) THEN 1 ELSE 0 END), ' ') AS rejected_mask,
       c[len(c)] AS chosen_last, rj[len(rj)] AS rejected_last,
       array_to_string(c || list_transform(range(cw - len(c)), lambda q: '{PAD_TEXT}'), ' ') AS chosen_ids
FROM z
"""


@register("pref_mask", "F1 F2 F3 F4 (dynamic, sides padded independently)", PREF_MASK_SQL)
def pref_mask(spark: SparkSession, sf: str) -> DataFrame:
    wide = P.to_wide(P.encode_pairs(_pairs(spark, sf), 128))
    wide = O.assign_batches(wide, ["pair_id"], 4)
    padded = P.pad_pairs(wide, PAD_TEXT, "dynamic")
    return padded.select(
        "pair_id", "batch_id", "chosen_width", "rejected_width",
        join_tokens("chosen_attention_mask").alias("chosen_mask"),
        join_tokens("rejected_attention_mask").alias("rejected_mask"),
        A.pool_last("chosen_ids", "chosen_attention_mask").alias("chosen_last"),
        A.pool_last("rejected_ids", "rejected_attention_mask").alias("rejected_last"),
        join_tokens("chosen_ids").alias("chosen_ids"))


PAD_COLLISION_SQL = f"""
WITH {PAIRS_SQL},
k AS (SELECT pair_id, side, list_slice(fl, greatest(1, len(fl) - 128 + 1), len(fl)) AS ids FROM f),
s AS (SELECT pair_id, side, len(ids) - 1 AS mask_last,
             CASE WHEN list_position(ids, '{EOT_TEXT}') IS NULL THEN len(ids) - 1
                  ELSE list_position(ids, '{EOT_TEXT}') - 2 END AS scan_last FROM k)
SELECT pair_id, side, CAST(mask_last AS INTEGER) AS mask_last, CAST(scan_last AS INTEGER) AS scan_last,
       mask_last <> scan_last AS collision
FROM s
"""


@register("pad_collision", "F5 F3 E10 (pad id == end-of-turn id)", PAD_COLLISION_SQL)
def pad_collision(spark: SparkSession, sf: str) -> DataFrame:
    enc = P.encode_pairs(_pairs(spark, sf), 128)
    enc = enc.withColumn("mask", A.attention_mask("ids", F.size("ids")))
    audited = P.pad_collision_audit(enc, "ids", "mask", EOT_TEXT)
    return audited.select("pair_id", "side", F.col("mask_last").cast("int"),
                          F.col("scan_last").cast("int"), "collision")


SCORED = """s AS (SELECT event_id AS pair_id, value / 100 - 0.2 AS rc, user_id / 150.0 - 0.3 AS rr FROM events)"""
SOFTPLUS_NEG_M = "(greatest(-(rc - rr), 0) + ln(1 + exp(-abs(rc - rr))))"

BT_SQL = f"""
WITH {SCORED}
SELECT round(avg({SOFTPLUS_NEG_M}) + avg(rc * rc + rr * rr) * {LAMBDA}, 6) AS loss,
       round(avg({SOFTPLUS_NEG_M}), 6) AS bt, round(avg(rc * rc + rr * rr) * {LAMBDA}, 6) AS reg,
       round(avg(CASE WHEN rc > rr THEN 1.0 ELSE 0.0 END), 6) AS acc,
       round(avg(rc), 6) AS r_chosen, round(avg(rr), 6) AS r_rejected,
       round(avg(rc) - avg(rr), 6) AS margin, round((avg(rc) + avg(rr)) / 2, 6) AS midpoint,
       CAST(count(*) AS BIGINT) AS n_pairs
FROM s
"""

METRIC_COLS = ["loss", "bt", "reg", "acc", "r_chosen", "r_rejected", "margin", "midpoint"]


def _round(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("bt_metrics", "H5 H6 H7 H8", BT_SQL)
def bt_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = M.preference_metrics(scored_pairs(spark, sf), l2=LAMBDA)
    return _round(m.select(*METRIC_COLS, "n_pairs"), METRIC_COLS)


VERDICT_SQL = f"""
WITH {SCORED}
SELECT pair_id, round(rc - rr, 6) AS margin, CASE WHEN rc - rr > 0 THEN '✓' ELSE '✗' END AS verdict,
       round({SOFTPLUS_NEG_M}, 6) AS bt
FROM s
"""


@register("pair_verdicts", "H9 H5", VERDICT_SQL)
def pair_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    v = M.pair_verdicts(scored_pairs(spark, sf)).withColumn("bt", M.bt_loss("r_chosen", "r_rejected"))
    return _round(v.select("pair_id", "margin", "verdict", "bt"), ["margin", "bt"])


EPOCH_SQL = f"""
WITH {SCORED},
b AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // 7 AS batch_id FROM s),
pb AS (SELECT batch_id, count(*) AS n_pairs, avg({SOFTPLUS_NEG_M}) AS bt, avg(rc * rc + rr * rr) * {LAMBDA} AS reg,
              avg(CASE WHEN rc > rr THEN 1.0 ELSE 0.0 END) AS acc FROM b GROUP BY batch_id),
pl AS (SELECT *, bt + reg AS loss FROM pb)
SELECT 'macro' AS mode, round(avg(loss), 6) AS loss, round(avg(bt), 6) AS bt, round(avg(reg), 6) AS reg,
       round(avg(acc), 6) AS acc FROM pl
UNION ALL
SELECT 'micro', round(sum(loss * n_pairs) / sum(n_pairs), 6), round(sum(bt * n_pairs) / sum(n_pairs), 6),
       round(sum(reg * n_pairs) / sum(n_pairs), 6), round(sum(acc * n_pairs) / sum(n_pairs), 6) FROM pl
"""


@register("epoch_macro_micro", "H4 G5 (last partial batch kept)", EPOCH_SQL)
def epoch_macro_micro(spark: SparkSession, sf: str) -> DataFrame:
    b = O.assign_batches(scored_pairs(spark, sf), ["pair_id"], 7)
    per_batch = M.preference_metrics(b, by=["batch_id"], l2=LAMBDA)
    e = M.epoch_mean(per_batch, ["loss", "bt", "reg", "acc"])
    return _round(e.select("mode", "loss", "bt", "reg", "acc"), ["loss", "bt", "reg", "acc"])


ACCUM_SQL = f"""
WITH {SCORED},
b AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // 50 AS batch_id FROM s),
pb AS (SELECT batch_id, CASE WHEN batch_id % 10 = 9 THEN 'val' ELSE 'train' END AS type,
              avg({SOFTPLUS_NEG_M}) AS bt, avg(CASE WHEN rc > rr THEN 1.0 ELSE 0.0 END) AS acc,
              avg(rc) AS r_chosen FROM b GROUP BY batch_id),
u AS (UNPIVOT pb ON bt, acc, r_chosen INTO NAME metric VALUE value)
SELECT type, metric, type || '/' || metric AS key, round(avg(value), 6) AS value FROM u GROUP BY type, metric
"""


@register("metric_keys", "H10 L1", ACCUM_SQL)
def metric_keys(spark: SparkSession, sf: str) -> DataFrame:
    b = O.assign_batches(scored_pairs(spark, sf), ["pair_id"], 50)
    pb = M.preference_metrics(b, by=["batch_id"]).withColumn(
        "type", F.when(F.col("batch_id") % 10 == 9, F.lit("val")).otherwise(F.lit("train")))
    acc = M.accumulate_metrics(pb, ["bt", "acc", "r_chosen"], type_col="type")
    return acc.select("type", "metric", "key", F.round("value", 6).alias("value"))


CE_SQL = f"""
WITH {SCORED},
c AS (SELECT {SOFTPLUS_NEG_M} AS bt,
             greatest(rc, rr) + ln(exp(rc - greatest(rc, rr)) + exp(rr - greatest(rc, rr))) - rc AS ce,
             (greatest(-((rc + 5) - (rr + 5)), 0) + ln(1 + exp(-abs((rc + 5) - (rr + 5))))) AS bt_shift FROM s)
SELECT CAST(count(*) AS BIGINT) AS n_pairs, max(abs(bt - ce)) < 1e-9 AS ce_equals_bt,
       max(abs(bt - bt_shift)) < 1e-9 AS shift_invariant FROM c
"""


@register("pairwise_ce", "H11", CE_SQL)
def pairwise_ce(spark: SparkSession, sf: str) -> DataFrame:
    s = scored_pairs(spark, sf)
    c = s.select(M.bt_loss("r_chosen", "r_rejected").alias("bt"),
                 M.pairwise_ce("r_chosen", "r_rejected").alias("ce"),
                 M.bt_loss(F.col("r_chosen") + 5, F.col("r_rejected") + 5).alias("bt_shift"))
    return c.agg(F.count(F.lit(1)).alias("n_pairs"),
                 (F.max(F.abs(F.col("bt") - F.col("ce"))) < 1e-9).alias("ce_equals_bt"),
                 (F.max(F.abs(F.col("bt") - F.col("bt_shift"))) < 1e-9).alias("shift_invariant"))


def logit_table(spark: SparkSession, sf: str) -> DataFrame:
    """Logit-table fixture from ``events``: candidates per user."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("group_id"), F.col("event_id").alias("item_id"),
                     F.log(F.col("value") + 1).alias("logit"), "ts", "event_type")


NLL_SQL = """
WITH g AS (SELECT user_id AS group_id, event_id AS item_id, ln(value + 1) AS logit, ts FROM events),
t AS (SELECT group_id, arg_max(item_id, (ts, item_id)) AS target_id FROM g GROUP BY group_id),
l AS (SELECT group_id, max(logit) + ln(sum(exp(logit - (SELECT max(logit) FROM g x WHERE x.group_id = g.group_id)))) AS lse
      FROM g GROUP BY group_id),
n AS (SELECT l.group_id, l.lse - g.logit AS nll FROM l JOIN t USING (group_id)
      JOIN g ON g.group_id = t.group_id AND g.item_id = t.target_id)
SELECT group_id, round(nll, 6) AS nll, round(exp(nll), 6) AS ppl FROM n
"""


@register("token_nll", "H1 H3 (per-group cross-entropy)", NLL_SQL)
def token_nll(spark: SparkSession, sf: str) -> DataFrame:
    lt = logit_table(spark, sf)
    targets = lt.groupBy("group_id").agg(
        F.max_by("item_id", F.struct("ts", "item_id")).alias("target_id"))
    nll = M.token_nll(lt.select("group_id", "item_id", "logit"), targets, ["group_id"])
    return nll.select("group_id", F.round("nll", 6).alias("nll"),
                      F.round(M.perplexity("nll"), 6).alias("ppl"))
