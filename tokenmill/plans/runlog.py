"""Checkable run-log queries over the events-derived run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators import metrics as M
from tokenmill.operators import runlog as R
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Run-log fixture from ``events``: step = event_id, epoch = event_id div 1000,
    run = event_type, loss = value / 100; 'view' rows are validation rows."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("run"),
                     F.when(F.col("event_type") == "view", F.lit("val")).otherwise(F.lit("train"))
                     .alias("type"),
                     F.floor(F.col("event_id") / 1000).cast("int").alias("epoch"),
                     F.col("event_id").alias("step"), "ts", (F.col("value") / 100).alias("loss"))


LOG_SQL = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CAST(event_id // 1000 AS INTEGER) AS epoch,
       event_id AS step,
       CASE WHEN event_type <> 'view' THEN printf('%.4f', value / 100) END AS train_loss,
       CASE WHEN event_type <> 'view' THEN printf('%.2f', exp(value / 100)) END AS train_perplexity,
       CASE WHEN event_type = 'view' THEN printf('%.4f', value / 100) END AS val_loss,
       CASE WHEN event_type = 'view' THEN printf('%.2f', exp(value / 100)) END AS val_perplexity
FROM events
"""


@register("runlog_rows", "L2 A6 (row format)", LOG_SQL)
def runlog_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.loss_to_log_row(run_log(spark, sf))


LATEST_SQL = """
WITH l AS (SELECT event_type AS run, event_id // 1000 AS epoch, event_id AS step, value / 100 AS loss,
                  strftime(ts, '%Y-%m-%d') AS day FROM events),
e AS (SELECT run, arg_max(day, step) AS day, 'epoch' || epoch AS tag, epoch, max(step) AS step,
             arg_max(loss, step) AS loss FROM l GROUP BY run, epoch),
r AS (SELECT run, day, 'latest' AS tag, arg_max(epoch, step) AS epoch, max(step) AS step,
             arg_max(loss, step) AS loss FROM l WHERE step % 500 = 0 AND step > 0 GROUP BY run, day)
SELECT run, day, tag, CAST(epoch AS INTEGER) AS epoch, step, round(loss, 6) AS loss FROM e
UNION ALL SELECT run, day, tag, CAST(epoch AS INTEGER), step, round(loss, 6) FROM r
"""


@register("runlog_latest", "L3", LATEST_SQL)
def runlog_latest(spark: SparkSession, sf: str) -> DataFrame:
    a = R.artifacts(run_log(spark, sf), 500)
    return a.select("run", "day", "tag", "epoch", "step", F.round("loss", 6).alias("loss"))


RESUME_SQL = """
WITH l AS (SELECT event_type AS run, event_id // 1000 AS epoch, event_id AS step, value / 100 AS loss,
                  strftime(ts, '%Y-%m-%d') AS day FROM events),
e AS (SELECT run, epoch, max(step) AS step, arg_max(loss, step) AS loss FROM l GROUP BY run, epoch),
r AS (SELECT run, arg_max(epoch, step) AS epoch, max(step) AS step, arg_max(loss, step) AS loss
      FROM l WHERE step % 500 = 0 AND step > 0 GROUP BY run, day),
a AS (SELECT * FROM e UNION ALL SELECT * FROM r)
SELECT run, CAST(arg_max(epoch, step) AS INTEGER) AS epoch, max(step) AS step,
       round(arg_max(loss, step), 6) AS loss FROM a GROUP BY run
"""


@register("resume_point", "L4", RESUME_SQL)
def resume_point(spark: SparkSession, sf: str) -> DataFrame:
    p = R.resume_point(R.artifacts(run_log(spark, sf), 500))
    return p.select("run", "epoch", "step", F.round("loss", 6).alias("loss"))


MERGE_SQL = """
WITH f AS (SELECT event_type, min(ts) AS first_ts, max(event_id // 5) AS last FROM events GROUP BY event_type),
o AS (SELECT event_type, coalesce(sum(last) OVER (ORDER BY first_ts, event_type ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING), 0) AS base FROM f)
SELECT e.event_id, e.event_type AS run, CAST(e.event_id // 5 + o.base AS BIGINT) AS merged_step,
       CAST(e.event_id // 5 AS BIGINT) AS local_step
FROM events e JOIN o USING (event_type)
"""


@register("merge_runs", "L5 G0", MERGE_SQL)
def merge_runs(spark: SparkSession, sf: str) -> DataFrame:
    log = run_log(spark, sf).withColumn("event_id", F.col("step")).withColumn(
        "step", F.floor(F.col("step") / 5).cast("long"))
    return R.merge_resumed_runs(log, "run").select("event_id", "run", "merged_step", "local_step")


COMPARE_SQL = """
SELECT CAST(event_id // 1000 AS INTEGER) AS epoch, event_type AS run, round(avg(value / 100), 6) AS mean_loss
FROM events GROUP BY event_id // 1000, event_type
"""


@register("compare_runs", "H12 (one row per epoch and run)", COMPARE_SQL)
def compare_runs(spark: SparkSession, sf: str) -> DataFrame:
    p = M.compare_runs(run_log(spark, sf), value="loss")
    return p.select("epoch", "run", F.round("mean_value", 6).alias("mean_loss"))


SIDE_BY_SIDE = ("view", "click")
SIDE_SQL = """
WITH m AS (
  SELECT event_id // 1000 AS epoch, avg(value / 100) FILTER (event_type = 'view') AS a,
         avg(value / 100) FILTER (event_type = 'click') AS b FROM events GROUP BY event_id // 1000)
SELECT CAST(epoch AS INTEGER) AS epoch, round(a, 6) AS view_loss, round(b, 6) AS click_loss,
       round(b - a, 6) AS click_loss_diff FROM m
"""


@register("runs_side_by_side", "H12 (one row per epoch, a column per run)", SIDE_SQL)
def runs_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    t = M.runs_side_by_side(run_log(spark, sf), SIDE_BY_SIDE, ["loss"])
    return t.select("epoch", *[F.round(c, 6).alias(c) for c in t.columns if c != "epoch"])


SUMMARY_SQL = """
SELECT event_type AS run, round(arg_min(value / 100, event_id), 6) AS first_value,
       round(arg_max(value / 100, event_id), 6) AS final_value,
       arg_min(event_id, (value, event_id)) AS best_step, round(min(value / 100), 6) AS best_value
FROM events GROUP BY event_type
"""


@register("run_summary", "H12 H13", SUMMARY_SQL)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    log = run_log(spark, sf)
    fl = M.first_last(log, value="loss")
    b = M.best_step(log, value="loss")
    return fl.join(b, "run").select("run", F.round("first_value", 6).alias("first_value"),
                                    F.round("final_value", 6).alias("final_value"), "best_step",
                                    F.round("best_value", 6).alias("best_value"))
