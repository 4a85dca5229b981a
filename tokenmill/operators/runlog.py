"""Run-log analytics: log rows, artifacts, resume points, merged resumed runs.

A run log is a table ``(run, type, epoch, step, ts, loss)``; the metrics CSV has the
reference's 7 columns with the train or the val half blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.plans.prefix import global_offsets

# The column names of the metrics CSV.
CSV_SCHEMA = ("timestamp string, epoch int, step bigint, train_loss double, "
              "train_perplexity double, val_loss double, val_perplexity double")
CSV_COLUMNS = ["timestamp", "epoch", "step", "train_loss", "train_perplexity", "val_loss",
               "val_perplexity"]


def loss_to_log_row(log: DataFrame, type_col: str = "type", loss: str = "loss", ts: str = "ts"
                    ) -> DataFrame:
    """L2: one row per logged step; loss as ``%.4f``, perplexity ``exp(loss)`` as ``%.2f``;
    the other half (train or val) left null."""
    is_train = F.col(type_col) == "train"
    is_val = F.col(type_col) == "val"
    lf = F.format_string("%.4f", F.col(loss))
    pf = F.format_string("%.2f", F.exp(F.col(loss)))
    return log.select(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("epoch").cast("int").alias("epoch"), F.col("step").cast("long").alias("step"),
        F.when(is_train, lf).alias("train_loss"), F.when(is_train, pf).alias("train_perplexity"),
        F.when(is_val, lf).alias("val_loss"), F.when(is_val, pf).alias("val_perplexity"))


def append_run_log(rows: DataFrame, path: str, first: bool = False) -> None:
    """Write log rows as CSV with a header; ``first`` starts a new log (overwrite)."""
    rows.select(*CSV_COLUMNS).write.mode("overwrite" if first else "append").option(
        "header", True).csv(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the metrics CSV back with its fixed schema (blank cells -> null)."""
    return spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)


def artifacts(log: DataFrame, every: int, run: str = "run", step: str = "step",
              epoch: str = "epoch", loss: str = "loss", ts: str = "ts") -> DataFrame:
    """L3: saved-artifact rows. Per epoch a kept ``epoch<n>`` row (its last step); a rolling
    ``latest`` row every ``every`` steps (step > 0), overwritten within a day, so per
    (run, day) only the last one survives. Upserts are ``max_by`` aggregates (skew-safe)."""
    day = F.date_format(ts, "yyyy-MM-dd")
    rec = F.struct(F.col(step).alias("step"), F.col(loss).alias("loss"), F.col(epoch).alias("epoch"))
    per_epoch = log.groupBy(run, epoch).agg(F.max_by(rec, F.col(step)).alias("r"),
                                            F.max_by(day, F.col(step)).alias("day")).select(
        run, "day", F.concat(F.lit("epoch"), F.col(epoch).cast("string")).alias("tag"), "r")
    rolling = log.where((F.col(step) % every == 0) & (F.col(step) > 0)).groupBy(
        run, day.alias("day")).agg(F.max_by(rec, F.col(step)).alias("r")).select(
        run, "day", F.lit("latest").alias("tag"), "r")
    return per_epoch.unionByName(rolling).select(
        run, "day", "tag", F.col("r.epoch").alias("epoch"), F.col("r.step").alias("step"),
        F.col("r.loss").alias("loss"))


def resume_point(arts: DataFrame, run: str = "run") -> DataFrame:
    """L4: (epoch, loss) of the most recent saved artifact of each run."""
    rec = F.struct("epoch", "step", "loss")
    return arts.groupBy(run).agg(F.max_by(rec, F.col("step")).alias("r")).select(
        run, "r.epoch", "r.step", "r.loss")


def merge_resumed_runs(log: DataFrame, segment: str, step: str = "step", ts: str = "ts",
                       out: str = "merged_step") -> DataFrame:
    """A resumed run restarts its step counter; put its segments (ordered by their first
    timestamp, then name) on one axis: ``out`` = step + the sum of the largest steps of the earlier
    segments. ``local_step`` is the step itself.

    One row per segment is summed up and joined back; the log is neither sorted nor ranked.
    """
    per = log.groupBy(segment).agg(F.min(ts).alias("__first"),
                                   F.max(step).cast("long").alias("__last"))
    offsets = global_offsets(per, ["__first", segment], "__last", out="__shift").select(
        segment, "__shift")
    return (log.join(offsets, segment)
            .withColumn(out, F.col(step) + F.col("__shift")).withColumn("local_step", F.col(step))
            .drop("__shift"))
