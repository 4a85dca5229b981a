"""Structured Streaming jobs (M1, M2).

M1 runs the row-local part of chat encoding (render each turn, count tokens) on a
file stream; it has no state, so it gives the same rows as the batch operator.
M2 tails a run log: watermark on event time, tumbling windows, running means.

Sinks and checkpoints go under the session's checkpoint folder (the shared
``spark.checkpoint.dir`` on a cluster), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators import chat as C
from tokenmill.session import ensure_checkpoint_dir


def stream_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output folder, checkpoint folder) for a new streaming run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"
    return f"{run}/out", f"{run}/checkpoint"


def source(spark: SparkSession, folder: str, fmt: str = "parquet", glob: str | None = None,
           max_files: int | None = None) -> DataFrame:
    """A file-source stream over ``folder`` (optionally only what matches ``glob`` in it: files, or
    tables that are folders of part files), with the schema of the files already there."""
    reader = spark.readStream.format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # in the path, as pathGlobFilter would be asked of the part files' names; braces make a plain name a
    # pattern too, whose match may be one file (a stream's plain path must be a folder)
    path = f"{folder.rstrip('/')}/{{{glob}}}" if glob else folder
    return reader.schema(spark.read.format(fmt).load(path).schema).load(path)


def encode_turns_stream(turns: DataFrame, template: C.ChatTemplate = C.DEFAULT_TEMPLATE
                        ) -> DataFrame:
    """M1 transformation (stateless): rendered turn tokens and their count."""
    r = C.render_turns(turns, template)
    return r.select("conv_id", "turn", "role", F.col("n").alias("n_tokens"), "toks")


def run_to_completion(df: DataFrame, out: str, checkpoint: str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Process everything available now, then stop (``trigger(availableNow=True)``)."""
    if mode == "append":
        q = (df.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    else:
        def write_batch(batch: DataFrame, _epoch: int) -> None:
            # complete/update output replaces the sink: idempotent if a batch is retried
            batch.write.mode("overwrite").format(fmt).save(out)
        q = (df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_encode(spark: SparkSession, folder: str, glob: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """M1: stream the flat turn table through the encoder; returns the sink as a DataFrame."""
    out, ckpt = stream_dirs(spark, "encode")
    enc = encode_turns_stream(source(spark, folder, fmt, glob))
    run_to_completion(enc, out, ckpt)
    return spark.read.parquet(out)


def stream_sft(spark: SparkSession, folder: str, max_length: int, fmt: str = "parquet",
               template: C.ChatTemplate = C.DEFAULT_TEMPLATE) -> DataFrame:
    """M1, whole chain: nested conversations -> B7, B2-able rendering, mask, truncation, shift; all
    row-local, so the stream keeps no state. Returns the sink as a DataFrame."""
    out, ckpt = stream_dirs(spark, "sft")
    run_to_completion(C.sft_examples_nested(source(spark, folder, fmt), max_length,
                                            template=template), out, ckpt)
    return spark.read.parquet(out)


def event_time(ts: str) -> F.Column:
    """Event time as TIMESTAMP from a TIMESTAMP or TIMESTAMP_NTZ column, read as UTC wall
    time (independent of the session time zone), second precision."""
    return F.timestamp_seconds(F.unix_timestamp(F.col(ts)))


def run_log_means(log: DataFrame, ts: str = "ts", run: str = "run", value: str = "loss",
                  window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """M2 transformation: per (event-time window, run) mean and count, with a watermark."""
    et = log.withColumn("__et", event_time(ts)).withWatermark("__et", watermark)
    g = et.groupBy(F.window("__et", window).alias("w"), F.col(run)).agg(
        F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), run, "mean_value", "n")


def stream_run_log(spark: SparkSession, folder: str, glob: str | None = None,
                   mode: str = "append", window: str = "1 day", watermark: str = "1 hour"
                   ) -> DataFrame:
    """M2 over the events table as a run log (run = event_type, loss = value / 100).

    ``append`` (default) emits each window once the watermark passes its end and drops
    its state, so state stays bounded on an endless log; ``complete`` rewrites every
    window each trigger (exact snapshot, state kept for all windows)."""
    out, ckpt = stream_dirs(spark, "runlog")
    src = source(spark, folder, glob=glob).select(
        "ts", F.col("event_type").alias("run"), (F.col("value") / 100).alias("loss"))
    run_to_completion(run_log_means(src, window=window, watermark=watermark), out, ckpt, mode)
    return spark.read.parquet(out)
