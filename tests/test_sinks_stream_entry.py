"""Sinks, streaming jobs, the run log CSV and the driver contract."""

import os

from pyspark.sql import functions as F

from tokenmill.operators import runlog as R
from tokenmill.sources import sinks
from tokenmill.streaming import jobs


def test_run_log_csv_roundtrip(spark, tmp_dir):
    ts = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    log = spark.createDataFrame([("train", 0, 1, 0.5), ("val", 0, 2, 0.25)],
                                "type string, epoch int, step long, loss double").withColumn("ts", ts)
    rows = R.loss_to_log_row(log)
    path = os.path.join(tmp_dir, "metrics")
    R.append_run_log(rows.where("step = 1"), path, first=True)
    R.append_run_log(rows.where("step = 2"), path)
    back = {r.step: r for r in R.read_run_log(spark, path).collect()}
    assert back[1].train_loss == 0.5 and back[1].val_loss is None
    assert back[2].val_perplexity == round(2.718281828 ** 0.25, 2) and back[2].train_loss is None
    assert back[1].timestamp == "2024-01-02 03:04:05"


def test_write_examples_and_samples(spark, tmp_dir):
    df = spark.createDataFrame([(0, "train", 0), (1, "validation", 0), (2, "train", 1)],
                               "id long, split string, batch_id long")
    path = os.path.join(tmp_dir, "examples")
    sinks.write_examples(df, path)
    assert {"split=train", "split=validation"} <= set(os.listdir(path))
    val = spark.read.parquet(path).where("split = 'validation'")
    assert [r.id for r in val.collect()] == [1]
    sp = os.path.join(tmp_dir, "peek")
    sinks.append_samples(df.select("id"), sp, first=True)
    sinks.append_samples(df.select("id"), sp)
    assert spark.read.json(sp).count() == 6


def test_stream_encode_equals_batch(spark, tmp_dir):
    rows = [(0, 0, "user", "hi there"), (0, 1, "assistant", "yo"), (1, 0, "user", "a b c")]
    src = os.path.join(tmp_dir, "turns")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .write.parquet(src)
    out = jobs.stream_encode(spark, src)
    got = {(r.conv_id, r.turn): r.n_tokens for r in out.collect()}
    assert got == {(0, 0): 6, (0, 1): 5, (1, 0): 7}


def test_streams_read_a_table_that_is_one_file_or_a_folder_of_parts(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    turns = pa.table({"conv_id": [0, 1, 2], "turn": [0, 0, 0], "role": ["user"] * 3, "text": ["a", "b c", "d"]})
    folder, flat = os.path.join(tmp_dir, "parts"), os.path.join(tmp_dir, "flat")
    os.makedirs(os.path.join(folder, "conversations.parquet"))
    os.makedirs(flat)
    for i in range(3):
        pq.write_table(turns.slice(i, 1), os.path.join(folder, "conversations.parquet", f"part-{i}.parquet"))
    pq.write_table(turns, os.path.join(flat, "conversations.parquet"))
    for top in (folder, flat):
        pq.write_table(pa.table({"other": [1]}), os.path.join(top, "labels.parquet"))
        got = jobs.stream_encode(spark, top, glob="conversations.parquet").collect()
        assert {(r.conv_id, r.n_tokens) for r in got} == {(0, 5), (1, 6), (2, 5)}


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["window_id", "input_ids", "target_ids"]
    assert df.count() >= 0
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 55


def test_stream_run_log_append_emits_closed_windows(spark, tmp_dir):
    import datetime as dt
    src = os.path.join(tmp_dir, "log")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=h), "a" if h % 2 else "b", float(h)) for h in range(72)]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double").write.parquet(src)
    out = jobs.stream_run_log(spark, src)  # append: only windows the watermark has closed
    days = sorted({r.window_start for r in out.collect()})
    assert days and all(d < 1704067200 + 2 * 86400 for d in days)  # the last day is still open
    full = jobs.stream_run_log(spark, src, mode="complete")
    assert full.select("window_start").distinct().count() == 3
