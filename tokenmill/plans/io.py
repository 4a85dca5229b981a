"""Sources and sinks as checkable queries: write, read back, compare."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT
from tokenmill.operators import chat as C
from tokenmill.operators import ordering as O
from tokenmill.operators import preference as P
from tokenmill.operators import runlog as R
from tokenmill.operators import tokenize as tok
from tokenmill.plans.registry import register
from tokenmill.plans.runlog import run_log
from tokenmill.session import ensure_checkpoint_dir
from tokenmill.sources import sinks, tables


def folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


@register("named_splits", "A1 G2 (two named splits, stacked)", """
SELECT 'train' AS split, doc_id AS id, CAST(length(text) AS BIGINT) AS n FROM documents
UNION ALL SELECT 'test', item_id, CAST(length(text) AS BIGINT) FROM benchmark
""")
def named_splits(spark: SparkSession, sf: str) -> DataFrame:
    both = tables.read_splits(spark, {"train": f"{sf}/documents.parquet", "test": f"{sf}/benchmark.parquet"})
    return both.select("split", F.coalesce("doc_id", "item_id").alias("id"),
                       F.length("text").cast("long").alias("n"))


@register("whole_text", "A2 (files as documents)", """
SELECT md5(line) AS line_md5, CAST(count(*) AS BIGINT) AS n
FROM (SELECT regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS line FROM documents) GROUP BY 1
""")
def whole_text(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "whole_text")
    tables.table(spark, sf, "documents").select(
        F.regexp_replace("text", "[\\r\\n]+", " ").alias("value")).write.text(path)
    files = tables.read_whole_text(spark, path)
    # every line of a written file ends in a line feed
    lines = files.select(F.explode(F.split(F.regexp_replace("text", "\\n\\z", ""), "\n")).alias("line"))
    return lines.groupBy(F.md5("line").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


@register("nested_conversations", "A3 E1 (nested write and read)", """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text FROM conversations
""")
def nested_conversations(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "conversations")
    turns = tables.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    C.collect_messages(turns).write.parquet(path)
    return C.flatten_messages(tables.read_conversations(spark, path))


@register("nested_preferences", "A4 F6 (prompt, chosen, rejected -> nested lists -> flat turns)", """
SELECT item_id AS pair_id, s AS side, CAST(t AS BIGINT) AS turn, CASE WHEN t = 0 THEN 'user' ELSE 'assistant' END AS role,
       CASE WHEN t = 0 THEN text WHEN s = 'chosen' THEN text || ' yes' ELSE reverse(text) END AS text
FROM benchmark, (VALUES ('chosen'), ('rejected')) x(s), (VALUES (0), (1)) y(t)
""")
def nested_preferences(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("pair_id"), F.col("text").alias("prompt"), F.concat("text", F.lit(" yes")).alias("chosen"),
        F.reverse("text").alias("rejected"))
    flat = P.pairs_from_prompts(rows)
    nested = (flat.withColumn("__k", F.struct("pair_id", "side")).transform(
        lambda d: C.collect_messages(d.drop("pair_id", "side"), "__k"))
        .groupBy(F.col("__k.pair_id").alias("pair_id")).agg(
            F.max_by("messages", F.col("__k.side") == "chosen").alias("chosen"),
            F.max_by("messages", F.col("__k.side") == "rejected").alias("rejected")))
    path = folder(spark, "preferences")
    nested.write.parquet(path)
    return P.flatten_pairs(tables.read_preferences(spark, path))


@register("eval_prompts", "A8 (a fixed prompt list against the corpus)", """
SELECT w AS prompt, CAST(count(*) AS BIGINT) AS n_docs
FROM documents, (VALUES ('the'), ('und'), ('les'), ('que')) x(w)
WHERE contains(' ' || text || ' ', ' ' || w || ' ') GROUP BY w
""")
def eval_prompts(spark: SparkSession, sf: str) -> DataFrame:
    prompts = tables.eval_set(spark, [("the",), ("und",), ("les",), ("que",)], "prompt string")
    words = tables.table(spark, sf, "documents").select(
        F.explode(F.array_distinct(F.split(F.col("text"), " "))).alias("prompt"))
    return words.join(F.broadcast(prompts), "prompt").groupBy("prompt").agg(F.count(F.lit(1)).alias("n_docs"))


@register("examples_sink", "A5 (one folder a split, read back)", """
SELECT split, batch_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (
  SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split,
         CAST((row_number() OVER (ORDER BY doc_id) - 1) // 16 AS BIGINT) AS batch_id FROM documents) GROUP BY ALL
""")
def examples_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "examples")
    ids = tables.table(spark, sf, "documents").select("doc_id")
    b = O.assign_batches(ids, ["doc_id"], 16).withColumn(
        "split", F.when(F.col("doc_id") % 10 == 0, "validation").otherwise("train"))
    sinks.write_examples(b, path)
    back = spark.read.parquet(path)
    return back.groupBy("split", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@register("runlog_csv", "A6 (CSV written in two appends, read back)", """
SELECT CAST(event_id // 1000 AS INTEGER) AS epoch, event_id AS step,
       CASE WHEN event_type <> 'view' THEN round(value / 100, 4) END AS train_loss,
       CASE WHEN event_type = 'view' THEN round(value / 100, 4) END AS val_loss
FROM events
""")
def runlog_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "runlog")
    rows = R.loss_to_log_row(run_log(spark, sf))
    R.append_run_log(rows.where("step % 2 = 0"), path, first=True)
    R.append_run_log(rows.where("step % 2 = 1"), path)
    return R.read_run_log(spark, path).select("epoch", "step", "train_loss", "val_loss")


@register("samples_sink", "A7 (samples as JSON lines, appended)", """
SELECT item_id, md5(text) AS text_md5 FROM benchmark
""")
def samples_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "samples")
    b = tables.table(spark, sf, "benchmark")
    sinks.append_samples(b.where("item_id % 2 = 0"), path, first=True)
    sinks.append_samples(b.where("item_id % 2 = 1"), path)
    return spark.read.schema("item_id long, text string").json(path).select(
        "item_id", F.md5("text").alias("text_md5"))


BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@register("bpe_roundtrip", "C3 C4 C11 (byte-level BPE and back)", """
SELECT doc_id, md5(text) AS text_md5, true AS shorter FROM documents
""")
def bpe_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    from tokenmill.operators.bpe import load_ranks
    ranks = load_ranks(BPE_RANKS)
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    dec = tok.decode(tok.encode(docs, kind="bpe", ranks=ranks), kind="bpe", ranks=ranks)
    return dec.select("doc_id", F.md5("decoded").alias("text_md5"),
                      (F.size("tokens") <= F.octet_length("text")).alias("shorter"))


@register("lm_windows_bpe", "C3 C6 C10 D1 D2 (windows over BPE ids with their own end id)")
def lm_windows_bpe(spark: SparkSession, sf: str) -> DataFrame:
    from tokenmill.operators.bpe import load_ranks
    from tokenmill.plans.pretrain import lm_dataset
    w = lm_dataset(tables.table(spark, sf, "documents").select("doc_id", "text"), 64, 64, kind="bpe",
                   ranks=load_ranks(BPE_RANKS))
    return w.select("window_id", "input_ids", "target_ids")


@register("special_marker_bytes", "C5 C6 (a marker inside the text is one reserved id)", f"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(hex(text), '..'),
         lambda h: CAST(('0x' || h) AS INTEGER)) || [256] || list_transform(regexp_extract_all(hex(text), '..'),
         lambda h: CAST(('0x' || h) AS INTEGER)), ' ') AS ids FROM documents
""")
def special_marker_bytes(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit(EOS_TEXT), "text").alias("text"))
    return tok.encode(docs, kind="byte").select("doc_id", F.array_join("tokens", " ").alias("ids"))


@register("special_marker_texts", "C5 C6 (a marker between whole texts is one reserved id)", """
WITH h AS (SELECT doc_id, list_transform(regexp_extract_all(hex(text), '..'),
                                         lambda h: CAST(('0x' || h) AS INTEGER)) AS b FROM documents)
SELECT doc_id, md5(array_to_string(b || [256] || b, ' ')) AS ids_md5,
       CAST(2 * len(b) + 1 AS INTEGER) AS n_ids FROM h
""")
def special_marker_texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit(EOS_TEXT), "text").alias("text"))
    return tok.encode(docs, kind="byte").select(
        "doc_id", F.md5(F.array_join("tokens", " ")).alias("ids_md5"), F.size("tokens").alias("n_ids"))
