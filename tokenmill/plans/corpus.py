"""Checkable queries for segmentation, splits and batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import BLANK_CLASS
from tokenmill.functions.text import is_blank, word_pattern
from tokenmill.operators import ordering as O
from tokenmill.operators import segment as seg
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

RX = word_pattern()
BLANK = f"[{BLANK_CLASS}]*"
LINE_RX = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


# the corpus by its definition: rows joined with a line feed, then split
RAW_LINES = f"""
raw AS (SELECT string_agg(CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 3 = 0 THEN ' = Doc ' || doc_id || ' = ' || chr(10) || x
                          WHEN doc_id % 3 = 1 THEN ' = = Part = = ' || chr(10) || x ELSE x END,
                          chr(10) ORDER BY doc_id) AS raw
        FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || chr(10) WHEN doc_id % 7 = 1 THEN text || chr(13)
                             ELSE text END AS x FROM documents)),
p AS (SELECT string_split_regex(raw, '{LINE_RX}') AS parts FROM raw),
k AS (SELECT line, ln FROM (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS ln, len(parts) AS np FROM p)
      WHERE NOT (ln = np AND line = ''))
"""
SEGMENT_SQL = f"""
WITH {RAW_LINES},
s AS (SELECT *, sum(CASE WHEN starts_with(line, ' = ') AND NOT starts_with(line, ' = = ') THEN 1 ELSE 0 END)
                OVER (ORDER BY ln ROWS UNBOUNDED PRECEDING) AS seg_id FROM k),
d AS (SELECT seg_id, string_agg(line, chr(10) ORDER BY ln) AS t,
             max(CASE WHEN regexp_full_match(line, '{BLANK}') THEN 0 ELSE 1 END) AS nonblank
      FROM s GROUP BY seg_id)
SELECT CAST(seg_id AS BIGINT) AS seg_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM d WHERE nonblank = 1
"""


@register("segment_headings", "C1 C2 B1", SEGMENT_SQL)
def segment_headings(spark: SparkSession, sf: str) -> DataFrame:
    corpus = seg.heading_corpus(_docs(spark, sf))
    docs = seg.segment_by_heading(corpus)
    return docs.select("seg_id", F.length("text").cast("long").alias("n_chars"),
                       F.md5("text").alias("text_md5"))


PART_BYTES = 2048
PARTS_SQL = f"""
WITH {RAW_LINES},
s AS (SELECT *, sum(CASE WHEN starts_with(line, ' = ') AND NOT starts_with(line, ' = = ') THEN 1 ELSE 0 END)
                OVER (ORDER BY ln ROWS UNBOUNDED PRECEDING) AS seg_id FROM k),
d AS (SELECT *, max(CASE WHEN regexp_full_match(line, '{BLANK}') THEN 0 ELSE 1 END) OVER w AS nonblank,
             max(ln) OVER w AS last FROM s WINDOW w AS (PARTITION BY seg_id)),
e AS (SELECT seg_id, ln, CASE WHEN ln = last THEN line ELSE line || chr(10) END AS line FROM d WHERE nonblank = 1),
x AS (SELECT seg_id, ln, i, substr(line, i + 1, {PART_BYTES // 8}) AS piece FROM (
        SELECT *, unnest(range(0, greatest(length(line), 1), {PART_BYTES // 8})) AS i FROM e)),
a AS (SELECT *, coalesce(sum(octet_length(encode(piece))) OVER (PARTITION BY seg_id ORDER BY ln, i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x)
SELECT CAST(seg_id AS BIGINT) AS seg_id, CAST(before // {PART_BYTES // 2} AS BIGINT) AS part_no,
       CAST(sum(octet_length(encode(piece))) AS BIGINT) AS n_bytes, md5(string_agg(piece, '' ORDER BY ln, i)) AS text_md5
FROM a GROUP BY ALL
"""


@register("segment_parts", "C2 B1 (documents as bounded parts)", PARTS_SQL)
def segment_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = seg.segment_parts(seg.heading_corpus(_docs(spark, sf)), part_bytes=PART_BYTES)
    return parts.select("seg_id", "part_no", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.md5("text").alias("text_md5"))


LINES_SQL = f"""
WITH {RAW_LINES}
SELECT md5(line) AS line_md5, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN regexp_full_match(line, '{BLANK}') THEN 0 ELSE 1 END) AS BIGINT) AS n_nonblank,
       CAST(sum(length(line)) AS BIGINT) AS line_chars
FROM k GROUP BY md5(line)
"""


@register("explode_lines", "C1 B1", LINES_SQL)
def explode_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = seg.explode_lines(seg.heading_corpus(_docs(spark, sf)))
    return lines.groupBy(F.md5("line").alias("line_md5")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum((~is_blank("line")).cast("int")).cast("long").alias("n_nonblank"),
        F.sum(F.length("line")).cast("long").alias("line_chars"))


@register("drop_blank", "B1 (lines that strip to nothing)", f"""
WITH {RAW_LINES}
SELECT md5(line) AS line_md5, CAST(count(*) AS BIGINT) AS n FROM k
WHERE NOT regexp_full_match(line, '{BLANK}') GROUP BY md5(line)
""")
def drop_blank(spark: SparkSession, sf: str) -> DataFrame:
    lines = seg.drop_blank(seg.explode_lines(seg.heading_corpus(_docs(spark, sf))), "line")
    return lines.groupBy(F.md5("line").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


TAIL_SPLIT_SQL = """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn > n - greatest(1, floor(CAST(0.01 AS DOUBLE) * n)) THEN 'validation'
                    ELSE 'train' END AS split
FROM r
"""


@register("tail_split", "G0 G1", TAIL_SPLIT_SQL)
def tail_split(spark: SparkSession, sf: str) -> DataFrame:
    return O.tail_split(_docs(spark, sf).select("doc_id"), ["doc_id"], 0.01)


DOC_SPLIT_SQL = """
WITH s AS (SELECT text, CASE WHEN CAST(('0x' || substr(md5('3:' || md5(text)), 1, 13)) AS BIGINT)
                                / 4503599627370496.0 < 0.1 THEN 'validation' ELSE 'train' END AS split
           FROM documents)
SELECT split, CAST(count(*) AS BIGINT) AS n_docs, CAST(count(DISTINCT text) AS BIGINT) AS n_texts,
       CAST((SELECT count(*) FROM (SELECT text FROM s GROUP BY text HAVING count(DISTINCT split) > 1)) AS BIGINT)
         AS n_leaked
FROM s GROUP BY split
"""


@register("doc_split_leak", "G3 (split by content; leaks looked for by text)", DOC_SPLIT_SQL)
def doc_split_leak(spark: SparkSession, sf: str) -> DataFrame:
    s = O.split_by_content(_docs(spark, sf), "text", 0.1, seed=3).withColumn("digest", F.md5("text"))
    n_leaked = O.split_leaks(s, "digest").count()  # one scalar (must be 0)
    counts = s.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                    F.count_distinct("digest").alias("n_texts"))
    return counts.select("split", "n_docs", "n_texts", F.lit(n_leaked).cast("long").alias("n_leaked"))


BATCH_PLAN_SQL = """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7:0:' || doc_id), doc_id) AS rn,
                  count(*) OVER () AS n FROM documents)
SELECT doc_id, CAST((rn - 1) // 7 AS BIGINT) AS batch_id, CAST((rn - 1) % 7 AS INTEGER) AS pos_in_batch
FROM r WHERE rn <= 7 * (n // 7)
"""


@register("batch_plan", "G4 G5 (shuffle + drop_last)", BATCH_PLAN_SQL)
def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    d = O.shuffle_order(_docs(spark, sf).select("doc_id"), "doc_id", seed=7, epoch=0)
    b = O.assign_batches(d, ["shuffle_key", "doc_id"], 7, drop_last=True)
    return b.select("doc_id", "batch_id", "pos_in_batch")


EPOCH_SQL = """
WITH RECURSIVE x AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS x, count(*) OVER () AS n FROM documents),
g AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM x),
h AS (SELECT *, (n + a - 1) // a AS b FROM g),
w AS (SELECT doc_id, e AS epoch, n, a, b, x // b AS l, x % b AS r, 0 AS t FROM h, range(0, 3) s(e)
      UNION ALL
      SELECT doc_id, epoch, n, a, b,
             CASE WHEN t % 2 = 0 THEN (l + CAST(('0x' || substr(md5('7:' || epoch || ':' || t % 6 || ':' || r), 1, 13)) AS BIGINT)) % a
                  ELSE l END,
             CASE WHEN t % 2 = 1 THEN (r + CAST(('0x' || substr(md5('7:' || epoch || ':' || t % 6 || ':' || l), 1, 13)) AS BIGINT)) % b
                  ELSE r END, t + 1
      FROM w WHERE t = 0 OR t % 6 <> 0 OR l * b + r >= n)
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, CAST((l * b + r) // 7 AS BIGINT) AS batch_id,
       CAST((l * b + r) % 7 AS INTEGER) AS pos_in_batch
FROM w WHERE t > 0 AND t % 6 = 0 AND l * b + r < n
"""


@register("epoch_batches", "G4 G5 (places of three epochs by a keyed permutation of one ranking)", EPOCH_SQL)
def epoch_batches(spark: SparkSession, sf: str) -> DataFrame:
    ranked = O.rank_rows(_docs(spark, sf).select("doc_id"), ["doc_id"])
    placed = O.epoch_places(ranked, ranked.count(), seed=7, epochs=3)
    return placed.select("doc_id", "epoch", F.floor(F.col("place") / 7).cast("long").alias("batch_id"),
                         (F.col("place") % 7).cast("int").alias("pos_in_batch"))


BATCH_SHAPE_SQL = f"""
WITH r AS (SELECT doc_id, len(regexp_extract_all(text, '{RX}')) + 1 AS n_tok,
                  row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
b AS (SELECT (rn - 1) // 7 AS batch_id, n_tok FROM r)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(max(n_tok) AS INTEGER) AS max_len, CAST(sum(n_tok) AS BIGINT) AS real_tokens,
       CAST(count(*) * max(n_tok) - sum(n_tok) AS BIGINT) AS dynamic_pad,
       CAST(sum(4096 - least(n_tok, 4096)) AS BIGINT) AS static_pad
FROM b GROUP BY batch_id
"""


@register("batch_shape", "G5 G6 (keep last partial batch)", BATCH_SHAPE_SQL)
def batch_shape(spark: SparkSession, sf: str) -> DataFrame:
    from tokenmill.functions.text import word_tokens
    d = _docs(spark, sf).select("doc_id", (F.size(word_tokens("text")) + 1).alias("n_tok"))
    b = O.assign_batches(d, ["doc_id"], 7)
    out = O.batch_shape(b, "n_tok", static_width=4096)
    return out.select("batch_id", "n_rows", "max_len", F.col("real_tokens").cast("long"),
                      F.col("dynamic_pad").cast("long"), F.col("static_pad").cast("long"))


STEP_PLAN_SQL = """
WITH b AS (SELECT count(*) AS n FROM documents),
nb AS (SELECT CAST(ceil(n / 8) AS BIGINT) AS n_batches FROM b),
p AS (SELECT n_batches, n_batches * 3 AS total_steps, CAST(floor(n_batches * 3 * CAST(0.03 AS DOUBLE)) AS BIGINT) AS warmup_steps,
             CAST(greatest(1, n_batches // 10) AS BIGINT) AS eval_every FROM nb)
SELECT n_batches, total_steps, warmup_steps, eval_every,
       CAST((SELECT count(*) FROM range(0, total_steps) r(s) WHERE s % eval_every = 0 AND s > 0) AS BIGINT)
         AS n_evals,
       CAST((SELECT count(*) FROM range(0, total_steps) r(s) WHERE s % 25 = 0) AS BIGINT) AS n_peeks
FROM p
"""


@register("step_plan", "G7 G8 G9", STEP_PLAN_SQL)
def step_plan(spark: SparkSession, sf: str) -> DataFrame:
    b = O.assign_batches(_docs(spark, sf).select("doc_id"), ["doc_id"], 8)
    plan = O.plan_steps(b, epochs=3).first()  # one row of scalars
    every = plan["eval_every"]
    batches = b.select("batch_id").distinct()
    # one training step per (epoch, batch); steps derive from the batch table
    steps = batches.select(F.explode(F.sequence(F.lit(0), F.lit(2))).alias("epoch"), "batch_id")
    steps = steps.select((F.col("epoch") * plan["n_batches"] + F.col("batch_id")).alias("step"))
    evals = O.cadence(steps, every, skip_zero=True).select(F.lit(1).alias("e"), F.lit(0).alias("p"))
    peeks = O.cadence(steps, 25).select(F.lit(0).alias("e"), F.lit(1).alias("p"))
    agg = evals.unionByName(peeks).agg(F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("n_evals"),
                                        F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("n_peeks"))
    return agg.select(F.lit(plan["n_batches"]).cast("long").alias("n_batches"),
                      F.lit(plan["total_steps"]).cast("long").alias("total_steps"),
                      F.lit(plan["warmup_steps"]).cast("long").alias("warmup_steps"),
                      F.lit(every).cast("long").alias("eval_every"), "n_evals", "n_peeks")


LOOP_SQL = """
WITH b AS (SELECT CAST(ceil(count(*) / 8) AS BIGINT) AS n FROM documents),
s AS (SELECT unnest(range(1, 3 * n + 1)) AS step, n FROM b)
SELECT 0 AS epoch, CAST(0 AS BIGINT) AS step, 'peek' AS event
UNION ALL SELECT CAST((step - 1) // n AS INTEGER), step, 'peek' FROM s WHERE step % 25 = 0
UNION ALL SELECT CAST((step - 1) // n AS INTEGER), step, 'eval' FROM s WHERE step % 10 = 0
UNION ALL SELECT CAST(step // n - 1 AS INTEGER), step, 'epoch_end' FROM s WHERE step % n = 0
"""


@register("loop_cadence", "G8 (steps from 1, a peek before the first, checks at epoch ends)", LOOP_SQL)
def loop_cadence(spark: SparkSession, sf: str) -> DataFrame:
    b = O.assign_batches(_docs(spark, sf).select("doc_id"), ["doc_id"], 8)
    return O.loop_cadence(b, epochs=3, peek_every=25, eval_every=10)


SEGMENT_WINDOWS_SQL = f"""
WITH {RAW_LINES},
s AS (SELECT *, sum(CASE WHEN starts_with(line, ' = ') AND NOT starts_with(line, ' = = ') THEN 1 ELSE 0 END)
                OVER (ORDER BY ln ROWS UNBOUNDED PRECEDING) AS seg_id FROM k),
d AS (SELECT seg_id, string_agg(line, chr(10) ORDER BY ln) AS t,
             max(CASE WHEN regexp_full_match(line, '{BLANK}') THEN 0 ELSE 1 END) AS nonblank
      FROM s GROUP BY seg_id),
t AS (SELECT seg_id, list_append(regexp_extract_all(t, '{RX}'), '<|endoftext|>') AS a FROM d WHERE nonblank = 1),
g AS (SELECT row_number() OVER (ORDER BY seg_id, pos) - 1 AS i, tok
      FROM (SELECT seg_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
n AS (SELECT count(*) AS n_tok FROM g),
e AS (SELECT unnest(range(greatest(0, (i - 64 + 31) // 32), i // 32 + 1)) AS w, i, tok FROM g)
SELECT CAST(w AS BIGINT) AS window_id,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < w * 32 + 64) AS input_ids,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i > w * 32) AS target_ids
FROM e, n WHERE w * 32 < n_tok - 64 GROUP BY w
"""


@register("segment_windows", "A1 C1 C2 B1 C3 C10 D1 D2 (line corpus -> windows, no document strings)",
          SEGMENT_WINDOWS_SQL)
def segment_windows(spark: SparkSession, sf: str) -> DataFrame:
    from tokenmill.functions.arrays import join_tokens
    from tokenmill.operators import windows as win
    corpus = seg.heading_corpus(_docs(spark, sf))
    toks = seg.segment_tokens(seg.segment_lines(corpus))
    offs, n = win.stream_offsets(toks, ["seg_id", "doc_id", "line_no"], with_total=True)
    w = win.sliding_windows(offs, 64, 32, n_tokens=n)
    return w.select("window_id", join_tokens("input_ids").alias("input_ids"),
                    join_tokens("target_ids").alias("target_ids"))
