"""Checkable SFT / chat queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmill.config import BOS_TEXT, EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT, PAD_TEXT
from tokenmill.functions.arrays import join_tokens
from tokenmill.functions.text import word_pattern
from tokenmill.operators import chat as C
from tokenmill.operators import ordering as O
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

T = C.DEFAULT_TEMPLATE
TRX = word_pattern(T.specials)
IGN = "-100"  # ignore label in string-token form

# DuckDB rendering shared by the SQL twins.
BASE_SQL = f"""
m AS (SELECT conv_id, turn, role,
             ['{HEADER_START_TEXT}', role, '{HEADER_END_TEXT}'] || regexp_extract_all(text, '{TRX}')
             || ['{EOT_TEXT}'] AS a, text FROM conversations),
l AS (SELECT conv_id, max(turn) AS mt, arg_max(role, turn) AS lr, count(*) AS nt FROM m GROUP BY conv_id),
f AS (SELECT conv_id, lr, nt, ['{BOS_TEXT}'] || flatten(list(a ORDER BY turn)) AS fl,
             1 + coalesce(sum(len(a)) FILTER (WHERE turn < mt), 0) + 3 AS pl,
             ['{BOS_TEXT}'] || coalesce(flatten(list(a ORDER BY turn) FILTER (WHERE turn < mt)), [])
             || ['{HEADER_START_TEXT}', 'assistant', '{HEADER_END_TEXT}'] AS prompt
      FROM m JOIN l USING (conv_id) GROUP BY conv_id, lr, nt)
"""


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


def _examples(spark: SparkSession, sf: str, max_length: int = 64) -> DataFrame:
    return C.sft_examples(_turns(spark, sf), max_length, ignore=IGN)


SFT_SQL = f"""
WITH {BASE_SQL},
k AS (SELECT conv_id, fl, pl, len(fl) AS fn FROM f WHERE lr = 'assistant'),
x AS (SELECT conv_id, fn, pl,
             list_slice(fl, greatest(1, fn - 64 + 1), fn) AS ids,
             list_slice(list_transform(fl, lambda t, i: CASE WHEN i <= pl THEN '{IGN}' ELSE t END),
                        greatest(1, fn - 64 + 1), fn) AS labels FROM k)
SELECT conv_id, array_to_string(list_slice(ids, 1, len(ids) - 1), ' ') AS input_ids,
       array_to_string(list_slice(labels, 2, len(labels)), ' ') AS target_ids,
       CAST(fn AS BIGINT) AS full_len, CAST(pl AS BIGINT) AS prompt_len
FROM x
"""


@register("sft_examples", "E2 E3 E4 E5 E6 E7 B7", SFT_SQL)
def sft_examples(spark: SparkSession, sf: str) -> DataFrame:
    ex = _examples(spark, sf)
    return ex.select("conv_id", join_tokens("input_ids").alias("input_ids"),
                     join_tokens("target_ids").alias("target_ids"), "full_len", "prompt_len")


SFT_FITS_SQL = f"""
WITH {BASE_SQL},
s AS (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ORDER BY conv_id LIMIT 80),
k AS (SELECT conv_id, len(fl) AS fn FROM f
      WHERE lr = 'assistant' AND conv_id IN (SELECT conv_id FROM s) AND len(fl) <= 256),
c AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY conv_id) AS rn FROM k) WHERE rn <= 30),
n AS (SELECT count(*) AS n FROM c)
SELECT conv_id, CASE WHEN rn > n - greatest(1, floor(CAST(0.1 AS DOUBLE) * n)) THEN 'validation'
                     ELSE 'train' END AS split, CAST(fn AS BIGINT) AS full_len
FROM c, n
"""


@register("sft_fits", "B2 B4 B5 G1 (scan bound -> filter -> cap -> split)", SFT_FITS_SQL)
def sft_fits(spark: SparkSession, sf: str) -> DataFrame:
    turns = _turns(spark, sf)
    scanned = O.first_n_by_order(turns.select("conv_id").distinct(), ["conv_id"], 80)
    turns = turns.join(scanned, "conv_id", "left_semi")
    lay = C.layout(C.render_turns(turns))
    lay, _ = C.require_last_role(lay)
    convs = C.conversation_stats(C.fits(lay, 256)).select("conv_id", "full_len")
    capped = O.cap_examples(convs, ["conv_id"], 30)
    return O.tail_split(capped, ["conv_id"], 0.1).select("conv_id", "split", "full_len")


PAD_STATIC_SQL = f"""
WITH {BASE_SQL},
k AS (SELECT conv_id, fl, pl, len(fl) AS fn FROM f WHERE lr = 'assistant'),
x AS (SELECT conv_id, list_slice(fl, greatest(1, fn - 64 + 1), fn) AS ids,
             list_slice(list_transform(fl, lambda t, i: CASE WHEN i <= pl THEN '{IGN}' ELSE t END),
                        greatest(1, fn - 64 + 1), fn) AS labels FROM k),
y AS (SELECT conv_id, list_slice(ids, 1, len(ids) - 1) AS inp, list_slice(labels, 2, len(labels)) AS tgt FROM x)
SELECT conv_id,
       array_to_string(inp || list_transform(range(63 - len(inp)), lambda z: '{PAD_TEXT}'), ' ') AS input_ids,
       array_to_string(tgt || list_transform(range(63 - len(tgt)), lambda z: '{IGN}'), ' ') AS target_ids
FROM y
"""


@register("sft_pad_static", "E9 E10", PAD_STATIC_SQL)
def sft_pad_static(spark: SparkSession, sf: str) -> DataFrame:
    pad = C.resolve_pad_id(PAD_TEXT, "<|endoftext|>")
    ex = C.pad_static(_examples(spark, sf), 63, {"input_ids": pad, "target_ids": IGN})
    return ex.select("conv_id", join_tokens("input_ids").alias("input_ids"),
                     join_tokens("target_ids").alias("target_ids"))


PAD_DYNAMIC_SQL = f"""
WITH {BASE_SQL},
k AS (SELECT conv_id, fl, pl, len(fl) AS fn FROM f WHERE lr = 'assistant'),
x AS (SELECT conv_id, list_slice(fl, greatest(1, fn - 64 + 1), fn) AS ids,
             list_slice(list_transform(fl, lambda t, i: CASE WHEN i <= pl THEN '{IGN}' ELSE t END),
                        greatest(1, fn - 64 + 1), fn) AS labels FROM k),
y AS (SELECT conv_id, list_slice(ids, 1, len(ids) - 1) AS inp, list_slice(labels, 2, len(labels)) AS tgt,
             (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS batch_id FROM x),
z AS (SELECT *, max(len(inp)) OVER (PARTITION BY batch_id) AS width FROM y)
SELECT conv_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(width AS INTEGER) AS width,
       array_to_string(inp || list_transform(range(width - len(inp)), lambda q: '{PAD_TEXT}'), ' ') AS input_ids,
       array_to_string(tgt || list_transform(range(width - len(tgt)), lambda q: '{IGN}'), ' ') AS target_ids
FROM z
"""


@register("sft_pad_dynamic", "E8 G5", PAD_DYNAMIC_SQL)
def sft_pad_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    ex = O.assign_batches(_examples(spark, sf), ["conv_id"], 4)
    ex = C.pad_dynamic(ex, {"input_ids": PAD_TEXT, "target_ids": IGN})
    return ex.select("conv_id", "batch_id", "width", join_tokens("input_ids").alias("input_ids"),
                     join_tokens("target_ids").alias("target_ids"))


LABEL_STATS_SQL = f"""
WITH {BASE_SQL},
k AS (SELECT conv_id, fl, pl, len(fl) AS fn FROM f WHERE lr = 'assistant'),
x AS (SELECT conv_id, list_slice(list_transform(fl, lambda t, i: CASE WHEN i <= pl THEN '{IGN}' ELSE t END),
                        greatest(1, fn - 64 + 1), fn) AS labels FROM k),
y AS (SELECT conv_id, list_slice(labels, 2, len(labels)) AS tgt, row_number() OVER (ORDER BY conv_id) AS rn,
             count(*) OVER () AS n FROM x),
s AS (SELECT CASE WHEN rn > n - greatest(1, floor(CAST(0.1 AS DOUBLE) * n)) THEN 'validation' ELSE 'train' END
             AS split, tgt FROM y)
SELECT split, CAST(count(*) AS BIGINT) AS n_examples,
       CAST(sum(len(list_filter(tgt, lambda v: v <> '{IGN}'))) AS BIGINT) AS supervised_tokens,
       CAST(sum(len(tgt)) AS BIGINT) AS target_tokens
FROM s GROUP BY split
"""


@register("sft_label_stats", "E14 H2-prep G1", LABEL_STATS_SQL)
def sft_label_stats(spark: SparkSession, sf: str) -> DataFrame:
    ex = O.tail_split(_examples(spark, sf), ["conv_id"], 0.1)
    return C.supervised_token_stats(ex, ["split"], ignore=IGN)


PREFIX_AUDIT_SQL = f"""
WITH {BASE_SQL}
SELECT conv_id, lr AS last_role, CAST(nt AS BIGINT) AS n_turns, CAST(pl AS BIGINT) AS prompt_len,
       CAST(len(fl) AS BIGINT) AS full_len, list_slice(fl, 1, pl) = prompt AS prefix_ok
FROM f
"""


@register("prompt_prefix_audit", "E3 E4 B7 (rejects visible)", PREFIX_AUDIT_SQL)
def prompt_prefix_audit(spark: SparkSession, sf: str) -> DataFrame:
    lay = C.layout(C.render_turns(_turns(spark, sf)))
    st = C.conversation_stats(lay)
    return st.select("conv_id", "last_role", F.col("n_turns").cast("long").alias("n_turns"),
                     "prompt_len", "full_len", F.col("last_header_ok").alias("prefix_ok"))


RENDER_SQL = f"""
WITH {BASE_SQL}
SELECT conv_id, CAST(len(fl) AS BIGINT) AS full_len, array_to_string(fl, ' ') AS rendered FROM f
"""


@register("chat_render", "E2", RENDER_SQL)
def chat_render(spark: SparkSession, sf: str) -> DataFrame:
    r = C.render_chat(_turns(spark, sf))
    return r.select("conv_id", "full_len", join_tokens("ids").alias("rendered"))


EXTRACT_SQL = f"""
WITH {BASE_SQL}
SELECT conv_id, array_to_string(regexp_extract_all(arg_max(text, turn), '{TRX}'), ' ') AS response
FROM m JOIN f USING (conv_id) WHERE f.lr = 'assistant' GROUP BY conv_id
"""


@register("extract_response", "E13", EXTRACT_SQL)
def extract_response(spark: SparkSession, sf: str) -> DataFrame:
    out = C.last_response(_turns(spark, sf))
    return out.select("conv_id", join_tokens("response").alias("response"))


GENERATED_SQL = f"""
WITH n AS (SELECT conv_id, turn, role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations),
t AS (SELECT conv_id, turn, regexp_extract_all(answer, '{TRX}') AS a FROM n WHERE role = 'user' AND answer IS NOT NULL)
SELECT conv_id, turn, array_to_string(a[1:(len(a) + 1) // 2], ' ') AS response FROM t
"""


@register("extract_generated", "E13 E12 (slice after the prompt, cut at the stop inside, specials dropped)", GENERATED_SQL)
def extract_generated(spark: SparkSession, sf: str) -> DataFrame:
    """A generation for every user turn that is answered: the prompt, a header mark, the first half of
    the answer, an end mark, then the second half, which no longer belongs to the response."""
    following = Window.partitionBy("conv_id").orderBy("turn")
    asked = _turns(spark, sf).withColumn("answer", F.lead("text").over(following)).where(
        (F.col("role") == "user") & F.col("answer").isNotNull()).withColumnRenamed("text", "prompt")
    a = T.tokens(F.col("answer"))
    half = F.ceil(F.size("a") / 2).cast("int")
    made = C.format_prompt(asked, "prompt").withColumn("a", a).withColumn("generated", F.concat(
        "prompt_ids", F.array(F.lit(HEADER_END_TEXT)), F.slice("a", F.lit(1), half), F.array(F.lit(EOT_TEXT)),
        F.slice("a", half + 1, F.size("a") - half)))
    out = C.extract_response(made, "generated", F.size("prompt_ids"), drop=[HEADER_END_TEXT])
    return out.select("conv_id", "turn", join_tokens("response").alias("response"))


FORMAT_PROMPT_SQL = f"""
SELECT conv_id, turn,
       array_to_string(['{BOS_TEXT}', '{HEADER_START_TEXT}', 'user', '{HEADER_END_TEXT}']
                       || regexp_extract_all(text, '{TRX}')
                       || ['{EOT_TEXT}', '{HEADER_START_TEXT}', 'assistant', '{HEADER_END_TEXT}'], ' ') AS prompt_ids,
       substr(text, 1, 70) AS preview
FROM conversations WHERE role = 'user'
"""


@register("format_prompt", "E12 B6", FORMAT_PROMPT_SQL)
def format_prompt(spark: SparkSession, sf: str) -> DataFrame:
    users = _turns(spark, sf).where(F.col("role") == "user").withColumnRenamed("text", "prompt")
    out = C.format_prompt(users, "prompt")
    return out.select("conv_id", "turn", join_tokens("prompt_ids").alias("prompt_ids"),
                      C.preview("prompt").alias("preview"))


GENERATION_PAD_SQL = f"""
WITH p AS (SELECT conv_id, turn, ['{BOS_TEXT}', '{HEADER_START_TEXT}', 'user', '{HEADER_END_TEXT}']
                  || regexp_extract_all(text, '{TRX}')
                  || ['{EOT_TEXT}', '{HEADER_START_TEXT}', 'assistant', '{HEADER_END_TEXT}'] AS a,
                  (row_number() OVER (ORDER BY conv_id, turn) - 1) // 8 AS batch_id
           FROM conversations WHERE role = 'user'),
w AS (SELECT *, max(len(a)) OVER (PARTITION BY batch_id) AS width FROM p)
SELECT conv_id, turn, CAST(batch_id AS BIGINT) AS batch_id, CAST(width AS INTEGER) AS width,
       array_to_string(list_transform(range(width - len(a)), lambda q: '{PAD_TEXT}') || a, ' ') AS prompt_ids,
       CAST(width - len(a) AS BIGINT) AS n_pads, CAST(len(a) AS BIGINT) AS n_attended,
       array_to_string(list_transform(range(width), lambda i: greatest(0, i - (width - len(a)))), ' ') AS positions
FROM w
"""


@register("generation_pad", "E8 E12 (left padding for generation, mask and positions)", GENERATION_PAD_SQL)
def generation_pad(spark: SparkSession, sf: str) -> DataFrame:
    users = _turns(spark, sf).where(F.col("role") == "user").withColumnRenamed("text", "prompt")
    prompts = C.format_prompt(users, "prompt").select("conv_id", "turn", "prompt_ids")
    out = C.pad_for_generation(O.assign_batches(prompts, ["conv_id", "turn"], 8), "prompt_ids", PAD_TEXT)
    attended = F.size(F.filter("attention_mask", lambda m: m == 1)).cast("long")
    return out.select("conv_id", "turn", "batch_id", "width", join_tokens("prompt_ids").alias("prompt_ids"),
                      (F.size("attention_mask") - attended).cast("long").alias("n_pads"),
                      attended.alias("n_attended"),
                      F.array_join(F.col("position_ids").cast("array<string>"), " ").alias("positions"))
