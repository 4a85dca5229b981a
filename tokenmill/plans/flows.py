"""The three end-to-end flows and the nested / integer-id forms as checkable queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT, EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT, BOS_TEXT, PAD_TEXT
from tokenmill.functions.arrays import join_tokens
from tokenmill.operators import chat as C
from tokenmill.operators import metrics as M
from tokenmill.operators import ordering as O
from tokenmill.operators import preference as P
from tokenmill.operators import segment as seg
from tokenmill.plans import datasets as D
from tokenmill.plans.corpus import BLANK, LINE_RX, RX
from tokenmill.plans.preference import PAIRS_SQL
from tokenmill.plans.prefix import materialize
from tokenmill.plans.registry import register
from tokenmill.plans.sft import BASE_SQL, SFT_SQL
from tokenmill.sources.tables import table
from tokenmill.streaming import jobs


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


def _split_flow(s: str, cond: str) -> str:
    """Windows of one named split of the heading corpus, from the definition."""
    return f"""
raw_{s} AS (SELECT string_agg(CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 3 = 0 THEN ' = Doc ' || doc_id || ' = ' || chr(10) || x
              WHEN doc_id % 3 = 1 THEN ' = = Part = = ' || chr(10) || x ELSE x END, chr(10) ORDER BY doc_id) AS raw
        FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || chr(10) WHEN doc_id % 7 = 1 THEN text || chr(13)
                             ELSE text END AS x FROM documents WHERE {cond})),
p_{s} AS (SELECT string_split_regex(raw, '{LINE_RX}') AS parts FROM raw_{s}),
k_{s} AS (SELECT line, ln FROM (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS ln, len(parts) AS np
          FROM p_{s}) WHERE NOT (ln = np AND line = '')),
s_{s} AS (SELECT *, sum(CASE WHEN starts_with(line, ' = ') AND NOT starts_with(line, ' = = ') THEN 1 ELSE 0 END)
          OVER (ORDER BY ln ROWS UNBOUNDED PRECEDING) AS seg_id FROM k_{s}),
d_{s} AS (SELECT seg_id, string_agg(line, chr(10) ORDER BY ln) AS t,
          max(CASE WHEN regexp_full_match(line, '{BLANK}') THEN 0 ELSE 1 END) AS nb FROM s_{s} GROUP BY seg_id),
t_{s} AS (SELECT seg_id, list_append(regexp_extract_all(t, '{RX}'), '{EOS_TEXT}') AS a FROM d_{s} WHERE nb = 1),
g_{s} AS (SELECT row_number() OVER (ORDER BY seg_id, pos) - 1 AS i, tok
          FROM (SELECT seg_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t_{s})),
n_{s} AS (SELECT count(*) AS n FROM g_{s}),
e_{s} AS (SELECT unnest(range(greatest(0, (i - 64 + 63) // 64), i // 64 + 1)) AS w, i, tok FROM g_{s}),
w_{s} AS (SELECT CAST(w AS BIGINT) AS window_id,
            string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < w * 64 + 64) AS input_ids,
            string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i > w * 64) AS target_ids
          FROM e_{s}, n_{s} WHERE w * 64 < n - 64 GROUP BY w)"""


PRETRAIN_SQL = f"""
WITH {_split_flow("train", "doc_id % 10 < 8")}, {_split_flow("validation", "doc_id % 10 = 8")},
{_split_flow("test", "doc_id % 10 = 9")},
tr AS (SELECT *, row_number() OVER (ORDER BY md5('0:0:' || window_id), window_id) - 1 AS r, count(*) OVER () AS n FROM w_train)
SELECT 'train' AS split, window_id, CAST(r // 5 AS BIGINT) AS batch_id, CAST(r % 5 AS INTEGER) AS pos_in_batch,
       input_ids, target_ids FROM tr WHERE r < 5 * (n // 5)
UNION ALL SELECT 'validation', window_id, CAST(window_id // 5 AS BIGINT), CAST(window_id % 5 AS INTEGER), input_ids, target_ids
FROM w_validation
UNION ALL SELECT 'test', window_id, CAST(window_id // 5 AS BIGINT), CAST(window_id % 5 AS INTEGER), input_ids, target_ids
FROM w_test
"""


@register("flow_pretraining", "A1 G2 C1 C2 B1 C3 C10 D1 D2 G4 G5 (line corpus, three named splits)", PRETRAIN_SQL)
def flow_pretraining(spark: SparkSession, sf: str) -> DataFrame:
    corpus = seg.heading_corpus(table(spark, sf, "documents").select("doc_id", "text")).withColumn(
        "split", F.when(F.col("doc_id") % 10 < 8, "train").when(F.col("doc_id") % 10 == 8, "validation")
        .otherwise("test"))
    ex = D.pretraining_examples(corpus, 64, 64, batch_size=5, headings=True)
    return ex.select("split", "window_id", "batch_id", "pos_in_batch",
                     join_tokens("input_ids").alias("input_ids"), join_tokens("target_ids").alias("target_ids"))


def _batched(table_: str, key: str, size: int) -> str:
    """Tail split of a tenth, train shuffled, batches restarting per split."""
    return f"""
o AS (SELECT *, row_number() OVER (ORDER BY {key}) AS rn, count(*) OVER () AS n FROM {table_}),
q AS (SELECT *, CASE WHEN rn > n - greatest(1, floor(CAST(0.1 AS DOUBLE) * n)) THEN 'validation' ELSE 'train' END AS split
      FROM o),
b AS (SELECT *, (CASE WHEN split = 'train' THEN row_number() OVER (PARTITION BY split ORDER BY md5('0:0:' || {key}), {key})
                 ELSE row_number() OVER (PARTITION BY split ORDER BY {key}) END - 1) // {size} AS batch_id FROM q)"""


# integer ids: bytes, specials 256 + place in the template's list
SPECIAL = {s: 256 + i for i, s in enumerate(C.BYTE_TEMPLATE.specials)}
BYTES = "list_transform(regexp_extract_all(hex({}), '..'), lambda h: CAST(('0x' || h) AS INTEGER))"
INT_BASE = f"""
m AS (SELECT conv_id, turn, role, [{SPECIAL[HEADER_START_TEXT]}] || {BYTES.format("role")} || [{SPECIAL[HEADER_END_TEXT]}]
             || {BYTES.format("text")} || [{SPECIAL[EOT_TEXT]}] AS a FROM conversations),
l AS (SELECT conv_id, max(turn) AS mt, arg_max(role, turn) AS lr FROM m GROUP BY conv_id),
f AS (SELECT conv_id, [{SPECIAL[BOS_TEXT]}] || flatten(list(a ORDER BY turn)) AS fl,
             1 + coalesce(sum(len(a)) FILTER (WHERE turn < mt), 0) + 11 AS pl
      FROM m JOIN l USING (conv_id) WHERE lr = 'assistant' GROUP BY conv_id),
x AS (SELECT conv_id, len(fl) AS fn, pl, list_slice(fl, greatest(1, len(fl) - 128 + 1), len(fl)) AS ids,
             list_slice(list_transform(fl, lambda t, i: CASE WHEN i <= pl THEN -100 ELSE t END),
                        greatest(1, len(fl) - 128 + 1), len(fl)) AS labels FROM f),
y AS (SELECT conv_id, fn, pl, list_slice(ids, 1, len(ids) - 1) AS inp, list_slice(labels, 2, len(labels)) AS tgt FROM x)
"""


@register("sft_examples_int", "E2 E3 E4 E5 E6 E7 C6 (integer ids, label -100)", f"""
WITH {INT_BASE}
SELECT conv_id, array_to_string(inp, ' ') AS input_ids, array_to_string(tgt, ' ') AS target_ids,
       CAST(fn AS BIGINT) AS full_len, CAST(pl AS BIGINT) AS prompt_len FROM y
""")
def sft_examples_int(spark: SparkSession, sf: str) -> DataFrame:
    ex = C.sft_examples(_turns(spark, sf), 128, template=C.BYTE_TEMPLATE)
    return ex.select("conv_id", join_tokens("input_ids").alias("input_ids"),
                     join_tokens("target_ids").alias("target_ids"), "full_len", "prompt_len")


FLOW_SFT_SQL = f"""
WITH {INT_BASE}, {_batched("y", "conv_id", 4)},
z AS (SELECT *, max(len(inp)) OVER (PARTITION BY split, batch_id) AS width FROM b)
SELECT conv_id, split, CAST(batch_id AS BIGINT) AS batch_id, CAST(width AS INTEGER) AS width,
       array_to_string(inp || list_transform(range(width - len(inp)), lambda i: {SPECIAL[EOS_TEXT]}), ' ') AS input_ids,
       array_to_string(tgt || list_transform(range(width - len(tgt)), lambda i: -100), ' ') AS target_ids
FROM z
"""


@register("flow_sft", "E2-E10 G1 G4 G5 (integer ids, dynamic padding)", FLOW_SFT_SQL)
def flow_sft(spark: SparkSession, sf: str) -> DataFrame:
    ex = D.sft_dataset(_turns(spark, sf), 128, 4, 0.1, template=C.BYTE_TEMPLATE)
    return ex.select("conv_id", "split", "batch_id", "width", join_tokens("input_ids").alias("input_ids"),
                     join_tokens("target_ids").alias("target_ids"))


FLOW_REWARD_SQL = f"""
WITH {PAIRS_SQL},
k0 AS (SELECT pair_id, side, list_slice(fl, greatest(1, len(fl) - 96 + 1), len(fl)) AS ids FROM f),
wd AS (SELECT pair_id, max(CASE WHEN side = 'chosen' THEN ids END) AS c, max(CASE WHEN side = 'rejected' THEN ids END) AS j
      FROM k0 GROUP BY pair_id), {_batched("wd", "pair_id", 3)}
SELECT pair_id, split, CAST(batch_id AS BIGINT) AS batch_id,
       array_to_string(c || list_transform(range(96 - len(c)), lambda i: '{PAD_TEXT}'), ' ') AS chosen_ids,
       array_to_string(j || list_transform(range(96 - len(j)), lambda i: '{PAD_TEXT}'), ' ') AS rejected_ids,
       CAST(len(c) AS BIGINT) AS chosen_ones, CAST(len(j) AS BIGINT) AS rejected_ones
FROM b
"""


@register("flow_reward", "F1 F2 F3 G1 G4 G5 (static padding, both sides)", FLOW_REWARD_SQL)
def flow_reward(spark: SparkSession, sf: str) -> DataFrame:
    ex = D.reward_dataset(P.pairs_from_conversations(_turns(spark, sf)), 96, 3, 0.1, dynamic_padding=False)

    def ones(c: str) -> F.Column:
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b)

    return ex.select("pair_id", "split", "batch_id", join_tokens("chosen_ids").alias("chosen_ids"),
                     join_tokens("rejected_ids").alias("rejected_ids"),
                     ones("chosen_attention_mask").alias("chosen_ones"),
                     ones("rejected_attention_mask").alias("rejected_ones"))


@register("sft_nested_stream", "A3 E1 M1 B7 E2-E7 (nested messages on a stream)", SFT_SQL)
def sft_nested_stream(spark: SparkSession, sf: str) -> DataFrame:
    nested = materialize(C.collect_messages(_turns(spark, sf)), "messages")
    out = jobs.stream_sft(spark, nested.inputFiles()[0].rsplit("/", 1)[0], 64)
    return out.select("conv_id", join_tokens("input_ids").alias("input_ids"),
                      join_tokens("target_ids").alias("target_ids"), "full_len", "prompt_len")


MASKED_SQL = f"""
WITH {INT_BASE},
p AS (SELECT conv_id, unnest(tgt) AS label, generate_subscripts(tgt, 1) AS i FROM y),
r AS (SELECT conv_id // 4 AS batch_id, avg(CASE WHEN label <> -100 THEN label / 64.0 + i / 100.0 END) AS loss,
             count(*) FILTER (WHERE label <> -100) AS n FROM p GROUP BY conv_id // 4)
SELECT 'macro' AS mode, round(avg(loss), 6) AS loss FROM r
UNION ALL SELECT 'micro', round(sum(loss * n) / sum(n), 6) FROM r
"""


@register("masked_epoch_loss", "H2 H4 (masked batch means over SFT labels)", MASKED_SQL)
def masked_epoch_loss(spark: SparkSession, sf: str) -> DataFrame:
    ex = C.sft_examples(_turns(spark, sf), 128, template=C.BYTE_TEMPLATE)
    # the loss of a position is made from its label and place
    pos = ex.select((F.floor(F.col("conv_id") / 4)).alias("batch_id"),
                    F.posexplode("target_ids").alias("i", "label")).withColumn(
        "nll", F.col("label") / 64.0 + (F.col("i") + 1) / 100.0)
    per = pos.groupBy("batch_id").agg(M.masked_mean("nll", "label").alias("loss"),
                                      F.sum((F.col("label") != -100).cast("int")).alias("n"))
    return M.epoch_mean(per.where("loss is not null"), ["loss"], weight="n").select(
        "mode", F.round("loss", 6).alias("loss"))


@register("batch_subset", "G9 (first evaluation batches)", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, CAST(r // 8 AS BIGINT) AS batch_id FROM r WHERE r // 8 < greatest(1, n // 16)
""")
def batch_subset(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "documents").select("doc_id")
    b = O.assign_batches(ids, ["doc_id"], 8)
    return O.subset_batches(b, max(1, ids.count() // 16)).select("doc_id", "batch_id")


@register("resolve_template", "E11 (a source without a template borrows its sibling's)", """
WITH m AS (SELECT DISTINCT source AS model FROM documents),
t AS (SELECT model, 'T:' || model AS template FROM m WHERE CAST(substr(model, 4) AS INTEGER) % 2 = 0
      UNION ALL SELECT model || '-Instruct', 'I:' || model FROM m WHERE CAST(substr(model, 4) AS INTEGER) % 3 = 0)
SELECT m.model, coalesce(a.template, b.template) AS template FROM m
LEFT JOIN t a ON a.model = m.model LEFT JOIN t b ON b.model = m.model || '-Instruct'
""")
def resolve_template(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "documents").select(F.col("source").alias("model")).distinct()
    no = F.substring("model", 4, 9).cast("int")
    t = m.where(no % 2 == 0).select("model", F.concat(F.lit("T:"), "model").alias("template")).union(
        m.where(no % 3 == 0).select(F.concat("model", F.lit("-Instruct")), F.concat(F.lit("I:"), "model")))
    return C.resolve_template(m, t)


@register("crop_context", "C12 (the last 16 tokens) C5 (an end marker inside the text is one token)", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(text || '{EOS_TEXT}' || text, '{RX}') AS a FROM documents)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n, array_to_string(list_slice(a, greatest(1, len(a) - 15), len(a)), ' ') AS tail,
       CAST(list_position(a, '{EOS_TEXT}') AS BIGINT) AS marker FROM t
""")
def crop_context(spark: SparkSession, sf: str) -> DataFrame:
    from tokenmill.operators import tokenize as tok
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit(EOS_TEXT), "text").alias("text"))
    t = tok.crop_context(tok.token_count(tok.encode(docs)), "tokens", 16, out="tail")
    return t.select("doc_id", F.col("n_tokens").cast("long").alias("n"), join_tokens("tail").alias("tail"),
                    F.array_position("tokens", EOS_TEXT).cast("long").alias("marker"))
