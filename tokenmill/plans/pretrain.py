"""Pretraining dataset plans and their checkable queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT, EOT_TEXT, PAD_TEXT
from tokenmill.functions.arrays import join_tokens
from tokenmill.functions.text import word_pattern
from tokenmill.operators import packing as pk
from tokenmill.operators import tokenize as tok
from tokenmill.operators import windows as win
from tokenmill.plans.prefix import materialize
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

RX = word_pattern()
EOS = EOS_TEXT


def doc_tokens(docs: DataFrame, kind: str = "word", text_col: str = "text",
               key: str = "doc_id", ranks: dict[bytes, int] | None = None) -> DataFrame:
    """documents -> (key, tokens + EOS); ``bpe`` takes a rank dictionary."""
    enc = tok.encode(docs.select(key, text_col), text_col, kind, ranks=ranks)
    eos = {"word": EOS_TEXT, "byte": 256, "bpe": len(ranks or ())}[kind]
    return tok.append_eos(enc, "tokens", eos).select(key, "tokens")


def lm_dataset(docs: DataFrame, max_length: int, stride: int, kind: str = "word",
               key: str = "doc_id", lineage: bool = False,
               ranks: dict[bytes, int] | None = None) -> DataFrame:
    """documents -> encode -> append EOS -> stream offsets -> sliding windows."""
    offs, n = win.stream_offsets(doc_tokens(docs, kind, key=key, ranks=ranks), [key], with_total=True)
    return win.sliding_windows(offs, max_length, stride, n_tokens=n,
                               lineage_key=key if lineage else None)


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


LM_WINDOWS_SQL = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
g AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS i, tok
      FROM (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
n AS (SELECT count(*) AS n_tok FROM g),
e AS (SELECT unnest(range(greatest(0, (i - 64 + 31) // 32), i // 32 + 1)) AS w, i, tok FROM g)
SELECT CAST(w AS BIGINT) AS window_id,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < w * 32 + 64) AS input_ids,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i > w * 32) AS target_ids
FROM e, n WHERE w * 32 < n_tok - 64 GROUP BY w
"""


@register("lm_windows", "A1 C3 C5 C10 D1 D2 D3 D5", LM_WINDOWS_SQL)
def lm_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = lm_dataset(_docs(spark, sf), 64, 32)
    return w.select("window_id", join_tokens("input_ids").alias("input_ids"),
                    join_tokens("target_ids").alias("target_ids"))


GAP_WINDOWS_SQL = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
g AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS i, tok
      FROM (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
n AS (SELECT count(*) AS n_tok FROM g),
e AS (SELECT i // 100 AS w, i, tok FROM g WHERE i % 100 <= 64)
SELECT CAST(w AS BIGINT) AS window_id,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < w * 100 + 64) AS input_ids,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i > w * 100) AS target_ids
FROM e, n WHERE w * 100 < n_tok - 64 GROUP BY w
"""


@register("lm_windows_gap", "D2 D5 (S > L+1: gaps)", GAP_WINDOWS_SQL)
def lm_windows_gap(spark: SparkSession, sf: str) -> DataFrame:
    w = lm_dataset(_docs(spark, sf), 64, 100)
    return w.select("window_id", join_tokens("input_ids").alias("input_ids"),
                    join_tokens("target_ids").alias("target_ids"))


WINDOW_COUNT_SQL = f"""
WITH n AS (SELECT sum(len(regexp_extract_all(text, '{RX}')) + 1) AS n_tok FROM documents),
p AS (SELECT * FROM (VALUES (64, 32), (64, 64), (64, 100), (7, 3), (4, 2)) v(max_length, stride))
SELECT CAST(max_length AS BIGINT) AS max_length, CAST(stride AS BIGINT) AS stride,
       CAST(n_tok AS BIGINT) AS n_tokens,
       CAST(greatest(0, ceil((n_tok - max_length) / stride)) AS BIGINT) AS n_windows
FROM n, p
"""


@register("lm_window_count", "C9 D4", WINDOW_COUNT_SQL)
def lm_window_count(spark: SparkSession, sf: str) -> DataFrame:
    lengths = doc_tokens(_docs(spark, sf)).select(F.size("tokens").cast("long").alias("n"))
    return win.window_counts(lengths, [(64, 32), (64, 64), (64, 100), (7, 3), (4, 2)])


_LINEAGE = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
g AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS i, doc_id, pos - 1 AS pos
      FROM (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
n AS (SELECT count(*) AS n_tok FROM g),
e AS (SELECT unnest(range(greatest(0, (i - 64 + 31) // 32), i // 32 + 1)) AS w, i, doc_id, pos FROM g)
"""
LINEAGE_SQL = _LINEAGE + """
SELECT CAST(w AS BIGINT) AS window_id, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs,
       min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM e, n WHERE w * 32 < n_tok - 64 GROUP BY w
"""


def _window_documents(spark: SparkSession, sf: str) -> DataFrame:
    offs, n = win.stream_offsets(doc_tokens(_docs(spark, sf)), ["doc_id"], with_total=True)
    return win.window_documents(offs, "doc_id", 64, 32, n)


@register("window_lineage", "D6", LINEAGE_SQL)
def window_lineage(spark: SparkSession, sf: str) -> DataFrame:
    at = F.struct("window_pos", "doc_id")
    return _window_documents(spark, sf).groupBy("window_id").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(at)["doc_id"].alias("first_doc"),
        F.max(at)["doc_id"].alias("last_doc"))


WINDOW_DOCUMENTS_SQL = _LINEAGE + """
SELECT CAST(w AS BIGINT) AS window_id, doc_id, CAST(min(i) - w * 32 AS BIGINT) AS window_pos,
       CAST(min(pos) AS BIGINT) AS doc_pos, CAST(count(*) AS BIGINT) AS n_tokens
FROM e, n WHERE w * 32 < n_tok - 64 GROUP BY w, doc_id
"""


@register("window_documents", "D6 (place of every document in its windows)", WINDOW_DOCUMENTS_SQL)
def window_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _window_documents(spark, sf).select("window_id", "doc_id", "window_pos", "doc_pos", "n_tokens")


PER_DOC_SQL = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
g AS (SELECT doc_id, pos - 1 AS i, tok, len(a) AS n
      FROM (SELECT doc_id, a, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
e AS (SELECT doc_id, unnest(range(greatest(0, (i - 64 + 31) // 32), i // 32 + 1)) AS w, i, tok, n FROM g)
SELECT doc_id, CAST(w AS BIGINT) AS window_id,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i < w * 32 + 64) AS input_ids,
       string_agg(tok, ' ' ORDER BY i) FILTER (WHERE i > w * 32) AS target_ids
FROM e WHERE w * 32 < n - 64 GROUP BY doc_id, w
"""


@register("per_doc_windows", "D6 (per_document mode)", PER_DOC_SQL)
def per_doc_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = win.windows_of_rows(doc_tokens(_docs(spark, sf)), "doc_id", 64, 32)
    return w.select("doc_id", "window_id", join_tokens("input_ids").alias("input_ids"),
                    join_tokens("target_ids").alias("target_ids"))


PACK_LENGTH = 512
_PARTS = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
c AS (SELECT doc_id, a, unnest(range(0, len(a), {PACK_LENGTH})) AS pos FROM t)
"""


@register("pack_documents", "D6 (packing: every part read back from its row)", _PARTS + f"""
SELECT doc_id, pos AS doc_pos, CAST(len(a[pos + 1:pos + {PACK_LENGTH}]) AS BIGINT) AS n_tokens,
       md5(array_to_string(a[pos + 1:pos + {PACK_LENGTH}], ' ')) AS tokens_md5
FROM c
""")
def pack_documents(spark: SparkSession, sf: str) -> DataFrame:
    packed = materialize(pk.pack_documents(doc_tokens(_docs(spark, sf)), ["doc_id"], PACK_LENGTH), "packed")
    back = pk.unpack_documents(packed.where(F.size("tokens") <= PACK_LENGTH), ["doc_id"])
    return back.select("doc_id", "doc_pos", F.size("tokens").cast("long").alias("n_tokens"),
                       F.md5(join_tokens("tokens")).alias("tokens_md5"))


NEXT_PAIRS_SQL = f"""
WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a FROM documents),
g AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS i, tok
      FROM (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t)),
n AS (SELECT count(*) AS n_tok FROM g),
c AS (SELECT i, tok, lead(tok) OVER (ORDER BY i) AS nxt FROM g),
e AS (SELECT unnest(range(greatest(0, (i - 63 + 31) // 32), i // 32 + 1)) AS w, tok, nxt FROM c)
SELECT tok AS context_token, nxt AS next_token, CAST(count(*) AS BIGINT) AS n_pairs
FROM e, n WHERE w * 32 < n_tok - 64 GROUP BY tok, nxt
"""


@register("next_token_pairs", "D7", NEXT_PAIRS_SQL)
def next_token_pairs(spark: SparkSession, sf: str) -> DataFrame:
    w = lm_dataset(_docs(spark, sf), 64, 32)
    pairs = win.next_token_pairs(w)
    return pairs.groupBy("context_token", "next_token").agg(
        F.count(F.lit(1)).alias("n_pairs"))


ENCODE_BYTE_SQL = """
SELECT doc_id, CAST(len(regexp_extract_all(hex(text), '..')) AS BIGINT) AS n_tokens,
       array_to_string(list_transform(regexp_extract_all(hex(text), '..'),
                       lambda h: CAST(('0x' || h) AS INTEGER)), ' ') AS token_ids
FROM documents
"""


@register("encode_byte", "C3 (byte)", ENCODE_BYTE_SQL)
def encode_byte(spark: SparkSession, sf: str) -> DataFrame:
    enc = tok.encode(_docs(spark, sf), "text", "byte")
    return enc.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                      join_tokens("tokens").alias("token_ids"))


ROUNDTRIP_SQL = """
SELECT doc_id, true AS roundtrip_ok, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents
"""


@register("roundtrip", "C4 C11 (byte decode)", ROUNDTRIP_SQL)
def roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    audited = tok.roundtrip_audit(_docs(spark, sf), "text", "byte")
    return audited.select("doc_id", "roundtrip_ok",
                          F.octet_length("text").cast("long").alias("n_bytes"))


VOCAB_SQL = f"""
WITH toks AS (SELECT unnest(regexp_extract_all(text, '{RX}')) AS token FROM documents),
c AS (SELECT token, count(*) AS cnt FROM toks WHERE token NOT IN ('{EOS}', '<unk>') GROUP BY token)
SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 3 AS INTEGER) AS id,
       CAST(cnt AS BIGINT) AS count
FROM c
UNION ALL SELECT '{EOS}', 0, 0
UNION ALL SELECT '{EOT_TEXT}', 1, 0
UNION ALL SELECT '{PAD_TEXT}', 2, 0
UNION ALL SELECT '<unk>', 3, 0
"""


@register("vocab", "C6 C7", VOCAB_SQL)
def vocab(spark: SparkSession, sf: str) -> DataFrame:
    toks = materialize(tok.encode(_docs(spark, sf), "text", "word"), "word_tokens")
    return tok.build_vocab(toks, "tokens")


ENCODE_WORD_SQL = f"""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(text, '{RX}')) AS token,
                     generate_subscripts(regexp_extract_all(text, '{RX}'), 1) AS pos FROM documents),
c AS (SELECT token, count(*) AS cnt FROM toks GROUP BY token),
v AS (SELECT token, row_number() OVER (ORDER BY cnt DESC, token) + 3 AS id FROM c)
SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) || ' 0' AS token_ids,
       CAST(count(*) + 1 AS BIGINT) AS n_tokens
FROM toks JOIN v USING (token) GROUP BY doc_id
"""


@register("encode_word", "C3 C8 C10 (word ids via vocabulary)", ENCODE_WORD_SQL)
def encode_word(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    toks = materialize(tok.encode(docs, "text", "word"), "word_tokens")
    v = tok.build_vocab(toks, "tokens")
    ids = tok.tokens_to_ids(toks.select("doc_id", "tokens"), "tokens", v, ["doc_id"])
    ids = tok.append_eos(ids, "ids", 0)
    return ids.select("doc_id", join_tokens("ids").alias("token_ids"),
                      F.size("ids").cast("long").alias("n_tokens"))
