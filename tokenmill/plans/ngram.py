"""Checkable n-gram language-statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT
from tokenmill.functions.text import word_pattern, word_tokens
from tokenmill.operators import metrics as M
from tokenmill.operators import ngram as N
from tokenmill.operators import ordering as O
from tokenmill.operators import passages as P
from tokenmill.plans.pretrain import doc_tokens
from tokenmill.plans.prefix import materialize
from tokenmill.plans.registry import register
from tokenmill.sources.tables import table

RX = word_pattern()
EOS = EOS_TEXT

SPLIT_DOCS = f"""
d AS (SELECT doc_id, list_append(regexp_extract_all(text, '{RX}'), '{EOS}') AS a,
             CASE WHEN CAST(('0x' || substr(md5('3:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0 < 0.1
                  THEN 'validation' ELSE 'train' END AS split FROM documents),
t AS (SELECT doc_id, split, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM d),
v AS (SELECT count(DISTINCT tok) AS V FROM t)
"""


def split_tokens(spark: SparkSession, sf: str, with_vocab: bool = True
                 ) -> tuple[DataFrame, int | None]:
    """Tokenized documents with their G3 split; plus the vocabulary size, for which they are read
    twice and so written once."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    toks = O.split_by_document(doc_tokens(docs), "doc_id", 0.1, seed=3)
    if not with_vocab:
        return toks, None
    toks = materialize(toks, "split_tokens")
    return toks, N.vocab_size(toks)


def _scored(spark: SparkSession, sf: str, n: int, by=()) -> DataFrame:
    toks, V = split_tokens(spark, sf)
    model = N.fit_ngram(toks.where(F.col("split") == "train"), n, V, k=1.0, joined=n == 1)
    return N.score_ngram(model, toks.where(F.col("split") == "validation"), n, V, k=1.0, by=by)


UNIGRAM_SQL = f"""
WITH {SPLIT_DOCS},
c AS (SELECT tok, count(*) AS c FROM t WHERE split = 'train' GROUP BY tok),
n AS (SELECT count(*) AS N FROM t WHERE split = 'train'),
e AS (SELECT tok, count(*) AS m FROM t WHERE split = 'validation' GROUP BY tok),
s AS (SELECT sum(-ln((coalesce(c.c, 0) + 1.0) / (N + V)) * m) / sum(m) AS ce, sum(m) AS nt
      FROM e LEFT JOIN c USING (tok), v, n)
SELECT round(ce, 6) AS cross_entropy, CAST(nt AS BIGINT) AS n_tokens, round(exp(ce), 6) AS perplexity FROM s
"""


@register("unigram_ppl", "I1 I2 I3 H3 G3", UNIGRAM_SQL)
def unigram_ppl(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf, 1)
    return s.select(F.round("cross_entropy", 6).alias("cross_entropy"),
                    F.col("n_tokens").cast("long"), F.round("perplexity", 6).alias("perplexity"))


BIGRAM_SQL = f"""
WITH {SPLIT_DOCS},
p AS (SELECT x.split, x.tok AS u, y.tok AS w FROM t x JOIN t y ON x.doc_id = y.doc_id AND y.pos = x.pos + 1),
c AS (SELECT u, w, count(*) AS c FROM p WHERE split = 'train' GROUP BY u, w),
cu AS (SELECT u, count(*) AS cu FROM p WHERE split = 'train' GROUP BY u),
e AS (SELECT u, w, count(*) AS m FROM p WHERE split = 'validation' GROUP BY u, w),
s AS (SELECT sum(-CASE WHEN cu.cu IS NULL THEN -ln(V) ELSE ln((coalesce(c.c, 0) + 1.0) / (cu.cu + V)) END * m)
             / sum(m) AS ce, sum(m) AS nt
      FROM e LEFT JOIN c USING (u, w) LEFT JOIN cu USING (u), v)
SELECT round(ce, 6) AS cross_entropy, CAST(nt AS BIGINT) AS n_tokens, round(exp(ce), 6) AS perplexity FROM s
"""


@register("bigram_ppl", "I1 I2 I3 H3", BIGRAM_SQL)
def bigram_ppl(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf, 2)
    return s.select(F.round("cross_entropy", 6).alias("cross_entropy"),
                    F.col("n_tokens").cast("long"), F.round("perplexity", 6).alias("perplexity"))


DOC_PPL_SQL = f"""
WITH {SPLIT_DOCS},
c AS (SELECT tok, count(*) AS c FROM t WHERE split = 'train' GROUP BY tok),
n AS (SELECT count(*) AS N FROM t WHERE split = 'train'),
e AS (SELECT doc_id, tok, count(*) AS m FROM t WHERE split = 'validation' GROUP BY doc_id, tok),
s AS (SELECT doc_id, sum(-ln((coalesce(c.c, 0) + 1.0) / (N + V)) * m) / sum(m) AS ce, sum(m) AS nt
      FROM e LEFT JOIN c USING (tok), v, n GROUP BY doc_id)
SELECT doc_id, round(ce, 6) AS cross_entropy, CAST(nt AS BIGINT) AS n_tokens, round(exp(ce), 6) AS perplexity FROM s
"""


@register("doc_ppl", "I3 H3 (per document)", DOC_PPL_SQL)
def doc_ppl(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf, 1, by=["doc_id"])
    return s.select("doc_id", F.round("cross_entropy", 6).alias("cross_entropy"),
                    F.col("n_tokens").cast("long"), F.round("perplexity", 6).alias("perplexity"))


TRIGRAM_COUNTS_SQL = f"""
WITH {SPLIT_DOCS},
p AS (SELECT x.tok AS c1, y.tok AS c2, z.tok AS nxt FROM t x
      JOIN t y ON x.doc_id = y.doc_id AND y.pos = x.pos + 1
      JOIN t z ON x.doc_id = z.doc_id AND z.pos = x.pos + 2)
SELECT c1 || ' ' || c2 AS ctx, nxt AS next, CAST(count(*) AS BIGINT) AS count FROM p GROUP BY c1, c2, nxt
"""


@register("trigram_counts", "I1 (n=3)", TRIGRAM_COUNTS_SQL)
def trigram_counts(spark: SparkSession, sf: str) -> DataFrame:
    toks, _ = split_tokens(spark, sf, with_vocab=False)
    c = N.ngram_counts(toks, 3)
    return c.select(F.array_join("ctx", " ").alias("ctx"), "next", "count")


NEXT_TOKEN_SQL = f"""
WITH {SPLIT_DOCS},
p AS (SELECT x.tok AS u, y.tok AS w FROM t x JOIN t y ON x.doc_id = y.doc_id AND y.pos = x.pos + 1),
c AS (SELECT u, w, count(*) AS c FROM p GROUP BY u, w),
cu AS (SELECT u, count(*) AS cu FROM p GROUP BY u),
b AS (SELECT item_id, regexp_extract_all(text, '{RX}') AS bt FROM benchmark),
l AS (SELECT item_id, bt[len(bt)] AS u FROM b WHERE len(bt) >= 1),
k AS (SELECT item_id, l.u AS ctx, w AS next, (c.c + 1.0) / (cu.cu + V) AS prob FROM l JOIN c USING (u) JOIN cu USING (u), v),
r AS (SELECT *, rank() OVER (PARTITION BY item_id ORDER BY prob DESC) AS rank FROM k)
SELECT item_id, ctx, next, round(prob, 6) AS prob, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
"""


@register("next_token", "I4 J4 (top-5 report per prompt)", NEXT_TOKEN_SQL)
def next_token(spark: SparkSession, sf: str) -> DataFrame:
    toks, V = split_tokens(spark, sf)
    model = N.fit_ngram(toks, 2, V, k=1.0)
    bench = table(spark, sf, "benchmark").select("item_id", word_tokens("text").alias("tokens"))
    top = N.next_token_candidates(bench, model, "item_id", k=5)
    return top.select("item_id", "ctx", "next",
                      F.round("prob", 6).alias("prob"), F.col("rank").cast("int"))


UNIFORM_SQL = f"""
WITH {SPLIT_DOCS}
SELECT CAST(V AS BIGINT) AS vocab_size, round(ln(V), 6) AS uniform_loss, round(CAST(V AS DOUBLE), 6) AS uniform_ppl FROM v
"""


@register("uniform_baseline", "H14", UNIFORM_SQL)
def uniform_baseline(spark: SparkSession, sf: str) -> DataFrame:
    toks, _ = split_tokens(spark, sf, with_vocab=False)
    u = M.uniform_baseline(toks.select(F.explode("tokens").alias("token")))
    return u.select(F.col("vocab_size").cast("long"), F.round("uniform_loss", 6).alias("uniform_loss"),
                    F.round("uniform_ppl", 6).alias("uniform_ppl"))


PASSAGE = 32
PASSAGE_SQL = f"""
WITH {SPLIT_DOCS},
w AS (SELECT doc_id, split, unnest(list_transform(range(1, len(a) - {PASSAGE} + 2),
                                                  lambda i: md5(array_to_string(list_slice(a, i, i + {PASSAGE} - 1), ' ')))) AS g,
             unnest(range(1, len(a) - {PASSAGE} + 2)) AS s FROM d WHERE len(a) >= {PASSAGE}),
f AS (SELECT doc_id, s, s - row_number() OVER (PARTITION BY doc_id ORDER BY s) AS run FROM w
      WHERE split = 'validation' AND g IN (SELECT g FROM w WHERE split = 'train'))
SELECT doc_id, CAST(min(s) - 1 AS BIGINT) AS first_token, CAST(max(s) - min(s) + {PASSAGE} AS BIGINT) AS n_tokens
FROM f GROUP BY doc_id, run
"""


@register("passage_leaks", "G3 (passages shared by the splits, winnowed)", PASSAGE_SQL)
def passage_leaks(spark: SparkSession, sf: str) -> DataFrame:
    toks, _ = split_tokens(spark, sf, with_vocab=False)
    return P.shared_passages(toks, PASSAGE)
