"""Next-token statistics: the relational form of "pretrain + evaluate" (I1-I4, C7, H14).

Counts are partial+final hash aggregates. Scoring first aggregates the evaluation
tokens to (n-gram, count) and only then joins the model, so a hot token ("the", ".")
is one row in the join rather than millions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.plans.prefix import materialize
from tokenmill.session import bounded_batches

# Token arrays that a task counts at a time, and rows of an Arrow batch it hands back.
GATHER_BYTES = 64 << 20
BATCH_ROWS = 1 << 16


def ngrams(tokens: DataFrame, n: int, col: str = "tokens", keep: Sequence[str] = ()) -> DataFrame:
    """Adjacent n-grams inside each token array: (keep..., ctx, next).

    ``ctx`` is the previous token (a string) for bigrams, ``""`` for unigrams and an
    array of the n-1 previous tokens otherwise: scalar keys hash and sort fastest.
    """
    if n < 1:
        raise ValueError("n >= 1")
    if n == 1:
        return tokens.select(*keep, F.lit("").alias("ctx"), F.explode(col).alias("next"))
    return _spread(tokens, n, col, keep).select(*keep, _context(n), F.col(f"t{n - 1}").alias("next"))


def _spread(tokens: DataFrame, n: int, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """n-grams (n > 1) as scalar columns (keep..., t0, .., t<n-1>)."""
    a = F.col(col)
    m = F.size(a) - (n - 1)  # number of n-grams
    # n shifted slices zipped position-wise: codegen'd expressions, no per-element lambda
    shifted = [F.slice(a, j + 1, m).alias(f"t{j}") for j in range(n)]
    z = tokens.where(F.size(a) >= n).select(*keep, F.explode(F.arrays_zip(*shifted)).alias("z"))
    return z.select(*keep, *[F.col(f"z.t{j}").alias(f"t{j}") for j in range(n)])


def _context(n: int) -> Column:
    return (F.col("t0") if n == 2 else F.array(*[F.col(f"t{j}") for j in range(n - 1)])).alias("ctx")


def _packed(n: int) -> Column:
    """t0, .., t<n-1> (strings) as one string: the lengths of all but the last, then the tokens. A null
    has the length -1, as the last token an empty length before it."""
    t = [F.col(f"t{j}") for j in range(n)]
    sizes = [F.coalesce(F.length(x), F.lit(-1)).cast("string") for x in t[:-1]]
    sizes.append(F.when(t[-1].isNull(), "-").otherwise(""))
    return F.concat(F.concat_ws(",", *sizes), F.lit(":"), *[F.coalesce(x, F.lit("")) for x in t])


def _unpacked(gram: Column, n: int) -> list[Column]:
    """The tokens of :func:`_packed`."""
    head = F.substring_index(gram, ":", 1)
    sizes = F.split(head, ",")
    at, out = F.length(head) + 2, []
    for j in range(n - 1):
        size = F.element_at(sizes, j + 1).cast("int")
        out.append(F.when(size >= 0, F.substring(gram, at, size)))
        at = at + F.greatest(size, F.lit(0))
    return [*out, F.when(F.element_at(sizes, n) == "", F.substring(gram, at, F.length(gram)))]


def _strings(tokens: DataFrame, col: str) -> bool:
    return tokens.schema[col].dataType.elementType.simpleString() == "string"


def _by_parts(count, size: int | None = None):
    """``count`` over (tokens, tokens of each row) of several one-column Arrow batches at a time."""
    size = size or GATHER_BYTES

    def joined(held):
        import pyarrow as pa
        lengths = pa.concat_arrays([a.value_lengths() for a in held]).fill_null(0)
        return pa.concat_arrays([a.flatten() for a in held]), lengths.to_numpy()

    def run(batches):
        held, held_bytes = [], 0
        for b in batches:
            held.append(b.column(0))
            held_bytes += b.column(0).nbytes
            if held_bytes >= size:
                yield from count(*joined(held))
                held, held_bytes = [], 0
        if held:
            yield from count(*joined(held))
    return run


def _pair_counts(size: int | None = None):
    """(ctx, next, count) of the token pairs of each part: places in its dictionary are counted, one
    number a pair, so a pair is made of strings once a part."""
    def count(tokens, lengths):
        import numpy as np
        import pyarrow as pa
        words = tokens.dictionary_encode()
        k = len(words.dictionary) + 1  # the last place is a null's
        at = words.indices.fill_null(k - 1).to_numpy().astype(np.int64)
        follows = np.ones(len(at), bool)  # by another token of the row
        follows[np.cumsum(lengths, dtype=np.int64)[lengths > 0] - 1] = False
        pairs = (at[:-1] * k + at[1:])[follows[:-1]]
        del at, follows
        pairs.sort()
        starts = np.flatnonzero(np.diff(pairs, prepend=-1))
        counts = np.diff(starts, append=len(pairs))
        pairs = pairs[starts]
        values = pa.concat_arrays([words.dictionary, pa.nulls(1, words.dictionary.type)])
        for i in range(0, len(pairs), BATCH_ROWS):
            u, w = np.divmod(pairs[i:i + BATCH_ROWS], k)
            yield pa.RecordBatch.from_arrays(
                [values.take(pa.array(u)), values.take(pa.array(w)), pa.array(counts[i:i + BATCH_ROWS])],
                names=["ctx", "next", "count"])
    return _by_parts(count, size)


def _distinct():
    """The distinct tokens of each part."""
    def count(tokens, lengths):
        import pyarrow as pa
        yield pa.RecordBatch.from_arrays([tokens.unique()], names=["t"])
    return _by_parts(count)


def ngram_counts(tokens: DataFrame, n: int, col: str = "tokens") -> DataFrame:
    """(ctx, next, count). Pairs of strings are counted a part of a task at a time before they are
    grouped. From three tokens on they are grouped as one string, which shuffles in fewer bytes than an
    array or several columns; the context is put together after counting."""
    count = F.count(F.lit(1)).alias("count")
    if n < 2 or not _strings(tokens, col):
        return ngrams(tokens, n, col).groupBy("ctx", "next").agg(count)
    if n == 2:
        bounded_batches(tokens.sparkSession)
        parts = tokens.where(F.size(col) >= n).select(col).mapInArrow(
            _pair_counts(), "ctx string, next string, count long")
        # few pairs of a task's parts are equal: they are shuffled as they are, not hashed before it too
        return parts.repartition("ctx", "next").groupBy("ctx", "next").agg(F.sum("count").alias("count"))
    counts = _spread(tokens, n, col).groupBy(_packed(n).alias("__gram")).agg(count)
    parts = _unpacked(F.col("__gram"), n)
    return counts.select(F.array(*parts[:-1]).alias("ctx"), parts[-1].alias("next"), "count")


class NgramTables(NamedTuple):
    """A model of n > 1 tokens before its tables are joined."""

    counts: DataFrame  # (ctx, next, count), written once
    totals: DataFrame  # (ctx, ctx_count)


def _smoothed(k: float, vocab_size: int) -> Column:
    return F.log((F.col("count") + k) / (F.col("ctx_count") + k * vocab_size))


def fit_ngram(train_tokens: DataFrame, n: int, vocab_size: int, k: float = 1.0,
              col: str = "tokens", joined: bool = True) -> DataFrame | NgramTables:
    """Add-k smoothed P(next | ctx) for seen n-grams, plus the context totals.

    Returns (ctx, next, count, ctx_count, logp), written once as a table; unseen (ctx, next) use
    ``log(k / (ctx_count + k V))`` and unseen contexts ``log(1 / V)``. The corpus is counted once:
    context totals come from the count table, for n = 1 they are one number. Without ``joined``
    (n > 1) counts and totals stay two tables: :func:`score_ngram` joins both to the n-grams it scores,
    so the count table is shuffled and sorted once, not once a join.
    """
    counts = materialize(ngram_counts(train_tokens, n, col), "ngram_counts")
    if n == 1:
        total = counts.agg(F.sum("count")).first()[0] or 0
        model = counts.withColumn("ctx_count", F.lit(total).cast("long"))
    else:
        totals = counts.groupBy("ctx").agg(F.sum("count").alias("ctx_count"))
        if not joined:
            return NgramTables(counts, totals)
        model = materialize(counts.join(totals, "ctx"), "ngram_model")
    return model.withColumn("logp", _smoothed(k, vocab_size))


def score_ngram(model: DataFrame | NgramTables, eval_tokens: DataFrame, n: int, vocab_size: int,
                k: float = 1.0, col: str = "tokens", by: Sequence[str] = ()) -> DataFrame:
    """Cross-entropy and perplexity of ``eval_tokens`` under ``model`` (overall or per ``by``).

    For n = 1 there is one context, so the join is on the token alone and its total is a number.
    """
    if n == 1:
        row = model.select("ctx_count").first()  # equal in all rows
        ev = ngrams(eval_tokens, n, col, keep=by).groupBy(*by, "next").agg(F.count(F.lit(1)).alias("m"))
        j = ev.join(model.select("next", "logp"), "next", "left").withColumn(
            "ctx_count", F.lit(row[0] if row else None).cast("long"))
    else:
        if by:
            ev = ngrams(eval_tokens, n, col, keep=by).groupBy(*by, "ctx", "next").agg(F.count(F.lit(1)).alias("m"))
        else:
            ev = ngram_counts(eval_tokens, n, col).withColumnRenamed("count", "m")
        if isinstance(model, NgramTables):
            j = ev.join(model.counts, ["ctx", "next"], "left").join(
                model.totals, "ctx", "left").withColumn("logp", _smoothed(k, vocab_size))
        else:
            totals = model.groupBy("ctx").agg(F.max("ctx_count").alias("ctx_count"))
            j = ev.join(model.select("ctx", "next", "logp"), ["ctx", "next"], "left").join(
                totals, "ctx", "left")
    unseen = F.when(F.col("ctx_count").isNull(), F.lit(-1.0) * F.log(F.lit(float(vocab_size)))) \
        .otherwise(F.log(F.lit(float(k)) / (F.col("ctx_count") + k * vocab_size)))
    lp = F.coalesce(F.col("logp"), unseen)
    agg = [(F.sum(-lp * F.col("m")) / F.sum("m")).alias("cross_entropy"),
           F.sum("m").alias("n_tokens")]
    out = j.groupBy(*by).agg(*agg) if by else j.agg(*agg)
    return out.withColumn("perplexity", F.exp("cross_entropy"))


def next_token_candidates(prompts: DataFrame, model: DataFrame, key: str, col: str = "tokens",
                          n: int = 2, k: int | None = None) -> DataFrame:
    """I4: candidate next tokens for the last ``n-1`` tokens of each prompt, with P(next|ctx).

    With ``k`` only the ``k`` best of a context (ties kept) are joined, with their ``rank``: the
    model is ranked before the prompts multiply it, so the result holds about prompts x k rows.
    """
    if n == 2:
        last = prompts.where(F.size(col) >= 1).select(key, F.element_at(col, -1).alias("ctx"))
    else:
        last = prompts.where(F.size(col) >= n - 1).select(
            key, F.slice(col, -(n - 1), n - 1).alias("ctx"))
    cols = [key, "ctx", "next", F.exp("logp").alias("prob")]
    if k is not None:
        asked = model.join(last.select("ctx").distinct(), "ctx", "left_semi")
        w = Window.partitionBy("ctx").orderBy(F.col("logp").desc())
        model = asked.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= k)
        cols.append("rank")
    return last.join(model, "ctx").select(*cols)


def vocab_size(tokens: DataFrame, col: str = "tokens") -> int:
    """Distinct token count (one scalar)."""
    if not _strings(tokens, col):
        return tokens.select(F.explode(col).alias("t")).distinct().count()
    bounded_batches(tokens.sparkSession)
    return tokens.select(col).mapInArrow(_distinct(), "t string").distinct().count()

