"""Tokenization operators (encode, decode, vocabulary, id lookup, EOS, audits).

Three tokenizer kinds:
* ``word`` - regex word tokens (array<string>); ids come from a vocabulary table.
* ``byte`` - UTF-8 bytes as ids 0-255, specials from 256 (array<int>), no vocabulary.
* ``bpe``  - byte-pair merges from a user-supplied rank table, run with ``mapInPandas``
  (the one place Python runs per batch; Arrow-batched).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tokenmill.config import BYTE_VOCAB, EOS_TEXT, EOT_TEXT, PAD_TEXT
from tokenmill.functions import arrays as A
from tokenmill.functions import bytes as B
from tokenmill.functions import text as T
from tokenmill.plans.prefix import global_rank, materialize
from tokenmill.session import bounded_batches

DEFAULT_SPECIALS = (EOS_TEXT,)
UNK_TEXT = "<unk>"
RESERVED = (EOS_TEXT, EOT_TEXT, PAD_TEXT)  # ids 0, 1, 2 of a word vocabulary; <unk> follows

# A vocabulary at or below this many rows is broadcast to the id lookup; larger ones
# use a shuffle join (AQE splits hot tokens).
BROADCAST_VOCAB_ROWS = 2_000_000


def encode(df: DataFrame, text_col: str = "text", kind: str = "word", out: str = "tokens",
           specials: Sequence[str] = DEFAULT_SPECIALS, ranks=None) -> DataFrame:
    """Text -> tokens. ``word`` gives strings, ``byte``/``bpe`` give int ids."""
    if kind == "word":
        return df.withColumn(out, T.word_tokens(text_col, specials))
    if kind == "byte":
        bounded_batches(df.sparkSession)
        return df.withColumn(out, B.encode_bytes(text_col, specials))
    if kind == "bpe":
        from tokenmill.operators.bpe import bpe_encode
        if ranks is None:
            raise ValueError("bpe needs a rank table (merges)")
        return bpe_encode(df, text_col, ranks, out=out, specials=specials)
    raise ValueError(f"unknown tokenizer kind {kind!r}")


def decode(df: DataFrame, ids_col: str = "tokens", kind: str = "word", out: str = "decoded",
           specials: Sequence[str] = DEFAULT_SPECIALS, vocab: DataFrame | None = None,
           key: Sequence[str] = (), ranks=None) -> DataFrame:
    """C4: tokens -> text. ``[]`` decodes to ``""``.

    ``byte`` is exact. ``word`` joins tokens with single spaces (lossy); with a
    ``vocab`` the ids are first mapped back to token strings.
    """
    if kind == "byte":
        bounded_batches(df.sparkSession)
        return df.withColumn(out, B.decode_bytes(ids_col, specials))
    if kind == "word":
        if vocab is None:
            return df.withColumn(out, F.array_join(F.col(ids_col), " "))
        strings = ids_to_tokens(df.withColumn("__ids", F.col(ids_col)), "__ids", vocab, key, out="__toks")
        return strings.withColumn(out, F.array_join("__toks", " ")).drop("__toks")
    if kind == "bpe":
        from tokenmill.operators.bpe import bpe_decode
        if ranks is None:
            raise ValueError("bpe needs a rank table (merges)")
        return bpe_decode(df, ids_col, ranks, out=out, specials=specials)
    raise ValueError(f"unknown tokenizer kind {kind!r}")


def special_ids(spark, kind: str = "word", specials: Sequence[str] = RESERVED, n_ranks: int = 0
                ) -> DataFrame:
    """The special-token table (token, id): the layout that :func:`build_vocab` reserves (word
    ids 0..k-1), ids from 256 (byte), ids after the ranks (bpe)."""
    base = {"word": 0, "byte": BYTE_VOCAB, "bpe": n_ranks}[kind]
    return spark.createDataFrame([(s, base + i) for i, s in enumerate(specials)],
                                 "token string, id int")


def append_eos(df: DataFrame, tokens: str = "tokens", eos=EOS_TEXT) -> DataFrame:
    """EOS after every document (the last one included)."""
    return df.withColumn(tokens, F.concat(F.col(tokens), F.array(F.lit(eos))))


def token_count(df: DataFrame, tokens: str = "tokens", out: str = "n_tokens") -> DataFrame:
    """C9."""
    return df.withColumn(out, F.size(tokens))


def crop_context(df: DataFrame, tokens: str, n: int, out: str | None = None) -> DataFrame:
    """Keep the last ``n`` tokens."""
    return df.withColumn(out or tokens, A.left_truncate(tokens, n))


def build_vocab(tokens_df: DataFrame, tokens: str = "tokens", min_count: int = 1,
                max_size: int | None = None, specials: Sequence[str] = RESERVED,
                unk: str | None = UNK_TEXT) -> DataFrame:
    """(token, id, count). Specials (and ``unk``) take ids 0..k-1, then tokens by
    count desc, token asc. Counting is a partial+final hash aggregate; ranking runs on
    the aggregated table with the range-partitioned global rank.
    """
    reserved = list(specials) + ([unk] if unk else [])
    counts = (
        tokens_df.select(F.explode(tokens).alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("count"))
        .where((F.col("count") >= min_count) & ~F.col("token").isin(reserved))
    )
    # the aggregate is written once (vocabulary-sized) so range sampling and the ranking
    # pass do not both recount the corpus
    counts = materialize(counts, "token_counts")
    ranked = global_rank(counts, [F.col("count").desc(), F.col("token").asc()], out="__r")
    if max_size is not None:
        ranked = ranked.where(F.col("__r") <= max_size - len(reserved))
    k = len(reserved)
    words = ranked.select("token", (F.col("__r") + k - 1).cast("int").alias("id"), "count")
    spark = tokens_df.sparkSession
    fixed = spark.createDataFrame([(t, i, 0) for i, t in enumerate(reserved)],
                                  "token string, id int, count long")
    return fixed.unionByName(words)


def _to_blocks(column: str, others: list[str]):
    """Each Arrow batch to one block row: its distinct values, and its rows with places in them."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 33
        for b in batches:
            col = b.column(b.schema.get_field_index(column))
            values = col.flatten().dictionary_encode()
            places = values.indices.cast(pa.int32())
            lengths = pa.compute.fill_null(pa.compute.list_value_length(col), 0).cast(pa.int64())
            ends = pa.compute.cumulative_sum(lengths)
            offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends]).cast(pa.int32())
            idx = pa.ListArray.from_arrays(offsets, places)
            rows = pa.StructArray.from_arrays(
                [*[b.column(b.schema.get_field_index(c)) for c in others], idx], names=[*others, "__idx"])

            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), one(values.dictionary), one(rows)],
                                             names=["block", "dictionary", "rows"])
            block += 1
    return run


def _lookup(df: DataFrame, column: str, table: DataFrame, source: str, target: str, out: str,
            default: Column | None = None) -> DataFrame:
    """``column``'s arrays with every value replaced by its ``target`` in ``table``.

    Rows travel in blocks of one Arrow batch: (distinct values, rows of places). Only the distinct
    values of a block meet the table; their targets come back as one array a block, and places
    are resolved inside the block. No row a value, and no grouping of values by their row.
    """
    others = [c for c in df.columns if c != column]
    values = df.schema[column].dataType
    row = T_.StructType([df.schema[c] for c in others]
                        + [T_.StructField("__idx", T_.ArrayType(T_.IntegerType()))])
    schema = T_.StructType([T_.StructField("block", T_.LongType()), T_.StructField("dictionary", values),
                            T_.StructField("rows", T_.ArrayType(row))])
    blocks = materialize(df.mapInArrow(_to_blocks(column, others), schema), "value_blocks")
    side = table.select(F.col(source).alias("__v"), F.col(target).alias("__t"))
    if side.count() <= BROADCAST_VOCAB_ROWS:  # size check before broadcasting
        side = F.broadcast(side)
    found = blocks.select("block", F.posexplode("dictionary").alias("__pos", "__v")).join(side, "__v", "left")
    targets = found.groupBy("block").agg(  # at most the distinct values of one block
        F.sort_array(F.collect_list(F.struct("__pos", "__t"))).alias("__d"))
    targets = targets.select("block", F.col("__d.__t").alias("__t"))
    fill = (lambda v: v) if default is None else (lambda v: F.coalesce(v, default))
    made = blocks.select("block", "rows").join(targets, "block", "left").select(F.explode(F.transform(
        "rows", lambda r: F.struct(*[r[c].alias(c) for c in others], F.transform(
            r["__idx"], lambda i: fill(F.get("__t", i))).alias(out)))).alias("__r"))
    return made.select("__r.*")


def tokens_to_ids(df: DataFrame, tokens: str, vocab: DataFrame, key: Sequence[str] = (),
                  out: str = "ids", unk: str = UNK_TEXT) -> DataFrame:
    """Token strings -> ids via the vocabulary; unknown and null tokens -> ``unk`` id.

    Adds ``out``; a null token array gives an empty one. No column has to be a key (``key`` is
    what an input of only key and tokens keeps): rows that share an id stay rows of their own.
    """
    row = vocab.where(F.col("token") == unk).select("id").first()  # one scalar
    unk_id = F.lit(row[0] if row else None).cast("int")
    if set(df.columns) <= set(key) | {tokens}:
        return _lookup(df, tokens, vocab, "token", "id", out, unk_id)
    kept = df.withColumn("__tokens", F.col(tokens))
    return _lookup(kept, "__tokens", vocab, "token", "id", out, unk_id)


def ids_to_tokens(df: DataFrame, ids: str, vocab: DataFrame, key: Sequence[str] = (),
                  out: str = "tokens") -> DataFrame:
    """Inverse of :func:`tokens_to_ids`; an id the vocabulary lacks gives null."""
    return _lookup(df, ids, vocab, "id", "token", out)


def roundtrip_audit(df: DataFrame, text_col: str = "text", kind: str = "byte",
                    specials: Sequence[str] = DEFAULT_SPECIALS, ranks=None) -> DataFrame:
    """C11: rows where decode(encode(text)) != text, with both texts."""
    enc = encode(df, text_col, kind, out="__ids", specials=specials, ranks=ranks)
    dec = decode(enc, "__ids", kind, out="decoded", specials=specials, ranks=ranks)
    return dec.withColumn("roundtrip_ok", F.col("decoded") == F.col(text_col)).drop("__ids")

