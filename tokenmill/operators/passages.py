"""Passages that two splits share (G3): a leak check below the level of whole documents.

A passage is a run of tokens; it leaks when every window of ``length`` tokens in it also occurs in
a row of the other split. Comparing all windows would shuffle the corpus ``length`` times over, so
rows are reduced to winnowed fingerprints first: of every ``length - gram + 1`` neighbouring grams
the one of smallest hash. Two equal windows pick equal fingerprints, so none is missed. Only windows
round fingerprints that both splits hold are spelt out and compared, by a digest of their tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.functions import hashing as X
from tokenmill.plans.prefix import materialize
from tokenmill.session import bounded_batches

MAX_BROADCAST_HASHES = 1_000_000


def _winnowed(rows: pa.Array, length: int, gram: int) -> pa.Array:
    """The fingerprints of the rows of a batch, its tokens hashed and winnowed in one pass."""
    size = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = rows.flatten()
    h = _hashes(tokens)
    n, span = len(h), length - gram + 1
    g = np.full(max(n - gram + 1, 0), 0x51ED270B, np.uint64)  # of the gram that starts here
    for j in range(gram):
        g = X.mix64(g * X._B + h[j:j + len(g)])
    m = max(len(g) - span + 1, 0)  # windows that start here
    least, at = g[:m].copy(), np.arange(m)
    for j in range(1, span):
        less = g[j:j + m] < least  # of equal hashes the first stays
        least[less] = g[j:j + m][less]
        at[less] = np.flatnonzero(less) + j
    first = np.cumsum(size) - size
    row = np.repeat(np.arange(len(size)), size)[:m]
    inside = np.arange(m) + length <= (first + size)[row]
    at, row = at[inside], row[inside]
    fresh = np.ones(len(at), bool)  # the places of neighbouring windows never go back
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    at, row = at[fresh], row[fresh]
    prints = pa.StructArray.from_arrays([pa.array(g[at].view(np.int64)),
                                         pa.array((at - first[row] + 1).astype(np.int32))], names=["h", "p"])
    off = np.r_[0, np.cumsum(np.bincount(row, minlength=len(size)))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), prints)


def _hashes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit hash of each token by its bytes and length; nulls share one."""
    null = tokens.is_null().to_numpy(zero_copy_only=False)
    tokens = pc.fill_null(tokens, "").cast(pa.large_string())
    _, off, data = tokens.buffers()
    off = np.frombuffer(off, np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
    data = (np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and data.size
            else np.zeros(0, np.uint8))
    off = off - off[0]
    h = np.zeros(len(tokens), np.uint64)
    has = np.diff(off) > 0
    h[has] = X.hash_spans(data, off[:-1][has], off[1:][has], fold=False) + np.diff(off)[has].astype(np.uint64)
    h[null] = np.uint64(0x9D39247E33776D41)
    return h


def winnow(tokens: Column, length: int, gram: int) -> Column:
    """array<struct<h, p>>: the fingerprints of a row of at least ``length`` tokens (others have none),
    ``p`` being the 1-based place of the gram; of equal hashes in a window the first place is taken."""
    def run(rows: pa.Array) -> pa.Array:
        return _winnowed(rows, length, gram)
    return F.arrow_udf(run, "array<struct<h:bigint,p:int>>")(tokens)


def shared_passages(df: DataFrame, length: int, keep: Sequence[str] = ("doc_id",),
                    gram: int | None = None, known: str = "train", tested: str = "validation",
                    split: str = "split", tokens: str = "tokens") -> DataFrame:
    """Maximal passages of ``tested`` rows whose windows of ``length`` tokens all occur in ``known``
    rows: ``keep`` columns, ``first_token`` (from 0) and ``n_tokens`` (long).

    Rows need no unique key: each is a row of its own. Null token arrays and rows shorter than
    ``length`` have no window and give nothing; null tokens equal each other. Fingerprints that many
    rows hold are counted by partial aggregates and meet as distinct hashes; a window that occurs in
    many rows meets its distinct digest. What is gathered for one row are places in that row.
    """
    gram = gram or (length + 1) // 2
    if not 1 <= gram <= length:
        raise ValueError("gram must be in [1, length]")
    span = length - gram + 1
    rows = df.where(F.size(tokens) >= length).where(F.col(split).isin(known, tested)).select(
        F.struct(*keep).alias("__keep"), (F.col(split) == known).alias("__known"),
        F.col(tokens).cast("array<string>").alias("__t"), F.monotonically_increasing_id().alias("__row"))
    bounded_batches(df.sparkSession)
    # hashing is the dear part: rows are dealt evenly, whatever the files and the longest rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(materialize(rows, "passage_keys").repartition(parts), "passage_rows")
    prints = rows.select("__row", "__known", F.explode(winnow(F.col("__t"), length, gram)).alias("f"))
    prints = materialize(prints.select("__row", "__known", F.col("f.h").alias("__h"),
                                       F.col("f.p").alias("__p")), "passage_prints")
    common = prints.groupBy("__h").agg(F.bool_or("__known").alias("a"),
                                       F.bool_or(~F.col("__known")).alias("b"))
    common = materialize(common.where("a AND b").select("__h"), "passage_common")
    small = common.count() <= MAX_BROADCAST_HASHES
    hits = prints.join(F.broadcast(common) if small else common, "__h", "left_semi").groupBy(
        "__row").agg(F.collect_set("__p").alias("__at"))

    last = F.size("__t") - length + 1
    starts = F.array_distinct(F.flatten(F.transform("__at", lambda p: F.sequence(
        F.greatest(p - span + 1, F.lit(1)), F.least(p, last)))))

    def window(s: Column) -> Column:  # digests are made before the explode: no row carries its tokens
        part = F.slice("__t", s, F.lit(length))
        return F.struct(s.alias("s"), F.md5(F.array_join(part, " ", "")).alias("a"),
                        F.xxhash64(part).alias("b"))

    near = rows.join(hits, "__row").select(
        "__row", "__keep", "__known", F.explode(F.transform(starts, window)).alias("w"))
    near = materialize(near.select("__row", "__keep", "__known", F.col("w.s").alias("__s"),
                                   F.struct("w.a", "w.b").alias("__d")), "passage_windows")
    found = near.where(~F.col("__known")).join(
        near.where("__known").select("__d").distinct(), "__d", "left_semi")
    places = Window.partitionBy("__row").orderBy("__s")  # windows of one row
    runs = found.withColumn("__new", (F.col("__s") - F.lag("__s", 1, -1).over(places) > 1).cast("int"))
    runs = runs.withColumn("__run", F.sum("__new").over(places))
    return runs.groupBy("__row", "__run").agg(
        F.first("__keep").alias("__keep"), (F.min("__s") - 1).cast("long").alias("first_token"),
        (F.max("__s") - F.min("__s") + length).cast("long").alias("n_tokens")).select(
        "__keep.*", "first_token", "n_tokens")
