"""Token-stream windows: the pretraining dataset.

The reference concatenates every document's tokens (+EOS) into one list and cuts
windows at starts ``range(0, N - L, S)``; input = ``[i, i+L)``, target = ``[i+1, i+L+1)``.
We never build that list. Each document (split into chunks of at most
``chunk_size`` tokens so one huge document cannot become one huge task) gets its
global offset from a two-level prefix sum.

Windows are assembled per fixed-size stream block: each token is shuffled to its
block, plus the first L tokens of a block to the previous one (the halo), so the
shuffle moves about N * (1 + L / B) tokens whatever the stride; windows are then cut
out of each block with ``slice``. A block group holds at most B + L tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.plans.prefix import global_offsets, materialize, total

DEFAULT_CHUNK = 65_536
# Stream block for window assembly.
DEFAULT_BLOCK = 65_536
# The chunk -> offset join broadcasts the offsets when there are at most this many chunks.
BROADCAST_OFFSET_ROWS = 2_000_000  # about 50 MB of (key, chunk_no, offset)


def window_count_value(n_tokens: int, max_length: int, stride: int) -> int:
    """``len(range(0, N - L, S))`` = max(0, ceil((N - L) / S)); N == L gives 0."""
    _check(max_length, stride)
    return max(0, -(-(n_tokens - max_length) // stride))


def _check(max_length: int, stride: int) -> None:
    if max_length < 1 or stride < 1:
        raise ValueError("max_length and stride must be >= 1")


def chunk_tokens(df: DataFrame, tokens: str = "tokens", chunk_size: int = DEFAULT_CHUNK,
                 out: str = "piece") -> DataFrame:
    """Split each token array into consecutive chunks (``chunk_no``, ``out``, ``n``)."""
    n = F.size(tokens)
    k = F.greatest(F.lit(1), F.ceil(n / F.lit(chunk_size))).cast("int")
    return (
        df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), k - 1)))
        .withColumn(out, F.slice(tokens, F.col("chunk_no") * chunk_size + 1, F.lit(chunk_size)))
        .withColumn("n", F.size(out).cast("long"))
        .drop(tokens)
    )


_SEP = "\u0001"


def _packed(piece: Column) -> tuple[Column, Column]:
    """An array of strings for a shuffle, as (joined string, array): an array takes twice the bytes. It
    stays an array, and the string is null, where a token is null or holds the separator."""
    joined = F.array_join(piece, _SEP)
    seps = F.length(joined) - F.length(F.replace(joined, F.lit(_SEP), F.lit("")))
    plain = (F.size(F.array_compact(piece)) == F.size(piece)) & (F.size(piece) > 0) & (
        seps == F.size(piece) - 1)
    return F.when(plain, joined), F.when(~plain | plain.isNull(), piece)


def _unpacked(joined: Column, piece: Column) -> Column:
    return F.coalesce(F.split(joined, _SEP, -1), piece)


def _strings(df: DataFrame, column: str = "piece") -> bool:
    return df.schema[column].dataType.elementType.simpleString() == "string"


def stream_offsets(df: DataFrame, order: Sequence[str], tokens: str = "tokens",
                   chunk_size: int = DEFAULT_CHUNK, partitions: int | None = None,
                   with_total: bool = False):
    """Position of every chunk in the EOS-joined stream.

    Returns ``order + (doc_row, chunk_no, piece, n, offset)`` (and the total token count N when
    ``with_total``). The token chunks are written once as a table; the prefix sum reads
    only its narrow columns, and the chunks join the offsets back on a row number of their
    own (broadcast only below a checked row count), so no key has to be unique or known.

    ``doc_row`` numbers the input rows. Null keys come first; rows of equal keys follow each
    other whole, in the order of a hash of their tokens (equal rows are interchangeable); a null
    token array has no tokens.
    """
    order = list(order)
    rows = (df.select(*order, F.coalesce(F.col(tokens), F.array().cast(df.schema[tokens].dataType))
                      .alias(tokens))
            .withColumn("doc_row", F.monotonically_increasing_id())
            .withColumn("__hash", F.xxhash64(tokens)))
    chunks = materialize(chunk_tokens(rows, tokens, chunk_size).withColumn(
        "__chunk", F.monotonically_increasing_id()), "token_chunks")  # written, so numbers stay
    lengths = chunks.select(*order, "__hash", "doc_row", "chunk_no", "__chunk", "n")
    offs = global_offsets(lengths, [*order, "__hash", "doc_row", "chunk_no"], "n", out="offset",
                          partitions=partitions).select("__chunk", "offset", "n")
    stats = offs.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).first()
    side = offs.drop("n")
    if stats["rows"] <= BROADCAST_OFFSET_ROWS:  # size check before broadcasting
        out = chunks.join(F.broadcast(side), "__chunk").drop("__hash", "__chunk")
    elif _strings(chunks):
        text, array = _packed(F.col("piece"))
        out = chunks.withColumns({"piece": array, "__text": text}).join(side, "__chunk").withColumn(
            "piece", _unpacked(F.col("__text"), F.col("piece"))).drop("__hash", "__chunk", "__text")
    else:
        out = chunks.join(side, "__chunk").drop("__hash", "__chunk")
    if with_total:
        return out, int(stats["n"] or 0)
    return out


def _block_pieces(chunks: DataFrame, max_length: int, block: int, last_start: Column,
                  keep: Sequence[str] = (), base: Column | None = None) -> DataFrame:
    """Explode each chunk into the pieces of every stream block that needs it.

    Block b owns the windows starting in [b*B, (b+1)*B) and so needs the tokens
    [b*B, (b+1)*B + L): its own plus an L-token halo from the next block. A chunk at
    [off, off+n) feeds blocks max(0, floor((off-L)/B)) .. floor((off+n-1)/B), capped
    at the block holding ``last_start`` (the last window start; < 0 means no window).
    """
    L, B = max_length, block
    off = F.col("offset") - (base if base is not None else F.lit(0))
    n = F.col("n")
    lo = F.greatest(F.lit(0), F.floor((off - L) / B)).cast("long")
    hi = F.least(F.floor((off + n - 1) / B), F.floor(last_start / B)).cast("long")
    cols = [*keep, "piece", "n", off.alias("__off"), last_start.alias("__last"),
            F.explode(F.sequence(lo, hi)).alias("block")]
    exploded = chunks.where((n > 0) & (last_start >= 0) & (lo <= hi)).select(*cols)
    b, o = F.col("block"), F.col("__off")
    start = F.greatest(b * B, o)
    end = F.least((b + 1) * B + L - 1, o + n - 1)
    out = [*keep, "block", "__last", start.alias("start"),
           F.slice("piece", (start - o + 1).cast("int"), (end - start + 1).cast("int"))
           .alias("piece")]
    return exploded.select(*out)


def _block_windows(pieces: DataFrame, group: Sequence[str], max_length: int, stride: int,
                   block: int, plan: DataFrame | None = None) -> DataFrame:
    """Reassemble each block (one shuffle on the block key) and cut its windows:
    input = [s, s+L), target = [s+1, s+L+1) for every start s = w*S in the block. ``plan``
    (see :func:`sliding_windows`; no ``group``): only its windows, with its columns."""
    L, S, B = max_length, stride, block
    fields, whole = ["piece"], F.col("__p.piece")
    if _strings(pieces):
        text, array = _packed(F.col("piece"))
        pieces = pieces.withColumns({"piece": array, "__text": text})
        fields = ["__text", "piece"]
        whole = F.transform("__p", lambda x: _unpacked(x["__text"], x["piece"]))
    g = pieces.groupBy(*group, "block").agg(
        F.sort_array(F.collect_list(F.struct("start", *fields))).alias("__p"),
        F.max("__last").alias("__last"))
    b = F.col("block")
    if plan is not None:  # one short array a block: the windows themselves are not moved again
        mine = plan.groupBy(F.floor(F.col("window_id") * S / B).alias("block")).agg(
            F.collect_list(F.struct("window_id", *[c for c in plan.columns if c != "window_id"])).alias("__w"))
        g = g.join(mine, "block").select("block", "__w", F.flatten(whole).alias("__arr"))
        rel = lambda w: (w["window_id"] * S - b * B + 1).cast("int")
        return g.select(F.explode(F.transform("__w", lambda w: F.struct(
            w["window_id"].alias("window_id"), F.slice("__arr", rel(w), L).alias("input_ids"),
            F.slice("__arr", rel(w) + 1, L).alias("target_ids"),
            *[w[c].alias(c) for c in plan.columns if c != "window_id"]))).alias("__w")).select("__w.*")
    g = g.select(*group, "block", "__last", F.flatten(whole).alias("__arr"))
    w_lo = F.floor((b * B + S - 1) / S).cast("long")
    w_hi = F.least(F.floor(((b + 1) * B - 1) / S), F.floor(F.col("__last") / S)).cast("long")

    def cut(w: Column) -> Column:
        rel = (w * S - b * B + 1).cast("int")
        return F.struct(w.alias("window_id"), F.slice("__arr", rel, L).alias("input_ids"),
                        F.slice("__arr", rel + 1, L).alias("target_ids"))

    # Windows are built inside the block row and only the small structs are exploded,
    # so the block array is never copied onto every output row.
    x = g.where(w_lo <= w_hi).select(
        *group, F.explode(F.transform(F.sequence(w_lo, w_hi), cut)).alias("__w"))
    return x.select(*group, "__w.*")


def sliding_windows(offsets: DataFrame, max_length: int, stride: int,
                    n_tokens: int | None = None, lineage_key: str | None = None,
                    block: int = DEFAULT_BLOCK, plan: DataFrame | None = None) -> DataFrame:
    """Windows over the global stream (they cross document boundaries).

    ``offsets`` is the output of :func:`stream_offsets`. Starts are ``range(0, N-L, S)``
    (S < L overlaps, S == L tiles, S > L leaves gaps); with ``lineage_key`` (D6) every
    window also lists the documents it touches, in stream order (see :func:`window_documents`).
    ``plan``, a table with one row for each ``window_id`` wanted, adds its columns to the windows; it
    travels to the blocks, so token arrays are not shuffled or ranked for it.
    Output: (window_id, input_ids, target_ids[, columns of the plan][, doc_ids, n_docs]).
    """
    _check(max_length, stride)
    if n_tokens is None:
        n_tokens = total(offsets.select("n"), "n")
    W = window_count_value(n_tokens, max_length, stride)
    last = F.lit((W - 1) * stride).cast("long")
    pieces = _block_pieces(offsets, max_length, block, last)
    out = _block_windows(pieces, [], max_length, stride, block, plan)
    if lineage_key:
        listed = F.sort_array(F.collect_list(F.struct("window_pos", lineage_key)))
        docs = window_documents(offsets, lineage_key, max_length, stride, n_tokens).groupBy(
            "window_id").agg(listed.alias("__d"))  # at most L + 1 documents
        out = out.join(docs, "window_id").withColumn(
            "doc_ids", F.col(f"__d.{lineage_key}")).drop("__d").withColumn("n_docs", F.size("doc_ids"))
    return out


def window_documents(offsets: DataFrame, key: str, max_length: int, stride: int,
                     n_tokens: int | None = None) -> DataFrame:
    """Which tokens of which document every window holds, from intervals alone.

    Windows start at multiples of the stride, so the windows that a chunk's span reaches follow
    from its offset by division: one row for each window and chunk that meet, no row or id a token
    and no token array. Chunks of one document inside a window are merged. Output, one row for each
    window and document: (window_id, key, doc_row, window_pos, doc_pos, n_tokens): the document's
    tokens ``[doc_pos, doc_pos + n_tokens)`` stand at ``[window_pos, window_pos + n_tokens)`` of the
    window's L + 1 tokens (inputs and the last target).
    """
    _check(max_length, stride)
    if n_tokens is None:
        n_tokens = total(offsets.select("n"), "n")
    L, S = max_length, stride
    W = window_count_value(n_tokens, L, S)
    lo, hi = F.col("offset"), F.col("offset") + F.col("n")
    first = F.greatest(F.lit(0), F.ceil((lo - L) / S)).cast("long")
    last = F.least(F.floor((hi - 1) / S), F.lit(W - 1)).cast("long")
    # a chunk's place in its document: all chunks but the last have the same size
    spans = offsets.where((F.col("n") > 0) & (first <= last)).select(
        key, "doc_row", "chunk_no", "offset", "n", F.explode(F.sequence(first, last)).alias("window_id"))
    start = F.col("window_id") * S
    a, b = F.greatest("offset", start), F.least(hi, start + L + 1)
    parts = spans.where(a < b).select("window_id", key, "doc_row", (a - start).alias("window_pos"), (
        b - a).alias("n_tokens"), F.struct("chunk_no", (a - F.col("offset")).alias("at")).alias("place"))
    merged = parts.groupBy("window_id", "doc_row").agg(
        F.first(key).alias(key), F.min("window_pos").alias("window_pos"), F.min("place").alias("place"),
        F.sum("n_tokens").alias("n_tokens"))
    size = offsets.agg(F.max("n")).first()[0] or 0  # of a full chunk, if any document has two
    return merged.select("window_id", key, "doc_row", "window_pos",
                         (F.col("place.chunk_no") * F.lit(size) + F.col("place.at")).alias("doc_pos"),
                         "n_tokens")


def per_document_windows(offsets: DataFrame, key: str, max_length: int, stride: int,
                         block: int = DEFAULT_BLOCK) -> DataFrame:
    """D6 extension: windows that never cross a document boundary.

    Each document's own stream (its tokens + EOS) is windowed like the global one.
    Output ``(key, window_id, input_ids, target_ids)`` with ``window_id`` local to the doc.
    """
    _check(max_length, stride)
    docs = offsets.groupBy("doc_row").agg(F.min("offset").alias("__doc_start"),
                                          F.sum("n").alias("__doc_n"))
    L, S = max_length, stride
    w_doc = F.greatest(F.lit(0), F.ceil((F.col("__doc_n") - L) / F.lit(S))).cast("long")
    joined = offsets.join(docs, "doc_row")
    pieces = _block_pieces(joined, L, block, (w_doc - 1) * S, keep=[key, "doc_row"],
                           base=F.col("__doc_start"))
    return _block_windows(pieces, [key, "doc_row"], L, S, block).drop("doc_row")


def windows_of_rows(docs: DataFrame, key: str, max_length: int, stride: int, tokens: str = "tokens"
                    ) -> DataFrame:
    """D6 for documents that are one row each: the same windows as
    :func:`per_document_windows`, cut inside the row, so nothing is shuffled."""
    _check(max_length, stride)
    last = F.size(tokens) - max_length - 1  # the last start that leaves a next token
    start = F.explode(F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))))
    return docs.select(key, tokens, start.alias("__s")).select(
        key, (F.col("__s") / stride).cast("long").alias("window_id"),
        F.slice(tokens, F.col("__s") + 1, F.lit(max_length)).alias("input_ids"),
        F.slice(tokens, F.col("__s") + 2, F.lit(max_length)).alias("target_ids"))


def window_count(lengths: DataFrame, max_length: int, stride: int, size: str = "n") -> DataFrame:
    """D4 as a one-row DataFrame: (n_tokens, n_windows)."""
    return window_counts(lengths, [(max_length, stride)], size).drop("max_length", "stride")


def window_counts(lengths: DataFrame, params, size: str = "n") -> DataFrame:
    """D4 for several (max_length, stride) pairs from one pass over the lengths."""
    for L, S in params:
        _check(L, S)
    n = lengths.agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("n_tokens"))
    grid = F.explode(F.array(*[F.struct(F.lit(L).cast("long").alias("max_length"),
                                        F.lit(S).cast("long").alias("stride"))
                               for L, S in params])).alias("p")
    return n.select("n_tokens", grid).select(
        "p.max_length", "p.stride", "n_tokens",
        F.greatest(F.lit(0), F.ceil((F.col("n_tokens") - F.col("p.max_length"))
                                    / F.col("p.stride"))).cast("long").alias("n_windows"))


def next_token_pairs(windows: DataFrame) -> DataFrame:
    """Flatten (window, position) into independent (context_token, next_token) rows."""
    z = F.posexplode(F.arrays_zip(F.col("input_ids").alias("c"), F.col("target_ids").alias("t")))
    return windows.select("window_id", z.alias("pos", "z")).select(
        "window_id", "pos", F.col("z.c").alias("context_token"), F.col("z.t").alias("next_token"))
