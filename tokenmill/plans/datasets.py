"""End-to-end dataset builders for the three training flows.

Each one composes the operators in the order the semantics require
(scan bound -> filter -> cap -> split -> shuffle -> batches -> padding) and returns one
table with ``split`` and ``batch_id`` columns, ready for :func:`sources.sinks.write_examples`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT, IGNORE_INDEX, PAD_TEXT
from tokenmill.operators import chat as C
from tokenmill.operators import ordering as O
from tokenmill.operators import preference as P
from tokenmill.operators import windows as win
from tokenmill.operators.segment import segment_lines, segment_tokens
from tokenmill.plans.prefix import materialize
from tokenmill.plans.pretrain import doc_tokens


def _batches(df: DataFrame, split: str, key: str, batch_size: int, seed: int, epoch: int,
             drop_last_train: bool) -> DataFrame:
    """Train rows in a seeded shuffled order (optionally dropping the last partial batch),
    other splits in key order; batch ids restart per split."""
    if split == "train":
        shuffled = O.shuffle_order(df, key, seed, epoch)
        return O.assign_batches(shuffled, ["shuffle_key", key], batch_size,
                                drop_last=drop_last_train).drop("shuffle_key")
    return O.assign_batches(df, [key], batch_size)


def _planned(rows: DataFrame, key: str, batch_size: int, val_fraction: float,
             max_examples: int | None, seed: int) -> DataFrame:
    """``rows`` with split, batch_id and pos_in_batch: the plan is made on the key column alone and
    joined back once, so token arrays are not ranked."""
    rows = materialize(rows, "examples")
    keys = O.tail_split(O.cap_examples(rows.select(key), [key], max_examples), [key], val_fraction)
    parts = [_batches(keys.where(F.col("split") == s), s, key, batch_size, seed, 0, False)
             for s in ("train", "validation")]
    return rows.join(parts[0].unionByName(parts[1]), key)


def pretraining_examples(docs: DataFrame, max_length: int = 256, stride: int = 128,
                         batch_size: int = 4, split_col: str = "split", key: str = "doc_id",
                         seed: int = 0, epoch: int = 0, kind: str = "word",
                         splits: tuple[str, ...] = ("train", "validation", "test"),
                         headings: bool = False) -> DataFrame:
    """§3.1: per named split: (segment the line corpus at its headings) -> encode -> EOS -> stream
    offsets -> windows (input, target); train shuffled with the last partial batch dropped,
    other splits in order. ``headings`` says that the rows are lines of a corpus, not documents;
    segments are then cut into windows without building document strings. Batches are planned on the
    window ids, which follow from the stream's length, and go to the stream blocks that the windows are cut from."""
    out = None
    for s in splits:
        rows = docs.where(F.col(split_col) == s)
        if headings:
            toks = segment_tokens(segment_lines(rows, key), key)
            order = ["seg_id", key, "line_no"]
        else:
            toks, order = doc_tokens(rows, kind, key=key), [key]
        offs, n = win.stream_offsets(toks, order, with_total=True)
        ids = docs.sparkSession.range(win.window_count_value(n, max_length, stride)).toDF("window_id")
        plan = _batches(ids, s, "window_id", batch_size, seed, epoch, drop_last_train=True)
        b = win.sliding_windows(offs, max_length, stride, n_tokens=n, plan=plan)
        b = b.withColumn(split_col, F.lit(s))
        out = b if out is None else out.unionByName(b)
    return out


def sft_dataset(turns: DataFrame, max_length: int = 1024, batch_size: int = 4,
                val_fraction: float = 0.01, filter_small: bool = False, filter_scan: int = 50000,
                max_examples: int | None = None, dynamic_padding: bool = True,
                pad_id=None, ignore=IGNORE_INDEX, seed: int = 0, key: str = "conv_id",
                template: C.ChatTemplate = C.DEFAULT_TEMPLATE) -> DataFrame:
    """§3.2: bounded scan -> fits -> cap -> tail split -> mask/truncate/shift -> batches -> pad.

    Conversations whose last message is not the assistant's are left out (B7).
    """
    if filter_small:
        scanned = O.first_n_by_order(turns.select(key).distinct(), [key], filter_scan)
        turns = turns.join(scanned, key, "left_semi")
    ex = C.sft_examples(turns, max_length, key=key, ignore=ignore, fits_only=filter_small,
                        template=template)
    out = _planned(ex, key, batch_size, val_fraction, max_examples, seed)
    kind = ex.schema["target_ids"].dataType.elementType
    pad = C.resolve_pad_id(pad_id, template.special(EOS_TEXT))
    pads = {"input_ids": pad, "target_ids": F.lit(ignore).cast(kind)}
    if dynamic_padding:
        # batch ids restart per split, so the padding window is per (split, batch)
        out = out.withColumn("__b", F.concat_ws(":", "split", F.col("batch_id").cast("string")))
        return C.pad_dynamic(out, pads, batch="__b").drop("__b")
    return C.pad_static(out, max_length - 1, pads)


def reward_dataset(pairs: DataFrame, max_length: int = 1024, batch_size: int = 4,
                   val_fraction: float = 0.01, filter_small: bool = False,
                   filter_scan: int = 50000, max_examples: int | None = None,
                   dynamic_padding: bool = True, pad_id=PAD_TEXT, seed: int = 0) -> DataFrame:
    """§3.3: pairs -> encode both sides -> (both sides fit) -> cap -> tail split -> batches ->
    independent padding + attention masks. Static padding pads to ``max_length``."""
    if filter_small:
        scanned = O.first_n_by_order(pairs.select("pair_id").distinct(), ["pair_id"], filter_scan)
        pairs = pairs.join(scanned, "pair_id", "left_semi")
    enc = P.encode_pairs(pairs, max_length)
    if filter_small:
        enc = P.pair_fits(enc, max_length)
    out = _planned(P.to_wide(enc), "pair_id", batch_size, val_fraction, max_examples, seed)
    if dynamic_padding:
        out = out.withColumn("__b", F.concat_ws(":", "split", F.col("batch_id").cast("string")))
        return P.pad_pairs(out, pad_id, "dynamic", batch="__b").drop("__b")
    return P.pad_pairs(out, pad_id, "static", max_length=max_length)
