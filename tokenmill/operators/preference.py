"""Preference pairs for reward-model data.

Pairs are flat turn tables ``(pair_id, side, turn, role, text)`` with side in
{chosen, rejected}; both sides are rendered and left-truncated with the chat
operators (no label mask, no shift) and padded independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions import arrays as A
from tokenmill.operators import chat as C
from tokenmill.plans.prefix import global_rank

SIDES = ("chosen", "rejected")


def pairs_from_prompts(df: DataFrame, key: str = "pair_id", prompt: str = "prompt",
                       chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """(prompt, chosen, rejected) strings -> flat two-turn conversations per side."""
    rows = []
    for side, col in (("chosen", chosen), ("rejected", rejected)):
        rows.append(df.select(key, F.lit(side).alias("side"), F.lit(0).cast("long").alias("turn"),
                              F.lit("user").alias("role"), F.col(prompt).alias("text")))
        rows.append(df.select(key, F.lit(side).alias("side"), F.lit(1).cast("long").alias("turn"),
                              F.lit("assistant").alias("role"), F.col(col).alias("text")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def pairs_from_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn"
                             ) -> DataFrame:
    """Derived preference pairs: each assistant-ended conversation is ``chosen``; ``rejected``
    is the same prompt answered with the last assistant turn of the next such conversation
    (by ``key``; the last one wraps to the first). Linear: rank + equi-join on rank + 1.
    """
    last = turns.groupBy(key).agg(F.max(order).alias("__mt"),
                                  F.max_by("role", order).alias("__lr"),
                                  F.max_by("text", order).alias("__lt"))
    ended = last.where(F.col("__lr") == "assistant").select(key, "__mt", "__lt")
    ranked = global_rank(ended, [key], out="__r")
    n = ranked.count()
    nxt = ranked.select(F.col("__r").alias("__nr"), F.col("__lt").alias("__rej"))
    pairs = ranked.withColumn("__nr", F.col("__r") % F.lit(n) + 1).join(nxt, "__nr").select(
        key, "__mt", "__rej")
    chosen = turns.join(ended.select(key), key, "left_semi").select(
        F.col(key).alias("pair_id"), F.lit("chosen").alias("side"), order, "role", "text")
    prefix = turns.join(pairs.select(key, "__mt"), key).where(F.col(order) < F.col("__mt")).select(
        F.col(key).alias("pair_id"), F.lit("rejected").alias("side"), order, "role", "text")
    answer = pairs.select(F.col(key).alias("pair_id"), F.lit("rejected").alias("side"),
                          F.col("__mt").alias(order), F.lit("assistant").alias("role"),
                          F.col("__rej").alias("text"))
    return chosen.unionByName(prefix).unionByName(answer)


def encode_pairs(pairs: DataFrame, max_length: int, template: C.ChatTemplate = C.DEFAULT_TEMPLATE
                 ) -> DataFrame:
    """render both sides and keep the last ``max_length`` tokens (no mask, no shift).

    Output: (pair_id, side, ids, full_len) - one row per side.
    """
    keyed = pairs.withColumn("__pk", F.struct("pair_id", "side")).drop("pair_id", "side")
    r = C.render_chat(keyed, max_length, key="__pk", template=template)
    return r.select("__pk.pair_id", "__pk.side", "ids", "full_len")


def pair_fits(encoded: DataFrame, max_length: int) -> DataFrame:
    """Keep a pair only if both sides fit without truncation."""
    ok = (encoded.groupBy("pair_id").agg(F.max("full_len").alias("__m"), F.count(F.lit(1)).alias("__k"))
          .where((F.col("__m") <= max_length) & (F.col("__k") == 2)).select("pair_id"))
    return encoded.join(ok, "pair_id", "left_semi")


def to_wide(encoded: DataFrame) -> DataFrame:
    """One row per pair: chosen_ids, rejected_ids; a side that a pair lacks is null."""
    def ids_of(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("ids")))

    return encoded.groupBy("pair_id").agg(ids_of("chosen").alias("chosen_ids"),
                                          ids_of("rejected").alias("rejected_ids"))


def incomplete_pairs(encoded: DataFrame) -> DataFrame:
    """(pair_id, missing) of the pairs that lack a side."""
    has = [F.max((F.col("side") == s).cast("int")).alias(s) for s in SIDES]
    return (encoded.groupBy("pair_id").agg(*has).where("chosen = 0 or rejected = 0")
            .select("pair_id", F.when(F.col("chosen") == 0, "chosen").otherwise("rejected")
                    .alias("missing")))


def flatten_pairs(df: DataFrame, key: str = "pair_id", chosen: str = "chosen",
                  rejected: str = "rejected") -> DataFrame:
    """A4: nested ``chosen`` / ``rejected`` message lists -> (pair_id, side, turn, role, text)."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("messages"))
                      for s, c in zip(SIDES, (chosen, rejected))])
    rows = df.select(F.col(key).alias("pair_id"), F.explode(sides).alias("s"))
    return rows.select("pair_id", "s.side", F.posexplode("s.messages").alias("turn", "m")).select(
        "pair_id", "side", F.col("turn").cast("long").alias("turn"), F.col("m.role").alias("role"),
        F.col("m.content").alias("text"))


def pad_pairs(wide: DataFrame, pad, mode: str = "dynamic", max_length: int | None = None,
              batch: str = "batch_id") -> DataFrame:
    """F2 + F3: pad chosen and rejected independently and add both attention masks.

    dynamic: each side to its own longest row in the batch; static: both to ``max_length``.
    """
    out = wide.withColumn("chosen_len", F.size("chosen_ids")).withColumn(
        "rejected_len", F.size("rejected_ids"))
    if mode == "static":
        if max_length is None:
            raise ValueError("static padding needs max_length")
        out = C.pad_static(out, max_length, {"chosen_ids": pad, "rejected_ids": pad})
        cw = rw = F.lit(max_length)
    elif mode == "dynamic":
        out = C.pad_dynamic(out, {"chosen_ids": pad}, batch, "chosen_width")
        out = C.pad_dynamic(out, {"rejected_ids": pad}, batch, "rejected_width")
        cw, rw = F.col("chosen_width"), F.col("rejected_width")
    else:
        raise ValueError(mode)
    return (out.withColumn("chosen_attention_mask",
                           F.concat(A.repeat(1, F.col("chosen_len")), A.repeat(0, cw - F.col("chosen_len"))))
            .withColumn("rejected_attention_mask",
                        F.concat(A.repeat(1, F.col("rejected_len")),
                                 A.repeat(0, rw - F.col("rejected_len")))))


def pad_collision_audit(df: DataFrame, ids: str, mask: str, pad) -> DataFrame:
    """where the pad-scan guess of the last real token (first pad position - 1)
    disagrees with the mask (``sum(mask) - 1``). Happens when the pad id also occurs
    among the real tokens (e.g. pad == EOS)."""
    first_pad = F.array_position(ids, F.lit(pad))  # 1-based, 0 when absent
    by_mask = A.last_real_index(mask)
    return (df.withColumn("mask_last", by_mask)
            .withColumn("scan_last", F.when(first_pad > 0, first_pad - 2)
                        .otherwise(F.size(ids) - 1))
            .withColumn("collision", F.col("mask_last") != F.col("scan_last")))
