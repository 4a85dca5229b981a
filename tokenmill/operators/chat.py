"""Conversations -> chat renderings and SFT examples.

Input is the flat turn table ``(conv_id, turn, role, text)`` (nested ``messages``
arrays are flattened first with :func:`flatten_messages`). A rendering is
``BOS + turn_1 + ... + turn_k`` where a turn is ``header(role) + content + EOT``; the
prompt of a conversation is ``BOS + turn_1 + ... + turn_(k-1) + header(assistant)``.

Scale: a conversation is never collected whole. Turn lengths go through the
range-partitioned prefix sum, so every turn knows its position inside its
rendering; only the turn pieces that fall in the kept tail (the last ``max_length``
tokens) are collected, so each group holds at most ``max_length`` tokens however
long the conversation is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.config import (BOS_TEXT, BYTE_VOCAB, EOS_TEXT, EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT,
                              IGNORE_INDEX)
from tokenmill.functions import arrays as A
from tokenmill.functions.text import byte_tokens, word_tokens
from tokenmill.plans.prefix import global_offsets, materialize


@dataclass(frozen=True)
class ChatTemplate:
    """Turn markup (word-token form). ``header_len`` tokens open every turn."""
    bos: str = BOS_TEXT
    header_start: str = HEADER_START_TEXT
    header_end: str = HEADER_END_TEXT
    eot: str = EOT_TEXT
    specials: tuple[str, ...] = (EOS_TEXT, EOT_TEXT, BOS_TEXT, HEADER_START_TEXT, HEADER_END_TEXT)

    kind: str = "word"  # "word": string tokens; "byte": integer ids, specials from 256 on

    def special(self, text: str):
        """A special token in the template's token form."""
        return text if self.kind == "word" else BYTE_VOCAB + self.specials.index(text)

    @property
    def bos_id(self):
        return self.special(self.bos)

    @property
    def header_len(self) -> int:
        """Tokens of the assistant header, which ends every prompt."""
        return 3 if self.kind == "word" else 2 + len("assistant")

    def tokens(self, text: Column) -> Column:
        return (word_tokens if self.kind == "word" else byte_tokens)(text, self.specials)

    def header(self, role: Column) -> Column:
        name = F.array(role) if self.kind == "word" else byte_tokens(role, ())
        return F.concat(F.array(F.lit(self.special(self.header_start))), name,
                        F.array(F.lit(self.special(self.header_end))))

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(self.header(role), self.tokens(text),
                        F.array(F.lit(self.special(self.eot))))


DEFAULT_TEMPLATE = ChatTemplate()
BYTE_TEMPLATE = ChatTemplate(kind="byte")


def flatten_messages(df: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """Nested ``array<struct<role, content>>`` -> flat turns (key, turn, role, text)."""
    return df.select(key, F.posexplode(messages).alias("turn", "m")).select(
        key, F.col("turn").cast("long").alias("turn"), F.col("m.role").alias("role"),
        F.col("m.content").alias("text"))


def collect_messages(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Flat turns -> nested ``messages`` (turn order). For conversations of bounded size,
    e.g. after :func:`fits`; the SFT/preference operators never need it."""
    return turns.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
        .alias("__m")).select(key, F.transform("__m", lambda m: F.struct(
            m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def render_turns(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Per-turn token arrays ``toks``, their length ``n`` and opening header ``hdr`` (row-local)."""
    return (turns.withColumn("toks", template.turn(F.col("role"), F.col("text")))
            .withColumn("n", F.size("toks").cast("long"))
            .withColumn("hdr", F.slice("toks", 1, template.header_len)))


def rendered_table(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                   template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Render every turn once and write it as a table (tokenize once; the layout then
    reads only the narrow columns, the tail pieces read the tokens)."""
    r = render_turns(turns.select(key, order, "role", "text"), template)
    return materialize(r.drop("text"), "rendered_turns")


def layout(rendered: DataFrame, key: str = "conv_id", order: str = "turn",
           template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Per turn: ``start`` (position in the full rendering, BOS at 0) plus conversation facts:
    ``full_len``, ``prompt_len``, ``last_turn``, ``last_role``, ``last_header_ok``.

    ``prompt_len = 1 + (tokens of all turns but the last) + header_len`` (E3/E4).
    ``last_header_ok``: the last turn opens with the assistant header, which is exactly
    when the prompt is a prefix of the full rendering.
    """
    narrow = rendered.select(key, order, "role", "n", F.col("hdr").alias("__hdr"))
    offs = global_offsets(narrow, [key, order], "n", out="__off")
    assistant_header = template.header(F.lit("assistant"))
    stats = offs.groupBy(key).agg(
        F.min("__off").alias("__conv_off"), F.sum("n").alias("__body"),
        F.max(order).alias("last_turn"), F.max_by("role", order).alias("last_role"),
        F.max_by("n", order).alias("__n_last"), F.count(F.lit(1)).alias("n_turns"),
        F.max_by("__hdr", order).alias("__last_hdr"))
    stats = stats.select(
        key, "last_turn", "last_role", "n_turns",
        (F.col("__body") + 1).alias("full_len"),
        (F.col("__body") + 1 - F.col("__n_last") + template.header_len).alias("prompt_len"),
        (F.col("__last_hdr") == assistant_header).alias("last_header_ok"),
        F.col("__conv_off"))
    return (offs.join(stats, key)
            .select(key, order, "n", (F.col("__off") - F.col("__conv_off") + 1).alias("start"),
                    "full_len", "prompt_len", "last_turn", "last_role", "n_turns",
                    "last_header_ok"))


def conversation_stats(lay: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row per conversation from a :func:`layout` (its last-turn row: no shuffle)."""
    return lay.where(F.col(order) == F.col("last_turn")).select(
        key, "full_len", "prompt_len", "last_turn", "last_role", "n_turns", "last_header_ok")


def require_last_role(lay: DataFrame, role: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) - conversations whose last message has ``role`` / the others."""
    ok = F.col("last_role") == role
    return lay.where(ok), lay.where(~ok)


def fits(lay: DataFrame, max_length: int) -> DataFrame:
    """B2: keep conversations whose full rendering has at most ``max_length`` tokens."""
    return lay.where(F.col("full_len") <= max_length)


def _tail_pieces(rendered: DataFrame, lay: DataFrame, key: str, order: str,
                 max_length: int | None, ignore, mask: bool, template: ChatTemplate) -> DataFrame:
    cut = (F.greatest(F.lit(0), F.col("full_len") - max_length) if max_length
           else F.lit(0)).cast("long")
    t = rendered.select(key, order, "toks").join(lay, [key, order])
    t = t.where(F.col("start") + F.col("n") > cut)
    ps = F.greatest(F.col("start"), cut)
    piece = F.slice("toks", (ps - F.col("start") + 1).cast("int"),
                    (F.col("start") + F.col("n") - ps).cast("int"))
    cols = [key, ps.alias("pos"), piece.alias("ids")]
    if mask:
        # the first (prompt_len - ps) tokens of the piece are prompt: masked
        n_masked = F.least(F.greatest(F.col("prompt_len") - ps, F.lit(0)), F.size(piece)).cast("int")
        # the label takes the ids' type: -100 for integer ids, "-100" for string tokens
        kind = t.schema["toks"].dataType.elementType
        ignore = F.lit(ignore).cast(kind)
        cols.append(F.concat(F.array_repeat(ignore, n_masked),
                             F.slice(piece, n_masked + 1, F.size(piece) - n_masked))
                    .alias("labels"))
    pieces = t.select(*cols)
    conv = lay.where(F.col(order) == F.col("last_turn")).where(cut == 0)
    bos = [key, F.lit(0).cast("long").alias("pos"), F.array(F.lit(template.bos_id)).alias("ids")]
    if mask:
        bos.append(F.array(ignore).alias("labels"))
    bos_rows = conv.select(*bos)
    return pieces.unionByName(bos_rows.select(*pieces.columns))


def _assemble(pieces: DataFrame, key: str, mask: bool) -> DataFrame:
    fields = ["pos", "ids"] + (["labels"] if mask else [])
    g = pieces.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("__p"))
    out = [key, F.flatten(F.col("__p.ids")).alias("ids")]
    if mask:
        out.append(F.flatten(F.col("__p.labels")).alias("labels"))
    return g.select(*out)


def render_chat(turns: DataFrame, max_length: int | None = None, key: str = "conv_id",
                order: str = "turn", template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """E2 (+E6): (key, ids, full_len) = the last ``max_length`` tokens of each rendering.

    Without ``max_length`` the whole rendering is collected; use that only for bounded
    conversations.
    """
    r = rendered_table(turns, key, order, template)
    # the narrow per-turn layout is used three times below: write it once
    lay = materialize(layout(r, key, order, template), "layout")
    out = _assemble(_tail_pieces(r, lay, key, order, max_length, None, False, template), key, False)
    return out.join(conversation_stats(lay, key, order).select(key, "full_len", "prompt_len",
                                                         "last_role"), key)


def sft_examples(turns: DataFrame, max_length: int, key: str = "conv_id", order: str = "turn",
                 ignore=IGNORE_INDEX, require_assistant: bool = True, fits_only: bool = False,
                 template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """E2-E7 (+B2, B7): one supervised example per conversation.

    labels = ``ignore`` for every prompt token, response tokens kept (only the last
    assistant turn is supervised); keep the last ``max_length`` tokens of ids and labels;
    then input = ids[:-1], target = labels[1:].
    Output: (key, input_ids, target_ids, full_len, prompt_len).
    """
    r = rendered_table(turns, key, order, template)
    # the narrow per-turn layout is used three times below: write it once
    lay = materialize(layout(r, key, order, template), "layout")
    if require_assistant:
        lay, _ = require_last_role(lay)
    if fits_only:
        lay = fits(lay, max_length)
    ex = _assemble(_tail_pieces(r, lay, key, order, max_length, ignore, True, template), key, True)
    return ex.join(conversation_stats(lay, key, order).select(key, "full_len", "prompt_len"), key).select(
        key, A.drop_last("ids").alias("input_ids"), A.drop_first("labels").alias("target_ids"),
        "full_len", "prompt_len")


def sft_examples_nested(df: DataFrame, max_length: int, key: str = "conv_id",
                        messages: str = "messages", ignore=IGNORE_INDEX, fits_only: bool = False,
                        template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """E2-E7 (+B2, B7) for nested ``messages``: the same examples row by row, without a shuffle, so it
    also runs on a stream. A conversation here already is one record."""
    turns = F.transform(messages, lambda m: template.turn(m["role"], m["content"]))
    ok = df.where(F.size(messages) > 0).where(F.element_at(messages, -1)["role"] == "assistant")
    full = F.concat(F.array(F.lit(template.bos_id)), F.flatten(turns))
    t = ok.select(key, full.alias("__f"), F.size(F.element_at(turns, -1)).alias("__n")).withColumn(
        "full_len", F.size("__f").cast("long"))
    t = t.withColumn("prompt_len", F.col("full_len") - F.col("__n") + template.header_len)
    if fits_only:
        t = t.where(F.col("full_len") <= max_length)
    masked = F.array_repeat(F.lit(ignore).cast(t.schema["__f"].dataType.elementType),
                            F.col("prompt_len").cast("int"))
    labels = F.concat(masked, F.slice("__f", F.size(masked) + 1, F.size("__f")))
    return t.select(key, A.drop_last(A.left_truncate("__f", max_length)).alias("input_ids"),
                    A.drop_first(A.left_truncate(labels, max_length)).alias("target_ids"),
                    "full_len", "prompt_len")


def resolve_pad_id(pad_id, eos_id):
    """Pad id, else EOS id (works on Python values and Columns)."""
    if isinstance(pad_id, Column) or isinstance(eos_id, Column):
        p = pad_id if isinstance(pad_id, Column) else F.lit(pad_id)
        e = eos_id if isinstance(eos_id, Column) else F.lit(eos_id)
        return F.coalesce(p, e)
    return eos_id if pad_id is None else pad_id


def pad_static(df: DataFrame, width: int, pads: dict[str, object]) -> DataFrame:
    """E9/F2 static: right-pad every listed column to ``width``; longer rows raise."""
    out = df
    for col, pad in pads.items():
        too_long = F.size(col) > width
        out = out.withColumn(col, F.when(too_long, F.raise_error(
            F.lit(f"{col} longer than static width {width}"))).otherwise(
            A.pad_right(col, width, pad)))
    return out


def pad_dynamic(df: DataFrame, pads: dict[str, object], batch: str = "batch_id",
                width_col: str = "width", length_of: str | None = None) -> DataFrame:
    """E8/F2 dynamic: right-pad to the longest row of the batch.

    The window is partitioned by batch id, so each group holds one batch (bounded).
    """
    first = length_of or next(iter(pads))
    w = Window.partitionBy(batch)
    out = df.withColumn(width_col, F.max(F.size(first)).over(w))
    for col, pad in pads.items():
        out = out.withColumn(col, A.pad_right(col, F.col(width_col), pad))
    return out


def pad_for_generation(df: DataFrame, ids: str, pad, batch: str = "batch_id",
                       width_col: str = "width") -> DataFrame:
    """Left-pad prompts to the longest of their batch, so that every last token stands at the right
    edge, with ``attention_mask`` (0 on pads) and ``position_ids`` (0 on pads, then counted from 0).

    A null sequence counts as empty: pads only, mask all 0. The batch's width is an aggregate joined
    back, since a batch column may hold any number of rows; rows of a null batch share a batch.
    """
    a = F.coalesce(F.col(ids), F.array().cast(df.schema[ids].dataType))
    widths = df.groupBy(F.col(batch).alias("__batch")).agg(F.max(F.size(a)).alias(width_col))
    rows = df.withColumn(ids, a).join(widths, F.col(batch).eqNullSafe(F.col("__batch"))).drop("__batch")
    n, width = F.size(ids), F.col(width_col)
    places = F.transform(F.col(ids), lambda _, i: i)
    return (rows.withColumn("attention_mask", A.pad_left(A.repeat(1, n), width, 0))
            .withColumn("position_ids", A.pad_left(places, width, 0))
            .withColumn(ids, A.pad_left(ids, width, pad)))


def resolve_template(models: DataFrame, templates: DataFrame, model: str = "model",
                     sibling_suffix: str = "-Instruct") -> DataFrame:
    """A model without a template borrows the template of ``model + suffix``."""
    own = templates.select(F.col(model).alias("__m1"), F.col("template").alias("__own"))
    sib = templates.select(F.col(model).alias("__m2"), F.col("template").alias("__sib"))
    return (models.join(own, models[model] == own["__m1"], "left")
            .join(sib, F.concat(models[model], F.lit(sibling_suffix)) == sib["__m2"], "left")
            .select(*[models[c] for c in models.columns],
                    F.coalesce("__own", "__sib").alias("template")))


def format_prompt(df: DataFrame, text: str = "prompt", out: str = "prompt_ids",
                  template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """One user message + the assistant header (generation prompt), row-local."""
    ids = F.concat(F.array(F.lit(template.bos_id)), template.turn(F.lit("user"), F.col(text)),
                   template.header(F.lit("assistant")))
    return df.withColumn(out, ids)


def extract_response(df: DataFrame, generated: str, prompt_len: str | Column,
                     stops: Sequence = (EOS_TEXT, EOT_TEXT), drop: Sequence = (),
                     out: str = "response") -> DataFrame:
    """Tokens after the prompt, cut before the first EOS/EOT, specials dropped."""
    pl = F.col(prompt_len) if isinstance(prompt_len, str) else prompt_len
    new = F.slice(generated, (pl + 1).cast("int"), F.greatest(F.lit(0), F.size(generated) - pl))
    cut = A.cut_at_stop(new, list(stops), keep_stop=False)
    dropped = F.filter(cut, lambda x: ~x.isin(*drop)) if drop else cut
    return df.withColumn(out, dropped)


def last_response(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                  role: str = "assistant", template: ChatTemplate = DEFAULT_TEMPLATE,
                  out: str = "response") -> DataFrame:
    """E13 for rendered conversations: the tokens of each conversation's last turn, where ``role``
    spoke it. The answer is that turn's own row, so nothing is rendered, cut or collected.
    Specials written inside the text are dropped."""
    last = turns.groupBy(key).agg(F.max_by(F.struct("role", "text"), order).alias("m")).where(
        F.col("m.role") == role)
    marks = [F.lit(template.special(s)) for s in template.specials]
    return last.select(key, F.filter(template.tokens(F.col("m.text")),
                                     lambda t: ~t.isin(*marks)).alias(out))


def supervised_token_stats(examples: DataFrame, by: Sequence[str], target: str = "target_ids",
                           ignore=IGNORE_INDEX) -> DataFrame:
    """Supervised (non-ignored) and total target positions per group."""
    sup = A.count_not(target, ignore)
    return examples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_examples"), F.sum(sup).cast("long").alias("supervised_tokens"),
        F.sum(F.size(target)).cast("long").alias("target_tokens"))


def preview(col: str | Column, n: int = 70) -> Column:
    """The first ``n`` characters for display."""
    return F.substring(F.col(col) if isinstance(col, str) else col, 1, n)
