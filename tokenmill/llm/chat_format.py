r"""Chat formatting with Spark expressions only: turns collected, sorted, merged and joined.

A conversation's turn structs are collected and sorted by (turn, role, text); an array aggregation
merges adjacent turns of one role into a block; the blocks become one string::

    ### user: first text</turn>second text of the same role</turn>
    ### assistant: answer</turn>

A block has one header, every text ends in ``</turn>`` and blocks are joined by a line feed. Inside
texts and roles ``\`` is written ``\\``, ``##`` as ``#\#`` and ``</turn>`` as ``<\/turn>`` (and ``: ``
as ``:\ `` in roles), so an escaped text never holds ``###`` or ``</turn>``: splitting at the literal
marker and dropping one backslash before each escaped character gives back exactly the input.

``loss_spans`` are code point ranges of ``formatted`` that cover each assistant text, without header
and marker.

A conversation above ``PART_WEIGHT`` (bytes plus ``TURN_WEIGHT`` a turn) is cut at turn bounds into
parts by a running sum over range partitions, so no group holds more than ``PART_WEIGHT`` and one turn; its
parts, joined in order of ``part``, are the conversation. The part that follows is told the last role
before it, so a block that spans parts has its header once.

Defined cases: null texts and null roles are empty; a null ``conv_id`` is a conversation of its own;
null turns come first; rows of one turn number go by role, then text; repeated rows are all
kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmill.llm.textnp import map_arrow
from tokenmill.plans.prefix import grouped_offsets, materialize

HEAD, COLON, END = "### ", ": ", "</turn>"
LOSS_ROLE = "assistant"
PART_WEIGHT = 1 << 20
TURN_WEIGHT = 2048  # so a part holds at most 513 turns
MAX_BROADCAST_CUT = 100_000  # ids of cut conversations that travel by broadcast

_KEY = ["cid", "nul"]
_MERGED = "array<struct<role:string,texts:array<string>>>"
_TURNS = "array<struct<role:string,text:string>>"
_SPANS = "array<struct<start:bigint,end:bigint>>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("##"), F.lit("#\\#"))
    return F.replace(out, F.lit(END), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(COLON), F.lit(":\\ "))


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")),
                  F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _merge(turns: Column) -> Column:
    """Adjacent turns of one role as one block (role, texts), in order."""
    def step(acc: Column, t: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.struct(last["role"].alias("role"),
                          F.concat(last["texts"], F.array(t["text"])).alias("texts"))
        new = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        return F.when((F.size(acc) > 0) & (last["role"] == t["role"]),
                      F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))
                      ).otherwise(F.concat(acc, F.array(new))).cast(_MERGED)
    return F.aggregate(turns, _empty(_MERGED), step)


def _pieces(blocks: Column, part: Column, before: Column) -> Column:
    """(head, role, text) of every turn, escaped; only the first of a block has a head."""
    def piece(b: Column, i: Column, t: Column, j: Column) -> Column:
        first = (i == 0) & (part == 0)
        goes_on = (i == 0) & (part > 0) & (b["role"] == before)
        head = F.concat(F.when(first, F.lit("")).otherwise(F.lit("\n")), F.lit(HEAD),
                        escape_role(b["role"]), F.lit(COLON))
        return F.struct(F.when((j > 0) | goes_on, F.lit("")).otherwise(head).alias("head"),
                        b["role"].alias("role"), escape(t).alias("text"))
    return F.flatten(F.transform(blocks, lambda b, i: F.transform(
        b["texts"], lambda t, j: piece(b, i, t, j))))


def _loss_spans(pieces: Column) -> Column:
    start = F.struct(F.lit(0).cast("bigint").alias("pos"), _empty(_SPANS).alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        lo = acc["pos"] + F.length(p["head"])
        hi = lo + F.length(p["text"])
        span = F.array(F.struct(lo.alias("start"), hi.alias("end")))
        return F.struct((hi + len(END)).alias("pos"),
                        F.when(p["role"] == LOSS_ROLE, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).cast(_SPANS).alias("spans"))
    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def _format_parts(turns: DataFrame) -> DataFrame:
    """(cid, nul, part, before, turn, role, text) to one formatted row a part."""
    grouped = turns.groupBy(*_KEY, "part").agg(
        F.max("before").alias("before"),
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    pieces = grouped.select(*_KEY, "part", _pieces(_merge(F.col("turns")), F.col("part"),
                                                   F.col("before")).alias("pieces"))
    return pieces.select(
        F.when(~F.col("nul"), F.col("cid")).alias("conv_id"), "part",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(END))),
                     "").alias("formatted"),
        _loss_spans(F.col("pieces")).alias("loss_spans"))


def format_conversations(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, cut, formatted, loss_spans): ``cut`` marks conversations of several parts."""
    turns = conversations.select(
        F.coalesce(F.col(id_col), F.lit(0)).cast("bigint").alias("cid"),
        F.col(id_col).isNull().alias("nul"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    weight = F.octet_length("text") + F.octet_length("role") + F.lit(TURN_WEIGHT)
    cut = materialize(turns.groupBy(*_KEY).agg(F.sum(weight).alias("w"))
                      .where(F.col("w") > PART_WEIGHT).select(*_KEY), "cut_conversations")
    n_cut = cut.count()
    whole = turns if not n_cut else turns.join(
        F.broadcast(cut) if n_cut <= MAX_BROADCAST_CUT else cut, _KEY, "left_anti")
    out = _format_parts(whole.withColumn("part", F.lit(0).cast("bigint")).withColumn(
        "before", F.lit(None).cast("string"))).withColumn("cut", F.lit(False))
    if n_cut:
        long = turns.join(F.broadcast(cut) if n_cut <= MAX_BROADCAST_CUT else cut, _KEY, "left_semi")
        at = grouped_offsets(long.withColumn("w", weight.cast("bigint")), _KEY,
                             ["turn", "role", "text"], "w", out="at")
        numbered = at.withColumn("part", F.floor(F.col("at") / PART_WEIGHT)).drop("at", "w")
        # a turn of several parts' weight leaves gaps between part numbers: lag reads the part before
        last = numbered.groupBy(*_KEY, "part").agg(F.max(F.struct("turn", "role"))["role"].alias("role"))
        before = last.select(*_KEY, "part", F.lag("role").over(
            Window.partitionBy(*_KEY).orderBy("part")).alias("before"))
        out = out.unionByName(_format_parts(numbered.join(before, [*_KEY, "part"]))
                              .withColumn("cut", F.lit(True)))
    return out.select("conv_id", "part", "cut", "formatted", "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) parsed from ``formatted`` and ``loss_text`` from its loss spans.

    A part of a cut conversation may begin inside a block; the roles of its first turns are null.
    """
    segments = F.split("formatted", END, -1)
    start = F.struct(F.lit(None).cast("string").alias("role"), _empty(_TURNS).alias("turns"))

    def step(acc: Column, s: Column) -> Column:
        body = F.when(F.startswith(s, F.lit("\n" + HEAD)), F.substr(s, F.lit(len(HEAD) + 2))).when(
            F.startswith(s, F.lit(HEAD)), F.substr(s, F.lit(len(HEAD) + 1)))
        at = F.instr(body, COLON)
        role = F.when(body.isNull(), acc["role"]).otherwise(unescape(F.substr(body, F.lit(1), at - 1)))
        text = unescape(F.when(body.isNull(), s).otherwise(F.substr(body, at + 2)))
        turn = F.array(F.struct(role.alias("role"), text.alias("text")))
        return F.struct(role.alias("role"), F.concat(acc["turns"], turn).cast(_TURNS).alias("turns"))

    turns = F.aggregate(F.slice(segments, F.lit(1), F.size(segments) - 1), start, step,
                        lambda acc: acc["turns"])
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)


_DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
           "loss_sha256 string, formatted_chars bigint")


def _digest_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose parts follow each other; holds one part at a time."""
    import hashlib
    state = None

    def close(s):
        return pa.RecordBatch.from_pylist(
            [{"conv_id": s["id"], "n_turns": s["n"], "turns_sha256": s["t"].hexdigest(),
              "loss_chars": s["loss"], "loss_sha256": s["l"].hexdigest(), "formatted_chars": s["f"]}],
            schema=pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                              ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if state is None or state["id"] != row["conv_id"]:
                if state is not None:
                    yield close(state)
                state = {"id": row["conv_id"], "n": 0, "t": hashlib.sha256(), "loss": 0,
                         "l": hashlib.sha256(), "f": 0, "role": ""}
            for t in row["turns"]:
                state["role"] = state["role"] if t["role"] is None else t["role"]
                state["t"].update(f"{state['role']}\n{t['text']}\n".encode())
            state["n"] += len(row["turns"])
            state["l"].update(row["loss_text"].encode())
            state["loss"] += len(row["loss_text"])
            state["f"] += row["formatted_chars"]
    if state is not None:
        yield close(state)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back of each conversation, as counts and SHA-256 digests.

    A digest is sequential: the parts of a cut conversation pass one task in order, one at a time.
    """
    back = read_back(formatted).withColumn("formatted_chars", F.length("formatted").cast("bigint"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = back.where(~F.col("cut")).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
    cut = back.where("cut").select("conv_id", "part", "turns", "loss_text", "formatted_chars")
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "part").drop("part")
    return whole.unionByName(map_arrow(cut, _digest_cut, _DIGEST))


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    """The table's rows and conversation -7, whose texts hold the template's own control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    extra = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: counts and digests read back from every formatted conversation."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return digests(format_conversations(with_control_conversation(table)))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') || '</turn>'
    AS body, CASE WHEN before = role THEN '' ELSE CASE WHEN i > 1 THEN chr(10) ELSE '' END || '### ' ||
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ': ', ':\ ')
    || ': ' END AS head FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
