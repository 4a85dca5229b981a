"""Line explode, heading segmentation and blank filtering.

Segmentation rule: a line starting with " = " but not " = = " opens a new document;
lines before the first heading form their own document; a document is its lines
joined with "\\n"; documents whose ``strip()`` is empty are dropped.

Segment ids are computed without a global window: the number of headings in every
source row goes through the range-partitioned prefix sum (one narrow row per source
row), and the running count inside a row is a window partitioned by that row (bounded
by the row, which is already one record).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT, HEADING_PREFIX, SUBHEADING_PREFIX
from tokenmill.functions.text import corpus_lines, is_blank, word_tokens
from tokenmill.plans.prefix import global_offsets, grouped_offsets, materialize


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """B1: keep rows whose text is not empty after Python-style ``strip()``."""
    return df.where(~is_blank(col))


def explode_lines(df: DataFrame, key: Sequence[str] | str = "doc_id", text: str = "text",
                  out: str = "line") -> DataFrame:
    """The lines of the corpus made of the rows in ``key`` order (a unique key), joined with a
    line feed and split at every line boundary. One row per line, ``line_no`` from 0 in its
    source row; a null text is an empty row."""
    key = [key] if isinstance(key, str) else list(key)
    last = df.agg(F.max(F.struct(*key)).alias("k")).first()["k"]  # one key
    is_last = F.lit(True)
    for c in key:
        is_last = is_last & F.col(c).eqNullSafe(F.lit(last[c] if last is not None else None))
    return df.select(*key, F.posexplode(corpus_lines(text, is_last)).alias("line_no", out))


def is_heading(line: str | Column) -> Column:
    c = F.col(line) if isinstance(line, str) else line
    return c.startswith(HEADING_PREFIX) & ~c.startswith(SUBHEADING_PREFIX)


def segment_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """C2 (line form): every line with its ``seg_id`` (0 = lines before the first heading).

    Input: source rows (key, text) in ``key`` order. Output: (key, line_no, line, seg_id).
    Lines are split and flagged once and written as a table; the per-row heading counts
    (narrow columns) feed the prefix sum.
    """
    lines = materialize(
        explode_lines(df, key, text).withColumn("__s", is_heading("line").cast("int")), "lines")
    per_row = lines.groupBy(key).agg(F.sum("__s").cast("long").alias("__h"))
    before = global_offsets(per_row, [key], "__h", out="__heads_before").select(
        key, "__heads_before")
    run = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return (lines.withColumn("__run", F.sum("__s").over(run))
            .join(before, key)
            .select(key, "line_no", "line",
                    (F.col("__heads_before") + F.col("__run")).alias("seg_id")))


def segment_by_heading(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """C2 + B1: documents (seg_id, text) built from the line corpus, blanks dropped."""
    lines = segment_lines(df, key, text)
    docs = lines.groupBy("seg_id").agg(
        F.sort_array(F.collect_list(F.struct(key, "line_no", "line"))).alias("__l"),
        F.max((~is_blank("line")).cast("int")).alias("__nonblank"))
    return (docs.where(F.col("__nonblank") == 1)
            .select("seg_id", F.array_join(F.col("__l.line"), "\n")
                    .alias("text")))


PART_BYTES = 64 << 10


def segment_parts(df: DataFrame, key: str = "doc_id", text: str = "text",
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """C2 + B1 with documents as bounded parts: (seg_id, part_no, text), no row above ``part_bytes``.

    The parts of a document, joined in order with nothing between, are the text that
    :func:`segment_by_heading` gives. Lines longer than a part are cut at code points; where a part
    ends follows from the running byte count inside the document (a per-group running sum over
    range partitions), so a document of any length never meets in one task. Whether a document is
    blank is a flag a document, joined back by its id alone.
    """
    if part_bytes < 8:
        raise ValueError("part_bytes must be at least 8")
    half, width = part_bytes // 2, part_bytes // 8  # a code point has at most four bytes
    lines = materialize(segment_lines(df, key, text), "segment_lines")
    facts = lines.groupBy("seg_id").agg(  # one narrow row a document
        F.max(F.struct(F.col(key).alias("k"), F.col("line_no").alias("l"))).alias("last"),
        F.max((~is_blank("line")).cast("int")).alias("nonblank")).where("nonblank = 1")
    kept = lines.join(facts.select("seg_id", "last"), "seg_id")
    is_last = (F.col(key) == F.col("last.k")) & (F.col("line_no") == F.col("last.l"))
    ended = kept.select("seg_id", key, "line_no", F.when(is_last, F.col("line")).otherwise(
        F.concat("line", F.lit("\n"))).alias("line"))
    starts = F.sequence(F.lit(0), F.greatest(F.length("line") - 1, F.lit(0)), F.lit(width))
    pieces = ended.select("seg_id", key, "line_no", F.posexplode(F.transform(
        starts, lambda i: F.substring(F.col("line"), i + 1, F.lit(width)))).alias("piece_no", "piece"))
    pieces = pieces.withColumn("size", F.octet_length("piece").cast("long"))
    at = grouped_offsets(pieces, ["seg_id"], [key, "line_no", "piece_no"], "size", out="at")
    # a part starts less than half a part's bytes before its last piece, which is at most the other half
    return at.groupBy("seg_id", F.floor(F.col("at") / half).alias("part_no")).agg(
        F.sort_array(F.collect_list(F.struct(key, "line_no", "piece_no", "piece"))).alias("p")).select(
        "seg_id", "part_no", F.array_join("p.piece", "").alias("text"))


def heading_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Line-corpus fixture: doc_id % 3 == 0 gets a " = Doc <id> = " heading, == 1 gets a
    " = = Part = = " sub-heading, each as an extra first line of the row; some rows end in a line
    feed (% 7 == 0), a carriage return (% 7 == 1) or are empty (% 11 == 0)."""
    tail = (F.when(F.col(key) % 7 == 0, F.concat(F.col(text), F.lit("\n")))
            .when(F.col(key) % 7 == 1, F.concat(F.col(text), F.lit("\r"))).otherwise(F.col(text)))
    docs = docs.select(key, F.when(F.col(key) % 11 == 0, F.lit("")).otherwise(tail).alias(text))
    head = (F.when(F.col(key) % 3 == 0, F.concat(F.lit(" = Doc "), F.col(key).cast("string"),
                                                  F.lit(" = ")))
            .when(F.col(key) % 3 == 1, F.lit(" = = Part = = ")))
    return docs.select(key, F.when(head.isNull() | (F.col(key) % 11 == 0), F.col(text))
                       .otherwise(F.concat(head, F.lit("\n"), F.col(text))).alias(text))


def segment_tokens(lines: DataFrame, key: str = "doc_id", eos: str = EOS_TEXT,
                   specials=(EOS_TEXT,)) -> DataFrame:
    """C2 + B1 + C3 + C10 without building document strings: word tokens per line of
    each non-blank segment, with EOS after the segment's last line.

    Word tokens never contain whitespace, so the tokens of a document joined with
    "\\n" are exactly its lines' tokens in order. Per-segment facts (last line,
    non-blank) are bounded aggregates. Output (seg_id, key, line_no, tokens) is ordered
    by (seg_id, key, line_no) for :func:`tokenmill.operators.windows.stream_offsets`.
    """
    last = F.max(F.struct(F.col(key), F.col("line_no"))).alias("__last")
    facts = lines.groupBy("seg_id").agg(
        last, F.max((~is_blank("line")).cast("int")).alias("__nonblank"))
    kept = lines.join(facts.where(F.col("__nonblank") == 1), "seg_id")
    is_last = (F.col(key) == F.col("__last")[key]) & (F.col("line_no") == F.col("__last.line_no"))
    toks = word_tokens(F.col("line"), specials)
    return kept.select(
        "seg_id", key, "line_no",
        F.when(is_last, F.concat(toks, F.array(F.lit(eos)))).otherwise(toks).alias("tokens"))
