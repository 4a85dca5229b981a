"""Column expressions for text: line splitting, blank tests, tokenizers.

All built-in Spark SQL expressions (JVM side, whole-stage codegen friendly).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.config import BLANK_CLASS, BYTE_VOCAB, EOS_TEXT, SPLITLINES_PATTERN, WORD_PATTERN


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_lines(text: str | Column) -> Column:
    """Python ``str.splitlines()``: split on every line boundary, drop one trailing empty piece."""
    parts = F.split(_c(text), SPLITLINES_PATTERN, -1)
    n = F.size(parts)
    return F.when(_c(text) == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, n - 1)).otherwise(parts))


def corpus_lines(text: str | Column, is_last: Column) -> Column:
    """The lines a source row contributes to the corpus "rows joined with a line feed, then split".

    The joiner ends the last piece of every row but the corpus' last one, so that piece is a line
    even when it is empty: an empty row is a blank line, a trailing line end adds one. After a
    lone carriage return the joiner completes one "\\r\\n" boundary instead of adding another.
    """
    text = F.coalesce(_c(text), F.lit(""))
    parts = F.split(text, SPLITLINES_PATTERN, -1)
    drop = (F.element_at(parts, -1) == "") & (is_last | text.endswith("\r"))
    return F.slice(parts, 1, F.size(parts) - drop.cast("int"))


def is_blank(text: str | Column) -> Column:
    """True when Python ``text.strip()`` would be empty."""
    return _c(text).rlike("\\A[" + BLANK_CLASS + "]*\\z")


def special_pattern(specials: Sequence[str]) -> str:
    return "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))


def word_pattern(specials: Sequence[str] = (EOS_TEXT,)) -> str:
    """Word pattern with the special literals tried first, so each becomes one token."""
    if not specials:
        return WORD_PATTERN
    return special_pattern(specials) + "|" + WORD_PATTERN


def word_tokens(text: str | Column, specials: Sequence[str] = (EOS_TEXT,)) -> Column:
    """Text -> array<string> of word tokens (specials kept whole)."""
    return F.regexp_extract_all(_c(text), F.lit(word_pattern(specials)), 0)


def utf8_byte_ids(text: str | Column) -> Column:
    """Text -> array<int> of its UTF-8 bytes (0-255).

    The UTF-8 bytes are re-read as ISO-8859-1, which maps byte b to the character U+00b,
    so splitting into characters and taking each code point yields the bytes.
    """
    latin = F.decode(F.encode(_c(text), "UTF-8"), "ISO-8859-1")
    chars = F.split(latin, "(?s)(?!$)")
    return F.when(F.length(latin) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(chars, lambda ch: F.ascii(ch)))


def byte_tokens(text: str | Column, specials: Sequence[str] = (EOS_TEXT,)) -> Column:
    """Text -> array<int>: UTF-8 bytes, each special literal -> one id (256 + index)."""
    if not specials:
        return utf8_byte_ids(text)
    pieces = F.split(_c(text), special_pattern(specials), -1)
    found = F.regexp_extract_all(_c(text), F.lit(special_pattern(specials)), 0)
    special_ids = F.transform(found, lambda s: _special_index(s, specials))

    def piece_ids(p: Column, i: Column) -> Column:
        head = F.when(i > 0, F.array(F.element_at(special_ids, i))).otherwise(
            F.array().cast("array<int>"))
        return F.concat(head, utf8_byte_ids(p))

    return F.flatten(F.transform(pieces, piece_ids))


def _special_index(s: Column, specials: Sequence[str]) -> Column:
    expr = F.lit(None).cast("int")
    for i, sp in enumerate(specials):
        expr = F.when(s == sp, F.lit(BYTE_VOCAB + i)).otherwise(expr)
    return expr


def decode_bytes(ids: str | Column, specials: Sequence[str] = (EOS_TEXT,)) -> Column:
    """array<int> byte ids -> text. Specials decode to their literal; ``[]`` -> ``""``."""
    def char_of(x: Column) -> Column:
        out = F.chr(x)  # byte b -> U+00b, undone by the ISO-8859-1 encode below
        for i, sp in enumerate(specials):
            out = F.when(x == BYTE_VOCAB + i, F.lit(sp)).otherwise(out)
        return out

    latin = F.array_join(F.transform(_c(ids), char_of), "")
    return F.decode(F.encode(latin, "ISO-8859-1"), "UTF-8")
