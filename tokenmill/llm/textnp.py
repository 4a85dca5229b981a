"""Vectorised text helpers shared by the operators of this subpackage.

An Arrow string column already is one UTF-8 buffer plus offsets, so word splitting, word
hashing and shingling run as numpy passes over that buffer: no Python object per word.
Batches are cut into blocks of a few MB, which bounds the memory of a task whatever the
length of the rows; one row is never cut, so results never depend on the block size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tokenmill.functions.hashing import _B, FOLD, hash_spans, mix64  # noqa: F401
from tokenmill.session import bounded_batches

BLOCK_BYTES = 4 << 20
_U = np.uint64

# byte classes
_bytes = np.arange(256)
SPACE = np.isin(_bytes, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) | (
    (_bytes >= 97) & (_bytes <= 122)) | (_bytes == 95) | (_bytes >= 128)
_BIG = BLOCK_BYTES  # rows above this size travel in a block of their own


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) blocks of at most ``limit`` text bytes (or one row).

    A null text counts as empty. ``bytes[offsets[i]:offsets[i+1]]`` is row i's UTF-8 text.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(batch.schema.get_field_index(text)), "")
        if pa.types.is_large_string(col.type):
            width = np.int64
        else:
            col, width = col.cast(pa.string()), np.int32
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        _, off_buf, data_buf = col.buffers()
        off = np.frombuffer(off_buf, width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = (np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size
                else np.zeros(0, np.uint8))
        lo, n = 0, len(col)
        while lo < n:
            hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the maximal runs of ``member`` bytes; a run never crosses rows."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = member[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    return (np.flatnonzero(inside & (~before | cut[:-1])),
            np.flatnonzero(inside & (~after | cut[1:])) + 1)


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, fold: bool = True
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``member`` bytes: (starts, ends, hash, first word of each row)."""
    s, e = spans(data, offsets, member)
    return s, e, hash_spans(data, s, e, fold), np.searchsorted(s, offsets)


def shingles(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words, with the row of each.

    A row of 1 to k-1 words has one shingle, made of all of them; a row without words none.
    """
    n_rows = len(first) - 1
    counts = np.diff(first)
    row_of_word = np.repeat(np.arange(n_rows), counts)
    n = len(h)
    if n >= k:
        x = np.full(n - k + 1, 0x51ED270B, _U)
        for j in range(k):
            x = mix64(x * _B + h[j:n - k + 1 + j])
        ok = row_of_word[:n - k + 1] == row_of_word[k - 1:]
        sh, row = x[ok], row_of_word[:n - k + 1][ok]
    else:
        sh, row = np.zeros(0, _U), np.zeros(0, np.int64)
    for c in range(1, k):
        short = np.flatnonzero(counts == c)
        if len(short):
            x = np.full(len(short), 0x1CE5 + c, _U)
            for j in range(c):
                x = mix64(x * _B + h[first[short] + j])
            sh, row = np.concatenate([sh, x]), np.concatenate([row, short])
    return sh, row


def collected(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a bounded result as arrays, by Arrow: no Python object for each row. A list
    column becomes its values end to end."""
    table = df.toArrow()
    out = {}
    for name in table.column_names:
        col = table.column(name).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
        out[name] = (col.flatten() if pa.types.is_list(col.type) else col).to_numpy(zero_copy_only=False)
    return out


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))
