"""UTF-8 bytes as token ids and back, one vectorised pass over an Arrow batch.

A string column in Arrow already is its bytes plus offsets, so encoding is a cast and decoding the
reverse; of rows that hold a special only the specials are touched one by one. An id takes four
bytes, so :func:`tokenmill.session.bounded_batches` bounds a batch by its bytes, not only by its rows.
The column expressions in ``functions.text`` do the same inside the JVM for short pieces.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.config import BYTE_VOCAB, EOS_TEXT


def _encode(texts: pa.Array, specials: Sequence[str]) -> pa.Array:
    null = texts.is_null()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = (np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and data.size
            else np.zeros(0, np.uint8))
    off = off - off[0]
    values = data.astype(np.int32)
    has = np.zeros(len(texts), bool)
    for s in specials:
        has |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    if has.any():  # a special's first byte becomes its id, the others go
        raw = {s.encode(): BYTE_VOCAB + i for i, s in enumerate(specials)}
        find = re.compile(b"|".join(re.escape(s) for s in sorted(raw, key=len, reverse=True))).finditer
        keep, gone = np.ones(len(data), bool), np.zeros(len(texts), np.int64)
        for r in np.flatnonzero(has):
            lo = off[r]
            for m in find(data[lo:off[r + 1]].tobytes()):
                i, j = lo + m.start(), lo + m.end()
                values[i], keep[i + 1:j] = raw[m.group()], False
                gone[r] += j - i - 1
        values, off = values[keep], off - np.r_[0, np.cumsum(gone)]
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values), mask=null)


def _decode(ids: pa.Array, specials: Sequence[str]) -> pa.Array:
    raw = [s.encode() for s in specials]
    rows = []
    for row in ids:
        if not row.is_valid:
            rows.append(None)
            continue
        v = row.values.to_numpy(zero_copy_only=False)
        if len(v) and v.max() >= BYTE_VOCAB:
            rows.append(b"".join(bytes([i]) if i < BYTE_VOCAB else raw[i - BYTE_VOCAB]
                                 for i in v.tolist()).decode("utf-8", "replace"))
        else:
            rows.append(v.astype(np.uint8).tobytes().decode("utf-8", "replace"))
    return pa.array(rows, pa.string())


def encode_bytes(text: str, specials: Sequence[str] = (EOS_TEXT,)) -> Column:
    names = tuple(specials)

    def run(texts: pa.Array) -> pa.Array:
        return _encode(texts, names)
    return F.arrow_udf(run, "array<int>")(text)


def decode_bytes(ids: str, specials: Sequence[str] = (EOS_TEXT,)) -> Column:
    names = tuple(specials)

    def run(rows: pa.Array) -> pa.Array:
        return _decode(rows, names)
    return F.arrow_udf(run, "string")(ids)
