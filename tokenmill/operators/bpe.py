"""Byte-pair encoding with a rank table (C3, C4, C11 ``bpe``), via an Arrow UDF on the text alone.

Ranks map byte strings to ids; a merge is allowed when its result has a rank, lower ranks merge
first, and every single byte has one. Text is cut by the published split pattern of byte-level
vocabularies, whose pieces make up the text again, so decoding returns it exactly. Specials become ids
of their own (``len(ranks) + index``).

Spark passes only the text column to Python; the other columns stay in the JVM. The rank table is
broadcast once per executor; its size in bytes is checked against ``MAX_RANK_BYTES`` first. A Python
worker keeps the ids of the pieces it has met from batch to batch and task to task (at most twice
``MAX_CACHED_PIECES``), as bytes that are joined to a row's ids; ids become text by table lookups.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT
from tokenmill.session import bounded_batches

MAX_RANK_BYTES = 256 << 20  # beyond this a rank table is refused rather than broadcast
MAX_CACHED_PIECES = 200_000
LONG_PIECE = 256  # bytes; longer pieces are merged by a heap and not kept
NO_RANK = 1 << 62

# Fixed value: the published pre-token pattern of byte-level BPE vocabularies.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def rank_table(ranks: DataFrame) -> dict[bytes, int]:
    """(token binary, rank int) as a dictionary, behind the size check."""
    size = ranks.agg(F.sum(F.octet_length("token") + 64)).first()[0] or 0
    if size > MAX_RANK_BYTES:
        raise ValueError(f"rank table of {size} bytes (> {MAX_RANK_BYTES}); refusing to broadcast")
    return {bytes(r["token"]): int(r["rank"]) for r in ranks.select("token", "rank").collect()}


def bpe_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Lowest-rank-first merging of one piece, of equal ranks the first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    rank = [ranks.get(piece[i:i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while rank:
        least = min(rank)
        if least == NO_RANK:
            break
        i = rank.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del rank[i]
        for j in (i - 1, i):  # only the neighbours of the merged part change
            if 0 <= j < len(rank):
                rank[j] = ranks.get(parts[j] + parts[j + 1], NO_RANK)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a piece of any length: a heap of (rank, start, middle, end) of the pairs, of which
    those count whose two parts are still there."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            r = ranks.get(piece[i:after[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, j, after[j]))

    for i in range(n):
        offer(i)
    alive = bytearray(b"\1" * n)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not (alive[i] and after[i] == j and alive[j] and after[j] == k):
            continue
        after[i], alive[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i:after[i]]] for i in range(n) if alive[i]]


class _Pieces(dict):
    """Piece -> its ids as int32 bytes. When full, the pieces become the older half, from which
    those still in use come back."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode("utf-8")
            ids = np.array(bpe_merge(raw, self.ranks), np.int32).tobytes()
            if len(raw) > LONG_PIECE:
                return ids
        if len(self) >= MAX_CACHED_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class _Encoder:
    def __init__(self, ranks: dict[bytes, int], specials: Sequence[str]):
        import regex
        self.ranks, self.names, self.pieces = ranks, tuple(specials), _Pieces(ranks)
        self.find = regex.compile(SPLIT_PATTERN).findall
        self.special = {s: np.int32(len(ranks) + i).tobytes() for i, s in enumerate(specials)}
        self.cut = (regex.compile("(" + "|".join(regex.escape(s) for s in specials) + ")").split
                    if specials else lambda t: [t])

    def __call__(self, text: str) -> bytes:
        """The ids of a text as int32 bytes."""
        ids = self.pieces.__getitem__
        return b"".join(self.special[part] if part in self.special else b"".join(map(ids, self.find(part)))
                        for part in self.cut(text))


class _Decoder:
    def __init__(self, ranks: dict[bytes, int], specials: Sequence[str]):
        self.ranks, self.names = ranks, tuple(specials)
        token = {r: t for t, r in ranks.items()}
        token.update({len(token) + i: s.encode() for i, s in enumerate(specials)})
        self.ids = np.array(sorted(token), np.int64)
        self.size = np.array([len(token[i]) for i in self.ids.tolist()], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(token[i] for i in self.ids.tolist()), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        if (self.ids[at] != ids).any():
            raise KeyError(f"ids without a token: {ids[self.ids[at] != ids][:5].tolist()}")
        size = self.size[at]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - ends + size, size)
        return self.data[place].tobytes()


_KEPT: dict[type, _Encoder | _Decoder] = {}  # of this Python worker, the last of each


def _kept(kind: type, ranks: dict[bytes, int], names: tuple[str, ...]):
    """The worker's encoder or decoder: a broadcast table is one object for all tasks of a worker."""
    own = _KEPT.get(kind)
    if own is None or own.ranks is not ranks or own.names != names:
        own = _KEPT[kind] = kind(ranks, names)
    return own


def _broadcast(df: DataFrame, ranks):
    bounded_batches(df.sparkSession)
    table = ranks if isinstance(ranks, dict) else rank_table(ranks)
    return df.sparkSession.sparkContext.broadcast(table)


def bpe_encode(df: DataFrame, text_col: str, ranks: DataFrame | dict[bytes, int], out: str = "tokens",
               specials: Sequence[str] = (EOS_TEXT,)) -> DataFrame:
    """Add ``out`` = BPE ids of ``text_col``; a null text gives null."""
    shared, names = _broadcast(df, ranks), tuple(specials)

    def encode(texts: pa.Array) -> pa.Array:
        own = _kept(_Encoder, shared.value, names)
        rows = [b"" if t is None else own(t) for t in texts.to_pylist()]
        off = np.cumsum([0, *map(len, rows)]) // 4
        ids = np.frombuffer(b"".join(rows), np.int32)
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids), mask=texts.is_null())

    # marked so that a column which uses the ids twice does not have them made twice
    return df.withColumn(out, F.arrow_udf(encode, "array<int>").asNondeterministic()(text_col))


def bpe_decode(df: DataFrame, ids_col: str, ranks: DataFrame | dict[bytes, int], out: str = "decoded",
               specials: Sequence[str] = (EOS_TEXT,)) -> DataFrame:
    """Add ``out`` = the text of the ids; ids that do not end a character give U+FFFD."""
    shared, names = _broadcast(df, ranks), tuple(specials)

    def decode(rows: pa.Array) -> pa.Array:
        own = _kept(_Decoder, shared.value, names)
        return pa.array([own(r.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace")
                         if r.is_valid else None for r in rows], pa.string())

    return df.withColumn(out, F.arrow_udf(decode, "string")(ids_col))
