"""SentencePiece BPE encoding and decoding with seeded merge-dropout.

Encoding merges adjacent pieces by an agenda: the best-scored candidate merge is taken first
(leftmost on ties), and each candidate may be skipped. A keyed hash of (seed, document, position of
the chunk, place, merged piece) decides the skips, so a run repeats exactly and shares no random state.
Every occurrence of a chunk draws its own skips: the same word gets different segmentations, all made of
merges the vocabulary allows, and all decode to the same text. With ``dropout`` 0 the pieces are those of
the library for the same model. ``variants`` above 0 lets the occurrences share so many keys.

Text is cut into chunks where no piece of the vocabulary can span (before a run of spaces and
around line ends), so a chunk's pieces do not depend on its neighbours. Its pieces without dropout and
the candidates met on the way are computed once per task (bounded by ``MAX_CACHED`` chunks); an
occurrence that keeps all of these candidates has those pieces, any other is merged on its own. A literal U+2581, which the
vocabulary uses for spaces, is spelled in byte pieces, which keeps decoding lossless.

Defined cases: a null text is empty and has no pieces; characters outside the vocabulary become
byte pieces; a null id counts as an empty string in the hash; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 20
MAX_CACHED = 1_000_000
WIDTHS = (4, 8, 12, 16, 24, 48)  # chunks up to each are merged side by side, longer ones alone
SPACE = "▁"
_CHUNK = re.compile(r"\n| *[^ \n]+| +")
_U = np.uint64


class Pieces:
    """What encoding and decoding need of a model: merges by pair of pieces, bytes of each id."""

    def __init__(self, model: str = MODEL):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.byte = [0] * 256
        self.raw: list[bytes] = []
        score = np.zeros(sp.vocab_size())
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            score[i] = sp.get_score(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.rank = np.empty(len(score), np.int32)  # place in order of score, best first
        self.rank[np.argsort(-score, kind="stable")] = np.arange(len(score))
        # every way to make a piece of two pieces: (left id, right id) -> id
        made = {(self.ids[p[:k]] << 32) | self.ids[p[k:]]: i for p, i in self.ids.items()
                for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        keys = np.fromiter(made, np.int64, len(made))
        order = np.argsort(keys)
        self.pair = np.append(keys[order], np.iinfo(np.int64).max)
        self.made = np.append(np.fromiter(made.values(), np.int64, len(made))[order], -1)
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, -1 where the vocabulary has none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pair, key)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def spell(self, code: int) -> list[int]:
        """Byte pieces of a character outside the vocabulary."""
        return [self.byte[b] for b in chr(code).encode("utf-8", "surrogatepass")]

    def decode(self, ids) -> str:
        """The text of a whole document's ids: pieces joined, the leading space dropped."""
        return b"".join(map(self.raw.__getitem__, ids))[1:].decode()


def skipped(key: np.ndarray, place: np.ndarray, piece: np.ndarray, dropout: int) -> np.ndarray:
    """The keyed hash of a candidate merge: True for ``dropout`` of 2^16."""
    h = X.mix64(key ^ (place.astype(_U) * X._B + piece.astype(_U) * _U(0xD6E8FEB86659FD93)))
    return (h >> _U(48)) < _U(dropout)


def merge_chunk(p: Pieces, codes: np.ndarray, key: int, dropout: int) -> list[int]:
    """Ids of one chunk by an agenda of candidate merges."""
    n = len(codes)
    sym = p.char[codes].tolist()
    alive = [True] * n
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        made = int(p.merge(np.array([sym[i]]), np.array([sym[j]]))[0])
        if made >= 0 and not (dropout and skipped(np.array([key], _U), np.array([i]),
                                                  np.array([made]), dropout)[0]):
            heapq.heappush(agenda, (int(p.rank[made]), i, j, sym[i], sym[j], made))

    for i in range(n - 1):
        offer(i, i + 1)
    while agenda:
        _, i, j, a, b, made = heapq.heappop(agenda)
        if not (alive[i] and alive[j] and nxt[i] == j and sym[i] == a and sym[j] == b):
            continue
        sym[i], alive[j], nxt[i] = made, False, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
            offer(i, nxt[i])
        if prv[i] >= 0:
            offer(prv[i], i)
    out: list[int] = []
    for i in range(n):
        if alive[i]:
            out += [sym[i]] if sym[i] >= 0 else p.spell(int(codes[i]))
    return out


def merge_chunks(p: Pieces, codes: np.ndarray, size: np.ndarray, key: np.ndarray, dropout: int,
                 met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids) of many chunks, all agendas advancing together: in each round every
    chunk takes its best candidate, the leftmost on ties. ``codes`` holds the chunks end to end;
    ``met`` takes the (chunk, place, piece) of the candidates."""
    w, width = len(size), int(size.max())
    none = np.iinfo(np.int32).max
    inside = np.arange(width) < size[:, None]
    code = np.zeros((w, width), np.int64)
    code[inside] = codes
    sym = np.where(inside, p.char[code], -1).astype(np.int64)
    place = np.arange(width)
    rank = np.full((w, width), none, np.int32)  # of the merge of a place and the next one alive
    made = np.full((w, width), -1, np.int64)

    def offer(rows, i, left, right):
        got = p.merge(left, right)
        ok = got >= 0
        if met is not None:
            met.append((rows[ok], i[ok], got[ok]))
        if dropout:
            ok &= ~skipped(key[rows], i, got, dropout)
        rank[rows, i] = np.where(ok, p.rank[got], none)
        made[rows, i] = got

    if width > 1:
        rows, i = np.nonzero(inside[:, 1:])
        offer(rows, i, sym[rows, i], sym[rows, i + 1])
    nxt = np.tile(place + 1, (w, 1))
    prv = np.tile(place - 1, (w, 1))
    alive = inside.copy()
    rows = np.arange(w)
    while len(rows):
        i = rank[rows].argmin(axis=1)
        going = rank[rows, i] < none
        rows, i = rows[going], i[going]
        if not len(rows):
            break
        j = nxt[rows, i]
        sym[rows, i] = made[rows, i]
        alive[rows, j] = False
        rank[rows, j] = rank[rows, i] = none
        k = nxt[rows, j]
        nxt[rows, i] = k
        on = k < size[rows]
        r, a, b = rows[on], i[on], k[on]
        prv[r, b] = a
        offer(r, a, sym[r, a], sym[r, b])
        h = prv[rows, i]
        on = h >= 0
        r, a, b = rows[on], h[on], i[on]
        offer(r, a, sym[r, a], sym[r, b])
    strange = (sym < 0) & alive
    if not strange.any():
        return sym[alive].astype(np.int32), alive.sum(axis=1)
    flat, count = [], alive.sum(axis=1)
    odd = strange.any(axis=1)
    for r in range(w):
        if odd[r]:
            own = []
            for c in np.flatnonzero(alive[r]):
                own += [int(sym[r, c])] if sym[r, c] >= 0 else p.spell(int(code[r, c]))
            flat.append(np.array(own, np.int32))
            count[r] = len(own)
        else:
            flat.append(sym[r][alive[r]].astype(np.int32))
    return np.concatenate(flat), count


def _chunks(text: str) -> list[str]:
    """A text's chunks; a literal U+2581 is a chunk of its own."""
    if not text:
        return []
    if SPACE not in text:
        return _CHUNK.findall(" " + text)
    out: list[str] = []
    for k, part in enumerate(text.split(SPACE)):
        if k:
            out.append(SPACE)
        out += _CHUNK.findall(part if k else " " + part)
    return out


class _Numbers(dict):
    """Chunk -> running number."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Encoder:
    """Encodes blocks of texts; remembers what each chunk it has met becomes without dropout."""

    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, variants: int = 0,
                 seed: int = SEED):
        self.pieces, self.drop = pieces, int(round(dropout * 65536))
        self.variants, self.seed = variants, seed
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.chunks: list[str] = []
        self.start, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        # candidates: of each chunk its first one and how many; place and piece. -1: a long chunk, not listed
        self.first, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.place, self.piece = np.zeros(0, np.uint8), np.zeros(0, np.int32)

    def _merge(self, own: list[str], key: np.ndarray, dropout: int, met: list | None = None):
        """(ids, start and number of the ids of each chunk); ``met``: candidates, all but long chunks'."""
        p = self.pieces
        size = np.fromiter(map(len, own), np.int64, len(own))
        codes = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32
                              ).astype(np.int64)
        end = np.cumsum(size)
        literal = codes == ord(SPACE)
        codes = np.where(codes == 32, ord(SPACE), codes)
        ids, count = [np.zeros(0, np.int32)], np.zeros(len(own), np.int64)
        start, at = np.zeros(len(own), np.int64), 0
        edge = 0
        for width in WIDTHS:
            i = np.flatnonzero((size > edge) & (size <= width))
            edge = width
            for lo in range(0, len(i), 1 << 16):
                part = i[lo:lo + (1 << 16)]
                pick = np.repeat(end[part] - size[part], size[part]) + (
                    np.arange(int(size[part].sum()))
                    - np.repeat(np.cumsum(size[part]) - size[part], size[part]))
                seen = None if met is None else []
                got, n = merge_chunks(p, codes[pick], size[part], key[part], dropout, seen)
                if met is not None:
                    met += [(part[r], place, piece) for r, place, piece in seen]
                if literal[pick].any():  # such a chunk is one character
                    got, n = self._literal(got, n, literal[pick][np.cumsum(size[part]) - 1])
                count[part], start[part] = n, at + np.cumsum(n) - n
                ids.append(got)
                at += len(got)
        for i in np.flatnonzero(size > edge):
            got = np.array(merge_chunk(p, codes[end[i] - size[i]:end[i]], int(key[i]), dropout),
                           np.int32)
            count[i], start[i] = len(got), at
            ids.append(got)
            at += len(got)
        return np.concatenate(ids), start, count

    def _meet(self, own: list[str]) -> None:
        """Remember the chunks ``own``, all new."""
        met: list | None = [] if self.drop else None
        ids, start, count = self._merge(own, np.zeros(len(own), _U), 0, met)
        self.start = np.concatenate([self.start, start + len(self.ids)])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])
        if not self.drop:
            return
        row, place, piece = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*met)) if met else (
            np.zeros(0, np.int64),) * 3
        order = np.argsort(row, kind="stable")
        many = np.bincount(row, minlength=len(own))
        first = len(self.place) + np.cumsum(many) - many
        many[np.fromiter(map(len, own), np.int64, len(own)) > WIDTHS[-1]] = -1
        self.first, self.many = np.concatenate([self.first, first]), np.concatenate([self.many, many])
        self.place = np.concatenate([self.place, place[order].astype(np.uint8)])
        self.piece = np.concatenate([self.piece, piece[order].astype(np.int32)])

    def _drops(self, num: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Which occurrences skip any candidate of their chunk's way without dropout."""
        many = np.maximum(self.many[num], 0)
        end = np.cumsum(many)
        at = np.repeat(self.first[num] - (end - many), many) + np.arange(int(end[-1]) if len(end) else 0)
        hit = skipped(np.repeat(key, many), self.place[at], self.piece[at], self.drop)
        sums = np.zeros(len(hit) + 1, np.int64)
        np.cumsum(hit, out=sums[1:])
        return (sums[end] > sums[end - many]) | (self.many[num] < 0)

    def _literal(self, ids, n, mask):
        spell = np.array(self.pieces.spell(ord(SPACE)), np.int32)
        rows = np.split(ids, np.cumsum(n)[:-1])
        rows = [spell if lit else r for r, lit in zip(rows, mask)]
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)

    def encode(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text), in order."""
        if len(self.number) >= MAX_CACHED:
            self._forget()
        look = self.number.__getitem__
        numbers, lens, known = [], [], len(self.number)
        for text in texts:
            own = _chunks(text)
            numbers += map(look, own)
            lens.append(len(own))
        num, n = np.array(numbers, np.int64), np.array(lens, np.int64)
        if len(self.number) > known:
            new = list(islice(self.number, known, None))
            self.chunks += new
            self._meet(new)
        all_ids, first, c = self.ids, self.start[num], self.count[num]
        if self.drop:
            key = self.keys(n, keys)
            own = np.flatnonzero(self._drops(num, key))
            if len(own):
                ids, start, c[own] = self._merge([self.chunks[i] for i in num[own]], key[own], self.drop)
                first[own] = start + len(all_ids)
                all_ids = np.concatenate([all_ids, ids])
        total = np.cumsum(c)
        pick = np.repeat(first - (total - c), c) + np.arange(int(total[-1]) if len(c) else 0)
        ends = np.concatenate([[0], total])[np.cumsum(n)]
        return all_ids[pick], np.diff(np.concatenate([[0], ends]))

    def keys(self, n: np.ndarray, keys: list[int]) -> np.ndarray:
        """The skip key of each occurrence, of texts of ``n`` chunks."""
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        doc = np.repeat(np.array(keys, np.int64).astype(_U), n)
        key = X.mix64(X.mix64(doc + _U(self.seed)) + place.astype(_U) * X._B)
        return X.mix64(key % _U(self.variants) + _U(self.seed)) if self.variants else key


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     model: str = MODEL, dropout: float = DROPOUT, variants: int = 0,
                     seed: int = SEED) -> DataFrame:
    """(id, ids, n_pieces, lossless): piece ids; lossless says that they decode to the text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Pieces(model))  # the vocabulary: its file's size

    def run(batches):
        pieces = shared.value
        enc = Encoder(pieces, dropout, variants, seed)
        raw = pieces.raw
        for rec, data, off in X.blocks(batches, "__text", 1 << 20):
            block = data.tobytes()
            rows = [block[off[i]:off[i + 1]] for i in range(rec.num_rows)]
            ids, n = enc.encode([r.decode() for r in rows], rec.column(1).to_pylist())
            end = np.cumsum(n)
            same = [b"".join(map(raw.__getitem__, ids[e - c:e].tolist()))[1:] == r
                    for r, c, e in zip(rows, n, end)]
            yield pa.RecordBatch.from_arrays([
                rec.column(0), X.list_array(ids, n, pa.int32()), pa.array(n), pa.array(same)],
                names=[id_col, "ids", "n_pieces", "lossless"])

    src = docs.select(F.col(id_col), F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
                      F.col(text_col).alias("__text"))
    schema = T.StructType([T.StructField(id_col, src.schema[0].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()),
                           T.StructField("lossless", T.BooleanType())])
    return X.map_arrow(src, run, schema)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
                     model: str = MODEL) -> DataFrame:
    """(id, text) back from piece ids; null ids give an empty text."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(Pieces(model))

    def run(batches):
        for rec in batches:
            texts = [shared.value.decode(x or []) for x in rec.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rec.column(0), pa.array(texts, pa.string())],
                                             names=[id_col, "text"])

    src = encoded.select(F.col(id_col), F.col(ids_col))
    return X.map_arrow(src, run, T.StructType([
        T.StructField(id_col, src.schema[0].dataType), T.StructField("text", T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: piece ids of every document with merge-dropout, checked to decode to the text."""
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
