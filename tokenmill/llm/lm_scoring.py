"""Language-model scoring by online logistic context mixing.

Texts fall into a few groups by their byte shares (in practice languages); the group is named first,
at log10(GROUPS), and the contexts at a word's start and the piece shares (by the white space before a
piece) are the group's.
The centres come from all training texts: every partition reduces its byte shares to a few weighted
means, the means of all partitions are clustered; every text is assigned.

A text is a chain of pieces: a word with the white-space byte after it (a virtual byte ends the
text; pieces above 64 bytes are cut). Bytes are predicted bit by bit, high bit first. For each bit,
hashed contexts of 0, 1, 2, 3, 4 and 6 preceding bytes (not beyond the white space before the word)
give the counts of zeros and ones that training texts had there; their log-odds, shrunk where
counts are few, are combined by a weight vector chosen by a gate (bit place, how many long
contexts were seen). The weights are learnt online, bit after bit, over all training pieces in
each partition and averaged over partitions. The result is refined by an adaptive map from (bits
so far, log-odds) to the observed share of ones. While a document is read, a second gate adapts: the
share of its pieces that had occurred in it before weighs the model against the document's own
piece frequencies. The score is the log10 probability of the whole text; ``bits_per_byte`` follows.

On Spark: documents are cut into blocks of pieces held as numbers into the block's dictionary.
Dictionaries, not token occurrences, are shuffled: they are counted over the corpus (word counts,
piece counts, context counts), every distinct piece is scored once, and the scores go back to the
blocks that use them. Nothing but the context model, whose size is fixed by ``TABLE_BITS``, is broadcast.

Base: add-one unigram over lower-cased words and one end token a text, learnt from the same rows.

Defined cases: a null text is empty and has one token, its end; a null id is scored, not learnt from
and not held out; repeated rows count each; an empty corpus gives base 0 for the end token; extra
columns are not read. Words and pieces are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import textnp as X
from tokenmill.plans.prefix import materialize

ORDERS = (1, 2, 3, 4, 6)
TABLE_BITS = 18
MAX_PIECE = 64
BLOCK = 8 << 20
PART = 1 << 20  # bytes of a block that are cut and numbered at a time (one text may have more)
SLICE = 1 << 18  # pieces of documents that are summed at a time (one document may have more)
LANES = 20_000
GATES = 8 * (len(ORDERS) + 1)
INPUTS = len(ORDERS) + 2
BUCKETS, REACH = 33, 8.0
DISCOUNT = 0.6
GROUPS, MEANS = 4, 8  # groups of texts; weighted means that stand for the texts of a partition
CHUNK = 8192
PLACE = 26  # low bits that number a block's entries
_U = np.uint64
_MASKS = [_U((1 << (8 * k)) - 1) for k in ORDERS]
_MULT = [_U(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * 2 * k & (2 ** 64 - 1)) | _U(1)
         for k in ORDERS]
_NODE, _FIN = _U(0xD6E8FEB86659FD93), _U(0xFF51AFD7ED558CCD)


# ---- pieces

def split_pieces(data: np.ndarray, off: np.ndarray):
    """(buffer, row, start, end, kind, word hash): pieces are buffer[start:end], preceded by their
    context byte. kind 0: whole, 1: cut, more follows, 2: last part of a cut one. The hash is of the
    word that ends in the piece (0: none)."""
    n = len(off) - 1
    raw = data.tobytes()
    cuts = off.tolist()
    # a zero byte before and after each text
    buf = np.frombuffer(b"\0" + b"\0\0".join(map(raw.__getitem__, map(slice, cuts, cuts[1:]))) + b"\0",
                        np.uint8)
    first = off[:-1] + 2 * np.arange(n) + 1
    ends = X.SPACE[buf]
    ends[off[1:] + 2 * np.arange(n) + 1] = True
    e = np.flatnonzero(ends) + 1
    prow = np.searchsorted(first, e - 1, side="right") - 1
    s = np.empty(len(e), np.int64)
    s[1:] = e[:-1]
    s[:1] = 1
    fresh = np.r_[True, prow[1:] != prow[:-1]] if len(e) else np.zeros(0, bool)
    s[fresh] = first[prow[fresh]]
    word = np.zeros(len(e), _U)
    has = e - s >= 2
    word[has] = X.hash_spans(buf, s[has], e[has] - 1) | _U(1)
    kind = np.zeros(len(e), np.uint8)
    if len(e) and (e - s).max() > MAX_PIECE:
        parts = np.maximum((e - s + MAX_PIECE - 1) // MAX_PIECE, 1)
        i = np.repeat(np.arange(len(e)), parts)
        nth = np.arange(len(i)) - np.repeat(np.cumsum(parts) - parts, parts)
        last = nth == parts[i] - 1
        kind = np.where(parts[i] == 1, 0, np.where(last, 2, 1)).astype(np.uint8)
        word = np.where(last, word[i], _U(0))
        s, e, prow = s[i] + nth * MAX_PIECE, np.minimum(s[i] + (nth + 1) * MAX_PIECE, e[i]), prow[i]
    return buf, prow, s, e, kind, word


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, kind) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(raw, size, codec="zstd", asbytes=True), kind)


_AFTER = np.full(256, 7, np.uint8)  # what stands before a piece: 0 the text's start, 1-6 white space
_AFTER[[0, 0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = np.arange(7)


def byte_profiles(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """[rows, 256] square roots of the byte shares of each text."""
    size = np.diff(off)
    share = np.zeros((len(size), 256))
    for lo in range(0, len(data), PART):  # a row may go over several parts
        hi = min(lo + PART, len(data))
        first, last = np.searchsorted(off, lo, side="right") - 1, np.searchsorted(off, hi)
        row = np.repeat(np.arange(last - first), np.diff(np.clip(off[first:last + 1], lo, hi)))
        share[first:last] += np.bincount(row * 256 + data[lo:hi], minlength=(last - first) * 256
                                         ).reshape(-1, 256)
    share /= np.maximum(size, 1)[:, None]
    return np.sqrt(share, out=share)


def _means(profiles: np.ndarray, mass: np.ndarray, k: int, rng, rounds: int = 15):
    """(means, mass of each, sum of squared distances) of Lloyd's algorithm from one seeded start."""
    c = profiles[rng.choice(len(profiles), k, replace=False)]
    for turn in range(rounds):
        d = (profiles ** 2).sum(axis=1)[:, None] - 2 * profiles @ c.T + (c ** 2).sum(axis=1)
        near = d.argmin(axis=1)
        own = (near == np.arange(k)[:, None]) * mass  # [k, rows]
        total = own.sum(axis=1)
        c = np.where(total[:, None] > 0, own @ profiles / np.maximum(total, 1)[:, None], c)
    return c, total, (d.min(axis=1) * mass).sum()


def _profile_means(batches):
    """The partition's texts as at most ``MEANS`` weighted means of their byte profiles."""
    means, mass, rng = np.zeros((0, 256)), np.zeros(0), np.random.default_rng(5)
    for rec, data, off in X.blocks(batches, "__text"):
        means = np.concatenate([means, byte_profiles(data, off)])
        mass = np.concatenate([mass, np.ones(rec.num_rows)])
        if len(means) > MEANS:
            means, mass, _ = _means(means, mass, MEANS, rng, 5)
            means, mass = means[mass > 0], mass[mass > 0]
    if len(means):
        yield pa.RecordBatch.from_arrays([
            X.list_array(means.ravel().astype(np.float32), np.full(len(means), 256), pa.float32()),
            pa.array(mass)], names=["f", "mass"])


def fit_groups(profiles: np.ndarray, k: int = GROUPS, seed: int = 5, mass: np.ndarray | None = None
               ) -> np.ndarray:
    """[k, 256] centres of the profiles, weighted by ``mass`` (Lloyd's algorithm, the best of four
    seeded starts)."""
    mass = np.ones(len(profiles)) if mass is None else mass
    best, least = np.zeros((1, 256)), np.inf
    rng = np.random.default_rng(seed)
    for _ in range(4 if len(profiles) >= k else 0):
        c, _, far = _means(profiles, mass, k, rng)
        if far < least:
            best, least = c, far
    return best


def _block_rows(centres: np.ndarray):
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for rec, data, off in X.blocks(batches, "__text", BLOCK):
            yield _one_block(rec, data, off, centres, (part << 16) + k)
            k += 1
    return run


def _one_part(data: np.ndarray, off: np.ndarray, group: np.ndarray, train: np.ndarray, base: int):
    """(buffer, keys of the distinct pieces, their (start from ``base``, end, kind, before, word hash),
    their training counts, number of each piece among them, words and pieces of each text)."""
    n = len(off) - 1
    buf, row, s, e, kind, word = split_pieces(data, off)
    before = (group[row] << 4).astype(np.uint8) | _AFTER[buf[s - 1]]
    key = X.mix64(X.hash_spans(buf, s, e, fold=False) + before)
    cut = kind > 0
    key[cut] = X.mix64(key[cut] + kind[cut] + word[cut] * X._B)
    order = np.argsort(key)
    ranked = key[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    at = order[fresh]  # any place of an entry
    idx = np.empty(len(key), np.int32)
    idx[order] = np.cumsum(fresh) - 1
    return (buf.tobytes(), ranked[fresh], (s[at] + base, e[at] + base, kind[at], before[at], word[at]),
            np.bincount(idx, weights=train[row], minlength=len(at)), idx,
            np.bincount(row, weights=word > 0, minlength=n).astype(np.int64), np.bincount(row, minlength=n))


def _one_block(rec, data, off, centres, number: int) -> pa.RecordBatch:
    group = ((centres ** 2).sum(axis=1) - 2 * (byte_profiles(data, off) @ centres.T)).argmin(axis=1)
    held = np.array(rec.column(1).to_pylist(), bool)
    train = np.array(rec.column(2).to_pylist(), bool)
    n, base, lo, parts = rec.num_rows, 0, 0, []
    while lo < n:  # a few texts at a time: only the distinct pieces' spans are kept, and the numbers
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + PART, side="right")) - 1)
        parts.append(_one_part(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], group[lo:hi], train[lo:hi], base))
        base += len(parts[-1][0])
        lo = hi
    texts, keys, spans, counts, numbers, words, pieces = zip(*parts)
    key = np.concatenate(keys)
    order = np.argsort(key)
    ranked = key[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    at = order[fresh]  # any part that has the entry
    place = np.empty(len(key), np.int32)
    place[order] = np.cumsum(fresh) - 1
    first = np.cumsum([0, *map(len, keys)])
    idx = np.concatenate([place[i:][k] for i, k in zip(first, numbers)])
    text = b"".join(texts)
    del parts, texts, keys, numbers
    span = [np.concatenate(x)[at] for x in zip(*spans)]
    entries = pa.concat_arrays([pa.array(
        [bytes([kd, pre]) + text[a:b] + (w.tobytes() if kd == 2 else b"") for a, b, kd, pre, w in zip(
            *(x[lo:lo + LANES].tolist() for x in span[:4]), span[4][lo:lo + LANES])], pa.binary())
        for lo in range(0, max(len(at), 1), LANES)])
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()),
        pa.array([rec.column(0).to_pylist()], pa.list_(rec.column(0).type)),
        pa.array([held.tolist()], pa.list_(pa.bool_())),
        X.list_array(off[1:] - off[:-1], [n], pa.int64()),
        pa.array([int(train.sum())], pa.int64()),
        X.list_array(np.concatenate(words), [n], pa.int64()),
        X.list_array(np.concatenate(pieces), [n], pa.int64()),
        pa.array([_packed(idx)], pa.binary()),
        pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries),
        X.list_array(np.bincount(place, weights=np.concatenate(counts), minlength=len(at)).astype(np.int64),
                     [len(at)], pa.int64()),
    ], names=["block", "ids", "held", "n_bytes", "train_docs", "words", "pieces", "idx", "entries",
              "n_train"])


# ---- the context model over distinct pieces

def _matrix(entries: list[bytes]):
    """(context and piece bytes as lanes, longest first; size; order)."""
    size = np.array([len(x) - 1 - (8 if x[0] == 2 else 0) for x in entries], np.int64)
    order = np.argsort(-size, kind="stable")
    size = size[order]
    width = int(size[0]) if len(size) else 0
    raw = b"".join(entries[i][1:size_ + 1].ljust(width, b"\0") for i, size_ in zip(order, size))
    return np.frombuffer(raw, np.uint8).reshape(len(entries), width), size, order


def _bits(mat: np.ndarray, size: np.ndarray):
    """(lanes, bit place, bits so far, next bit, table slots) of each bit of each byte."""
    pack = np.zeros(len(mat), _U)
    for t in range(1, mat.shape[1]):
        m = int(np.searchsorted(-size, -t, side="left"))  # lanes with size > t
        pack = ((pack[:m] << _U(8)) | mat[:m, t - 1]) & _U(0xFFFFFFFFFFFF)
        ctx = [(pack & k) * mult for k, mult in zip(_MASKS, _MULT)]
        byte, node = mat[:m, t].astype(np.int64), np.ones(m, np.int64)
        for b in range(7, -1, -1):
            bit = (byte >> b) & 1
            step = node.astype(_U) * _NODE
            slots = [((((c + step) ^ ((c + step) >> _U(29))) * _FIN) >> _U(64 - TABLE_BITS)
                      ).astype(np.int64) for c in ctx]
            yield m, 7 - b, node, bit, slots
            node = node * 2 + bit


def _context_counts(batches):
    """(chunk, counts of zeros and ones) of the partition, ``CHUNK`` slots to a row; slots of all orders
    are in one numbering, 0..255 order 0."""
    size = 256 + (len(ORDERS) << TABLE_BITS)
    n = np.zeros((2, size))
    for rec in batches:
        entries, weight = rec.column(0).to_pylist(), rec.column(1).to_numpy()
        for lo in range(0, len(entries), 10 * LANES):
            mat, lens, order = _matrix(entries[lo:lo + 10 * LANES])
            w = weight[lo:lo + 10 * LANES][order].astype(float)
            for m, _, node, bit, slots in _bits(mat, lens):
                for b in (0, 1):
                    pick = bit == b
                    own = w[:m][pick]
                    n[b, :256] += np.bincount(node[pick], own, 256)
                    for k, s in enumerate(slots):
                        np.add.at(n[b], s[pick] + (256 + (k << TABLE_BITS)), own)
    for chunk, lo in enumerate(range(0, size, CHUNK)):
        part = n[:, lo:lo + CHUNK].astype(np.float32)
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([_packed(part)])],
                                             names=["chunk", "counts"])


def _sum_counts(batches):
    """Log-odds of each slot, shrunk where counts are few, from the partitions' counts of a chunk."""
    size = 256 + (len(ORDERS) << TABLE_BITS)
    total: dict[int, np.ndarray] = {}
    for rec in batches:
        for chunk, raw in zip(rec.column(0).to_pylist(), rec.column(1).to_pylist()):
            width = min(CHUNK, size - chunk * CHUNK)
            part = _unpacked(raw, 2 * width, np.float32).reshape(2, width)
            total[chunk] = total.get(chunk, 0.0) + part.astype(np.float64)
    for chunk, (n0, n1) in total.items():
        i = np.flatnonzero(n0 + n1)
        n = n0[i] + n1[i]
        odds = np.clip(np.log((n1[i] + 0.1) / (n0[i] + 0.1)), -12, 12) * n / (n + 0.5)
        yield pa.RecordBatch.from_arrays(
            [pa.array((i + chunk * CHUNK).astype(np.int32)), pa.array(odds.astype(np.float32))],
            names=["slot", "odds"])


def _inputs(table: np.ndarray, node, slots):
    x = np.empty((INPUTS, len(node)), np.float32)
    x[0] = 0.3
    x[1] = table[node]
    for k, s in enumerate(slots):
        x[2 + k] = table[s + (256 + (k << TABLE_BITS))]
    return x


def _gate(x, place):
    return np.count_nonzero(x[2:], axis=0) * 8 + place


def _odds(table, weights, place, node, slots):
    x = _inputs(table, node, slots)
    gate = _gate(x, place)
    return x, gate, np.clip((weights[gate].T * x).sum(axis=0), -REACH * 2, REACH * 2)


def _bucket(z):
    return np.clip(np.rint((z + REACH) * ((BUCKETS - 1) / (2 * REACH))), 0, BUCKETS - 1).astype(int)


def _learn(table: np.ndarray):
    def run(batches):
        weights = np.full((GATES, INPUTS), 0.3, np.float32)
        seen = np.zeros(GATES)
        share = np.zeros((2, 256 * BUCKETS))
        for rec in batches:
            entries, weight = rec.column(0).to_pylist(), rec.column(1).to_numpy()
            for lo in range(0, len(entries), LANES):
                mat, lens, order = _matrix(entries[lo:lo + LANES])
                w = weight[lo:lo + LANES][order].astype(np.float32)
                for m, place, node, bit, slots in _bits(mat, lens):
                    x, gate, z = _odds(table, weights, place, node, slots)
                    own = w[:m]
                    for b in (0, 1):
                        share[b] += np.bincount(node * BUCKETS + _bucket(z),
                                                own * (bit == b), 256 * BUCKETS)
                    err = (bit - 1 / (1 + np.exp(-z))) * own
                    mass = np.bincount(gate, own, GATES)
                    seen += mass
                    step = 0.2 / (1 + seen / 2e5) ** 0.3 / np.maximum(mass, 1)
                    for k in range(INPUTS):
                        weights[:, k] += step * np.bincount(gate, err * x[k], GATES)
        if seen.any():
            g, k = np.divmod(np.arange(GATES * INPUTS), INPUTS)
            i = np.flatnonzero(share.sum(axis=0))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[np.arange(GATES * INPUTS), GATES * INPUTS + i]),
                pa.array(np.r_[weights.ravel().astype(float) * seen[g], share[1, i]]),
                pa.array(np.r_[seen[g], share[:, i].sum(axis=0)])], names=["at", "top", "mass"])
    return run


def _score(model, n_pieces: np.ndarray, n_kinds: np.ndarray):
    def run(batches):
        table, weights, refined = model.value
        for rec in batches:
            entries, n = rec.column(0).to_pylist(), rec.column(2).to_numpy().astype(float)
            out = np.zeros(len(entries))
            for lo in range(0, len(entries), LANES):
                mat, lens, order = _matrix(entries[lo:lo + LANES])
                total = np.zeros(len(order))
                for m, place, node, bit, slots in _bits(mat, lens):
                    _, _, z = _odds(table, weights, place, node, slots)
                    p = 0.5 / (1 + np.exp(-z)) + 0.5 * refined[node * BUCKETS + _bucket(z)]
                    total[:m] += np.log10(np.where(bit == 1, p, 1 - p))
                out[lo + order] = total
            # whole pieces that the group's training texts held after this white space, discounted for
            # the unseen; the white space is known before the piece, so each class has its own shares
            g = np.array([x[1] for x in entries], np.int64)
            mass = np.maximum(n_pieces[g], 1)
            unseen = np.where(n_pieces[g] > 0, DISCOUNT * n_kinds[g] / mass, 1.0)
            with np.errstate(divide="ignore"):  # log 0: a piece that the group never held
                whole = np.log(np.maximum(n - DISCOUNT, 0) / mass)
            # in logs: the bits of a long unlikely piece fall below the least double
            out = np.logaddexp(whole, np.log(unseen) + out * np.log(10)) / np.log(10)
            yield pa.RecordBatch.from_arrays([rec.column(0), rec.column(1), pa.array(out)],
                                             names=["entry", "word", "lp"])
    return run


def _words(batches):
    for rec in batches:
        entries = rec.column(0).to_pylist()
        size = np.array([len(x) for x in entries], np.int64)
        kind = np.array([x[0] for x in entries], np.uint8)
        buf = np.frombuffer(b"".join(entries), np.uint8)
        end = np.cumsum(size)
        word = np.zeros(len(entries), _U)
        plain = (kind == 0) & (size >= 4)  # kind, context, at least one word byte, end
        if plain.any():
            word[plain] = X.hash_spans(buf, (end - size)[plain] + 2, end[plain] - 1) | _U(1)
        for i in np.flatnonzero(kind == 2):
            word[i] = np.frombuffer(entries[i][-8:], _U)[0]
        yield pa.RecordBatch.from_arrays(
            [rec.column(0), rec.column(1),
             pa.array(word.view(np.int64), mask=word == 0)], names=["entry", "n", "word"])


def _totals(n_words: int, n_docs: int, n_types: int):
    """N, V and the end token's count, of the base."""
    return n_words + n_docs, n_types + (n_docs > 0), n_docs


NO_COUNT = 1 << 32
LARGE = 1 << 32  # word counts from here on are kept in a list, N / LARGE long at most


def _code(lp: str, c: str) -> Column:
    """A piece's log10 probability (to 2^-16, above -16000: 66 bytes at most, each bit at least 5e-7) and
    its word's count in one long: ``NO_COUNT`` without a word, above it a place in the list of large ones."""
    count = F.when(F.col(c) < 0, F.lit(NO_COUNT)).otherwise(F.col(c))
    return F.round(F.col(lp) * 65536).cast("long") * (1 << 33) + count


def _decoded(code: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = code & ((1 << 33) - 1)
    c = np.where(count == NO_COUNT, -1, count)
    listed = count > NO_COUNT
    c[listed] = large[count[listed] - NO_COUNT - 1]
    return (code >> 33) / 65536.0, c


def _listed(words: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(word, c) with the place in the list in place of a large count; the list."""
    large = words.where(F.col("c") >= LARGE).collect()  # N / LARGE rows at most
    if large:
        place = words.sparkSession.createDataFrame(
            [(r["word"], NO_COUNT + 1 + i) for i, r in enumerate(large)], "word long, place long")
        words = words.join(F.broadcast(place), "word", "left").select(
            "word", F.coalesce("place", "c").alias("c"))
    return words, np.array([r["c"] for r in large], np.int64)


def _sums(idx: np.ndarray, size: np.ndarray, lp: np.ndarray, c: np.ndarray):
    """(model score, base score without its norm, known words, words) of documents of ``size`` pieces."""
    n = len(size)
    row = np.repeat(np.arange(n), size)
    place = np.arange(len(idx)) - np.repeat(np.cumsum(size) - size, size)
    # how often a piece has occurred before in its document
    order = np.argsort(row * (len(lp) + 1) + idx, kind="stable")
    same = np.r_[False, (row[order][1:] == row[order][:-1]) & (idx[order][1:] == idx[order][:-1])]
    run_start = np.maximum.accumulate(np.where(same, 0, np.arange(len(idx))))
    before = np.empty(len(idx), np.int64)
    before[order] = np.arange(len(idx)) - run_start
    repeats = np.cumsum(before > 0) - (before > 0)
    repeats -= np.repeat(repeats[np.cumsum(size) - size], size)
    share = np.where(place > 0, (repeats + 0.5) / (place + 2.0), 0.0)
    own = lp[idx]
    logp = np.log10(1 - share) + own
    old = before > 0
    logp[old] = np.log10((1 - share[old]) * 10.0 ** own[old] + share[old] * before[old] / place[old])
    known = c[idx]
    is_word = known >= 0
    base = np.where(is_word, np.log10(np.maximum(known, 0) + 1), 0.0)
    return (np.bincount(row, logp, n), np.bincount(row, base, n),
            np.bincount(row, is_word & (known > 0), n), np.bincount(row, is_word, n))


def _documents(train_tokens: int, types: int, ends: int, large: np.ndarray):
    norm = np.log10(train_tokens + types + 1)

    def run(batches):
        for rec in batches:
            col = {name: rec.column(i) for i, name in enumerate(rec.schema.names)}
            for r in range(rec.num_rows):
                def values(name):
                    return col[name][r].values.to_numpy(zero_copy_only=False)

                size, at = values("pieces"), values("at") & ((1 << PLACE) - 1)
                n = len(size)
                idx = _unpacked(col["idx"][r].as_py(), int(size.sum()), np.int32)
                lp, c = np.zeros(len(at)), np.zeros(len(at), np.int64)
                lp[at], c[at] = _decoded(values("code"), large)
                # a few documents at a time: their arrays, not the block's, are held
                start, sums, lo = np.r_[0, np.cumsum(size)], np.zeros((4, n)), 0
                while lo < n:
                    hi = max(lo + 1, int(np.searchsorted(start, start[lo] + SLICE, side="right")) - 1)
                    sums[:, lo:hi] = _sums(idx[start[lo]:start[hi]].astype(np.int64), size[lo:hi], lp, c)
                    lo = hi
                score = sums[0] - np.log10(GROUPS)  # naming the group
                yield pa.RecordBatch.from_arrays([
                    col["ids"][r].values, col["held"][r].values,
                    pa.array(values("words") + 1),
                    pa.array(sums[2].astype(np.int64) + (ends > 0)),
                    pa.array(np.full(n, train_tokens, np.int64)),
                    pa.array(sums[1] - sums[3] * norm + np.log10(ends + 1) - norm),
                    pa.array(score),
                    pa.array(-score / np.log10(2.0) / np.maximum(values("n_bytes"), 1)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                          "base_score", "score", "bits_per_byte"])
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 7, held: int = 2) -> DataFrame:
    """One row per document: base and mixing score of its whole text."""
    spark = docs.sparkSession
    key = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(key == held, F.lit(False)).alias("held"),
                      F.coalesce(key != held, F.lit(False)).alias("train"),
                      F.col(text_col).alias("__text"))
    id_sql = src.schema["id"].dataType.simpleString()
    means = X.collected(X.map_arrow(src.where("train").select("__text"), _profile_means,
                                    "f array<float>, mass double"))  # a few rows a partition
    # in an order of their own: which partition ends first decides nothing
    f = means["f"].reshape(-1, 256).astype(float)
    order = np.lexsort((f.sum(axis=1), -means["mass"]))
    centres = fit_groups(f[order], mass=means["mass"][order])
    blocks = materialize(X.map_arrow(
        src, _block_rows(centres),
        f"block long, ids array<{id_sql}>, held array<boolean>, n_bytes array<long>, "
        "train_docs long, words array<long>, pieces array<long>, idx binary, "
        "entries array<binary>, n_train array<long>"), "blocks")
    n_docs = blocks.agg(F.sum("train_docs")).first()[0] or 0

    used = blocks.select("block", F.posexplode(F.arrays_zip("entries", "n_train")).alias("pos", "x")
                         ).select((F.col("block") * (1 << PLACE) + F.col("pos")).alias("at"),
                                  F.col("x.entries").alias("entry"), F.col("x.n_train").alias("n"))
    pieces = used.groupBy("entry").agg(F.sum("n").alias("n"))
    pieces = materialize(X.map_arrow(pieces, _words, "entry binary, n long, word long"), "pieces")
    learnt = pieces.where("n > 0").select("entry", "n")
    words = materialize(pieces.where("n > 0 and word is not null").groupBy("word")
                        .agg(F.sum("n").alias("c")), "words")
    w = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_tokens, n_types, n_ends = _totals(w["n"] or 0, n_docs, w["v"])

    words, large = _listed(words)

    counts = X.map_arrow(learnt, _context_counts, "chunk int, counts binary").repartition("chunk")
    odds = X.collected(X.map_arrow(counts, _sum_counts, "slot int, odds float"))  # the fixed-size model
    table = np.zeros(256 + (len(ORDERS) << TABLE_BITS), np.float32)
    table[odds["slot"]] = odds["odds"]
    fit = (X.map_arrow(learnt, _learn(table), "at long, top double, mass double")
           .groupBy("at").agg(F.sum("top").alias("top"), F.sum("mass").alias("mass")))
    fit = X.collected(fit)
    flat = np.full(GATES * INPUTS, 0.3)
    mid = (np.arange(BUCKETS) * (2 * REACH / (BUCKETS - 1))) - REACH
    refined = np.tile(1 / (1 + np.exp(-mid)), 256)
    at, top, mass = fit["at"], fit["top"], fit["mass"]
    own = (at < len(flat)) & (mass > 0)
    flat[at[own]] = top[own] / mass[own]
    rest = at >= len(flat)
    i = at[rest] - len(flat)
    refined[i] = (top[rest] + 8 * refined[i]) / (mass[rest] + 8)
    model = spark.sparkContext.broadcast(
        (table, flat.reshape(GATES, INPUTS).astype(np.float32), np.clip(refined, 1e-6, 1 - 1e-6)))

    n_pieces, n_kinds = np.zeros(256), np.zeros(256)
    for r in learnt.groupBy(F.hex(F.substring("entry", 2, 1)).alias("pre")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("t")).collect():  # a row a group and class
        n_pieces[int(r["pre"], 16)], n_kinds[int(r["pre"], 16)] = r["n"], r["t"]
    scored = X.map_arrow(pieces.select("entry", "word", "n"), _score(model, n_pieces, n_kinds),
                         "entry binary, word long, lp double")
    scored = scored.select(F.xxhash64("entry").alias("key"), "word", "lp").join(words, "word", "left")
    scored = materialize(scored.withColumn(
        "c", F.when(F.col("word").isNull(), -1).otherwise(F.coalesce("c", F.lit(0))))
        .select("key", _code("lp", "c").alias("code")), "scored")
    # both lists take their elements row by row, so they run in step
    got = (used.select(F.xxhash64("entry").alias("key"), "at").join(scored, "key")
           .groupBy(F.shiftright("at", PLACE).alias("block"))
           .agg(F.collect_list("at").alias("at"), F.collect_list("code").alias("code")))
    ready = blocks.select("block", "ids", "held", "n_bytes", "words", "pieces", "idx").join(got, "block")
    return X.map_arrow(
        ready, _documents(n_tokens, n_types, n_ends, large),
        f"doc_id {id_sql}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double").withColumnRenamed("doc_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: scores of every document, learnt from rows with crc32(doc_id) mod 7 <> 2."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
