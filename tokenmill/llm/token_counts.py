"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A text is split into pre-tokens (the published split of byte-level vocabularies). The tokens of a
pre-token are the vocabulary pieces of the cheapest way to spell it; a piece of rank r costs
log(r + 1) plus a constant, the unigram (Zipf) prior of a frequency-ordered vocabulary. Among
equally cheap ways the one of fewer tokens counts.

The distinct pre-tokens of a block of text that have not been met in the task go into a trie, level
by level: a node is a distinct prefix. The forward score of a node is the least, over pieces that
end there, of the score of the ancestor at the piece's start plus the piece's cost; it is computed
once for a prefix however many pre-tokens share it, for all nodes of a level at once. Terminal nodes
give the pre-token's count, which stays in the task's table (bounded by ``MAX_KNOWN``).

Costs are whole numbers with the count in the low bits, so sums are exact and ties well defined.

A pre-token above ``LONG`` bytes shares no prefix worth keeping: it takes the same forward pass alone, in
windows of ``WINDOW`` places that hand on the scores of the last places only, and is not remembered.

Defined cases: a null or empty text has no tokens; pre-tokens of any length are scored whole; repeated
rows count each; extra columns are not read.
"""

from __future__ import annotations

import base64
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-token pattern of byte-level BPE vocabularies.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MAX_KNOWN = 400_000
LONG, WINDOW = 4096, 1 << 16  # bytes: scored outside the trie; places of a long pre-token at a time
SCALE = 1024  # cost units per nat
_COUNT, WIDE = 20, 40  # low bits that count tokens: of a pre-token, of a document
_U = np.uint64


class UnigramTrie:
    """Piece costs by hash, and the forward pass over a trie of strings."""

    def __init__(self, path: str = VOCABULARY):
        pieces: list[tuple[bytes, int]] = []
        with open(path, "rb") as f:
            for line in f:
                token, rank = line.split()
                pieces.append((base64.b64decode(token), int(rank)))
        total = math.log(sum(1.0 / (r + 1) for _, r in pieces))
        self.cost = {t: (round(SCALE * (math.log(r + 1) + total)) << _COUNT) | 1 for t, r in pieces}
        self.width = max(map(len, self.cost))
        keys = np.array([self._hash(t) for t in self.cost], _U)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], _U(2 ** 64 - 1))
        self.costs = np.append(np.fromiter(self.cost.values(), np.int64)[order], 0)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[keys >> _U(42)] = True

    @staticmethod
    def _hash(token: bytes) -> int:
        h = 0
        for b in token:
            h = ((h + b + 1) * int(X._B)) & (2 ** 64 - 1)
        return h

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Forward score of each word's terminal node."""
        size = np.array([len(w) for w in words], np.int64)
        out = np.zeros(len(words), np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        text = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        start = np.cumsum(size) - size
        big = np.int64(1) << 60
        node = np.zeros(len(words), np.int64)  # of each word, at the current level
        # of each node: hashes of its last 1, 2, ... bytes; scores of its ancestors 1, 2, ... up
        tails, above = np.zeros((1, 0), _U), np.zeros((1, 0), np.int64)
        score = np.zeros(1, np.int64)
        for level in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -level, side="left"))  # words longer than the level
            byte = text[start[:m] + level].astype(np.int64)
            edge, at = np.unique(node[:m] * 256 + byte, return_inverse=True)
            parent, byte = edge >> 8, (edge & 255).astype(_U)
            node = at
            k = min(level + 1, self.width)
            old = tails[parent][:, :k - 1]
            tails = np.empty((len(edge), k), _U)
            tails[:, 0] = (byte + _U(1)) * X._B
            # the hash of the last j+1 bytes extends the parent's hash of its last j bytes
            tails[:, 1:] = (old + (byte + _U(1))[:, None]) * X._B
            up = np.empty((len(edge), k), np.int64)
            up[:, 0] = score[parent]
            up[:, 1:] = above[parent][:, :k - 1]
            above = up
            score = np.full(len(edge), big)
            i, j = np.nonzero(self.maybe[tails >> _U(42)])
            h = tails[i, j]
            found = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            ok = self.keys[found] == h
            i, j, found = i[ok], j[ok], found[ok]
            np.minimum.at(score, i, above[i, j] + self.costs[found])
            done = size[:m] == level + 1
            out[order[:m][done]] = score[node[done]]
        return out

    def long_score(self, word: bytes) -> int:
        """Forward score of one word of any length, its token count in the ``WIDE`` low bits."""
        data = np.frombuffer(word, np.uint8).astype(_U) + _U(1)
        few, recent = (1 << _COUNT) - 1, [0]  # scores up to the current place, the newest last
        for lo in range(0, len(data), WINDOW):
            hi = min(lo + WINDOW, len(data))
            tail, power, found = np.zeros(hi - lo, _U), 1, []
            for j in range(min(self.width, hi)):  # tails of j + 1 bytes by the place they end at
                power = power * int(X._B) & (2 ** 64 - 1)
                first = max(lo, j)
                tail[first - lo:] += data[first - j:hi - j] * _U(power)
                h = tail[first - lo:]
                at = np.flatnonzero(self.maybe[h >> _U(42)])
                key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
                ok = self.keys[key] == h[at]
                at = at[ok] + first
                found.append(np.stack([at, np.full(len(at), j), self.costs[key[ok]]]))
            end, back, cost = np.concatenate(found, axis=1)
            order = np.argsort(end, kind="stable")
            shift = len(recent) - lo  # where the score after place 0 would lie
            recent += [1 << 200] * (hi - lo)
            for e, j, c in zip(end[order].tolist(), back[order].tolist(), cost[order].tolist()):
                x = recent[e + shift - j - 1] + ((c >> _COUNT) << WIDE | (c & few))
                if x < recent[e + shift]:
                    recent[e + shift] = x
            recent = recent[-self.width:]
        return recent[-1]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_pretokens, n_tokens, log_prob) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(UnigramTrie(vocabulary))  # its file's size

    def run(batches):
        import regex
        find = regex.compile(PATTERN).findall
        trie, known = shared.value, {}
        few, low = (1 << _COUNT) - 1, (1 << WIDE) - 1
        for rec, data, off in X.blocks(batches, "__text", 2 << 20):
            block = data.tobytes()
            words = [find(block[a:b].decode()) for a, b in zip(off[:-1], off[1:])]
            if len(known) > MAX_KNOWN:
                known.clear()
            new = list(set().union(*words).difference(known))
            large = [w for w in new if len(w) * 4 > LONG and len(w.encode()) > LONG]
            if new:
                small = list(set(new).difference(large))
                got = trie.scores([w.encode() for w in small]).tolist()
                known.update(zip(small, (((x >> _COUNT) << WIDE) | (x & few) for x in got)))
                known.update((w, trie.long_score(w.encode())) for w in large)
            # a document's sum keeps both parts: the count needs fewer than 2^40 tokens
            total = [sum(map(known.__getitem__, w)) for w in words]
            for w in large:
                del known[w]
            n = np.array([t & low for t in total], np.int64)
            cost = np.array([t >> WIDE for t in total], np.float64)
            yield pa.RecordBatch.from_arrays([
                rec.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(n),
                pa.array(-cost / SCALE)], names=[id_col, "n_pretokens", "n_tokens", "log_prob"])

    src = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    return X.map_arrow(src, run, T.StructType([
        T.StructField(id_col, src.schema[0].dataType), T.StructField("n_pretokens", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: token counts of every document."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
