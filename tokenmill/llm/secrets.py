"""Secret scan: base patterns plus a randomness test battery with false-discovery control.

Base kinds, leftmost and non-overlapping for each kind: ``assign`` (a password-like key set to a
value of 8+ characters), ``access`` (AKIA..., 16+ characters), ``hex`` (32+ hex digits).

Battery. Every maximal run of 20+ characters of [A-Za-z0-9+/_=-] is cut at inner '=' (padding stays);
parts of 20+ characters are candidates. A part that fits no one encoding is cut at '/' (at '-' and '_' when
it holds a '+'); the parts of 20+ characters of that, and those between all of '/', '-' and '_', are the
candidates then, and of nested ones the longest accepted counts. A candidate's encoding is inferred (hex, base32, base62, base64) and its symbols are tested against uniform random ones:
chi-squared over character kinds and over eighths of the alphabet, a runs test around the middle
of the alphabet, and lag-1 serial correlation. The smallest of the four p-values, corrected for
their number, is the candidate's p: uniform for random strings, near 0 for ordinary words.

False-discovery control, aware of length. Candidates of the whole corpus are counted by stratum
(encoding, length class) and p. Twice the number at p >= 0.5 estimates the random strings of a
stratum; the threshold is the smallest p above which the excess over their uniform share is at
most 10%. Long strata have sharper tests, so their thresholds are lower.

Defined cases: null text is empty; positions count code points, ends are exclusive; candidates that
touch a base span add nothing; text without candidates has no spans; repeated rows are scanned
each; extra columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X

# The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    rb"""([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
BASE_KINDS = ("assign", "access", "hex")
_HINT = re.compile(rb"passw|secret|token|api_?key|AKIA", re.I)

MIN_RUN = 20
FDR = 0.10
EDGES = [0.0, 0.001, 0.01, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]
LENGTHS = (32, 48, 96)
MASK = "[SECRET]"
_PATH_PARTS, _PLUS_PARTS, _SMALL_PARTS = (re.compile(x) for x in (rb"[^/]+", rb"[^_-]+", rb"[^/_-]+"))

_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_RUN = np.isin(np.arange(256), list(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"))


def _alphabet(symbols: bytes) -> np.ndarray:
    a = np.full(256, -1, np.int64)
    a[np.frombuffer(symbols, np.uint8)] = np.arange(len(symbols))
    return a


_UP, _LOW, _DIG = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_ENCODINGS = (
    ("hex", (_alphabet(_DIG + b"abcdef"), _alphabet(_DIG + b"ABCDEF")), (10, 6)),
    ("base32", (_alphabet(_UP + b"234567"),), (26, 6)),
    ("base62", (_alphabet(_UP + _LOW + _DIG),), (26, 26, 10)),
    ("base64", (_alphabet(_UP + _LOW + _DIG + b"+/"), _alphabet(_UP + _LOW + _DIG + b"-_")),
     (26, 26, 10, 2)),
)


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the Wilson-Hilferty cube root."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(s: bytes) -> tuple[str, float] | None:
    """(encoding, p) of a run: p is small when it does not look like uniform random symbols."""
    raw = np.frombuffer(s.rstrip(b"="), np.uint8)
    n = len(raw)
    if n < MIN_RUN:
        return None
    for name, tables, kinds in _ENCODINGS:
        v = next((t[raw] for t in tables if (t[raw] >= 0).all()), None)
        if v is not None:
            break
    else:
        return None
    size = sum(kinds)
    share = np.array(kinds) / size
    seen = np.bincount(np.searchsorted(np.cumsum(kinds), v, side="right"), minlength=len(kinds))
    p = [_chi2_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), len(kinds) - 1)]
    eighth = np.bincount(v * 8 // size, minlength=8)
    width = np.bincount(np.arange(size) * 8 // size, minlength=8) / size
    p.append(_chi2_tail(float(((eighth - n * width) ** 2 / (n * width)).sum()), 7))
    high = v * 2 >= size
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p.append(math.erfc(abs(runs - mean) / math.sqrt(2 * var)))
    else:
        p.append(2.0 ** (1 - n))
    c = v - v.mean()
    total = float((c * c).sum())
    r = float((c[1:] * c[:-1]).sum()) / total if total else 1.0
    p.append(math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2)))
    least = min(max(min(p), 0.0), 1.0)
    return name, 1 - (1 - least) ** len(p)


def _tested(run: bytes):
    """(start, end, encoding, p) of the candidates of a run."""
    stop, at = len(run.rstrip(b"=")), 0
    for piece in run[:stop].split(b"="):
        a, b = at, at + len(piece)
        at = b + 1
        if b - a < MIN_RUN:
            continue
        b = len(run) if b == stop else b
        got = randomness(run[a:b])
        if got:
            yield a, b, *got
            continue
        wide = _PLUS_PARTS if b"+" in piece else _PATH_PARTS
        for x, y in sorted({m.span() for parts in (wide, _SMALL_PARTS)
                            for m in parts.finditer(run[a:b])}):
            got = randomness(run[a + x:a + y])
            if got:
                yield a + x, a + y, *got


def _candidates(data, off):
    """(row, start byte, end byte, stratum, p) of the block's candidates."""
    s, e = X.spans(data, off, _RUN)
    keep = e - s >= MIN_RUN
    s, e = s[keep], e[keep]
    rows = np.searchsorted(off, s, side="right") - 1
    for i, a, b in zip(rows, s, e):
        for x, y, name, p in _tested(data[a:b].tobytes()):
            yield int(i), int(a) + x, int(a) + y, f"{name}:{sum(y - x >= n for n in LENGTHS)}", p


def _histogram(batches):
    for _, data, off in X.blocks(batches, "__text"):
        found = [(c[3], int(np.searchsorted(EDGES, c[4], side="right")) - 1)
                 for c in _candidates(data, off)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.int32())], names=["stratum", "bin"])


def thresholds(docs: DataFrame, text_col: str = "text", fdr: float = FDR) -> dict[str, float]:
    """The least accepted p of each stratum, from the counts of the whole corpus."""
    counts = X.map_arrow(docs.select(F.col(text_col).alias("__text")), _histogram,
                         "stratum string, bin int").groupBy("stratum", "bin").count()
    strata: dict[str, np.ndarray] = {}
    for r in counts.collect():  # at most 16 strata x 13 bins
        strata.setdefault(r["stratum"], np.zeros(len(EDGES)))[r["bin"]] += r["count"]
    out = {}
    for name, n in strata.items():
        random = 2 * n[-1]
        above = np.cumsum(n[::-1])[::-1]
        excess = np.maximum(0.0, above - (1 - np.array(EDGES)) * random)
        good = [t for t, a, x in zip(EDGES, above, excess) if t > 0 and a and x <= fdr * a]
        out[name] = min(good, default=0.5)
    return out


def find_spans(data: np.ndarray, off: np.ndarray, limits: dict[str, float]
               ) -> dict[int, list[tuple[int, int, int]]]:
    """row -> [(start byte, end byte, kind)], kinds 0..2 base, 3 random; within the row."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    s, e = X.spans(data, off, _HEX)
    keep = e - s >= MIN_HEX
    rows = np.searchsorted(off, s[keep], side="right") - 1
    for i, a, b in zip(rows, s[keep], e[keep]):
        found.setdefault(int(i), []).append((int(a - off[i]), int(b - off[i]), 2))
    block = data.tobytes()
    hinted = {int(np.searchsorted(off, m.start(), side="right")) - 1 for m in _HINT.finditer(block)}
    for i in hinted:
        row = block[off[i]:off[i + 1]]
        own = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(row)
               if m.end(2) - m.start(2) >= MIN_ASSIGN]
        own += [(m.start(), m.end(), 1) for m in ACCESS.finditer(row)
                if m.end() - m.start() >= MIN_ACCESS]
        if own:
            found.setdefault(i, []).extend(own)
    longest = sorted(_candidates(data, off), key=lambda c: c[1] - c[2])  # first among nested ones
    for i, a, b, stratum, p in longest:
        a, b = a - int(off[i]), b - int(off[i])
        if p >= limits.get(stratum, 0.5) and not any(
                x < b and a < y for x, y, _ in found.get(i, ())):
            found.setdefault(i, []).append((a, b, 3))
    return {i: sorted(v, key=lambda t: (t[0], t[2])) for i, v in found.items()}


def _point(row: np.ndarray, at: int) -> int:
    """Byte position -> code points before it."""
    return int(np.count_nonzero((row[:at] & 0xC0) != 0x80))


SPAN = "array<struct<kind:string,start:int,end:int>>"
KINDS = (*BASE_KINDS, "random")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fdr: float = FDR) -> DataFrame:
    """(id, spans): every secret of every document, by start, then kind as listed."""
    limits = thresholds(docs, text_col, fdr)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for rec, data, off in X.blocks(batches, "__text"):
            found = find_spans(data, off, limits)
            spans = [[] for _ in range(rec.num_rows)]
            for i, own in found.items():
                row = data[off[i]:off[i + 1]]
                spans[i] = [{"kind": KINDS[k], "start": _point(row, a), "end": _point(row, b)}
                            for a, b, k in own]
            yield pa.RecordBatch.from_arrays(
                [rec.column(0), pa.array(spans, pa.list_(kind))], names=[id_col, "spans"])

    src = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = T.StructType([T.StructField(id_col, src.schema[0].dataType),
                           T.StructField("spans", T.ArrayType(T.StructType([
                               T.StructField("kind", T.StringType()),
                               T.StructField("start", T.IntegerType()),
                               T.StructField("end", T.IntegerType())])))])
    return X.map_arrow(src, run, schema)


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
           fdr: float = FDR) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK``; a length column follows the text."""
    limits = thresholds(docs, text_col, fdr)

    def run(batches):
        for rec, data, off in X.blocks(batches, text_col):
            found = find_spans(data, off, limits)
            at = rec.schema.get_field_index(text_col)
            texts, new = rec.column(at).to_pylist(), {}
            for i, own in found.items():
                raw, parts, end = data[off[i]:off[i + 1]].tobytes(), [], 0
                for a, b, _ in own:
                    if b <= end:
                        continue
                    if a >= end:
                        parts += [raw[end:a], MASK.encode()]
                    end = b
                new[i] = texts[i] = b"".join([*parts, raw[end:]]).decode()
            cols = list(rec.columns)
            cols[at] = pa.array(texts, rec.schema.field(at).type)
            n_at = rec.schema.get_field_index(length_col)
            if n_at >= 0 and pa.types.is_integer(rec.schema.field(n_at).type):
                sizes = rec.column(n_at).to_pylist()
                for i, text in new.items():
                    sizes[i] = len(text)
                cols[n_at] = pa.array(sizes, rec.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=rec.schema)

    return X.map_arrow(docs, run, docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: secret spans of every document."""
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
