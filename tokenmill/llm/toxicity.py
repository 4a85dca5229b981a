"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Lexicon. A few seed words per language are fixed; the rest is induced from all labelled training rows
but the quarter kept for calibration: word stems (the first 4 to 8 bytes, or the whole word) whose document frequency among toxic rows
exceeds that among others with a high z-score, every one that does. A stem's weight is its log ratio; a word's weight is the
largest of its stems. Stems are held as 64-bit hashes.

Features of a whole text, dense: densities and counts of lexicon words (strong, weak, weighted), the
share of them with a second-person word within three words, capitals, words in capitals, ! and ?,
other punctuation, and obfuscation: words mixing letters with digits or symbols, such words that
become lexicon words when digits are read as letters, runs of single letters, stretched letters.

Trees (Spark ML) are fitted on a sample of at most about ``MAX_FIT`` labelled rows (the bound is that
parameter; a hash of the id decides); a quarter of it is kept from the trees to fit the isotonic map from
their score to a probability. Every document is scored.

Defined cases: a null or empty text has zero features and gets their score; null ids are scored, not
learnt from; repeated ids in labels count once (toxic if any says so); without both classes among
the labelled rows the score is the share of toxic ones (0.5 without labels); extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X
from tokenmill.llm.quality import fold, hash_share
from tokenmill.plans.prefix import materialize

MAX_FIT = 12_000
# Labelled ids up to this many rows travel to the texts (about 100 MB); beyond it the texts are
# shuffled to the labels once. Both give the same rows.
MAX_SENT_LABELS = 2_000_000
STEMS = (4, 5, 6, 7, 8)
FLAG_AT = 0.7
_U = np.uint64

# Seed insults and second-person words.
SEEDS = ("idiot", "idiots", "stupid", "moron", "morons", "loser", "losers", "scum", "trash", "pathetic",
         "worthless", "disgusting", "clown", "dumb", "imbecile", "bastard", "bitch", "asshole", "fuck",
         "fucking", "shit", "whore", "retard", "arschloch", "dummkopf", "schlampe", "abschaum",
         "scheisse", "hurensohn", "connard", "salaud", "salope", "merde", "imbécile", "abruti",
         "idiota", "imbécil", "estúpido", "puta", "mierda", "cabrón", "gilipollas", "basura")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "youre", "du", "dich", "dir", "dein",
                 "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti",
                 "usted", "ustedes", "tus", "vosotros")
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"01345789$@!", b"oieastbgsai"):
    _LEET[_a] = _b
_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123, 128:256]] = True
_ODD = np.isin(np.arange(256), list(b"0123456789$@!*#%"))
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.isin(np.arange(256), list(b"!?"))
_PUNCT = np.isin(np.arange(256), list(b".,;:'\"()[]-#$%&*+/<=>@\\^_`{|}~"))
_INWORD = X.ALNUM | np.isin(np.arange(256), list(b"$@!*"))
N_FEATURES = 17


def _hashes(words) -> np.ndarray:
    data = [w.encode() for w in words]
    end = np.cumsum([len(d) for d in data])
    return X.hash_spans(np.frombuffer(b"".join(data), np.uint8),
                        end - [len(d) for d in data], end, seed=99)


SECOND_HASHES = np.sort(_hashes(SECOND_PERSON))


def _stems(data, s, e):
    """[words, stems] hashes: prefixes (0 where the word is no longer), then the whole word."""
    out = np.zeros((len(s), len(STEMS) + 1), _U)
    for j, k in enumerate(STEMS):
        longer = e - s > k
        out[longer, j] = X.hash_spans(data, s[longer], s[longer] + k, seed=k)
    out[:, -1] = X.hash_spans(data, s, e, seed=99)
    return out


def _weights(stems: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Largest lexicon weight among each word's stems."""
    at = np.minimum(np.searchsorted(keys, stems), len(keys) - 1)
    return np.where(keys[at] == stems, values[at], 0.0).max(axis=1)


def text_features(data: np.ndarray, off: np.ndarray, keys: np.ndarray, values: np.ndarray
                  ) -> np.ndarray:
    n, size = len(off) - 1, np.diff(off)
    chars = np.maximum(size, 1)

    def bytes_of(member):
        c = np.zeros(len(data) + 1, np.int64)
        np.cumsum(member[data], out=c[1:])
        return c[off[1:]] - c[off[:-1]]

    s, e = X.spans(data, off, X.ALNUM)
    first = np.searchsorted(s, off)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words)
    nw = np.maximum(words, 1)
    stems = _stems(data, s, e)
    weight = _weights(stems, keys, values)
    strong, weak = weight >= 3.0, (weight > 0) & (weight < 3.0)

    def per_row(x):
        return np.bincount(row, weights=x, minlength=n)

    you = np.isin(stems[:, -1], SECOND_HASHES)
    near = np.zeros(len(s), bool)
    for d in (1, 2, 3):
        near[d:] |= you[:-d] & (row[d:] == row[:-d])
        near[:-d] |= you[d:] & (row[:-d] == row[d:])
    hot = weight > 0
    length = e - s
    capital = np.add.reduceat(_UPPER[data].astype(np.int64), s) if len(s) else np.zeros(0)
    if len(s):  # reduceat runs to the next start; gaps hold no capitals
        shout = (capital >= length) & (length >= 3)
        single = length == 1
        lone = single.copy()
        lone[1:] &= single[:-1] & (row[1:] == row[:-1])
    else:
        shout = lone = np.zeros(0, bool)
    # mixed words, read again with digits and signs as letters
    ms, me = X.spans(data, off, _INWORD)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ODD[data], out=odd[1:])
    mixed = (letters[me] - letters[ms] >= 2) & (odd[me - 1] - odd[ms] >= 1)
    ms, me = ms[mixed], me[mixed]
    mrow = np.searchsorted(off, ms, side="right") - 1
    cloaked = (_weights(_stems(_LEET[data], ms, me), keys, values) > 0 if len(ms)
               else np.zeros(0, bool))
    stretched = np.zeros(len(data) + 1, np.int64)
    if len(data) > 2:
        same = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]
        np.cumsum(same, out=stretched[3:])
    total = per_row(weight)
    return np.stack([
        per_row(strong) / nw, np.log1p(per_row(strong)), per_row(weak) / nw, np.log1p(per_row(weak)),
        total / nw, np.log1p(total), per_row(hot & near) / nw, per_row(hot & near) / np.maximum(per_row(hot), 1),
        per_row(you) / nw, bytes_of(_UPPER) / chars, per_row(shout) / nw, bytes_of(_MARK) / chars,
        bytes_of(_PUNCT) / chars, np.bincount(mrow, minlength=n) / nw,
        np.log1p(np.bincount(mrow, weights=cloaked, minlength=n)), per_row(lone) / nw,
        (stretched[off[1:]] - stretched[off[:-1]]) / chars,
    ], axis=1)


def _stem_counts(batches):
    """(stem, toxic documents, other documents) of the block."""
    for rec, data, off in X.blocks(batches, "__text"):
        toxic = np.array(rec.column(0).to_pylist(), bool)
        s, e = X.spans(data, off, X.ALNUM)
        row = np.repeat(np.arange(rec.num_rows), np.diff(np.searchsorted(s, off)))
        stems = _stems(data, s, e)
        key = np.repeat(row, stems.shape[1])
        flat = stems.ravel()
        used = flat != 0
        order = np.lexsort((key[used], flat[used]))
        k, f = key[used][order], flat[used][order]
        if not len(f):
            continue
        once = np.r_[True, (f[1:] != f[:-1]) | (k[1:] != k[:-1])]
        k, f = k[once], f[once]
        start = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
        yes = np.add.reduceat(toxic[k].astype(np.int64), start)
        every = np.diff(np.r_[start, len(f)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(f[start].view(np.int64)), pa.array(yes), pa.array(every - yes)],
            names=["stem", "yes", "no"])


def induce_lexicon(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted stem hashes, weights) from (toxic, __text) rows, with the seeds."""
    n = labelled.select("toxic").agg(F.sum(F.col("toxic").cast("long")).alias("yes"),
                                     F.count(F.lit(1)).alias("all")).first()
    yes, no = n["yes"] or 0, n["all"] - (n["yes"] or 0)
    keys, values = [h for h in _hashes(SEEDS)], [4.0] * len(SEEDS)
    if yes and no:
        a, b = F.col("yes") + 0.5, F.col("no") + 0.5
        ratio = F.log(a / (yes + 1)) - F.log(b / (no + 1))
        best = X.collected(X.map_arrow(labelled.select("toxic", "__text"), _stem_counts,
                            "stem long, yes long, no long")
                .groupBy("stem").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
                .withColumn("w", ratio).withColumn("z", F.col("w") / F.sqrt(1 / a + 1 / b))
                .where("yes >= 4 and w >= 1.0 and z >= 4.0").select("stem", "w"))
        keys = np.r_[keys, best["stem"].astype(np.int64).view(_U)]
        values = np.r_[values, np.minimum(best["w"], 6.0)]
    keys, values = np.array(keys, _U), np.array(values)
    order = np.lexsort((-values, keys))
    keys, values = keys[order], values[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    return keys[first], values[first]


def features_of(docs: DataFrame, lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    keys, values = lexicon

    def run(batches):
        for rec, data, off in X.blocks(batches, "__text"):
            f = text_features(data, off, keys, values)
            yield pa.RecordBatch.from_arrays(
                [rec.column(0), X.list_array(f.ravel(), np.full(len(f), N_FEATURES), pa.float64())],
                names=["id", "f"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
    return X.map_arrow(src, run, T.StructType([
        T.StructField("id", src.schema["id"].dataType),
        T.StructField("f", T.ArrayType(T.DoubleType()))]))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
                   id_col: str = "doc_id", text_col: str = "text", max_fit: int = MAX_FIT) -> DataFrame:
    """(id, held_out, score, predicted) for every document; labels: (id, toxic)."""
    def out(c: Column) -> Column:
        return fold(c, folds) == held

    rows = labels.where(~out(F.col("id"))).groupBy("id").agg(F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.where("toxic is not null")
    rows = materialize(rows, "labels")
    n_rows = rows.count()
    share = min(1.0, max_fit / max(n_rows, 1))
    sample = rows.where(hash_share(F.col("id"), share, 9))  # bounded: about max_fit rows
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
    part = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(4))
    learn = rows.where(part != 0)
    lexicon = induce_lexicon(text.join(F.broadcast(learn) if n_rows <= MAX_SENT_LABELS else learn, "id"))
    sample = materialize(text.join(F.broadcast(sample), "id").withColumn("part", part), "labelled")
    feats = materialize(features_of(docs, lexicon, id_col, text_col), "features")
    held_out = F.coalesce(out(F.col("id")), F.lit(False)).alias("held_out")

    known = materialize(features_of(sample, lexicon, "id", "__text").join(
        sample.select("id", "toxic", "part").distinct(), "id"), "fit").select(
        array_to_vector("f").alias("features"), F.col("toxic").cast("double").alias("label"), "part")
    n = {(r["kept"], r["label"]): r["count"] for r in known.groupBy(
        (F.col("part") == 0).alias("kept"), "label").count().collect()}  # at most four rows
    if not (n.get((False, 0.0)) and n.get((False, 1.0))):
        every = sum(n.values())
        flat = sum(v for (_, y), v in n.items() if y == 1.0) / every if every else 0.5
        scored = feats.select("id", held_out, F.lit(float(flat)).alias("score"))
    else:
        trees = GBTClassifier(maxIter=20, maxDepth=4, maxBins=64, stepSize=0.2, seed=1,
                              minInstancesPerNode=5).fit(known.where("part <> 0").coalesce(4))

        def raw(df):
            return trees.transform(df).withColumn("raw", vector_to_array("probability")[1])

        calibrate = known if not n.get((True, 1.0)) else known.where("part = 0")
        iso = IsotonicRegression(featuresCol="raw", predictionCol="score").fit(
            raw(calibrate).select("raw", "label").coalesce(4))
        scored = raw(feats.select("id", array_to_vector("f").alias("features")))
        # a little of the trees' own order is kept inside the flat steps of the isotonic map
        scored = iso.transform(scored).select(
            "id", held_out, (0.9 * F.col("score") + 0.1 * F.col("raw")).alias("score"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score",
                         (F.col("score") >= FLAG_AT).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: toxicity score of every document, learnt from rows with crc32(doc_id) mod 3 <> 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), "toxic")
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
