"""MinHash near-dedup of documents by weighted Jaccard (BagMinHash).

A document is the multiset of its five-word shingles (words: runs of letters, digits, ``_``
and non-ASCII bytes, A-Z folded). Two documents are linked when their multiset Jaccard
similarity is at least 0.8; groups are the connected components of the links.

1. Signature. A shingle of weight w runs Poisson processes over the weight axis, one for each
   dyadic interval [0,1), [1,2), [2,4), ... up to w, with the interval's length as rate. A point
   has a time, one of m signature slots and a position in the interval; points at or above w
   are rejected. Each slot keeps its earliest time, so two documents agree in a slot with
   probability equal to their weighted Jaccard similarity. A process stops when its time passes
   the latest slot, which leaves two or three points for a shingle of a usual document.
2. Exact copies share a text hash and stand for one another as one class.
3. Bands of slots give bucket keys. Every class of a bucket is held against the bucket's smallest
   class, then, where several components are left, against a class of the largest, in a few turns. That is
   linear in the bucket and joins most copies. Classes whose buckets still hold several components
   meet in an exact prefix-filtering join on their rarest shingles, which compares only pairs that can
   still reach the threshold; so a group of n copies is not expanded into its pairs, and no
   link between components is lost beyond the bands' own miss rate (7 in 10^5 at the threshold).
4. Pairs whose whole signatures agree too little are dropped; the rest are verified by exact
   multiset overlap.

Defined cases: a null text is an empty text; texts without a word link only to exact copies;
texts of 1 to 4 words are one shingle; repeated rows share a class; a null id never names a
class while another id does; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.llm import textnp as X
from tokenmill.llm.components import connected_components
from tokenmill.plans.prefix import materialize

BANDS, ROWS, SHINGLE, THRESHOLD = 24, 5, 5, 0.8
#: A pair at the threshold agrees in fewer than this share of 120 slots once in about 10^5 times.
MIN_AGREEMENT = 0.64
TURNS = 2
MAX_SENT_CLASSES = 2_000_000  # (key, id) rows, about 100 MB as a broadcast table
_U = np.uint64
_GOLD, _C2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def multiset(sh: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with its count, ordered by row."""
    if not len(sh):
        return sh, row, np.zeros(0, np.int64)
    # one integer sort: the row above the shingle's upper bits, which tell shingles of one row apart
    order = np.argsort((row.astype(_U) << _U(40)) | (sh >> _U(24)))
    sh, row = sh[order], row[order]
    first = np.flatnonzero(np.r_[True, (sh[1:] != sh[:-1]) | (row[1:] != row[:-1])])
    return sh[first], row[first], np.diff(np.r_[first, len(sh)])


def bag_minhash(sh: np.ndarray, row: np.ndarray, weight: np.ndarray, n_rows: int,
                m: int, seed: int = 1) -> np.ndarray:
    """[n_rows, m] earliest times; a row without shingles keeps infinity."""
    sig = np.full(n_rows * m, np.inf)
    top = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64)
    item = np.repeat(np.arange(len(sh)), top + 1)
    level = np.arange(len(item)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(level == 0, 0.0, np.exp2(level - 1.0))
    rate = np.where(level == 0, 1.0, np.exp2(level - 1.0))
    key = X.mix64(sh[item] + level.astype(_U) * _C2 + _U(seed))
    r, w = row[item], weight[item].astype(np.float64)
    # how many points a process needs at first, from the document's total weight
    mass = np.bincount(row, weights=weight, minlength=n_rows)
    need = m * (math.log(m) + 2.0) / np.maximum(mass[r], 1.0) * rate
    size = np.clip(np.ceil(np.log2(np.maximum(need, 1.0))), 0, 10).astype(np.int64)
    for c in np.unique(size):
        i = np.flatnonzero(size == c)
        g = 1 << int(c)
        at, done = np.zeros(len(i)), 0
        while len(i):
            z = X.mix64(key[i][:, None] + (np.arange(done + 1, done + g + 1, dtype=_U) * _GOLD))
            t = -np.log(((z >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / rate[i][:, None]
            t[:, 0] += at
            np.cumsum(t, axis=1, out=t)  # sequential, so equal in every document
            z = X.mix64(z ^ _C2)
            slot = ((z >> _U(32)) * _U(m)) >> _U(32)
            where = (z & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 * rate[i][:, None]
            ok = where + low[i][:, None] < w[i][:, None]
            np.minimum.at(sig, ((r[i] * m)[:, None] + slot.astype(np.int64))[ok], t[ok])
            done += g
            last = sig.reshape(n_rows, m).max(axis=1)
            more = t[:, -1] < last[r[i]]
            at, i = t[:, -1][more], i[more]
    return sig.reshape(n_rows, m)


def _document_shingles(data: np.ndarray, off: np.ndarray, k: int):
    _, _, h, first = X.words(data, off, X.ALNUM)
    return multiset(*X.shingles(h, first, k))


def _signature_rows(bands: int, rows: int, k: int, seed: int):
    m = bands * rows

    def run(batches):
        for rec, data, off in X.blocks(batches, "__text", 2 << 20):
            n = rec.num_rows
            sh, row, weight = _document_shingles(data, off, k)
            bits = bag_minhash(sh, row, weight, n, m, seed).view(_U)
            keys = np.empty((n, bands), _U)
            for j in range(bands):
                x = np.full(n, j + 1, _U)
                for s in range(rows):
                    x = X.mix64(x * X._B + bits[:, j * rows + s])
                keys[:, j] = x
            has = np.bincount(row, minlength=n) > 0
            short = (X.mix64(bits) >> _U(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([
                rec.column(0), rec.column(1),
                X.list_array(keys[has].view(np.int64).ravel(), np.where(has, bands, 0), pa.int64()),
                pa.array([s.tobytes() if ok else b"" for s, ok in zip(short, has)], pa.binary()),
            ], names=["id", "node", "bands", "sig"])
    return run


def _overlap_rows(k: int):
    def run(batches):
        for rec, data, off in X.blocks(batches, "__text", 2 << 20):
            sh, row, weight = _document_shingles(data, off, k)
            item = np.repeat(np.arange(len(sh)), weight)
            nth = np.arange(len(item)) - np.repeat(np.cumsum(weight) - weight, weight)
            ids = X.mix64(sh[item] + nth.astype(_U) * _C2)  # the nth copy of a shingle is an item
            yield pa.RecordBatch.from_arrays([
                rec.column(0),
                X.list_array(ids.view(np.int64), np.bincount(row[item], minlength=rec.num_rows),
                             pa.int64()),
            ], names=["node", "items"])
    return run


def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), np.uint32).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), np.uint32).reshape(len(b), -1)
    return pd.Series((x == y).mean(axis=1))


def _class_key(text: Column) -> Column:
    """The key of a class of exact copies. 60 bits of MD5: with 10^9 different texts the chance
    that any two share a key is below one half; such a pair would count as copies."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), _class_key(text).alias("node"),
                       text.alias("__text"))


def _leaders(rest: DataFrame, by: str, turn: int = 0) -> DataFrame:
    """(by, main, chief) of the keys that hold several components: the largest of them and a class
    of it, which ``turn`` varies."""
    sizes = rest.groupBy(by, "component").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("m"))
    return sizes.groupBy(by).agg(
        F.max_by(F.struct("component", "m"), F.struct("n", "component")).alias("b"),
        F.count(F.lit(1)).alias("parts")).where("parts > 1").select(
        by, F.col("b.component").alias("main"), F.col("b.m").alias("chief"))


def _prefix_pairs(rest: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``rest`` (node, component) in different components that can reach the
    threshold, exactly, by prefix filtering: with every class's items in one order, rare ones
    first, two similar classes share an item among their first size - ceil(t * size) + 1, and from
    its places at least ceil(t / (1 + t) * (sizes)) items must still be common. Classes whose
    differences are their own (edited copies, shared passages) have no such item and meet nobody."""
    flat = materialize(items.join(rest, "node", "left_semi").select(
        "node", F.size("items").alias("size"), F.explode("items").alias("item")), "flat")
    often = flat.groupBy("item").agg(F.count(F.lit(1)).alias("f"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("f", "item"))
    first = (flat.join(often, "item").withColumn("place", place)
             .where((F.col("f") > 1) & (F.col("place") <= F.col("size")
                                        - F.ceil(F.col("size") * threshold) + 1)))
    first = materialize(first.join(rest, "node").select("node", "component", "item", "place", "size"),
                        "prefixes")
    several = first.join(_leaders(first, "item"), "item")
    x = several.where("component <> main").select(
        "item", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("place").alias("pa"),
        F.col("size").alias("sa"))
    y = several.select(
        "item", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("place").alias("pb"),
        F.col("size").alias("sb"), (F.col("component") == F.col("main")).alias("big"))
    left = F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb")) + 1
    need = F.ceil((F.col("sa") + F.col("sb")) * (threshold / (1 + threshold)) - 1e-9)
    return (x.join(y, "item").where("ca <> cb and (big or a < b)").where(left >= need)
            .where((F.col("sa") >= threshold * F.col("sb")) & (F.col("sb") >= threshold * F.col("sa")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _similar(pairs: DataFrame, signatures: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes whose multiset Jaccard similarity reaches the threshold."""
    def side(table, end, column, name):
        return table.select(F.col("node").alias(end), F.col(column).alias(name))

    likely = materialize(
        pairs.join(side(signatures, "a", "sig", "sa"), "a").join(side(signatures, "b", "sig", "sb"), "b")
        .where(F.pandas_udf(_agreement, "double")("sa", "sb") >= MIN_AGREEMENT).select("a", "b"), "likely")
    common = F.size(F.array_intersect("x", "y"))
    return (likely.join(side(items, "a", "items", "x"), "a").join(side(items, "b", "items", "y"), "b")
            .select("a", "b", common.alias("n"), (F.size("x") + F.size("y")).alias("s"))
            .where(F.col("n") >= threshold * (F.col("s") - F.col("n")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    k: int = SHINGLE, seed: int = 1) -> DataFrame:
    """One row per document: id, class_key (of its exact copies), class_id (the class's smallest
    id), component_id (the smallest id of its group), kept (it is that row of the group)."""
    keyed = _keyed(docs, id_col, text_col)
    kind = T.StructType([T.StructField("id", keyed.schema["id"].dataType),
                         T.StructField("node", T.LongType()),
                         T.StructField("bands", T.ArrayType(T.LongType())),
                         T.StructField("sig", T.BinaryType())])
    raw = materialize(X.map_arrow(keyed, _signature_rows(bands, rows, k, seed), kind), "bagminhash")
    classes = materialize(raw.groupBy("node").agg(F.min("id").alias("class_id")), "classes")

    in_band = raw.select(F.explode("bands").alias("band"), "node").distinct()
    shared = in_band.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")
                                         ).where("lo <> hi")
    member = materialize(in_band.join(shared.select("band", "lo"), "band"), "buckets")
    # signature and items of the classes that share a bucket, made once
    used = materialize(member.select("node").distinct().join(classes, "node"), "used")
    signatures = materialize(raw.select("node", "sig").join(used, "node", "left_semi")
                             .dropDuplicates(["node"]), "signatures")
    # the narrow class table goes to the texts while it is small; beyond that both are shuffled
    named = F.broadcast(used) if used.count() <= MAX_SENT_CLASSES else used
    items = materialize(X.map_arrow(
        keyed.join(named, (keyed["node"] == used["node"]) & keyed["id"].eqNullSafe(used["class_id"]),
                   "left_semi").select("node", "__text"),
        _overlap_rows(k), "node long, items array<long>").dropDuplicates(["node"]), "items")
    star = materialize(
        member.where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct(),
        "pairs")
    links = materialize(_similar(star, signatures, items, threshold), "links")
    comp = connected_components(links)

    def with_components(rows):
        return rows.join(comp, "node", "left").select(
            *rows.columns, F.coalesce("component", "node").alias("component"))

    # more rounds: every class against a class of its bucket's largest component, another each time
    tested = star
    for turn in range(TURNS):
        rest = with_components(member.select("band", "node"))
        again = materialize(
            rest.join(_leaders(rest, "band", turn), "band").where("component <> main")
            .select(F.least("node", "chief").alias("a"), F.greatest("node", "chief").alias("b"))
            .distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if again.isEmpty():
            break
        tested = tested.union(again)
        found = materialize(_similar(again, signatures, items, threshold), "links")
        if found.isEmpty():
            break
        links = links.union(found)
        comp = connected_components(links)

    # what is left: classes that share a bucket with another component
    rest = with_components(member.select("band", "node"))
    open_ = materialize(with_components(rest.join(_leaders(rest, "band"), "band", "left_semi")
                                        .select("node").distinct()), "open")
    last = materialize(_prefix_pairs(open_, items, threshold)
                       .join(tested, ["a", "b"], "left_anti"), "pairs")
    if not last.isEmpty():
        more = materialize(_similar(last, signatures, items, threshold), "links")
        if not more.isEmpty():
            comp = connected_components(links.union(more))

    named = (comp.join(classes, "node").groupBy("component")
             .agg(F.min(F.struct(F.col("class_id").isNull().alias("x"), "class_id", "node")
                        ).alias("best")))
    comp = comp.join(named, "component").select(
        "node", F.col("best.class_id").alias("component_id"), F.col("best.node").alias("best"))
    per_class = classes.join(comp, "node", "left").select(
        "node", "class_id",
        F.when(F.col("best").isNull(), F.col("class_id")).otherwise(F.col("component_id")
                                                                    ).alias("component_id"),
        F.coalesce("best", "node").alias("best"))
    return raw.select("id", "node").join(per_class, "node").select(
        F.col("id").alias(id_col), F.col("node").alias("class_key"), "class_id", "component_id",
        (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("best"))
         ).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row left of each group; all columns stay, repeated rows go.

    Of rows with equal id and text but other columns that differ, any one stays.
    """
    kept = near_duplicates(docs, id_col, text_col, **kw).where("kept").select(
        F.col(id_col).alias("__id"), F.col("class_key").alias("__class")).distinct()
    rows = docs.withColumn("__key", _class_key(F.col(text_col)))
    out = rows.join(kept, (rows["__key"] == kept["__class"])
                    & rows[id_col].eqNullSafe(kept["__id"]), "left_semi")
    return out.dropDuplicates(["__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every document with its class of exact copies and its group of near copies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "class_id", "component_id", "kept")
