"""Embedding near-dedup by collision counting over sorted one-dimensional projections.

Each of T tables orders the unit vectors by (cell, projection): a random direction gives the
projection, b random hyperplanes of the table's own give the cell, so that an order holds a
roughly constant number of vectors near a place however many rows there are. A pair collides in
a table when both are in one cell and each lies in the window of half-width ``WINDOW`` centred at the
other's projection. Pairs that collide in at least ``MIN_COLLISIONS`` tables are verified by cosine in
double precision.

Calibration. Two vectors at the threshold angle a are at distance 2 sin(a/2); they collide in a
table with probability (1 - a/pi)^b * P(|N(0,1)| <= WINDOW / distance). T is the least number of tables
for which a Binomial(T, that) reaches the count with probability ``RECALL``; closer pairs do better.

Windows become equi-joins on intervals of width WINDOW: a vector is in its own interval and meets
the next one. Tight groups do not become pairs: vectors within half the threshold angle of one
common leader are all linked by the triangle inequality, so a group is counted, not expanded;
only pairs of different groups are counted and verified.

Defined cases: null, zero or non-finite vectors, and vectors with null components, link with
nothing; vectors of different length never link; every row is a vector of its own, numbered when it is
read, so rows that share an id are compared and counted one by one (equal rows link with each other);
null ids link with nothing; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import textnp as X
from tokenmill.llm.components import connected_components
from tokenmill.plans.prefix import materialize

THRESHOLD, WINDOW, MIN_COLLISIONS, RECALL = 0.9, 0.7, 2, 0.99
LEADER_TABLES = 8
_U = np.uint64


def calibrate(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(hyperplanes b, tables T) for n vectors."""
    angle = math.acos(threshold)
    near = math.erf(WINDOW / (2 * math.sin(angle / 2)) / math.sqrt(2))
    b = int(min(max(round(math.log2(max(n, 2))) - 3, 2), 32))
    p = (1 - angle / math.pi) ** b * near
    t = MIN_COLLISIONS
    while sum(math.comb(t, k) * p ** k * (1 - p) ** (t - k)
              for k in range(MIN_COLLISIONS)) > 1 - recall:
        t += 1
    return b, t


def _projections(dim: int, tables: int, b: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables)), rng.standard_normal((dim, tables * b))


def _cells(tables: int, b: int, seed: int):
    """Rows (id, table cell, projection) of a batch of vectors."""
    def run(batches):
        for rec in batches:
            ids = rec.column(0).to_numpy(zero_copy_only=False)
            vec = rec.column(1)
            values = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(vec.offsets.to_numpy()).astype(np.int64)
            ends = np.cumsum(size)
            for dim in np.unique(size):
                pick = np.flatnonzero(size == dim)
                v = values[(ends[pick] - dim)[:, None] + np.arange(dim)]
                v = v / np.linalg.norm(v, axis=1, keepdims=True)
                line, planes = _projections(int(dim), tables, b, seed)
                side = ((v @ planes) >= 0).reshape(len(v), tables, b)
                code = (side @ (np.uint64(1) << np.arange(b, dtype=_U))).astype(_U)
                cell = X.mix64(code + X.mix64(np.arange(tables, dtype=_U) + _U(int(dim) << 20)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids[pick], tables)),
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), len(pick))),
                    pa.array(cell.view(np.int64).ravel()), pa.array((v @ line).ravel())],
                    names=["id", "t", "cell", "proj"])
    return run


def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    out = np.zeros(len(a))
    size = a.map(len).to_numpy()
    for dim in np.unique(size):
        i = np.flatnonzero(size == dim)
        x = np.stack(a.to_numpy()[i]).astype(np.float64)
        y = np.stack(b.to_numpy()[i]).astype(np.float64)
        out[i] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    return pd.Series(out)


def _with_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    cosine = F.pandas_udf(_cosine, "double")
    return (pairs.join(vectors.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a")
            .join(vectors.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b")
            .where(F.size("va") == F.size("vb"))
            .select("a", "b", cosine("va", "vb").alias("cosine")))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = (F.col("name").isNotNull() & (F.size("vec") > 0) & finite
          & F.exists("vec", lambda x: x != 0))
    everything = materialize(
        vectors.select(F.col(id_col).alias("name"), F.col(vec_col).cast("array<double>").alias("vec"))
        .withColumn("ok", F.coalesce(ok, F.lit(False)))
        .withColumn("id", F.monotonically_increasing_id()), "vectors")  # written: the numbers stay
    usable = everything.where("ok").select("id", "vec")
    b, tables = calibrate(usable.count(), threshold, recall)
    cells = materialize(X.map_arrow(usable, _cells(tables, b, seed),
                                    "id long, t int, cell long, proj double"), "cells")

    # groups whose members all lie within half the threshold angle of one leader
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    few = cells.where(F.col("t") < LEADER_TABLES)
    leader = few.groupBy("cell").agg(F.min("id").alias("a"))
    tries = few.join(leader, "cell").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    group = (_with_cosine(tries, usable).where(F.col("cosine") >= half)
             .groupBy("b").agg(F.min("a").alias("g")).withColumnRenamed("b", "id"))
    group = materialize(usable.select("id").join(group, "id", "left")
                        .select("id", F.coalesce("g", "id").alias("g")), "groups")

    # windows: own interval on the left side, own and next on the right
    placed = cells.join(group, "id").select(
        "id", "g", "cell", "proj", F.floor(F.col("proj") / WINDOW).cast("long").alias("at"))
    left = placed.select(F.col("id").alias("i"), F.col("g").alias("gi"), "cell",
                         F.col("proj").alias("pi"), F.col("at").alias("slot"))
    right = placed.select(F.col("id").alias("j"), F.col("g").alias("gj"), "cell",
                          F.col("proj").alias("pj"), F.col("at").alias("own"),
                          F.explode(F.array("at", F.col("at") - 1)).alias("slot"))
    hits = (left.join(right, ["cell", "slot"])
            .where(F.abs(F.col("pi") - F.col("pj")) <= WINDOW)
            .where("gi <> gj and (own > slot or i < j)"))
    counted = (hits.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
               .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= MIN_COLLISIONS).select("a", "b"))
    links = materialize(_with_cosine(counted, usable)
                        .where(F.col("cosine") >= threshold).select("a", "b"), "links")

    # within a group everybody is linked, its leader apart where that belongs to another group
    sizes = group.groupBy("g").agg(F.count(F.lit(1)).alias("members"))
    cross = (links.select(F.col("a").alias("id")).union(links.select("b"))
             .groupBy("id").agg(F.count(F.lit(1)).alias("cross")))
    inside = group.where("id <> g").select(F.col("id").alias("a"), F.col("g").alias("b"))
    comp = connected_components(links.union(inside))
    per = (group.join(sizes, "g").join(cross, "id", "left")
           .select("id", (F.col("members") - 1 + F.coalesce("cross", F.lit(0))).alias("n")))
    part = comp.select(F.col("node").alias("id"), "component").join(
        everything.select("id", "name"), "id")
    part = part.join(part.groupBy("component").agg(F.min("name").alias("c")), "component").select("id", "c")
    return (everything.select("id", "name").join(per, "id", "left").join(part, "id", "left")
            .select(F.col("name").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "name").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: links and groups of all vectors at cosine 0.9 or more."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
