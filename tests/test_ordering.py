"""Splits, batches and step plans."""

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import ordering as O


@pytest.mark.parametrize("n,val", [(0, 0), (1, 1), (99, 1), (100, 1), (199, 1), (200, 2)])
def test_tail_split_sizes(spark, n, val):
    df = spark.range(n).withColumnRenamed("id", "k")
    s = O.tail_split(df, ["k"], 0.01)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts.get("validation", 0) == val
    assert counts.get("train", 0) == n - val
    if val:
        assert s.where(F.col("split") == "validation").agg(F.min("k")).first()[0] == n - val


def test_assign_batches_drop_last(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    kept = O.assign_batches(df, ["k"], 4, drop_last=True).collect()
    assert len(kept) == 8 and max(r.batch_id for r in kept) == 1
    allb = O.assign_batches(df, ["k"], 4).collect()
    assert {r.k: (r.batch_id, r.pos_in_batch) for r in allb}[9] == (2, 1)


def test_split_by_document_is_stable_and_disjoint(spark):
    df = spark.range(300).withColumnRenamed("id", "doc_id")
    a = O.split_by_document(df, "doc_id", 0.2, seed=1)
    b = O.split_by_document(df, "doc_id", 0.2, seed=1)
    assert sorted(a.collect()) == sorted(b.collect())
    assert O.split_leaks(a.unionByName(a), "doc_id").count() == 0
    n_val = a.where(F.col("split") == "validation").count()
    assert 20 < n_val < 100


def test_plan_and_cadence(spark):
    b = spark.createDataFrame([(i,) for i in range(25)], "batch_id long")
    p = O.plan_steps(b, epochs=4).first()
    assert (p.n_batches, p.total_steps, p.warmup_steps, p.eval_every) == (25, 100, 3, 2)
    steps = spark.range(10).withColumnRenamed("id", "step")
    assert [r.step for r in O.cadence(steps, 4).orderBy("step").collect()] == [0, 4, 8]
    assert [r.step for r in O.cadence(steps, 4, skip_zero=True).orderBy("step").collect()] == [4, 8]
    assert O.subset_batches(b, 3).count() == 3 and O.subset_batches(b, None).count() == 25


def test_loop_cadence_counts_as_the_loop(spark):
    for n in (0, 1, 5):
        want, step = [(0, 0, "peek")], 0
        for epoch in range(3):
            for _ in range(n):
                step += 1
                want += [(epoch, step, "peek")] * (step % 4 == 0) + [(epoch, step, "eval")] * (step % 5 == 0)
            want.append((epoch, step, "epoch_end"))
        rows = [(i * 7,) for i in range(n)] * 2 + [(None,)]
        b = spark.createDataFrame(rows, "batch_id long")
        assert sorted(map(tuple, O.loop_cadence(b, 3, 4, 5).collect())) == sorted(want)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 1000, 4999])
def test_epoch_places_are_permutations(spark, n):
    ranked = spark.range(1, n + 1).withColumnRenamed("id", "rank")
    rows = O.epoch_places(ranked, n, seed=5, epochs=3).collect()
    by = [[r["place"] for r in sorted(rows, key=lambda r: r["rank"]) if r["epoch"] == e] for e in range(3)]
    assert all(sorted(p) == list(range(n)) for p in by)
    if n >= 1000:  # epochs differ, and neighbours do not stay together
        assert by[0] != by[1] != by[2]
        assert sum(abs(x - y) == 1 for x, y in zip(by[0], by[0][1:])) < n / 50
    plan = O.epoch_places(ranked, n, seed=5, epochs=3)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_epoch_places_null_and_repeated_ranks(spark):
    ranked = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "c")], "rank long, k string")
    rows = O.epoch_places(ranked, 3, seed=5).collect()
    assert [r["place"] for r in rows if r["k"] == "b"] == [None]
    assert len({r["place"] for r in rows if r["k"] == "c"}) == 1 and len(rows) == 4
