"""Metric reductions and candidate selection on literal fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import metrics as M
from tokenmill.operators import ngram as N
from tokenmill.operators import sampling as S


def test_bt_loss_stable(spark):
    df = spark.createDataFrame([(0.0, 0.0), (800.0, 0.0), (0.0, 800.0)], "rc double, rr double")
    got = [r[0] for r in df.select(M.bt_loss("rc", "rr")).collect()]
    assert got[0] == pytest.approx(math.log(2)) and got[1] == pytest.approx(0.0, abs=1e-12)
    assert got[2] == pytest.approx(800.0)
    ce = [r[0] for r in df.select(M.pairwise_ce("rc", "rr")).collect()]
    assert ce == pytest.approx(got)


def test_preference_metrics_ties_are_wrong(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "r_chosen double, r_rejected double")
    m = M.preference_metrics(df, l2=0.5).first()
    assert m.acc == 0.5
    assert m.reg == pytest.approx(0.5 * (2 + 5) / 2)
    assert m.loss == pytest.approx(m.bt + m.reg)


def test_expected_values_sf001(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    s = ev.select((F.col("value") / 100 - 0.2).alias("r_chosen"),
                  (F.col("user_id") / 150.0 - 0.3).alias("r_rejected"))
    m = M.preference_metrics(s, l2=1e-3).first()
    assert round(m.bt, 6) == 0.681329 and round(m.acc, 3) == 0.518 and round(m.reg, 6) == 0.000451


def test_epoch_macro_vs_micro(spark):
    pb = spark.createDataFrame([(0, 1.0, 4), (1, 3.0, 1)], "batch_id int, loss double, n_pairs long")
    got = {r.mode: r.loss for r in M.epoch_mean(pb, ["loss"]).collect()}
    assert got == {"macro": 2.0, "micro": pytest.approx(7 / 5)}


def test_masked_mean_and_perplexity(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, -100), (2.0, 7)], "nll double, label int")
    v = df.agg(M.masked_mean("nll", "label").alias("m")).first().m
    assert v == 1.5
    empty = df.where("label = -100").agg(M.masked_mean("nll", "label").alias("m")).first().m
    assert empty is None


def test_best_step_and_first_last(spark):
    log = spark.createDataFrame([("a", 0, 3.0), ("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 2.0)],
                                "run string, step long, value double")
    b = M.best_step(log).first()
    assert (b.best_step, b.best_value) == (1, 1.0)
    fl = M.first_last(log).first()
    assert (fl.first_value, fl.final_value) == (3.0, 2.0)


LOGITS = [2.0, 1.0, 1.0, 1.0, 0.0, -1.0]


def logits_df(spark):
    return spark.createDataFrame([(0, i, z) for i, z in enumerate(LOGITS)],
                                 "group_id long, item_id long, logit double")


def test_top_k_keeps_ties(spark):
    got = sorted(r.item_id for r in S.top_k(logits_df(spark), 2).collect())
    assert got == [0, 1, 2, 3]
    assert S.top_k(logits_df(spark), 0).count() == 6
    assert S.top_k(logits_df(spark), 100).count() == 6


@pytest.mark.parametrize("p,items", [(0.0001, [0]), (0.5, [0, 1]), (0.7, [0, 1, 2])])
def test_top_p(spark, p, items):
    assert sorted(r.item_id for r in S.top_p(logits_df(spark), p).collect()) == items


@pytest.mark.parametrize("bound", [1, 3, 1000])
@pytest.mark.parametrize("p", [1e-9, 0.2, 0.5, 0.83, 0.999])
def test_top_p_selection_equals_order(spark, p, bound):
    rng = random.Random(5)
    rows = [("big", i, rng.gauss(0, 2)) for i in range(300)]
    rows += [("ties", i, 0.25) for i in range(40)] + [("mixed", i, float(i % 3)) for i in range(30)]
    rows += [("steep", i, -40.0 * i) for i in range(5)] + [("twice", 7, 1.0)] * 4
    rows += [("big", -1, None), ("big", -2, float("nan")), ("big", -3, float("-inf")), (None, 1, 1.0)]
    rng.shuffle(rows)
    want = []
    for g in {r[0] for r in rows if r[0]}:
        items = [(z, i) for h, i, z in rows if h == g and z is not None and z == z and z > -math.inf]
        top = max(z for z, _ in items)
        mass = sum(math.exp(z - top) for z, _ in items)
        before = 0.0
        for z, i in sorted(items, key=lambda x: (-x[0], x[1])):
            if before < p:
                want.append((g, i))
            before += math.exp(z - top) / mass
    df = spark.createDataFrame(rows, "group_id string, item_id long, logit double")
    got = [(r.group_id, r.item_id) for r in S.top_p(df, p, bound=bound).collect()]
    assert sorted(got) == sorted(want)
    assert S.top_p(df.limit(0), p, bound=bound).count() == 0


def test_draw_does_not_depend_on_the_bound(spark):
    rows = [(g, i, (i * g % 7) / 2.0) for g in range(20) for i in range(30)]
    df = spark.createDataFrame(rows, "group_id long, item_id long, logit double")
    draws = [{r.group_id: r.item_id for r in S.sample(df, 4, bound=b).collect()} for b in (1, 5, 1000)]
    assert draws[0] == draws[1] == draws[2] and len(draws[0]) == 20


def test_greedy_softmax_penalty(spark):
    df = logits_df(spark)
    assert S.greedy(df).first().item_id == 0
    probs = {r.item_id: r.prob for r in S.softmax(S.temperature(df, 2.0)).collect()}
    z = [math.exp(x / 2) for x in LOGITS]
    assert probs[0] == pytest.approx(z[0] / sum(z))
    hist = spark.createDataFrame([(0, 1), (0, 1), (0, 5)], "group_id long, item_id long")
    pen = {r.item_id: r.logit for r in S.repetition_penalty(df, hist, 2.0).collect()}
    assert pen[1] == pytest.approx(1.0 / 4) and pen[5] == pytest.approx(-0.5) and pen[0] == 2.0
    signed = {r.item_id: r.logit for r in S.repetition_penalty(df, hist, 2.0, signed=True).collect()}
    assert signed[5] == pytest.approx(-2.0)


def test_sample_is_deterministic_and_follows_probs(spark):
    rows = [(g, i, z) for g in range(400) for i, z in enumerate([math.log(0.7), math.log(0.3)])]
    df = spark.createDataFrame(rows, "group_id long, item_id long, logit double")
    a = {r.group_id: r.item_id for r in S.sample(df, seed=3).collect()}
    b = {r.group_id: r.item_id for r in S.sample(df, seed=3).collect()}
    assert a == b and len(a) == 400
    share = sum(1 for v in a.values() if v == 0) / 400
    assert 0.6 < share < 0.8
    greedy = {r.group_id: r.item_id for r in S.decode_step(df, t=0).collect()}
    assert set(greedy.values()) == {0}


def test_cut_at_stop(spark):
    df = spark.createDataFrame([([1, 2, 9, 3],), ([1, 2],)], "ids array<int>")
    got = [list(r.ids) for r in S.cut_at_stop(df, "ids", [9, 7]).collect()]
    assert got == [[1, 2, 9], [1, 2]]


def test_ngram_fit_and_score(spark):
    train = spark.createDataFrame([(["a", "b", "a", "b"],)], "tokens array<string>")
    ev = spark.createDataFrame([(["a", "b", "c"],)], "tokens array<string>")
    m = N.fit_ngram(train, 2, vocab_size=3, k=1.0)
    got = N.score_ngram(m, ev, 2, vocab_size=3, k=1.0).first()
    # P(b|a) = (2+1)/(2+3); context b seen once -> P(c|b) = (0+1)/(1+3)
    exp = -(math.log(3 / 5) + math.log(1 / 4)) / 2
    assert got.cross_entropy == pytest.approx(exp) and got.n_tokens == 2
    uni = N.score_ngram(N.fit_ngram(train, 1, 3), ev, 1, 3).first()
    assert uni.cross_entropy == pytest.approx(-(math.log(3 / 7) * 2 + math.log(1 / 7)) / 3)


def test_race_draws_in_proportion_to_softmax(spark):
    import math
    logits = {1: 0.0, 2: 1.0, 3: -2.0, 4: 2.5, 5: float("-inf"), 6: None, 7: float("nan")}
    rows = [(g, i, z) for g in range(4000) for i, z in logits.items()]
    df = spark.createDataFrame(rows, "group_id long, item_id long, logit double")
    drawn = [r.item_id for r in S.sample_race(df, seed=3).collect()]
    total = sum(math.exp(z) for z in logits.values() if z is not None and z == z)
    assert len(drawn) == 4000
    for i, z in logits.items():
        p = math.exp(z) / total if z is not None and z == z else 0.0
        assert abs(drawn.count(i) / 4000 - p) < 4 * math.sqrt(p * (1 - p) / 4000) + 1e-9
    again = [r.item_id for r in S.sample_race(df.repartition(7), seed=3).orderBy("group_id").collect()]
    assert again == [r.item_id for r in S.sample_race(df, seed=3).orderBy("group_id").collect()]
    # large logits do not overflow; equal rows and an undrawable group are defined
    odd = spark.createDataFrame([(1, 1, 1e308), (1, 2, 5.0), (2, 9, 1.0), (2, 9, 1.0), (3, 1, None)],
                                "group_id long, item_id long, logit double")
    assert sorted((r.group_id, r.item_id) for r in S.sample_race(odd, 1).collect()) == [(1, 1), (2, 9)]
    assert "SortMergeJoin" not in S.sample_race(df, 1)._jdf.queryExecution().executedPlan().toString()


def test_runs_side_by_side(spark):
    rows = [(0, "a", 1.0, 2.0), (0, "a", 3.0, None), (0, "b", 5.0, 1.0), (1, "b", 7.0, 1.0), (2, "c", 9.0, 1.0),
            (0, None, 4.0, 4.0), (None, "a", 6.0, 6.0)]
    log = spark.createDataFrame(rows, "epoch int, run string, loss double, acc double")
    got = {r.epoch: tuple(r)[1:] for r in M.runs_side_by_side(log, ["a", "b"], ["loss", "acc"]).collect()}
    # a_loss, a_acc, b_loss, b_acc, then b against a
    assert got == {0: (2.0, 2.0, 5.0, 1.0, 3.0, -1.0), 1: (None, None, 7.0, 1.0, None, None),
                   2: (None,) * 6, None: (6.0, 6.0, None, None, None, None)}
    assert M.runs_side_by_side(log.limit(0), ["a"], ["loss"]).collect() == []


def test_trigrams_of_any_tokens_are_told_apart(spark):
    """Counts equal a plain count, whatever stands in the tokens."""
    import random
    from collections import Counter

    from tokenmill.operators import ngram as N
    rng = random.Random(4)
    odd = ["", None, ":", ",", "1,", "1:", "a", "ab", "b", "-", "-1", "é", "\U0001f600", "a:b"]
    rows = [[rng.choice(odd) for _ in range(rng.randrange(0, 40))] for _ in range(150)] + [None, []]
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    for n in (3, 4):
        plain = Counter(tuple(r[i:i + n]) for r in rows if r for i in range(len(r) - n + 1))
        got = {(*r["ctx"], r["next"]): r["count"] for r in N.ngram_counts(df, n).collect()}
        assert got == plain
    ints = spark.createDataFrame([([1, 2, 3, 1, 2, 3],)], "tokens array<int>")
    assert {(*r["ctx"], r["next"], r["count"]) for r in N.ngram_counts(ints, 3).collect()} == {
        (1, 2, 3, 2), (2, 3, 1, 1), (3, 1, 2, 1)}


def test_pairs_counted_by_parts(spark):
    """Null tokens, null, empty and one-token rows; parts of one batch and of several."""
    from collections import Counter

    import pyarrow as pa
    rows = [["a", "b", "a", "b"], None, [], ["a"], ["b", None, "b", None], ["\u00e9 x", "a"], ["a", "b"], [None, None]]
    pairs = Counter(p for r in rows for p in zip(r or [], (r or [])[1:], strict=False))
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    got = {(r["ctx"], r["next"]): r["count"] for r in N.ngram_counts(df, 2).collect()}
    assert got == pairs
    assert N.vocab_size(df) == len({t for r in rows for t in r or []})  # null counts as one
    for size in (1, 1 << 20):
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[i:i + 3], pa.list_(pa.string()))], ["tokens"])
                   for i in range(0, len(rows), 3)]
        out = Counter()
        for b in N._pair_counts(size)(iter(batches)):
            for r in b.to_pylist():
                out[r["ctx"], r["next"]] += r["count"]
        assert out == pairs


def test_scores_from_counts_and_totals(spark):
    """The two tables of a model score as the joined model does."""
    train = spark.createDataFrame([(["a", "b", "a", "c", None, "a", "b"],)], "tokens array<string>")
    ev = spark.createDataFrame([(["a", "b", "x", "a", "a", None, "a"],)], "tokens array<string>")
    joined = N.score_ngram(N.fit_ngram(train, 2, 5), ev, 2, 5).first()
    tables = N.fit_ngram(train, 2, 5, joined=False)
    apart = N.score_ngram(tables, ev, 2, 5).first()
    assert apart["n_tokens"] == joined["n_tokens"] == 6
    assert apart["cross_entropy"] == pytest.approx(joined["cross_entropy"], abs=1e-12)


def test_bigram_ppl_joins_scored_pairs_only(spark, tmp_dir):
    """The count table is written once and joined once: no second table of all pairs."""
    from tokenmill.plans import ngram as plan
    from tokenmill.plans import prefix
    spark.createDataFrame([(i, "a b c . " * (1 + i % 3)) for i in range(40)], "doc_id long, text string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    before = len(prefix._WRITTEN)
    assert plan.bigram_ppl(spark, tmp_dir).first()["n_tokens"] > 0
    names = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in prefix._WRITTEN[before:]]
    assert names == ["split_tokens", "ngram_counts"]
