"""Packing: every token in one place, no row over its length, close to the least number of rows."""

import collections
import random

import pytest

from tokenmill.operators import packing as P

SCHEMA = "doc_id long, tokens array<string>, bin string, n int, start string"  # names the operator uses


def bins_of(histogram, length):
    fill, seen = collections.defaultdict(list), collections.Counter()
    for n, lo, hi, per, first, start, segment in P.plan_packing(histogram, length):
        for r in range(lo, hi):
            b, slot = divmod(r - lo, per)
            fill[first + b].append((start + slot * n, n, segment + slot))
        seen[n] += hi - lo
    assert dict(seen) == {n: c for n, c in histogram.items() if c}
    return fill


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    length = rnd.choice([5, 10, 64, 100])
    h = {rnd.randint(1, length): rnd.choice([1, 2, 7, 1000]) for _ in range(rnd.randint(1, 30))}
    fill = bins_of(h, length)
    assert sorted(fill) == list(range(len(fill)))
    for parts in fill.values():
        at = 0
        for k, (start, n, segment) in enumerate(sorted(parts)):
            assert (start, segment) == (at, k + 1)
            at += n
        assert at <= length
    # item by item: as many bins as the plain algorithm
    spaces = []
    for n in sorted(h, reverse=True):
        for _ in range(h[n]):
            best = min((i for i, s in enumerate(spaces) if s >= n), key=lambda i: spaces[i], default=None)
            if best is None:
                spaces.append(length)
                best = len(spaces) - 1
            spaces[best] -= n
    assert len(fill) <= len(spaces) * 1.02 + 1
    assert len(fill) <= 11 / 9 * -(-sum(n * c for n, c in h.items()) // length) + 1 or max(h) > length / 3


def test_rows_and_their_documents(spark):
    rnd = random.Random(3)
    docs = [(rnd.choice([None, 1, 2, 3, 4]), [f"t{i}.{j}" for j in range(rnd.choice([0, 1, 3, 8, 9, 25]))], "x", 1, "y")
            for i in range(60)] + [(5, None, "x", 1, "y"), (6, ["same"], "x", 1, "y"), (6, ["same"], "x", 1, "y")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    packed = P.pack_documents(df, ["doc_id"], 8)
    rows = packed.collect()
    assert all(len(r.tokens) == r.n_tokens <= 8 for r in rows)
    for r in rows:
        assert len(r.segment_ids) == len(r.positions) == r.n_tokens
        for d in r.documents:  # a segment is the document's own run, its positions those in the document
            at = [i for i, s in enumerate(r.segment_ids) if s == d.segment]
            assert at == list(range(d.start, d.start + d.n))
            assert [r.positions[i] for i in at] == list(range(d.doc_pos, d.doc_pos + d.n))
    want = collections.Counter((k, "".join(t)) for k, t, *_ in docs if t)
    back = collections.defaultdict(list)
    for r in P.unpack_documents(packed, ["doc_id"]).collect():
        back[r.doc_id, r.doc_row].append((r.doc_pos, r.tokens))
    got = collections.Counter((k, "".join(t for _, p in sorted(v) for t in p)) for (k, _), v in back.items())
    assert got == want
    (report,) = P.packing_report(packed, 8).collect()
    n = sum(len(t or []) for _, t, *_ in docs)
    assert (report.n_bins, report.n_tokens, report.n_empty) == (len(rows), n, 8 * len(rows) - n)
    assert report.empty_share < 0.1


def test_nothing_to_pack(spark):
    df = spark.createDataFrame([(1, [], "x", 1, "y"), (2, None, "x", 1, "y")], SCHEMA)
    assert P.pack_documents(df, ["doc_id"], 8).collect() == []
    with pytest.raises(ValueError):
        P.pack_documents(df, ["doc_id"], 0)
