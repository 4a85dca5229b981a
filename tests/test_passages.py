"""Passages shared by two splits against a plain comparison of all windows."""

import random

import pytest

from tokenmill.operators import passages as P

SCHEMA = "doc_id long, split string, tokens array<string>, __row string"


def brute(rows, length):
    def windows(t):
        return [tuple(t[i:i + length]) for i in range(len(t) - length + 1)]
    known = {w for _, s, t, _ in rows if s == "train" and t for w in windows(t)}
    out = []
    for key, s, t, _ in rows:
        if s != "validation" or not t:
            continue
        hit = [w in known for w in windows(t)]
        i = 0
        while i < len(hit):
            j = i
            while j < len(hit) and hit[j]:
                j += 1
            if j > i:
                out.append((key, i, j - i + length - 1))
            i = j + 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,gram", [(1, None), (4, 1), (6, 3), (6, 6), (9, None)])
def test_every_shared_passage_is_found(spark, length, gram):
    rng = random.Random(length)
    words = [str(i) for i in range(12)]
    rows = []
    common = [rng.choice(words) for _ in range(40)]
    for k in range(60):
        t = [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        if k % 3 == 0:
            cut = rng.randrange(0, 30)
            t = t[:10] + common[cut:cut + rng.randrange(3, 20)] + t[10:]
        rows.append((k // 2 if k % 5 else None, "validation" if k % 4 == 0 else "train", t, "x"))
    rows += [(70, "validation", None, "x"), (71, "validation", [], None), (72, "test", common, "x"),
             (73, "validation", common, "x"), (73, "validation", common, "x"), (74, "train", common, "x"),
             (75, "train", ["a"] * 50, "x"), (76, "validation", ["a"] * 30 + ["b"], "x"),
             (77, None, common, "x"), (78, "train", ["a b", "c"] * 9, "x"), (79, "validation", ["a", "b", "c"] * 9, "x"),
             (80, "train", [None, "q"] * 9, "x"), (81, "validation", [None, "q"] * 9, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in P.shared_passages(df, length, gram=gram).collect()]
    assert sorted(got, key=repr) == brute(rows, length)


def test_empty_table_and_bad_gram(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = P.shared_passages(empty, 5)
    assert out.columns == ["doc_id", "first_token", "n_tokens"] and out.count() == 0
    with pytest.raises(ValueError):
        P.shared_passages(empty, 5, gram=6)


@pytest.mark.parametrize("length,gram", [(1, 1), (5, 2), (6, 6), (7, 4), (32, 16)])
def test_every_window_has_the_first_of_its_least_grams_in_one_pass(length, gram):
    import time

    import pyarrow as pa
    rng = random.Random(gram)
    rows = [[rng.choice(["a", "b", "", None, "\u6f22"]) for _ in range(rng.randrange(0, 60))] for _ in range(40)]
    rows += [None, [], ["a"] * 50]
    got = P._winnowed(pa.array([["skipped"], *rows], pa.list_(pa.string())).slice(1), length, gram).to_pylist()
    assert len(got) == len(rows)
    known = {}
    for t, prints in zip(rows, got):
        t, n = t or [], len(t or [])
        where = {f["p"]: f["h"] for f in prints}
        for p, h in where.items():  # equal grams have equal hashes, wherever they stand
            assert known.setdefault(tuple(t[p - 1:p - 1 + gram]), h) == h
        assert [f["p"] for f in prints] == sorted(where)
        for s in range(1, n - length + 2):  # each window holds a fingerprint
            assert any(s <= p <= s + length - gram for p in where)
    start = time.time()  # row by row in interpreted expressions: about a minute
    big = P._winnowed(pa.array([[str(i % 9973) for i in range(100_000)]] * 10), 32, 16)
    assert all(len(x) > 1000 for x in big) and time.time() - start < 10
