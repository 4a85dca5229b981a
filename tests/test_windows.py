"""Sliding windows: literal cases and the properties that define them."""

import random
from itertools import chain

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import windows as win


def spark_windows(spark, docs, L, S, chunk=65536, block=65536, eos="<eos>"):
    rows = [(i, d + [eos]) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    offs, n = win.stream_offsets(df, ["doc_id"], chunk_size=chunk, with_total=True)
    w = win.sliding_windows(offs, L, S, n_tokens=n, block=block)
    got = sorted(w.collect(), key=lambda r: r.window_id)
    return [(list(r.input_ids), list(r.target_ids)) for r in got], [r.window_id for r in got]


def test_reference_fixture(spark):
    docs = [["hello", "world"], ["foo", "bar", "baz"]]
    got, ids = spark_windows(spark, docs, 4, 2)
    assert got == [(["hello", "world", "<eos>", "foo"], ["world", "<eos>", "foo", "bar"]),
                   (["<eos>", "foo", "bar", "baz"], ["foo", "bar", "baz", "<eos>"])]
    assert ids == [0, 1]


@pytest.mark.parametrize("L,S", [(4, 1), (4, 2), (4, 4), (4, 5), (4, 9), (7, 3), (1, 1)])
def test_random_docs_small_chunks_and_blocks(spark, L, S):
    rnd = random.Random(L * 100 + S)
    docs = [[f"t{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 12))] for _ in range(15)]
    stream = list(chain.from_iterable(d + ["<eos>"] for d in docs))
    got, ids = spark_windows(spark, docs, L, S, chunk=3, block=5)
    # as many windows as starts 0, S, 2S, ... leave room for L tokens and the next one
    assert ids == list(range(max(0, (len(stream) - L + S - 1) // S)))
    for w, (inp, tgt) in zip(ids, got):
        assert inp + tgt[-1:] == stream[w * S:w * S + L + 1] and inp[1:] == tgt[:-1]


def test_edge_counts(spark):
    # N == L -> 0 windows; N == L + 1 -> 1 window; too short -> 0
    assert spark_windows(spark, [["a", "b", "c"]], 4, 1)[0] == []          # N = 4 = L
    assert len(spark_windows(spark, [["a", "b", "c", "d"]], 4, 3)[0]) == 1  # N = 5
    assert spark_windows(spark, [["a"]], 100, 1)[0] == []
    assert win.window_count_value(4, 4, 1) == 0
    assert win.window_count_value(5, 4, 7) == 1


def test_eos_between_and_after_documents(spark):
    got, _ = spark_windows(spark, [["hello"], ["world"]], 3, 1)
    assert got[0] == (["hello", "<eos>", "world"], ["<eos>", "world", "<eos>"])


def test_per_document_windows(spark):
    docs = [["a", "b", "c", "d", "e"], ["x"], ["p", "q", "r", "s"]]
    rows = [(i, d + ["<eos>"]) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    offs = win.stream_offsets(df, ["doc_id"], chunk_size=2)
    got = win.per_document_windows(offs, "doc_id", 3, 2, block=4).collect()
    got = sorted((r.doc_id, r.window_id, list(r.input_ids), list(r.target_ids)) for r in got)
    exp = []
    for i, d in enumerate(docs):
        s = d + ["<eos>"]
        for w, st in enumerate(range(0, len(s) - 3, 2)):
            exp.append((i, w, s[st:st + 3], s[st + 1:st + 4]))
    assert got == sorted(exp)


def test_lineage_lists_documents(spark):
    docs = [["a", "b"], ["c"], ["d", "e", "f"]]
    rows = [(i, d + ["<eos>"]) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    offs, n = win.stream_offsets(df, ["doc_id"], with_total=True)
    w = win.sliding_windows(offs, 4, 4, n_tokens=n, lineage_key="doc_id")
    got = {r.window_id: list(r.doc_ids) for r in w.collect()}
    assert got == {0: [0, 1], 1: [1, 2]}


def test_next_token_pairs(spark):
    df = spark.createDataFrame([(0, ["a", "b"], ["b", "c"])],
                               "window_id long, input_ids array<string>, target_ids array<string>")
    got = [(r.context_token, r.next_token) for r in win.next_token_pairs(df).orderBy("pos").collect()]
    assert got == [("a", "b"), ("b", "c")]


def test_null_and_repeated_keys_keep_their_rows(spark):
    docs = [(1, ["a"] * 5), (1, ["b"] * 4), (None, ["c"] * 3), (2, ["d"] * 2), (1, ["b"] * 4), (3, None), (4, [])]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>").repartition(3)
    for chunk in (2, 65536):
        offs, n = win.stream_offsets(df, ["doc_id"], chunk_size=chunk, with_total=True)
        assert n == 18
        got = sorted(win.sliding_windows(offs, 4, 3, n_tokens=n, block=5).collect())
        stream = [t for r in sorted(got) for t in r.input_ids[:3]] + list(got[-1].input_ids[3:]) + [
            got[-1].target_ids[-1]]
        # null first, rows of key 1 whole and one after the other in some fixed order, then key 2
        runs = "".join(stream)
        assert runs in {("ccc" + "".join(p) + "dd")[:len(runs)] for p in (
            ("aaaaa", "bbbb", "bbbb"), ("bbbb", "bbbb", "aaaaa"))}
        assert [r.window_id for r in got] == list(range(5))
        per_doc = win.per_document_windows(offs, "doc_id", 3, 1, block=4).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, "".join(r.input_ids)) for r in per_doc) == [
            (False, 1, "aaa"), (False, 1, "aaa"), (False, 1, "bbb"), (False, 1, "bbb")]


def test_window_documents_equal_a_walk_over_the_tokens(spark):
    rnd = random.Random(7)
    docs = [[f"t{rnd.randint(0, 9)}" for _ in range(rnd.choice([0, 1, 2, 5, 30]))] for _ in range(25)]
    df = spark.createDataFrame([(i, d + ["<eos>"]) for i, d in enumerate(docs)], "doc_id long, tokens array<string>")
    stream = [(i, p) for i, d in enumerate(docs) for p in range(len(d) + 1)]
    for L, S, chunk in [(4, 2, 3), (4, 4, 65536), (4, 9, 3), (7, 1, 2)]:
        offs, n = win.stream_offsets(df, ["doc_id"], chunk_size=chunk, with_total=True)
        want = {}
        for w, s in enumerate(range(0, len(stream) - L, S)):
            for at, (i, p) in enumerate(stream[s:s + L + 1]):
                first = want.setdefault((w, i), [at, p, 0])
                first[2] += 1
        got = {(r.window_id, r.doc_id): [r.window_pos, r.doc_pos, r.n_tokens]
               for r in win.window_documents(offs, "doc_id", L, S, n).collect()}
        assert got == want


def test_window_documents_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, tokens array<string>")
    offs = win.stream_offsets(df, ["doc_id"])
    assert win.window_documents(offs, "doc_id", 4, 2).collect() == []


@pytest.mark.parametrize("limit", [0, 1000])
def test_windows_of_any_tokens(spark, monkeypatch, limit):
    """Tokens that are null, empty or hold the separator come back, with offsets broadcast or joined."""
    import random

    from tokenmill.operators import windows as W
    monkeypatch.setattr(W, "BROADCAST_OFFSET_ROWS", limit)
    rng = random.Random(limit)
    odd = ["a", "bc", "", None, W._SEP, f"x{W._SEP}y", "é", " "]
    docs = [[rng.choice(odd if k % 2 else odd[:2]) for _ in range(rng.randrange(0, 40))] for k in range(30)]
    docs += [[None, f"p{W._SEP}q"], [""], ["", ""], [None]]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, tokens array<string>")
    offs, n = W.stream_offsets(df, ["id"], chunk_size=7, with_total=True)
    flat = sum(docs, [])
    assert n == len(flat)
    got = {r.window_id: (r.input_ids, r.target_ids) for r in
           W.sliding_windows(offs, 5, 3, n_tokens=n, block=16).collect()}
    assert got == {w: (flat[i:i + 5], flat[i + 1:i + 6]) for w, i in enumerate(range(0, n - 5, 3))}


def test_pieces_of_strings_shuffle_as_strings(spark):
    from tokenmill.operators import windows as W
    df = spark.createDataFrame([(0, ["a", "b", "c"]), (1, None)], "id long, tokens array<string>")
    text, array = W._packed(F.col("tokens"))
    got = df.select("id", text.alias("t"), array.alias("a")).orderBy("id").collect()
    assert got[0].t == W._SEP.join("abc") and got[0].a is None and got[1].t is None and got[1].a is None
