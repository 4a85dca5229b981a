"""Line splitting, blank test and tokenizers against Python behaviour."""

import pytest
from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT
from tokenmill.functions.text import is_blank, split_lines, word_tokens
from tokenmill.operators import tokenize as tok

LINES = ["a\nb", "a\r\nb", "a\rb", "a\x0bb\x0cc", "x\x1cy\x1dz\x1ew", "p\x85q", "u v w",
         "end\n", "end\r\n", "", "\n", "\n\n", "one", "a\n\nb\n"]


def test_split_lines_matches_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(LINES)], "i int, s string")
    got = {r.i: list(r.l) for r in df.select("i", split_lines("s").alias("l")).collect()}
    for i, s in enumerate(LINES):
        assert got[i] == s.splitlines(), repr(s)


@pytest.mark.parametrize("s", [" ", "\t", " ", "  \t\n", "x", " x ", ""])
def test_is_blank_matches_strip(spark, s):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(is_blank("s")).first()[0] == (s.strip() == "")


def test_word_tokens_and_specials(spark):
    df = spark.createDataFrame([("Hello, world!",), (f"a{EOS_TEXT}b",), ("",)], "t string")
    got = [list(r[0]) for r in df.select(word_tokens("t")).collect()]
    assert got == [["Hello", ",", "world", "!"], ["a", EOS_TEXT, "b"], []]


def test_byte_roundtrip_and_eos(spark):
    texts = ["hello world", "Hello, world!", "", "héllo – ✓ 漢字 🙂", f"x{EOS_TEXT}y{EOS_TEXT}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    enc = tok.encode(df, "text", "byte")
    rows = {r.i: list(r.tokens) for r in enc.collect()}
    assert rows[0] == list("hello world".encode())
    assert rows[2] == []
    assert rows[4] == [ord("x"), 256, ord("y"), 256]  # the EOS literal is one id
    dec = tok.decode(enc, "tokens", "byte").collect()
    assert all(r.decoded == r.text for r in dec)
    empty = spark.createDataFrame([([],)], "ids array<int>")
    assert tok.decode(empty, "ids", "byte").first().decoded == ""


def test_vocab_and_ids(spark):
    df = spark.createDataFrame([(0, "b a b c"), (1, "c b")], "doc_id long, text string")
    toks = tok.encode(df, "text", "word")
    v = {r.token: (r.id, r["count"]) for r in tok.build_vocab(toks).collect()}
    assert v[EOS_TEXT][0] == 0 and v["<unk>"][0] == 3  # after the reserved markers
    assert v["b"] == (4, 3) and v["c"] == (5, 2) and v["a"] == (6, 1)
    ids = {r.doc_id: list(r.ids) for r in tok.tokens_to_ids(toks, "tokens", tok.build_vocab(toks),
                                                             ["doc_id"]).collect()}
    assert ids == {0: [4, 6, 4, 5], 1: [5, 4]}
    small = tok.build_vocab(toks, max_size=5)
    unk = {r.doc_id: list(r.ids) for r in tok.tokens_to_ids(toks, "tokens", small,
                                                             ["doc_id"]).collect()}
    assert unk == {0: [4, 3, 4, 3], 1: [3, 4]}


def test_append_eos_and_crop(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "tokens array<int>")
    assert list(tok.append_eos(df, "tokens", 9).first().tokens) == [1, 2, 3, 9]
    assert list(tok.crop_context(df, "tokens", 2).first().tokens) == [2, 3]
    assert list(tok.crop_context(df, "tokens", 5).first().tokens) == [1, 2, 3]


def test_lookup_keeps_rows_columns_and_order(spark):
    from tokenmill.operators import tokenize as tok
    vocab = spark.createDataFrame([("<eos>", 0, 0), ("<unk>", 1, 0), ("a", 2, 5), ("b", 3, 4)],
                                  "token string, id int, count long")
    rows = [(1, ["a", "b", "a"], "x"), (1, ["b"], "y"), (None, ["zz", None, "a"], "z"), (2, [], "e"),
            (3, None, "n"), (1, ["b"], "y")]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, block string").repartition(3)
    got = sorted(tuple(r) for r in tok.tokens_to_ids(df, "tokens", vocab).select(
        F.coalesce("doc_id", F.lit(-1)), "block", "ids").collect())
    assert got == [(-1, "z", [1, 1, 2]), (1, "x", [2, 3, 2]), (1, "y", [3]), (1, "y", [3]), (2, "e", []), (3, "n", [])]
    only = tok.tokens_to_ids(df.select("doc_id", "tokens"), "tokens", vocab, ["doc_id"])
    assert only.columns == ["doc_id", "ids"] and only.count() == 6
    back = tok.decode(tok.tokens_to_ids(df, "tokens", vocab), "ids", "word", vocab=vocab)
    assert sorted(r.decoded for r in back.collect()) == ["", "", "<unk> <unk> a", "a b a", "b", "b"]
    empty = df.limit(0)
    assert tok.tokens_to_ids(empty, "tokens", vocab).collect() == []
    plan = tok.tokens_to_ids(df, "tokens", vocab)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode(tokens" not in plan


def test_byte_ids_of_a_batch_with_specials_stay_arrays():
    """No Python object an id: a batch with a special takes little more than its ids."""
    import tracemalloc

    import pyarrow as pa

    from tokenmill.functions import bytes as B
    texts = pa.array([f"é{EOS_TEXT}x", None, "", "ab", f"{EOS_TEXT}{EOS_TEXT}"] + ["y" * 100_000 + EOS_TEXT] * 20)
    tracemalloc.start()
    got = B._encode(texts.slice(0), (EOS_TEXT, EOS_TEXT + "!"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.slice(0, 5).to_pylist() == [[195, 169, 256, 120], None, [], [97, 98], [256, 256]]
    assert got[5].as_py() == [121] * 100_000 + [256] and peak < 14 * 2_000_000
    longer = B._encode(pa.array([f"a{EOS_TEXT}!b{EOS_TEXT}"]).slice(0), (EOS_TEXT, EOS_TEXT + "!"))
    assert longer.to_pylist() == [[97, 257, 98, 256]]
    part = B._encode(texts.slice(3, 2), (EOS_TEXT,))
    assert part.to_pylist() == [[97, 98], [256, 256]]


def test_byte_batches_are_bounded_by_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    tok.encode(spark.createDataFrame([(0, "a")], "id long, text string"), "text", "byte")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20
