"""BPE with a tiny synthetic rank table; readers; template fallback."""

import os

from pyspark.sql import functions as F

from tokenmill.config import EOS_TEXT
from tokenmill.operators import chat as C
from tokenmill.operators import tokenize as tok
from tokenmill.operators.bpe import bpe_merge
from tokenmill.sources import tables


def ranks(spark):
    base = [(bytes([b]), b) for b in range(256)]
    merges = [b"he", b"ll", b"hell", b"hello", b" w", b" wo"]
    rows = base + [(m, 256 + i) for i, m in enumerate(merges)]
    return spark.createDataFrame(rows, "token binary, rank int"), dict(rows)


def test_bpe_merge_helper(spark):
    _, table = ranks(spark)
    assert bpe_merge(b"hello", table) == [table[b"hello"]]
    assert bpe_merge(b"help", table) == [table[b"he"], ord("l"), ord("p")]


def test_bpe_encode_with_specials(spark):
    rdf, table = ranks(spark)
    df = spark.createDataFrame([(0, f"hello world{EOS_TEXT}"), (1, "")], "id long, text string")
    got = {r.id: list(r.tokens) for r in tok.encode(df, "text", "bpe", ranks=rdf).collect()}
    eos = len(table)
    assert got[0] == [table[b"hello"], table[b" wo"], ord("r"), ord("l"), ord("d"), eos]
    assert got[1] == []


def test_bpe_pieces_lose_nothing(spark):
    from tokenmill.operators.bpe import load_ranks
    texts = ["a_b __init__ x1", "it's  two\n\n  lines\t", "", "naïve 漢字 \U0001f600!", f"a{EOS_TEXT}b", "½²"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    small, _ = ranks(spark)
    for table in (small, load_ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")):
        bad = tok.roundtrip_audit(df, "text", "bpe", ranks=table).where("not roundtrip_ok")
        assert bad.count() == 0


def test_bpe_ids_equal_the_library_s(spark):
    import tiktoken

    from tokenmill.operators.bpe import SPLIT_PATTERN, load_ranks
    table = load_ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=table, special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    for r in tok.encode(docs, "text", "bpe", ranks=table).collect():
        assert r.tokens == lib.encode_ordinary(r.text)


def _plain_merge(piece, table):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        found = [(table[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in table]
        if not found:
            return [table[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_bpe_merges_of_short_and_long_pieces_equal_the_definition(spark):
    import random
    import time

    from tokenmill.operators import bpe as B
    _, table = ranks(spark)
    rng = random.Random(3)
    table |= {w: len(table) + i for i, w in enumerate([b"aa", b"aaaa", b"ba", b"aba", b"lo"])}
    for n in (1, 2, 3, 40, B.LONG_PIECE, B.LONG_PIECE + 1, 700):
        for letters in (b"ab", b"helo w", b"a", b"xyz"):
            piece = bytes(rng.choice(letters) for _ in range(n))
            if piece not in table:
                assert B.bpe_merge(piece, table) == B._merge_long(piece, table) == _plain_merge(piece, table)
    start = time.time()  # quadratic before: minutes
    assert len(B.bpe_merge(b"a" * 200_000, table)) == 50_000 and time.time() - start < 20


def test_bpe_worker_keeps_pieces_within_its_bound(spark):
    from tokenmill.operators import bpe as B
    _, table = ranks(spark)
    assert B._kept(B._Encoder, table, ("x",)) is B._kept(B._Encoder, table, ("x",))
    assert B._kept(B._Encoder, dict(table), ("x",)) is not B._kept(B._Encoder, table, ("x",))
    known, most = B._Pieces(table), B.MAX_CACHED_PIECES
    B.MAX_CACHED_PIECES = 10
    try:
        for i in [*range(25), 3, 24, *range(40)]:
            assert known[f"p{i}"] == known[f"p{i}"]
            assert len(known) <= 10 and len(known.older) <= 10
    finally:
        B.MAX_CACHED_PIECES = most


def test_bpe_decode_of_odd_ids(spark):
    rdf, table = ranks(spark)
    df = spark.createDataFrame([(0, [0xC3, 256]), (1, []), (2, None), (3, [len(table), 0xC3, 0xA9])],
                               "id long, tokens array<int>")
    got = {r.id: r.decoded for r in tok.decode(df, "tokens", "bpe", ranks=rdf).collect()}
    assert got == {0: "\ufffdhe", 1: "", 2: None, 3: EOS_TEXT + "é"}


def test_one_layout_of_reserved_ids(spark):
    vocab = {r.token: r.id for r in tok.build_vocab(
        spark.createDataFrame([(["b", "a", "b"],)], "tokens array<string>")).collect()}
    fixed = {r.token: r.id for r in tok.special_ids(spark, "word").collect()}
    assert all(vocab[t] == i for t, i in fixed.items()) and len(set(vocab.values())) == len(vocab) == 6


def test_read_corpus_text_and_whole_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    with open(p, "w") as f:
        f.write(" = T = \nline one\nline two\n")
    lines = tables.read_corpus(spark, p, split="train", fmt="text")
    assert lines.count() == 3 and {r.split for r in lines.collect()} == {"train"}
    whole = tables.read_whole_text(spark, p).collect()
    assert len(whole) == 1 and whole[0].text.startswith(" = T = ")


def test_resolve_template(spark):
    models = spark.createDataFrame([("base",), ("chat",)], "model string")
    temps = spark.createDataFrame([("base-Instruct", "T1"), ("chat", "T2")],
                                  "model string, template string")
    got = {r.model: r.template for r in C.resolve_template(models, temps).collect()}
    assert got == {"base": "T1", "chat": "T2"}
    assert C.resolve_pad_id(None, 7) == 7 and C.resolve_pad_id(3, 7) == 3


def test_flatten_and_collect_messages(spark):
    nested = spark.createDataFrame(
        [(1, [("user", "hi"), ("assistant", "yo")])],
        "conv_id long, messages array<struct<role:string,content:string>>")
    flat = C.flatten_messages(nested)
    assert [(r.turn, r.role, r.text) for r in flat.orderBy("turn").collect()] == [
        (0, "user", "hi"), (1, "assistant", "yo")]
    back = C.collect_messages(flat).first().messages
    assert [(m.role, m.content) for m in back] == [("user", "hi"), ("assistant", "yo")]


def test_read_splits_and_eval_set(spark, tmp_dir):
    for split in ("train", "validation"):
        spark.createDataFrame([(f"{split} text",)], "text string").write.parquet(
            os.path.join(tmp_dir, split))
    df = tables.read_splits(spark, {s: os.path.join(tmp_dir, s) for s in ("train", "validation")})
    assert sorted((r.split, r.text) for r in df.collect()) == [
        ("train", "train text"), ("validation", "validation text")]
    ev = tables.eval_set(spark, [("p1", "good", "bad")], "prompt string, chosen string, rejected string")
    assert ev.count() == 1
