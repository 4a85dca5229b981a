"""SFT examples and preference pairs: literal cases and properties."""

import random

import pytest
from pyspark.sql import functions as F

from tokenmill.config import BOS_TEXT, EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT
from tokenmill.functions import arrays as A
from tokenmill.operators import chat as C
from tokenmill.operators import preference as P

IGN = "-100"


def render(msgs, gen_prompt=False):
    out = [BOS_TEXT]
    for role, text in msgs:
        out += [HEADER_START_TEXT, role, HEADER_END_TEXT] + text.split() + [EOT_TEXT]
    if gen_prompt:
        out += [HEADER_START_TEXT, "assistant", HEADER_END_TEXT]
    return out


CONVS = {
    0: [("user", "hi there"), ("assistant", "hello friend")],
    1: [("assistant", "solo reply words")],                       # one-turn [assistant]
    2: [("system", "be nice"), ("user", "q one"), ("assistant", "a one"), ("user", "q two"),
        ("assistant", "a two is longer than the rest of it")],    # two assistant turns
    3: [("user", "only a question")],                             # ends in user: rejected
    4: [("user", "x " * 30), ("assistant", "y " * 40)],           # response longer than L
}


def turns_df(spark, convs):
    rows = [(cid, t, role, text) for cid, msgs in convs.items() for t, (role, text) in enumerate(msgs)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_sft_example_literal(spark):
    ex = {r.conv_id: r for r in C.sft_examples(turns_df(spark, CONVS), 64).collect()}
    head = [BOS_TEXT, HEADER_START_TEXT, "user", HEADER_END_TEXT, "hi", "there", EOT_TEXT,
            HEADER_START_TEXT, "assistant", HEADER_END_TEXT]
    assert ex[0].input_ids == head + ["hello", "friend"]
    assert ex[0].target_ids == [IGN] * 9 + ["hello", "friend", EOT_TEXT]
    assert ex[1].target_ids == [IGN] * 3 + ["solo", "reply", "words", EOT_TEXT]


@pytest.mark.parametrize("L", [5, 9, 16, 64, 256])
def test_sft_example_properties(spark, L):
    ex = {r.conv_id: r for r in C.sft_examples(turns_df(spark, CONVS), L).collect()}
    assert set(ex) == {0, 1, 2, 4}  # those that the assistant ends
    for cid, r in ex.items():
        whole = render(CONVS[cid])
        answer = CONVS[cid][-1][1].split() + [EOT_TEXT]
        kept = min(L, len(whole))
        assert len(r.input_ids) == len(r.target_ids) == kept - 1
        assert r.input_ids + whole[-1:] == whole[len(whole) - kept:]
        # the answer is supervised, nothing before it
        n = min(len(answer), kept - 1)
        assert r.target_ids[kept - 1 - n:] == answer[len(answer) - n:]
        assert set(r.target_ids[:kept - 1 - n]) <= {IGN}


@pytest.mark.parametrize("L", [7, 300])
def test_integer_ids_and_nested_form(spark, L):
    turns = turns_df(spark, CONVS)
    flat = C.sft_examples(turns, L, template=C.BYTE_TEMPLATE)
    assert dict(flat.dtypes)["target_ids"] == "array<int>"
    nested = C.sft_examples_nested(C.collect_messages(turns), L, template=C.BYTE_TEMPLATE)
    rows = [sorted(map(tuple, d.select("conv_id", "input_ids", "target_ids", "full_len",
                                       "prompt_len").collect())) for d in (flat, nested)]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    if L == 300:
        r = next(x for x in rows[0] if x[0] == 0)
        assert bytes(i for i in r[2] if 0 <= i < 256) == b"hello friend" and r[2][-1] == 257


def test_answers_of_long_conversations_are_whole(spark):
    answer = " ".join(f"w{i}" for i in range(40))
    turns = turns_df(spark, {7: [("user", "x " * 5200), ("assistant", answer)]})
    assert "".join(C.last_response(turns).first().response) == answer.replace(" ", "")
    r = C.render_chat(turns).first()
    assert len(r.ids) == r.full_len == 1 + 4 + 5200 + 4 + 80


def test_rejects_and_prefix_audit(spark):
    lay = C.layout(C.render_turns(turns_df(spark, CONVS)))
    kept, rejected = C.require_last_role(lay)
    assert {r.conv_id for r in C.conversation_stats(rejected).collect()} == {3}
    st = {r.conv_id: r for r in C.conversation_stats(lay).collect()}
    for cid, msgs in CONVS.items():
        full, prompt = render(msgs), render(msgs[:-1], gen_prompt=True)
        assert st[cid].full_len == len(full) and st[cid].prompt_len == len(prompt)
        assert st[cid].last_header_ok == (full[:len(prompt)] == prompt)


def test_fits_and_render(spark):
    r = C.render_chat(turns_df(spark, CONVS), max_length=12)
    got = {x.conv_id: list(x.ids) for x in r.collect()}
    assert got == {cid: render(m)[-12:] for cid, m in CONVS.items()}
    lay = C.fits(C.layout(C.render_turns(turns_df(spark, CONVS))), 12)
    assert {x.conv_id for x in C.conversation_stats(lay).collect()} == {
        cid for cid, m in CONVS.items() if len(render(m)) <= 12}


def test_static_and_dynamic_padding(spark):
    ex = C.sft_examples(turns_df(spark, CONVS), 16, ignore=IGN)
    st = C.pad_static(ex, 15, {"input_ids": "<pad>", "target_ids": IGN}).collect()
    for r in st:
        assert len(r.input_ids) == 15 == len(r.target_ids)
    with pytest.raises(Exception):
        C.pad_static(ex, 3, {"input_ids": "<pad>"}).collect()
    b = ex.withColumn("batch_id", F.lit(0))
    dyn = C.pad_dynamic(b, {"input_ids": "<pad>", "target_ids": IGN}).collect()
    width = max(len(r.input_ids) for r in ex.collect())
    assert all(len(r.input_ids) == width == len(r.target_ids) for r in dyn)


def test_extract_response_and_format(spark):
    df = spark.createDataFrame([(["p1", "p2", "r1", "r2", EOT_TEXT, "junk"], 2)],
                               "gen array<string>, pl int")
    got = C.extract_response(df, "gen", "pl").first().response
    assert list(got) == ["r1", "r2"]
    none = spark.createDataFrame([(["p", "r"], 1)], "gen array<string>, pl int")
    assert list(C.extract_response(none, "gen", "pl").first().response) == ["r"]
    fp = C.format_prompt(spark.createDataFrame([("what now",)], "prompt string")).first()
    assert list(fp.prompt_ids) == render([("user", "what now")], gen_prompt=True)


def test_pairs_encode_fit_pad_mask(spark):
    src = spark.createDataFrame([(0, "q a", "good answer", "bad"), (1, "q b", "fine", "x " * 20)],
                                "pair_id long, prompt string, chosen string, rejected string")
    pairs = P.pairs_from_prompts(src)
    enc = P.encode_pairs(pairs, 64)
    got = {(r.pair_id, r.side): list(r.ids) for r in enc.collect()}
    assert got[(0, "chosen")] == render([("user", "q a"), ("assistant", "good answer")])
    assert {r.pair_id for r in P.pair_fits(enc, 20).collect()} == {0}
    wide = P.to_wide(enc).withColumn("batch_id", F.lit(0))
    padded = P.pad_pairs(wide, "<pad>", "dynamic").collect()
    for r in padded:
        assert len(r.chosen_ids) == r.chosen_width == len(r.chosen_attention_mask)
        assert len(r.rejected_ids) == r.rejected_width
        assert sum(r.chosen_attention_mask) == r.chosen_len
    st = P.pad_pairs(P.to_wide(enc), "<pad>", "static", max_length=64).collect()
    assert all(len(r.chosen_ids) == 64 == len(r.rejected_ids) for r in st)
    pooled = P.pad_pairs(wide, "<pad>", "dynamic").select(
        A.pool_last("chosen_ids", "chosen_attention_mask").alias("p")).collect()
    assert all(r.p == EOT_TEXT for r in pooled)


def test_pad_collision_when_pad_is_eos(spark):
    df = spark.createDataFrame([(["a", "<eos>", "b", "<eos>", "<eos>"], [1, 1, 1, 1, 0]),
                                (["a", "b", "<eos>"], [1, 1, 0])], "ids array<string>, mask array<int>")
    got = [(r.mask_last, r.scan_last, r.collision) for r in
           P.pad_collision_audit(df, "ids", "mask", "<eos>").collect()]
    assert got == [(3, 0, True), (1, 1, False)]


def test_pairs_from_conversations_wraps(spark):
    convs = {10: [("user", "a"), ("assistant", "r10")], 11: [("user", "b")],
             12: [("user", "c"), ("assistant", "r12")]}
    pairs = P.pairs_from_conversations(turns_df(spark, convs)).collect()
    rej = {r.pair_id: r.text for r in pairs if r.side == "rejected" and r.role == "assistant"}
    assert rej == {10: "r12", 12: "r10"}


def test_array_helpers(spark):
    df = spark.createDataFrame([([5, 6, 7], [1, 1, 0])], "a array<int>, m array<int>")
    r = df.select(A.mask_prefix("a", 2, -100).alias("x"), A.mask_prefix("a", 9, -1).alias("y"),
                  A.mask_prefix("a", 0, -1).alias("z"), A.count_not("a", 6).alias("c"),
                  A.mask_sum("m").alias("s"), A.pool_last("a", "m").alias("p"),
                  A.left_truncate("a", 5).alias("t"), A.join_tokens("a").alias("j")).first()
    assert list(r.x) == [-100, -100, 7] and list(r.y) == [-1, -1, -1] and list(r.z) == [5, 6, 7]
    assert (r.c, r.s, r.p, list(r.t), r.j) == (2, 2, 6, [5, 6, 7], "5 6 7")


def test_pair_ids_and_incomplete_pairs(spark):
    big = 9007199254740993
    rows = [(big, s, 0, "user", "q") for s in ("chosen", "rejected")] + [(big + 1, "rejected", 0, "user", "z")]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    enc = P.encode_pairs(df, 32)
    assert {(r.pair_id, r.side) for r in enc.collect()} == {(r[0], r[1]) for r in rows}
    wide = {r.pair_id: r for r in P.to_wide(enc).collect()}
    assert wide[big + 1].chosen_ids is None and wide[big].chosen_ids == wide[big].rejected_ids
    assert [tuple(r) for r in P.incomplete_pairs(enc).collect()] == [(big + 1, "chosen")]
    named = P.encode_pairs(df.withColumn("pair_id", F.concat(F.lit("p"), F.col("pair_id").cast("string"))), 32)
    assert named.count() == 3


def test_left_padding_for_generation(spark):
    rows = [(0, 1, ["a", "b"]), (0, 2, ["c", "d", "e"]), (0, 3, None), (1, 4, []), (None, 5, ["f"]),
            (None, 6, ["g", "h"]), (0, 2, ["c", "d", "e"])]
    df = spark.createDataFrame(rows, "batch_id long, id long, ids array<string>")
    got = sorted((r.id, r.ids, r.attention_mask, r.position_ids, r.width)
                 for r in C.pad_for_generation(df, "ids", "-").collect())
    assert got == [
        (1, ["-", "a", "b"], [0, 1, 1], [0, 0, 1], 3), (2, ["c", "d", "e"], [1, 1, 1], [0, 1, 2], 3),
        (2, ["c", "d", "e"], [1, 1, 1], [0, 1, 2], 3), (3, ["-"] * 3, [0] * 3, [0] * 3, 3),
        (4, [], [], [], 0), (5, ["-", "f"], [0, 1], [0, 0], 2), (6, ["g", "h"], [1, 1], [0, 1], 2)]
    assert C.pad_for_generation(df.limit(0), "ids", "-").count() == 0
