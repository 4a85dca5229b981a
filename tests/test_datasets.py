"""End-to-end dataset builders on the sf0.001 tables: shapes and invariants."""

from pyspark.sql import functions as F

from tokenmill.operators import ordering as O
from tokenmill.operators import preference as P
from tokenmill.plans import datasets as D
from tokenmill.plans.pretrain import lm_dataset

SF = "/root/testdata/sf0.001"


def test_pretraining_examples(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = O.split_by_document(docs, "doc_id", 0.2, seed=1)
    ex = D.pretraining_examples(docs, max_length=32, stride=16, batch_size=4).collect()
    assert ex and all(len(r.input_ids) == 32 and list(r.input_ids[1:]) == list(r.target_ids[:-1])
                      for r in ex)
    train = [r for r in ex if r.split == "train"]
    per_batch = {}
    for r in train:
        per_batch[r.batch_id] = per_batch.get(r.batch_id, 0) + 1
    assert set(per_batch.values()) == {4}  # drop_last on train


def test_pretraining_batches_are_planned_without_token_arrays(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(150))
    docs = spark.createDataFrame([(d, text[d:], "validation" if d == 3 else "train") for d in range(5)],
                                 "doc_id long, text string, split string")
    want = []
    for s in ("train", "validation"):
        w = lm_dataset(docs.where(F.col("split") == s), 8, 3)
        want += D._batches(w, s, "window_id", 4, 0, 0, True).withColumn("split", F.lit(s)).collect()
    ranked, assign = [], O.assign_batches

    def spy(df, *args, **kw):
        ranked.append(df.columns)
        return assign(df, *args, **kw)

    monkeypatch.setattr(O, "assign_batches", spy)
    got = D.pretraining_examples(docs, max_length=8, stride=3, batch_size=4)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) > 200
    assert len(ranked) == 3 and not any("input_ids" in c or "target_ids" in c for c in ranked)


def test_sft_dataset_static_and_dynamic(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    st = D.sft_dataset(turns, max_length=128, batch_size=3, val_fraction=0.1,
                       dynamic_padding=False, ignore="-100").collect()
    assert st and all(len(r.input_ids) == 127 == len(r.target_ids) for r in st)
    assert {r.split for r in st} == {"train", "validation"}
    dyn = D.sft_dataset(turns, max_length=2048, batch_size=3, val_fraction=0.1, filter_small=True,
                        filter_scan=50, max_examples=20, ignore="-100").collect()
    assert 0 < len(dyn) <= 20
    widths = {}
    for r in dyn:
        widths.setdefault((r.split, r.batch_id), set()).add(len(r.input_ids))
    assert all(len(v) == 1 for v in widths.values())


def test_reward_dataset(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    pairs = P.pairs_from_conversations(turns)
    rd = D.reward_dataset(pairs, max_length=96, batch_size=2, val_fraction=0.2).collect()
    assert rd
    for r in rd:
        assert len(r.chosen_ids) == r.chosen_width == len(r.chosen_attention_mask)
        assert sum(r.chosen_attention_mask) == r.chosen_len <= 96
    st = D.reward_dataset(pairs, max_length=96, batch_size=2, dynamic_padding=False).collect()
    assert all(len(r.chosen_ids) == 96 == len(r.rejected_ids) for r in st)
