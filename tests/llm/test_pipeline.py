"""The pipeline's stages, each against what it has to do with its own input."""

import corpus_pipeline
from tokenmill.llm import contamination, near_dedup, secrets

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality classifier", "MinHash near-dedup"]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    good, unique, clean, masked, pieces = tables[1:]
    assert all(t.columns == columns for t in tables[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = labels.join(good.select("doc_id"), "doc_id", "left_semi")
    assert judged.where("quality = 1").count() >= 0.98 * labels.where("quality = 1").count()
    assert judged.where("quality = 0").count() <= 0.1 * labels.where("quality = 0").count()
    groups = near_dedup.near_duplicates(good).select("component_id").distinct().count()
    assert unique.count() == groups < good.count()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = contamination.find_overlaps(unique, bench).select("id").distinct().count()
    assert bad > 0 and clean.count() == unique.count() - bad
    assert masked.count() == clean.count()
    assert secrets.scan_secrets(clean).where("size(spans) > 0").count() > 0
    assert masked.join(clean.select("doc_id", "text"), ["doc_id", "text"], "left_anti").where(
        "not contains(text, '[SECRET]')").count() == 0
    assert pieces.count() == masked.count() and pieces.where("not lossless").count() == 0


def test_run_equals_its_stages(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    want = sorted(map(tuple, docs.select("doc_id", "n_pieces").collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).select("doc_id", "n_pieces").collect())) == want
