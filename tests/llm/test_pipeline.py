"""The stages one by one on a small corpus, each against what its operator says of its input."""

import collections

import corpus_pipeline
from payscore.llm import decontaminate, mixing, neardup, privacy, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, spark.read.parquet(f"{SF}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "benchmark decontamination", "personal data", "mixing sources"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns == columns
        got = collections.Counter(r.doc_id for r in after.collect())
        if k == 0:
            want = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
        elif k == 1:
            want = {r.doc_id for r in neardup.near_duplicates(docs).where("kept").collect()}
        elif k == 2:
            want = set(before) - {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
        elif k == 3:
            want = set(before)
            spans = {r.doc_id: r.spans for r in privacy.find(docs).collect()}
            for r in after.collect():
                assert (r.text == before[r.doc_id].text) == (spans[r.doc_id] == "")
        else:
            taken = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect() if r.size}
            assert {i: n for i, n in got.items()} == {i: n for i, n in taken.items() if n}
            want = set(got)
        assert set(got) == want and (k == 4 or max(got.values()) == 1)
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_empty_corpus(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
