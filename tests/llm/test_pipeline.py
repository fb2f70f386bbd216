from collections import Counter

import corpus_pipeline
from tidegauge.llm import near_dup

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "decontamination", "packing"]
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.simpleString() == docs.schema.simpleString()
        before, after = (Counter(map(tuple, t.collect())) for t in (docs, out))
        assert not after - before  # rows as they were
        kept.append((sum(before.values()), sum(after.values())))
        docs = corpus_pipeline.stored(out, "test")
    assert all(b <= a for a, b in kept) and kept[-1][1] > 0.5 * kept[0][0]
    groups = {r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert len(groups) == docs.count()  # nothing near is left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
