from collections import Counter

import corpus_pipeline
from tests.llm.data import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"


def test_stages_bear_odd_documents(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert stage(spark, no_documents(spark), FOLDER).collect() == []
        assert out.count() > 0
        docs = out
    last = corpus_pipeline.STAGES[-1][1]
    assert Counter(r["doc_id"] for r in last(spark, docs, FOLDER).collect()) == Counter(r["doc_id"] for r in docs.collect())
    assert last(spark, no_documents(spark), FOLDER).collect() == []


def test_decisions_take_effect(spark):
    """Each stage against its operator's own verdicts on the same input."""
    from pyspark.sql import functions as F
    from threadlens.llm import decontaminate, mixing, simhash, toxicity

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("labels", "benchmark"))
    model = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return Counter(r["doc_id"] for r in df.select("doc_id").collect())

    assert ids(stages["toxicity"](spark, docs, FOLDER)) == ids(toxicity.score_toxicity(docs, model).filter("score < 0.7"))
    assert ids(stages["simhash_near_dedup"](spark, docs, FOLDER)) == ids(
        simhash.near_duplicates(docs).filter("doc_id = component_id"))
    assert ids(stages["benchmark_decontamination"](spark, docs, FOLDER)) == ids(
        decontaminate.find_overlap(docs, bench).filter("not contaminated"))
    assert ids(stages["mixing_sources"](spark, docs, FOLDER)) == +Counter(
        {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()})


def test_run(spark):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    by_start = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted(r["doc_id"] for r in found)
    assert by_start[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(by_start, by_start[1:]))
