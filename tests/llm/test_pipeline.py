"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
from fitmill.llm import decontaminate, mixing, neardup, quality
from fitmill.llm.shared import written
from tests.llm.data import SMALL


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SMALL)))
    assert all(k.columns == columns for k in kept[:-1]) and len(corpus_pipeline.STAGES) == 5
    model = quality.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in quality.scored(docs, model).collect() if r.predicted}
    assert {r.doc_id for r in kept[1].collect()} == good
    heads = {r.class_id for r in neardup.classes(kept[1]).collect()}
    assert {r.doc_id for r in kept[2].collect()} == heads
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert not any(r.contaminated for r in decontaminate.matches(kept[3], bench).collect())
    copies = {r.doc_id: r.copies for r in mixing.mix(kept[3]).collect()}
    assert kept[4].count() == sum(copies.values()) and kept[5].count() == kept[4].count()
    total = kept[5].selectExpr("sum(n_tokens) AS n", "max(start + n_tokens) AS last").first()
    assert total.n == total["last"]
