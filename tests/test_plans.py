"""Plans of the hot operators: pruned scans, one exchange on the key, no nested loops."""

import re

import pytest

import __spark_entry__ as entry
from fitmill.operators import matching as mt
from fitmill.operators import similarity as sim
from fitmill.operators import terms as tm
from fitmill.session import stack
from tests.samples import texts
from workload.inputs import STOP_WORDS, documents, jobs, taxonomy
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def big_exchanges(plan):
    """Exchanges above the scan of the documents, in the first branch of the plan."""
    return len(re.findall(r"Exchange hashpartitioning\(doc_id", plan))


def test_term_hits_are_broadcast_joins_over_a_pruned_scan(spark):
    plan = final_plan(tm.term_hits(documents(spark, SF_DIR), taxonomy(spark)))
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoop" not in plan and plan.count("BroadcastHashJoin") == 2
    scan = re.search(r"FileScan parquet \[doc_id#\d+L,text#\d+\]", plan)
    assert scan and big_exchanges(plan) == 1


def test_all_pairs_shuffle_only_the_text(spark):
    docs = sim.gram_counts(documents(spark, SF_DIR), STOP_WORDS)
    plan = final_plan(sim.tfidf_all_pairs(docs, sim.gram_counts(jobs(spark, SF_DIR), STOP_WORDS, "job_id")))
    assert "SortMergeJoin" not in plan
    assert "hashpartitioning(gram" not in plan.split("BroadcastQueryStage")[0]


@pytest.mark.parametrize("name", ["tfidf_pair_capped", "win_rate", "section_similarity", "scored_corpus"])
def test_grams_of_pairs_are_no_rows(spark, name):
    # grams grouped as rows spill once a task has many texts, and maps of them were broadcast
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[doc_id#\d+L?, (section#\d+, )?gram#", plan)


def test_matrix_shuffles_neither_grams_nor_its_rows(spark):
    plan = entry.queries()["match_matrix"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(doc_id#\d+L, job_id", plan)
    assert not re.search(r"HashAggregate\(keys=\[doc_id#\d+L, gram#", plan)


@pytest.mark.parametrize("name", ["title_strings", "education_strings", "job_title", "entity_count_stats", "doc_profile"])
def test_text_is_folded_once_for_all_patterns(spark, name):
    # inlined, the fold ran again for every cue of every pattern
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") < 12


@pytest.mark.parametrize("name", ["match_matrix", "full_analysis", "scored_corpus", "term_overlap"])
def test_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grouping_above_a_union_is_whole(spark):
    """One key must come out once, however the inputs of the union were partitioned."""
    spread = documents(spark, SF_DIR).repartition("doc_id").select("doc_id", F.length("text").alias("n"))
    left = spread.groupBy("doc_id").agg(F.max("n").alias("n"))
    right = spread.filter("doc_id % 97 = 0").groupBy("doc_id").agg(F.min("n").alias("n"))
    rows = stack(left, right).groupBy("doc_id").agg(F.count("*").alias("c"))
    assert rows.count() == documents(spark, SF_DIR).count()


def test_terms_beyond_broadcast_size(spark):
    """The same hits when nothing may be broadcast, on short texts."""
    docs, t = texts(spark), taxonomy(spark)
    want = {tuple(r) for r in mt.term_sets(docs, t).select("doc_id", F.array_join("terms", "|")).collect()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = mt.term_sets(docs, t)
        got = {tuple(r) for r in df.select("doc_id", F.array_join("terms", "|")).collect()}
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
