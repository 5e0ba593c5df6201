"""Term overlap, fused score and ranking of document and job pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitmill.operators import terms as tm
from fitmill.rules import wordlists as wl
from fitmill.session import stack

# jobs of a full grid
MOST_JOBS = 1000


def term_sets(texts: DataFrame, taxonomy: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, terms`` straight from the occurrences: one exchange, of hits only."""
    return tm.flat(tm.occurrences(texts, taxonomy, key, text), key)


def ratios(matched: Column, predicted: Column, expected: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 with 0 for every empty denominator."""
    precision = F.when(predicted > 0, matched / predicted).otherwise(F.lit(0.0))
    recall = F.when(expected > 0, matched / expected).otherwise(F.lit(0.0))
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return precision, recall, f1


def overlap(doc_sets: DataFrame, job_sets: DataFrame) -> DataFrame:
    """``doc_id, job_id, n_matched, precision, recall, f1`` of every pair sharing a term.

    Pairs that are missing share nothing and have F1 0.
    """
    docs = doc_sets.select("doc_id", F.size("terms").alias("n_doc"), F.explode("terms").alias("term"))
    jobs = job_sets.select("job_id", F.size("terms").alias("n_job"), F.explode("terms").alias("term"))
    counts = docs.join(jobs, "term").groupBy("doc_id", "job_id", "n_doc", "n_job").agg(
        F.count("*").alias("n_matched"))
    precision, recall, f1 = ratios(F.col("n_matched"), F.col("n_doc"), F.col("n_job"))
    return counts.select("doc_id", "job_id", "n_matched", "n_doc", "n_job",
                         precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def overlap_lists(pairs: DataFrame, doc_sets: DataFrame, job_sets: DataFrame) -> DataFrame:
    """Matched, missing and extra terms, sorted, and the ratios, for the given pairs.

    Further columns of either side are kept.
    """
    none = F.array().cast("array<string>")
    both = (
        pairs.join(doc_sets.withColumnRenamed("terms", "_doc"), "doc_id", "left")
        .join(job_sets.withColumnRenamed("terms", "_job"), "job_id", "left")
        .withColumn("_doc", F.coalesce("_doc", none)).withColumn("_job", F.coalesce("_job", none))
    )
    matched = F.array_sort(F.array_intersect("_doc", "_job"))
    precision, recall, f1 = ratios(F.size("matched"), F.size("_doc"), F.size("_job"))
    return (
        both.withColumn("matched", matched)
        .withColumn("missing", F.array_sort(F.array_except("_job", "_doc")))
        .withColumn("extra", F.array_sort(F.array_except("_doc", "_job")))
        .withColumn("precision", precision).withColumn("recall", recall).withColumn("f1", f1)
        .drop("_doc", "_job")
    )


def fused(f1: Column, tfidf: Column, embedding: Column | None = None) -> Column:
    """30 % text similarity, by embedding where there is one, and 70 % term F1."""
    semantic = tfidf if embedding is None else F.coalesce(embedding, tfidf)
    return semantic * wl.SEMANTIC_WEIGHT + f1 * 100 * wl.TERM_WEIGHT


def fit_level(score: Column) -> Column:
    return F.when(score >= wl.STRONG_FROM, "Strong").when(score >= wl.MODERATE_FROM, "Moderate").otherwise("Weak")


def score_pairs(overlaps: DataFrame, tfidf: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """``doc_id, job_id, f1, tfidf, embedding, score, fit_level`` of every pair with any evidence.

    The inputs hold one row per pair each, so they are stacked and grouped once instead of
    outer-joined. They are dealt out by document alone: a pair has two or three rows, which
    grouping ahead would not lessen, and what ranks or lists a document's jobs needs no further
    exchange.
    """
    def side(df, name):
        columns = [F.col(name) if c == name else F.lit(None).cast("double").alias(c)
                   for c in ("f1", "tfidf", "embedding")]
        return df.select("doc_id", "job_id", *columns)

    rows = [side(overlaps, "f1"), side(tfidf, "tfidf")]
    if embeddings is not None:
        rows.append(side(embeddings, "embedding"))
    merged = stack(*rows).repartition("doc_id").groupBy("doc_id", "job_id").agg(
        F.coalesce(F.max("f1"), F.lit(0.0)).alias("f1"),
        F.coalesce(F.max("tfidf"), F.lit(0.0)).alias("tfidf"),
        F.max("embedding").alias("embedding"))
    score = fused(F.col("f1"), F.col("tfidf"), F.col("embedding"))
    return merged.withColumn("score", score).withColumn("fit_level", fit_level(F.col("score")))


def best_job(scores: DataFrame, by: str = "score") -> DataFrame:
    """One row per document: the job with the highest score, the lowest id on ties."""
    top = scores.groupBy("doc_id").agg(F.max(by).alias("_top"))
    rest = [c for c in scores.columns if c not in ("doc_id", "job_id")]
    order = Window.partitionBy("doc_id").orderBy("job_id")
    return (
        scores.join(top, "doc_id").filter(F.col(by) == F.col("_top"))
        .withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select("doc_id", "job_id", *rest)
    )


def best_of_all(scores: DataFrame, docs: DataFrame, jobs: DataFrame, by: str = "score") -> DataFrame:
    """``doc_id, job_id, by`` of every document; the lowest job id with 0 where nothing matches."""
    lowest = jobs.select(F.min("job_id")).scalar()
    found = best_job(scores.select("doc_id", "job_id", by), by)
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("job_id", lowest).alias("job_id"), F.coalesce(by, F.lit(0.0)).alias(by))


def top_jobs(scores: DataFrame, k: int = 10, by: str = "score") -> DataFrame:
    """The k best jobs of every document that has any evidence, with their rank."""
    order = Window.partitionBy("doc_id").orderBy(F.col(by).desc(), "job_id")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def full_grid(scores: DataFrame, docs: DataFrame, job_ids: list, value: str = "score") -> DataFrame:
    """``doc_id, job_id, value`` of every document with every listed job, 0 where there is no evidence.

    The output has a row for each, so the list is bounded; ``top_jobs`` is for many jobs. A document
    meets its evidence as one list, and the rows are made after that: none of them is shuffled.
    """
    if len(job_ids) > MOST_JOBS:
        raise ValueError(f"a grid has {MOST_JOBS} jobs at most; take top_jobs for more")
    entry = "array<struct<job_id:bigint,value:double>>"
    listed = F.array(*[F.lit(j) for j in job_ids]).cast("array<bigint>")
    known = (
        scores.filter(F.col("job_id").isin(job_ids) & F.col(value).isNotNull())
        .groupBy("doc_id").agg(F.collect_list(F.struct("job_id", F.col(value).alias("value"))).cast(entry).alias("_known"))
    )
    grid = docs.select("doc_id").distinct().join(known, "doc_id", "left").select(
        "doc_id", F.coalesce("_known", F.array().cast(entry)).alias("_known"))
    rest = F.transform(F.array_except(listed, F.col("_known.job_id")),
                       lambda j: F.struct(j.alias("job_id"), F.lit(0.0).alias("value")))
    return (
        grid.select("doc_id", F.concat("_known", rest).alias("_row"))
        .select("doc_id", F.explode_outer("_row").alias("_row")).filter("_row IS NOT NULL")
        .select("doc_id", "_row.job_id", F.col("_row.value").alias(value))
    )


def pivot(grid: DataFrame, job_ids: list, value: str = "score") -> DataFrame:
    """The grid as one row per document with a column per listed job."""
    return grid.groupBy("doc_id").pivot("job_id", job_ids).agg(F.max(value))
