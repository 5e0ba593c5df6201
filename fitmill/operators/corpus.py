"""Statistics over a labelled corpus and its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.functions import text as tx
from fitmill.operators.taxonomy import flatten
from fitmill.rules.wordlists import UNKNOWN_CATEGORY

ALL = "ALL"
LEVELS = ["Strong", "Moderate", "Weak"]


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    """Rows per category, in order of category."""
    return df.groupBy(category).agg(F.count("*").alias("n")).orderBy(category)


def category_word_stats(df: DataFrame, category: str = "category", text: str = "text") -> DataFrame:
    return (
        df.select(category, tx.word_count(F.col(text)).alias("words")).groupBy(category)
        .agg(F.count("*").alias("n"), F.avg("words").alias("avg_words"),
             F.min("words").alias("min_words"), F.max("words").alias("max_words"))
    )


def job_of_category(docs: DataFrame, templates: DataFrame, default_text: str | None = None,
                    default_job: DataFrame | None = None) -> DataFrame:
    """Add the job of each document's category: ``job_id, job_text``.

    ``templates`` has one row per category. Where it has none, ``default_job`` (one row) or
    ``default_text`` applies.
    """
    found = docs.join(templates.select("category", "job_id", F.col("text").alias("job_text")), "category", "left")
    if default_job is not None:
        default_id = default_job.select("job_id").scalar()
        default_text = default_job.select("text").scalar()
    else:
        default_id, default_text = F.lit(-1).cast("long"), F.lit(default_text)
    missing = F.col("job_text").isNull()
    return (
        found.withColumn("job_id", F.when(missing, default_id).otherwise(F.col("job_id")))
        .withColumn("job_text", F.when(missing, default_text).otherwise(F.col("job_text")))
    )


def summary(scored: DataFrame) -> DataFrame:
    """Totals, success rate, means and fit distribution per category and, as ``ALL``, overall.

    One pass: the rollup adds the total row.
    """
    good = F.col("success")
    means = ["skills_extracted", "skills_matched", "skill_f1", "semantic_score", "overall_score"]
    out = scored.rollup("category").agg(
        F.grouping("category").alias("_total"),
        F.count("*").alias("total_samples"),
        F.count_if(good).alias("successful_samples"),
        (100 * F.avg(good.cast("double"))).alias("success_rate"),
        *[F.avg(F.when(good, F.col(c))).alias(f"avg_{c}") for c in means],
        *[F.count_if(good & (F.col("fit_level") == level)).alias(level.lower()) for level in LEVELS])
    return out.withColumn("category", F.when(F.col("_total") == 1, ALL).otherwise(F.col("category")))


def overall(scored: DataFrame) -> DataFrame:
    return summary(scored).filter("_total = 1").drop("_total", "category")


def by_category(scored: DataFrame, k: int = 10) -> DataFrame:
    """Means, fit levels and the ``k`` most common terms of each category's successful documents."""
    kept = ["category", "successful_samples", "avg_skills_extracted", "avg_overall_score", "avg_skill_f1"]
    top = (
        top_terms_by_category(scored.filter("success").select("category", "terms"), k)
        .groupBy("category").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).getField("term").alias("top_terms"))
    )
    return (
        summary(scored).filter("_total = 0 AND successful_samples > 0")
        .select(*kept, *[level.lower() for level in LEVELS]).withColumnRenamed("successful_samples", "sample_count")
        .join(top, "category", "left").withColumn("top_terms", F.coalesce("top_terms", F.array().cast("array<string>")))
    )


def fit_distribution(scored: DataFrame) -> DataFrame:
    """Documents and percent share per fit level over the successful ones."""
    counts = scored.filter("success").groupBy("fit_level").agg(F.count("*").alias("n"))
    # three rows at most
    return counts.withColumn("share", 100 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def top_terms_by_category(sets: DataFrame, k: int = 10) -> DataFrame:
    """``category, rank, term, n``: the most common terms; ties in order of the term."""
    counts = sets.select("category", F.explode("terms").alias("term")).groupBy("category", "term").agg(
        F.count("*").alias("n"))
    order = Window.partitionBy("category").orderBy(F.desc("n"), "term")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_terms(sets: DataFrame, taxonomy: DataFrame, k: int = 20) -> DataFrame:
    """``term, n, category``: the most common terms of all documents."""
    counts = sets.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "term").limit(k)
    return top.join(flatten(taxonomy), "term", "left").withColumn(
        "category", F.coalesce("category", F.lit(UNKNOWN_CATEGORY)))


def _mean_with_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Mean per category and, as ``ALL``, over all documents."""
    rolled = df.rollup("category").agg(F.grouping("category").alias("_total"), F.count("*").alias("n_docs"),
                                       F.avg(value).alias(out))
    return rolled.select(F.when(F.col("_total") == 1, ALL).otherwise(F.col("category")).alias("category"),
                         "n_docs", out)


def expected_recall(sets: DataFrame, expected: DataFrame) -> DataFrame:
    """Mean share of the expected terms that were found; categories without a list are left out.

    The denominator is the length of the list as given.
    """
    lists = expected.groupBy("category").agg(
        F.collect_set(F.lower("term")).alias("_want"), F.count("*").alias("_length"))
    recall = F.size(F.array_intersect("terms", "_want")) / F.col("_length")
    return _mean_with_total(sets.join(lists, "category").withColumn("recall", recall), "recall", "avg_recall")


def terms_per_document(sets: DataFrame) -> DataFrame:
    return _mean_with_total(sets.withColumn("n_terms", F.size("terms")), "n_terms", "avg_terms")


def count_stats(counts: DataFrame, kinds: list[str]) -> DataFrame:
    """``kind, avg_count, max_count, min_count`` of one count column per kind."""
    pairs = ", ".join(f"'{k}', {k}" for k in kinds)
    long = counts.select(F.expr(f"stack({len(kinds)}, {pairs}) AS (kind, n)"))
    return long.groupBy("kind").agg(F.avg("n").alias("avg_count"), F.max("n").alias("max_count"),
                                    F.min("n").alias("min_count"))


def word_recall(text, job_text):
    """Share of the job's distinct words, split at white space, that the text holds."""
    job_words = F.array_distinct(rx.words(F.lower(job_text)))
    held = F.size(F.array_intersect(job_words, rx.words(F.lower(text))))
    return F.when(F.size(job_words) > 0, held / F.size(job_words)).otherwise(F.lit(0.0))
