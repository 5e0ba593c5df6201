"""Precision, recall and F1 of sets of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.session import stack


def set_prf(predicted: DataFrame, truth: DataFrame, cases: DataFrame, keys: list[str], case_sensitive: bool = False,
            zero_division: float = 0.0, empty_truth: float = 1.0) -> DataFrame:
    """Scores of the distinct texts per case: ``keys..., precision, recall, f1, tp, fp, fn``.

    ``cases`` lists what is evaluated, also cases whose truth is empty: these score
    ``empty_truth`` and carry no counts. ``zero_division`` is the precision when nothing was
    predicted.
    """
    text = F.col("text") if case_sensitive else F.lower("text")

    def side(df, name):
        flags = [F.lit(1 if name == n else 0).alias(n) for n in ("_p", "_t")]
        return df.select(*keys, text.alias("text"), *flags)

    either = (
        stack(side(predicted, "_p"), side(truth, "_t"))
        .groupBy(*keys, "text").agg(F.max("_p").alias("_p"), F.max("_t").alias("_t"))
    )
    counts = either.groupBy(*keys).agg(
        F.sum(F.col("_p") * F.col("_t")).alias("tp"),
        F.sum(F.col("_p") * (1 - F.col("_t"))).alias("fp"),
        F.sum((1 - F.col("_p")) * F.col("_t")).alias("fn"))
    tp, fp, fn = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "fp", "fn"))
    empty = tp + fn == 0

    def unless_empty(value):
        return F.when(empty, F.lit(empty_truth)).otherwise(value)

    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(zero_division))
    recall = tp / F.greatest(tp + fn, F.lit(1))
    f1 = F.when(tp > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return (
        cases.select(*keys).distinct().join(counts, keys, "left")
        .select(*keys, unless_empty(precision).alias("precision"), unless_empty(recall).alias("recall"),
                unless_empty(f1).alias("f1"),
                *[F.when(~empty, c).alias(n) for n, c in (("tp", tp), ("fp", fp), ("fn", fn))])
    )


def macro(scores: DataFrame, label: str = "label") -> DataFrame:
    """Mean per label over its cases, and the unweighted mean of the label F1s as ``OVERALL``."""
    per_label = scores.groupBy(label).agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])
    none = F.lit(None).cast("double")
    overall = per_label.agg(F.avg("f1").alias("f1")).select(
        F.lit("OVERALL").alias(label), none.alias("precision"), none.alias("recall"), "f1")
    return stack(per_label, overall)


def mean_scores(scores: DataFrame) -> DataFrame:
    """One row with the mean precision, recall and F1."""
    return scores.agg(*[F.avg(c).alias(f"avg_{c}") for c in ("precision", "recall", "f1")])


def accuracy(found: DataFrame, expected: DataFrame, key: str = "doc_id", value: str = "job_id") -> DataFrame:
    """Share of expected values that were found; a key without a finding counts as wrong."""
    both = expected.select(key, F.col(value).alias("_want")).join(
        found.select(key, F.col(value).alias("_got")), key, "left")
    hit = F.coalesce(F.col("_want") == F.col("_got"), F.lit(False))
    return both.agg(F.count_if(hit).alias("correct"), F.count("*").alias("total"),
                    F.avg(hit.cast("double")).alias("accuracy"))


def win_rate(scores: DataFrame, a: str, b: str) -> DataFrame:
    """Share of rows in which ``a`` is strictly greater than ``b``, and how many rows lack one of them."""
    wins = F.col(a) > F.col(b)
    return scores.agg(F.count_if(wins).alias("wins"), F.count(wins).alias("total"),
                      F.count_if(wins.isNull()).alias("without"), F.avg(wins.cast("double")).alias("win_rate"))
