"""Repeatable samples. Rows are ordered by a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitmill.session import cut_lineage

SEED = 42


def _hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))


def simple_sample(df: DataFrame, n: int, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The first ``n`` rows in hash order."""
    return df.orderBy(_hash(key, seed), key).limit(n)


def stratified_sample(df: DataFrame, n: int | Column, category: str = "category", key: str = "doc_id",
                      seed: int = SEED) -> DataFrame:
    """Up to ``n`` rows per category: the first in hash order.

    A category may hold most of the rows, so no category is ever sorted as a whole. Hash
    buckets are counted first. Whole buckets below the cut are kept without ranking and only
    the one bucket the cut falls into is ranked.
    """
    n = F.lit(n) if isinstance(n, int) else n
    hashed = df.withColumn("_hash", _hash(key, seed)).withColumn("_bucket", F.substring("_hash", 1, 4))
    earlier = Window.partitionBy(category).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        hashed.groupBy(category, "_bucket").agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_n", n)
        .filter((F.col("_before") < F.col("_n")) & (F.col("_before") + F.col("_rows") >= F.col("_n")))
        .select(F.col(category).alias("_category"), F.col("_bucket").alias("_cut"),
                (F.col("_n") - F.col("_before")).alias("_left"))
    )
    # One row per category. Written out, so that its size is known before the join is planned.
    cuts = cut_lineage(cuts, "sample-cuts")
    kept = hashed.join(cuts, F.col(category).eqNullSafe(F.col("_category")), "left").filter(
        F.col("_cut").isNull() | (F.col("_bucket") <= F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(category, "_bucket").orderBy("_hash", key))
    return (
        kept.withColumn("_rank", rank)
        .filter(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")) | (F.col("_rank") <= F.col("_left")))
        .select(*df.columns)
    )


def per_category(df: DataFrame, n_total: int, category: str = "category") -> Column:
    """Rows per category for about ``n_total`` rows: at least one."""
    categories = df.select(F.countDistinct(category)).scalar()
    return F.greatest(F.lit(1), F.floor(F.lit(n_total) / categories)).cast("long")
