"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "fitmill") -> SparkSession:
    """A session for tests and bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``; without it, it's an error. Only in a local
    session, as in tests, a fresh temporary folder is made and set as the checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name, planned so that a later grouping is right.

    Spark 4.1 lets a union of inputs hashed by the same key pass for hashed by that key, but
    the adaptive planner may coalesce the partitions of each input differently. A grouping
    above then sees one key in two tasks and returns it twice (seen with 4.1.2). Without the
    claim the grouping gets its own exchange. Other versions ignore the setting.
    """
    first.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    for other in others:
        first = first.unionByName(other)
    return first


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cache, the written table survives the loss of executors and gives later
    joins a measured size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
