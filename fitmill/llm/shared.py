"""Helpers of the operators: written intermediates, document keys, files in the shared folder."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmill.session import new_path

#: One word: a run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that a Python worker is sent at once.
BATCH_BYTES = 4 << 20


def workspace(spark: SparkSession) -> str:
    """A new folder's address under `spark.checkpoint.dir`, which all executors share.

    What is written there stays until the caller removes it or the session's folder goes.
    """
    return new_path(spark, "fitmill")


def small_batches(spark: SparkSession) -> None:
    """Has the session send Python workers whole rows of texts in batches of BATCH_BYTES, or one row.

    Spark's own bound is 10,000 rows, which for texts are tens of MB, held by a task several times over: as Arrow
    data inside and outside of the JVM, and as strings.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: later steps neither repeat nor lose them."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column = "text") -> Column:
    """64-bit key of a text; with doc_id it names a row. Rows alike in both count as one document."""
    return F.xxhash64(text)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address that a task reads or writes whole files in, and the path in it."""
    if "://" not in uri:  # a path, or a URI of a local one as Spark writes it
        uri = f"file://{uri.removeprefix('file:')}"
    return fs.FileSystem.from_uri(uri)
