"""The labelled corpus: ``doc_id, category, text``."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitmill.functions import text as tx
from fitmill.session import stack

CSV_COLUMNS = ("Category", "Resume")


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below ``path``, those with the same first line together."""
    meta = F.col("_metadata")
    place = F.struct(meta.file_block_start.alias("block"), F.monotonically_increasing_id().alias("nth"))
    lines = spark.read.text(path).select("value", meta.file_path.alias("file"), place.alias("place"))
    heads = lines.groupBy("file").agg(F.min_by("value", "place").alias("head"))
    found = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    return [[unquote(f) for f in row.files] for row in found] or [[path]]


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] = CSV_COLUMNS,
             skip_malformed: bool = False, clean: bool = False) -> DataFrame:
    """The named columns of a labelled CSV with quoted multi-line texts.

    Columns are found by the names in each file's own header, trimmed, wherever they stand; a missing
    one is an error and others are left out. Fields that a row lacks are null. ``skip_malformed`` drops
    rows that have more fields than their header (an empty one behind the last doesn't count). ``clean``
    adds the cleaned text beside the raw one. A file with quoted line breaks can't be split, so a large
    corpus comes in several files; their first lines take a scan of their own.
    """
    parts = []
    for files in _files_by_header(spark, path):
        reader = (spark.read.option("header", True).option("multiLine", True)
                  .option("quote", '"').option("escape", '"'))
        names = [c.strip() for c in reader.csv(files[0]).columns]
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}; it has {', '.join(names)}")
        # places for names, since a header may repeat one; one place more tells rows that are too long
        places = [f"_{k}" for k in range(len(names) + 1)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in places])
        rows = reader.schema(schema).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(files)
        if skip_malformed:
            rows = rows.filter(F.col(places[-1]).isNull())
        parts.append(rows.select(*[F.col(places[names.index(c)]).alias(c) for c in columns]))
    df = stack(*parts)
    if clean:
        df = df.withColumn("Resume_Cleaned", tx.clean_text(F.col("Resume")))
    return df


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.option("header", True).option("quote", '"').option("escape", '"')
       .option("quoteAll", True).csv(path))

