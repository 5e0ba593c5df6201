"""Batches that Python workers are sent."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fitmill.llm import decontaminate, neardup, quality, shared, tokens
from tests.llm.data import edge_docs

CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "n": [batch.nbytes]})


@pytest.mark.parametrize("start", [
    lambda docs: quality.scored(docs, 0.5),
    lambda docs: quality.accepted(docs, 0.5),
    lambda docs: neardup.classes(docs),
    lambda docs: decontaminate.cleaned(docs, docs.selectExpr("doc_id AS item_id", "text").limit(1)),
    lambda docs: tokens.write(docs, tokens_path()),
])
def test_operators_send_small_batches(spark, start):
    spark.conf.unset(CONF)
    start(edge_docs(spark))
    long = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    rows = long.mapInArrow(sizes, "rows long, n long").collect()
    assert sum(r["rows"] for r in rows) == 9000 and max(r["n"] for r in rows) < shared.BATCH_BYTES + (1 << 16)


def tokens_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
