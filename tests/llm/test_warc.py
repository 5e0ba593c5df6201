"""WARC: records through stream, members and index; revisits."""

import hashlib
import io
import zlib

import duckdb
from pyspark.sql import functions as F

from fitmill.llm import warc, workload
from tests.llm.data import SMALL


def test_split_and_members():
    page = {"url": "http://x/ y", "payload_digest": "d", "refers_to": None}
    records = [warc.record(page | {"page_id": k, "html": b"<p>\r\n\r\n" * k, "payload_bytes": 7 * k}) for k in range(40)]
    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"".join(map(stream.compress, records)) + stream.flush()
    assert [r for r, _ in warc.split_records(warc.inflated(io.BytesIO(data)))] == records
    assert [r for r, _ in warc.split_records(warc.inflated(io.BytesIO(b"".join(map(warc.member, records)))))] == records


def test_awkward_pages(spark):
    big = "<p>" + "é" * 600
    rows = [(1, "u", big), (9, "u", big), (5, None, big), (2, "a", "short"), (3, "b", "short"), (4, "c", None), (6, "d", ""),
            (9, "u", big), (None, "n", big), (None, "n", "z" * 1000), (None, "n", "z" * 1000), (7, "e", "q" * 999), (8, "e", "q" * 999),
            (10, "long", "<b>" * 400_000), (11, "long", "<b>" * 400_000)]
    rows += [(100 + k, "hot", "same " * 300) for k in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("clash")).withColumn("first", F.lit(1))
    out = warc.read_records(warc.normalise(warc.write_streams(warc.with_revisits(pages)))).collect()
    largest = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            largest[h] = max(i, largest.get(h, i))
    want = []
    for i, _, h in rows:
        data, top = (h or "").encode(), largest.get(h)
        revisit = top is not None and i != top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(want, key=repr)
    assert {bytes(r.payload).decode() for r in out if r.page_id == 9} == {big}
    assert warc.read_records(warc.normalise(warc.write_streams(warc.with_revisits(pages.limit(0))))).collect() == []


def test_given_pages(spark):
    got = sorted((tuple(r) for r in workload.op8_warc_normaliser(spark, SMALL).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM '{SMALL}/pages.parquet'")
    assert got == sorted(con.execute(workload.SQL["op8_warc_normaliser"]).fetchall(), key=repr)
