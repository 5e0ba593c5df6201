"""WARC archives of web pages: written as whole-file gzip streams, normalised to one member a record, read back.

`write_streams` makes archives as many crawlers leave them: one gzip stream over all records, in which no record
can be reached alone. `normalise` inflates such a stream once, front to back, rewrites every record as a gzip
member of its own and writes a sidecar index of their offsets beside the archive. `read_records` reads records
through the index. All three work file by file in tasks, hold one record (and a piece of stream) at a time, and
name files by task attempt, so that a repeated task never meets the leavings of a lost one.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.llm.shared import filesystem, workspace, written

#: Payloads shorter than this are never revisits.
REVISIT_BYTES = 1000
PIECE = 1 << 20
_END = b"\r\n\r\n"


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null for responses) of each page.

    A null html is empty. Of pages with equal payloads of `least` bytes or more the one with the largest
    page_id is the response and the others refer to it; rows that repeat its page_id too are that response
    again. A null page_id is smaller than all others, and where all are null every page is a response.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("html"),
                     F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    many = (p.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
            .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    same = p.join(written(many), "payload_digest", "left")
    refers = F.when((F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return same.select("page_id", "url", "html", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def record(page: dict) -> bytes:
    """One WARC/1.1 record; a revisit holds no payload but says its length."""
    revisit = page["refers_to"] is not None
    body = b"" if revisit else page["html"]
    digest = page["payload_digest"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page['page_id'] is None else page['page_id']}>",
             f"WARC-Target-URI: {' '.join((page['url'] or '').split())}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {page['payload_bytes']}",
             "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if revisit:
        lines[4:4] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      f"WARC-Refers-To: <urn:page:{page['refers_to']}>"]
    return "\r\n".join(lines).encode() + _END + body + _END


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record where one should begin")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str]]]:
    """Whole records of an inflated stream that comes in pieces."""
    held = bytearray()
    pieces = iter(pieces)
    while True:
        while (end := held.find(_END)) < 0:
            if (piece := next(pieces, None)) is None:
                if held:
                    raise ValueError("the stream ends within a record's head")
                return
            held += piece
        head = headers(bytes(held[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        while len(held) < size:
            if (piece := next(pieces, None)) is None:
                raise ValueError("the stream ends within a record")
            held += piece
        yield bytes(held[:size]), head
        del held[:size]


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or several, read once from front to back."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(PIECE):
        while data:
            yield inflate.decompress(data)
            if not inflate.eof:
                break
            data, inflate = inflate.unused_data, zlib.decompressobj(31)


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def _output(folder: str, name: str):
    system, root = filesystem(folder)
    system.create_dir(root, recursive=True)
    return system.open_output_stream(f"{root}/{name}", compression=None)


def write_streams(records: DataFrame) -> DataFrame:
    """Writes the rows of with_revisits(), each task one gzip stream; returns the addresses of the files: path."""
    folder = workspace(records.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, deflate = f"{TaskContext.get().taskAttemptId()}.warc.gz", None, zlib.compressobj(6, zlib.DEFLATED, 31)
        for batch in batches:
            for row in range(batch.num_rows):
                out = _output(folder, name) if out is None else out
                page = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                out.write(deflate.compress(record(page)))
        if out is not None:
            out.write(deflate.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

    return written(records.mapInArrow(part, "path string"))


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrites gzip archives (path) with a member for each record; returns path, index_path.

    The index has a line for each record: offset, length, type and record id as JSON.
    """
    folder = workspace(archives.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, nth = TaskContext.get().taskAttemptId(), 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, source = filesystem(path)
                name, nth, place = f"{attempt}-{nth}.warc.gz", nth + 1, 0
                with system.open_input_stream(source, compression=None) as stream, _output(folder, name) as out, \
                        _output(folder, f"{name}.idx") as index:
                    for data, head in split_records(inflated(stream)):
                        packed = member(data)
                        out.write(packed)
                        line = {"offset": place, "length": len(packed), "type": head["warc-type"], "id": head["warc-record-id"]}
                        index.write(json.dumps(line).encode() + b"\n")
                        place += len(packed)
                yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "index_path": [f"{folder}/{name}.idx"]})

    return written(_spread(archives).mapInArrow(part, "path string, index_path string"))


def read_records(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload of each record, through the indexes.

    A response's length and digest are taken from its payload and must agree with its head.
    """
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def page_number(address: str | None) -> int | None:
        number = (address or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def one(data: bytes) -> tuple:
        head = headers(data[:data.index(_END)])
        begin = data.index(_END) + 4
        payload = data[begin:begin + int(head["content-length"])]
        digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
        if head["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
            raise ValueError(f"{head['warc-record-id']}: the payload isn't what its head says")
        return (page_number(head["warc-record-id"]), size, digest, head["warc-type"],
                page_number(head.get("warc-refers-to")), payload)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (system, path), (_, index) = filesystem(row["path"]), filesystem(row["index_path"])
                rows, held = [], 0
                with system.open_input_file(path) as file, system.open_input_stream(index, compression=None) as lines:
                    for line in lines.read().splitlines():
                        at = json.loads(line)
                        rows.append(one(zlib.decompress(file.read_at(at["length"], at["offset"]), 31)))
                        held += len(rows[-1][-1])
                        if held > 8 * PIECE or len(rows) == 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return _spread(archives).mapInArrow(part, schema)


def _spread(files: DataFrame) -> DataFrame:
    """A list of files, dealt out so that each task gets about one."""
    return files.repartition(max(1, files.count()), "path")
