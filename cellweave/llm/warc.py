"""WARC archives of pages, written and read back as streams of chunks.

A payload is a run of (record, chunk number, bytes) rows, so no task holds a record whole.
The writer adds up a digest chunk by chunk and compresses as it goes, one gzip member a record;
the reader walks the members the same way. Of records with equal payloads one is stored as the
response, the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import fresh_path, prepare, written

CHUNK = 256 << 10
#: A reader's share of an archive: whole records of about so many compressed bytes.
SEGMENT = 4 << 20
#: Chunk rows handed on at a time.
BATCH = 32
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of addresses


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}')}>"


def chunked(pages: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """(row, page_id, url, n_bytes, sha1, refers_to, chunk_no, data): payloads in UTF-8, null read as empty.

    An empty payload has one empty chunk. What :func:`roles` ``decided`` comes first: a page
    that refers to another is one chunk without data, so that only payloads that are stored are
    cut up and moved.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    whole = whole.withColumns({"n_bytes": F.octet_length("html").cast("long"), "sha1": F.sha1("html")})
    refers = F.lit(None).cast("long")
    if decided is not None:
        known = decided.where("response_id <> page_id").select(F.col("page_id").alias("_page_id"), F.col("sha1").alias("_sha1"), "response_id")
        whole = whole.join(known, (F.col("sha1") == F.col("_sha1")) & (F.col("page_id") == F.col("_page_id")), "left")
        refers = F.col("response_id")
    whole = whole.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "n_bytes", "sha1", refers.alias("refers_to"), F.when(refers.isNull(), F.col("html")).otherwise(F.lit(b"")).alias("html"))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("html") / CHUNK) - 1, F.lit(0)).cast("int"))
    return whole.withColumn("chunk_no", F.explode(numbers)).withColumn("data", F.substr("html", F.col("chunk_no") * CHUNK + 1, F.lit(CHUNK))).drop("html")


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, sha1, response_id): the smallest id among records with an equal payload.

    Payloads shorter than ``least`` bytes are each their own response. Only digests are moved.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(html).alias("sha1"), F.octet_length(html).alias("n_bytes")).distinct()
    # written, so that Spark sees both sides' sizes and splits the pages of a frequent payload
    first = written(known.where(F.col("n_bytes") >= least).groupBy("sha1").agg(F.min("page_id").alias("response_id")), "first-records")
    return known.join(first, "sha1", "left").select("page_id", "sha1", "response_id")


def _header(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode("utf-8", "surrogatepass")


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write one record for each row of ``pages`` into archives in ``folder``.

    Returns (path, start, end): segments of whole records. Each attempt of a task writes a file
    of its own, and only segments of the attempts that count are returned, so a lost executor
    leaves at most an archive that nothing names. ``folder`` may be on any file system that
    pyarrow can open.
    """
    # roles know digests and ids only; a page of its own payload's smallest id, or without any id, is a response
    rows = chunked(pages, written(roles(pages, least), "roles"))
    rows = rows.select("row", "chunk_no", "page_id", "url", "n_bytes", "sha1", "refers_to", "data").sortWithinPartitions("row", "chunk_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out = None
        segments: list[tuple[str, int, int]] = []
        at = begun = 0
        gz = sha = None
        for batch in batches:
            for row in (dict(zip(batch.schema.names, r, strict=True)) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                if row["chunk_no"] == 0:
                    if at - begun >= SEGMENT:
                        segments.append((path, begun, at))
                        begun = at
                    gz, sha = zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1()
                    again = row["refers_to"] is not None
                    http = _HTTP % row["n_bytes"]
                    fields = [
                        ("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", record_id(row["page_id"])), ("WARC-Date", "1970-01-01T00:00:00Z"),
                        ("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", "sha1:" + base32(bytes.fromhex(row["sha1"]))),
                        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http) + (0 if again else row["n_bytes"])),
                        ("X-Page-Id", "" if row["page_id"] is None else row["page_id"]),
                    ]
                    if again:
                        fields += [("WARC-Refers-To", record_id(row["refers_to"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", row["refers_to"])]
                    at += out.write(gz.compress(_header(fields) + http))
                    size = 0
                if row["refers_to"] is None:
                    sha.update(row["data"])
                    size += len(row["data"])
                    at += out.write(gz.compress(row["data"]))
                    if size < row["n_bytes"]:
                        continue
                    if sha.hexdigest() != row["sha1"]:
                        raise ValueError(f"page {row['page_id']}: chunks don't add up to the payload")
                at += out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if out is not None:
            out.close()
            segments.append((path, begun, at))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*segments, strict=True)], names=["path", "start", "end"])

    return written(rows.mapInArrow(run, "path string, start long, end long"), "warc-index")


def chunk_rows(stream, size: int) -> Iterator[dict]:
    """Rows (record and chunk number) of a stretch of gzip members: ``CHUNK`` bytes of payload at most, and the
    digest of the payload up to their end (``running``). The ``last`` row of a record comes once
    its length and digest are found right; a record without stored payload has one empty chunk.
    """
    left, pending = size, b""
    while left > 0 or pending:
        member = zlib.decompressobj(31)
        head, held, body, fields, sha, number = b"", bytearray(), 0, None, hashlib.sha1(), 0
        row: dict = {}
        while not member.eof:
            if not pending:
                pending = stream.read(min(left, CHUNK))
                if not pending:
                    raise ValueError("the archive ends inside a record")
                left -= len(pending)
            data = member.decompress(pending, CHUNK)
            pending = member.unused_data if member.eof else member.unconsumed_tail
            if fields is None:
                head += data
                if head.count(b"\r\n\r\n") < 2:
                    continue
                text, http, data = head.split(b"\r\n\r\n", 2)
                fields = dict(line.split(": ", 1) for line in text.decode("utf-8", "surrogatepass").split("\r\n")[1:])
                n = int(fields["Content-Length"]) - len(http) - 4
                row = {
                    "record_id": fields["WARC-Record-ID"], "page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, "payload_bytes": int(http.rsplit(b": ", 1)[1]),
                    "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
                    "refers_to": int(fields["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in fields else None,
                }
            held += data[: max(0, n - body)]
            body += min(len(data), max(0, n - body))
            while len(held) > CHUNK:
                part = bytes(held[:CHUNK])
                del held[:CHUNK]
                sha.update(part)
                yield row | {"chunk_no": number, "data": part, "running": base32(sha.copy().digest()), "last": False}
                number += 1
        if fields is None or body != n:
            raise ValueError("a record is shorter than its header says")
        sha.update(held)
        if row["record_type"] == "response" and base32(sha.digest()) != row["payload_digest"]:
            raise ValueError(f"{row['record_id']}: the payload does not match its digest")
        yield row | {"chunk_no": number, "data": bytes(held), "running": base32(sha.digest()), "last": True}


_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_CHUNKS = pa.schema([("record_id", pa.string()), *_RECORD, ("chunk_no", pa.int64()), ("data", pa.binary()), ("running", pa.string()), ("last", pa.bool_())])


def _segments(index: DataFrame, folder: str, schema: pa.Schema, ddl: str, whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows: list[dict] = []
                with store.open_input_file(path) as file:
                    file.seek(start)
                    for row in chunk_rows(file, end - start):
                        if whole or row["last"]:
                            rows.append({n: row[n] for n in schema.names})
                        if len(rows) == (BATCH if whole else 20 * BATCH):
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # one segment, one share of the work, wherever it was written
    spread = index.repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return spread.select("path", "start", "end").mapInArrow(run, ddl)


_RECORD_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(index: DataFrame, folder: str) -> DataFrame:
    """Records of the segments (path, start, end) of archives on ``folder``'s file system, checked as they are read."""
    return _segments(index, folder, _RECORD, _RECORD_DDL, False)


def read_chunks(index: DataFrame, folder: str) -> DataFrame:
    """The same archives as rows (record_id, chunk_no) with ``data``: no row, and no task, holds a whole payload.

    ``running`` is the payload's digest up to the chunk's end, so a reader of chunks in order can
    tell at which of them a payload went wrong; in the ``last`` one it is the payload's own.
    """
    return _segments(index, folder, _CHUNKS, f"record_id string, {_RECORD_DDL}, chunk_no long, data binary, running string, last boolean", True)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` and read the archives back: one row for each page.

    Rows that repeat id and payload get the same record each; a row without an id is a response
    unless an equal payload has one. A null html is an empty payload, payloads of any length pass in
    chunks, and other columns are not looked at. An empty table gives no rows.
    """
    folder = archive_folder(pages.sparkSession)
    return read(write(pages, folder, least), folder)


def archive_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared folder, as a URI."""
    folder = fresh_path(prepare(spark), "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
