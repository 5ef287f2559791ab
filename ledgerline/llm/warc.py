"""WARC archives written from and read into a chunked record table.

Payloads travel as rows of record identifier and chunk number, at most ``chunk_bytes`` each, in both
directions; digests are carried from chunk to chunk, so neither writer nor reader holds a record.
Of records with equal payloads of at least ``min_dedup_bytes``, the one with the largest identifier
is a response and the others revisit it.

Every task attempt writes files of its own names; only files in the manifest, which Spark commits
with the task that wrote them, are read. A lost executor leaves at most files that nobody reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ledgerline.llm.blocks import quoted

CHUNK_BYTES = 1 << 20
MIN_DEDUP_BYTES = 1000
FILE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:record:"
BATCH_BYTES = 4 << 20

CHUNKS = (
    "record_id string, url string, record_type string, refers_to string, payload_bytes bigint, "
    "payload_digest string, chunk_no bigint, is_last boolean, data binary, bytes_so_far bigint, digest_so_far string"
)


def chunk_table(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_dedup_bytes: int, chunk_bytes: int
) -> DataFrame:
    """Rows of record and chunk with the record's type, length and digest. Chunks of a record follow
    each other in one partition. A null payload is empty; a null identifier never is the response
    that others revisit, unless all equal ones are null."""
    records = pages.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(url_col)).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(quoted(payload_col)).cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    keepers = (
        records.where(F.col("payload_bytes") >= min_dedup_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("id").alias("keeper"), F.count("*").alias("copies"))
        .where("copies > 1 and keeper is not null")
        .drop("copies")
    )
    marked = records.join(keepers, ["payload_digest", "payload_bytes"], "left").select(
        "*", (F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))).alias("revisits")
    )
    last = F.when(F.col("revisits"), 0).otherwise(F.greatest(F.lit(0), F.ceil(F.col("payload_bytes") / chunk_bytes) - 1))
    return marked.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("chunk_no")).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("record_id"),
        "url",
        F.when(F.col("revisits"), "revisit").otherwise("response").alias("record_type"),
        F.when(F.col("revisits"), F.col("keeper").cast("string")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        "chunk_no",
        F.when(~F.col("revisits"), F.substring("payload", (F.col("chunk_no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes))).alias("data"),
    )


def _head(record: dict) -> tuple[bytes, bytes]:
    """WARC header and, for a response, the HTTP header in front of the payload."""
    n, digest = record["payload_bytes"], base64.b32encode(bytes.fromhex(record["payload_digest"])).decode()
    http = b""
    if record["record_type"] == "response":
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {record['record_type']}",
        f"WARC-Record-ID: <{URN}{quote(record['record_id'], safe='')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {n}",
    ]
    if record["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(record['url'], safe=':/?#[]@!$&()*+,;=~%')}")
    if record["refers_to"] is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{quote(record['refers_to'], safe='')}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (n if http else 0)}", "", ""]
    return "\r\n".join(lines).encode(), http


class ArchiveWriter:
    """Files of gzip members, one member per record."""

    def __init__(self, folder: str):
        self.files, path = fs.FileSystem.from_uri(folder)
        self.path, self.made, self.out, self.size, self.records = path, [], None, 0, 0

    def begin(self) -> None:
        if self.out is None or self.size >= FILE_BYTES:
            self.end_file()
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out, self.size, self.records = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None), 0, 0
        self.member = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.records += 1

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def end_file(self) -> None:
        if self.out is not None:
            self.out.close()
            self.made.append((self.name, self.size, self.records))
            self.out = None


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write the records of a chunk table below ``folder`` and return the manifest as committed."""
    spark = chunks.sparkSession
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    schema = _parse_datatype_string("name string, bytes bigint, records bigint")
    arrow = to_arrow_schema(schema)

    def run(batches):
        writer, digest, done = ArchiveWriter(folder), None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    writer.begin()
                    head, http = _head(row)
                    writer.add(head + http)
                    digest, done = hashlib.sha1(usedforsecurity=False), 0
                if row["data"] is not None:
                    writer.add(row["data"])
                    digest.update(row["data"])
                    done += len(row["data"])
                    if done == row["payload_bytes"] and digest.hexdigest() != row["payload_digest"]:
                        raise ValueError(f"record {row['record_id']}: digest differs from its chunks")
                if row["data"] is None or done == row["payload_bytes"]:
                    writer.end()
        writer.end_file()
        if writer.made:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, m, strict=True)) for m in writer.made], schema=arrow)

    chunks.mapInArrow(run, schema).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def _records(stream):
    """Headers of each record and a function that reads on in its block."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while line := stream.readline().strip(b"\r\n"):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        left = int(head["Content-Length"])

        def read(n, stream=stream):
            nonlocal left
            data = stream.read(min(n, left))
            if len(data) < min(n, left):
                raise ValueError("archive ends inside a record")
            left -= len(data)
            return data

        yield head, read
        while left:
            read(CHUNK_BYTES)
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record does not end with its mark")


def _identifier(value: str | None) -> str | None:
    return None if value is None else unquote(value.strip("<>").removeprefix(URN))


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives in a manifest, one task per archive.

    ``bytes_so_far`` and ``digest_so_far`` are of the payload up to and with the chunk, so the last
    chunk has those of the whole payload; a revisit is one row without data. ``payload_bytes`` and
    ``payload_digest`` are what the record's header says.
    """
    schema = _parse_datatype_string(CHUNKS)
    arrow = to_arrow_schema(schema)

    def rows(path, files):
        with files.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
            for head, read in _records(io.BufferedReader(plain, CHUNK_BYTES)):
                base = {
                    "record_id": _identifier(head["WARC-Record-ID"]) or None,
                    "url": unquote(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
                    "record_type": head["WARC-Type"],
                    "refers_to": _identifier(head.get("WARC-Refers-To")),
                    "payload_bytes": int(head["X-Payload-Length"]),
                    "payload_digest": base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
                }
                if head["WARC-Type"] == "revisit":
                    yield base | {"chunk_no": 0, "is_last": True, "data": None, "bytes_so_far": 0, "digest_so_far": None}
                    continue
                line = b""
                while not line.endswith(b"\r\n\r\n"):
                    line += read(1)
                digest, done, number = hashlib.sha1(usedforsecurity=False), 0, 0
                while True:
                    data = read(chunk_bytes)
                    digest.update(data)
                    done += len(data)
                    last = done >= base["payload_bytes"]
                    yield base | {"chunk_no": number, "is_last": last, "data": data, "bytes_so_far": done, "digest_so_far": digest.hexdigest()}
                    number += 1
                    if last:
                        break

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                held, size = [], 0
                for row in rows(f"{root}/{name}", files):
                    held.append(row)
                    size += len(row["data"] or b"") + 200
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    number = max(1, manifest.count())
    names = manifest.select("name")
    # One archive is read where its name is.
    return (names.repartition(number) if number > 1 else names).mapInArrow(run, schema)


def round_trip(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_dedup_bytes: int = MIN_DEDUP_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Write all pages to archives below ``folder`` and read them back as a chunk table.

    Null payloads are empty; null urls stay null; repeated rows are records of their own; an empty
    table gives no archives and no rows. Other columns are not read.
    """
    chunks = chunk_table(pages, id_col, url_col, payload_col, min_dedup_bytes, chunk_bytes)
    return read_archives(pages.sparkSession, write_archives(chunks, folder), folder, chunk_bytes)
