"""Web archives through a chunk table: no step after the scan holds a whole record.

Payloads become rows of (record, chunk number, bytes) before the shuffle.  Sorted by record and chunk
number they are streamed into gzipped WARC files, one gzip member a record; reading streams the
files back into the same rows, each with the SHA-1 of the payload up to and including its chunk.
Files live in the shared workspace and are opened through ``pyarrow.fs`` (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.workspace import materialize, workspace

CHUNK_BYTES = 64 * 1024
DATE = "2024-01-01T00:00:00Z"  # of all records: equal input gives equal archives
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = "record_id string, page_id string, record_type string, refers_to string, payload_bytes long"


def plan_records(pages: DataFrame, key: str, body: str, url: str, min_bytes: int) -> DataFrame:
    """One row for each row of ``pages``: record id, type, referred page, payload hash and size.

    Of equal payloads (SHA-256 and size) of ``min_bytes`` or more, the row with the smallest key
    is the response and the others revisit it.  Minima are combined before the shuffle and joined
    back to narrow rows, so a payload that a third of the pages share is no bottleneck.
    """
    payload = F.encode(F.coalesce(F.col(body).cast("string"), F.lit("")), "UTF-8")
    meta = pages.select(
        F.col(key).alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.sha2(payload, 256).alias("hash"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    first = meta.groupBy("hash").agg(F.min("page_id").alias("first_page"))
    revisits = (F.col("payload_bytes") >= min_bytes) & (F.col("page_id") > F.col("first_page"))
    return meta.join(first, "hash").select(
        _record_id(F.col("page_id"), F.col("url"), F.col("hash")).alias("record_id"),
        "page_id",
        "payload_bytes",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first_page")).alias("refers_to"),
    )


def _record_id(key, url, payload_hash):
    """Equal rows have equal record ids: they are one record."""
    h = F.md5(F.concat_ws("\t", F.coalesce(key.cast("string"), F.lit("\\N")), url, payload_hash))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def chunk_rows(pages: DataFrame, key: str, body: str, url: str, chunk: int) -> DataFrame:
    """``record_id, page_id, url, sha1, payload_bytes, number, data`` of every payload's chunks."""
    payload = F.encode(F.coalesce(F.col(body).cast("string"), F.lit("")), "UTF-8")
    pages = pages.select(
        F.col(key).alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    size = F.octet_length("payload")
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / chunk)).cast("int"))
    parts = F.transform(
        numbers,
        lambda i: F.struct(
            i.alias("number"), F.substring(F.col("payload"), i * chunk + 1, F.lit(chunk)).alias("data")
        ),
    )
    return pages.select(
        _record_id(F.col("page_id"), F.col("url"), F.sha2("payload", 256)).alias("record_id"),
        "url",
        F.sha1("payload").alias("sha1"),
        F.inline(parts),
    )


def base32_sha1(hex_digits: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digits)).decode()


def _header(row: dict, length: int) -> bytes:
    url = "".join(c for c in row["url"] if c >= " ") or f"urn:page:{row['page_id']}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{row['record_id']}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Page-ID: {row['page_id']}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(row['sha1'])}",
        f"WARC-Payload-Length: {row['payload_bytes']}",
    ]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To-Page: {row['refers_to']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        names = batch.schema.names
        for i in range(len(batch)):
            yield {n: c[i].as_py() for n, c in zip(names, columns, strict=True)}


def write_archives(
    pages: DataFrame,
    key: str = "page_id",
    body: str = "html",
    url: str = "url",
    min_bytes: int = 0,
    chunk: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Write ``pages`` as WARC files; the manifest (``path``, ``records``) and the planned records.

    A file is written by one task under a name of its own and counts only once its manifest row is
    stored; what a lost or repeated task left behind is in no manifest.  Null bodies are empty
    payloads, a null url is written as ``urn:page:<id>``, rows equal in key, url and body are one
    record, further columns are not read, an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    folder = workspace(spark, "warc")
    records = materialize(plan_records(pages, key, body, url, min_bytes), "warc-records")
    distinct = records.dropDuplicates(["record_id"])
    rows = (
        chunk_rows(pages, key, body, url, chunk)
        .join(distinct, "record_id")
        .where("record_type = 'response' OR number = 0")
        .withColumn("data", F.when(F.col("record_type") == "response", F.col("data")))
        .withColumn("page_id", F.col("page_id").cast("string"))
        .withColumn("refers_to", F.col("refers_to").cast("string"))
        .repartition("record_id")
        .sortWithinPartitions("record_id", "number")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pa.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        filesystem.create_dir(root, recursive=True)
        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
        out = packer = digest = None
        last, records, expected = (None, -1), 0, ""

        def finish() -> None:
            if packer is not None:
                if digest.hexdigest() != expected and expected:
                    raise ValueError(f"payload of record {last[0]} is not what was announced")
                out.write(packer.compress(b"\r\n\r\n") + packer.flush())

        for row in _rows(batches):
            if (row["record_id"], row["number"]) == last:
                continue  # an equal row: the same record
            if row["record_id"] != last[0]:
                out = out or filesystem.open_output_stream(path, compression=None)
                finish()
                is_response = row["record_type"] == "response"
                packer, digest = zlib.compressobj(1, wbits=31), hashlib.sha1()
                expected = row["sha1"] if is_response else ""
                length = len(HTTP) + row["payload_bytes"] if is_response else len(HTTP)
                out.write(packer.compress(_header(row, length) + HTTP))
                records += 1
            data = row["data"] or b""
            digest.update(data)
            out.write(packer.compress(data))
            last = (row["record_id"], row["number"])
        finish()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64())})

    manifest = rows.mapInArrow(write, "path string, records long")
    return materialize(manifest, "warc-manifest"), records


class _Stream:
    """Reads a gzipped file of several members piece by piece."""

    def __init__(self, source, block: int):
        self.source, self.block = source, block
        self.unpacker, self.raw, self.buffer = None, b"", bytearray()

    def _fill(self) -> bool:
        raw = self.raw or self.source.read(self.block)
        if not raw:
            return False
        self.unpacker = self.unpacker or zlib.decompressobj(wbits=31)
        self.buffer += self.unpacker.decompress(raw, self.block)
        self.raw = self.unpacker.unconsumed_tail
        if self.unpacker.eof:
            self.raw, self.unpacker = self.unpacker.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to ``mark``, which is skipped; None at the end of the file."""
        while (at := self.buffer.find(mark)) < 0:
            if not self._fill():
                return None
        found = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer only at the end of the file."""
        while len(self.buffer) < n and self._fill():
            pass
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found


def read_archives(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the files in ``manifest``: record columns, ``number``, ``data``, ``sha1``.

    ``sha1`` is the bare base32 digest of the payload so far; a response's last chunk must agree
    with the record's header, else the read fails.  A revisit has one row without data and the
    digest from its header.  ``payload_bytes`` is the header's, of the full payload.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            filesystem = pa.fs.FileSystem.from_uri(manifest_uri)[0]
            with filesystem.open_input_stream(row["path"], compression=None) as source:
                found, size = [], 0
                for chunk_row in _chunks(_Stream(source, chunk), chunk):
                    found.append(chunk_row)
                    size += len(chunk_row["data"] or b"")
                    if size >= 4 * chunk or len(found) >= 1000:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema(
        [(n, pa.string()) for n in ("record_id", "page_id", "record_type", "refers_to")]
        + [("payload_bytes", pa.int64()), ("number", pa.int32()), ("data", pa.binary()), ("sha1", pa.string())]
    )
    folder = workspace(spark, "warc")
    manifest_uri = folder if ":" in folder else f"file://{folder}"
    # one task a file, as far as there are partitions: a fixed number, which is not merged again
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = manifest.select("path").repartition(files, "path")
    return paths.mapInArrow(read, f"{RECORD}, number int, data binary, sha1 string")


def _chunks(stream: _Stream, chunk: int) -> Iterator[dict]:
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        http = stream.until(b"\r\n\r\n")
        left = length - len(http) - 4
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        row = {
            "record_id": fields["WARC-Record-ID"][len("<urn:uuid:") : -1],
            "page_id": fields["WARC-Page-ID"] if fields["WARC-Page-ID"] != "None" else None,
            "record_type": fields["WARC-Type"],
            "refers_to": fields.get("WARC-Refers-To-Page"),
            "payload_bytes": int(fields["WARC-Payload-Length"]),
        }
        if row["record_type"] == "revisit":
            yield row | {"number": 0, "data": None, "sha1": digest}
        else:
            sha1, number = hashlib.sha1(), 0
            while left > 0 or number == 0:
                data = stream.take(min(chunk, left))
                if len(data) < min(chunk, left):
                    raise ValueError(f"record {row['record_id']} is cut short")
                sha1.update(data)
                left -= len(data)
                so_far = base64.b32encode(sha1.digest()).decode()
                if left <= 0 and so_far != digest:
                    raise ValueError(f"record {row['record_id']} does not match its digest")
                yield row | {"number": number, "data": data, "sha1": so_far}
                number += 1
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"record {row['record_id']} does not end where it should")
