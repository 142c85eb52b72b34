"""WARC archives of crawled pages: writing them and reading them back.

Every record is a gzip member of its own, so a reader can start at any member. The reader goes
through an archive once, in blocks of bounded size: it inflates step by step, frames each record by
its Content-Length and checks its digests. Repeated payloads are written once; the others become
revisit records that refer to the record with the payload.

Tasks write their archives under names of their own attempt, and a manifest, written by Spark's
committer, lists those that count. Files of lost or repeated attempts are in no manifest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.llm.shipping import ship
from opdiag.operators.sized import join_lookup
from opdiag.session import scratch_path

#: An archive is closed after the record that takes it past this size.
ARCHIVE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 18
MIN_PAYLOAD = 0
#: Records without a date of their own carry this one, so that archives can be compared.
RECORD_DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = (
    "path string, page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, digests_hold boolean"
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_ID = "<urn:page:{}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    revisit: bool,
) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP head only."""
    body = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        body += payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {RECORD_DATE}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}",
                 f"WARC-Refers-To: {_ID.format('' if refers_to is None else refers_to)}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(body)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    squeeze = zlib.compressobj(wbits=31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return squeeze.compress(whole) + squeeze.flush()


class DamagedArchive(ValueError):
    """An archive that ends within a record or is not made of WARC records."""


class _Inflated:
    """Reads across the members of a gzip file."""

    def __init__(self, source: BinaryIO):
        self.source, self.packed, self.plain = source, b"", bytearray()
        self.inflater = None

    def _more(self) -> bool:
        if not self.packed:
            self.packed = self.source.read(BLOCK_BYTES)
            if not self.packed and self.inflater is None:
                return False
        if self.inflater is None:
            self.inflater = zlib.decompressobj(wbits=31)
        given = len(self.packed)
        try:
            found = self.inflater.decompress(self.packed, BLOCK_BYTES)
        except zlib.error as error:
            raise DamagedArchive(str(error)) from error
        self.plain += found
        self.packed = self.inflater.unconsumed_tail
        if self.inflater.eof:
            self.packed = self.inflater.unused_data
            self.inflater = None
        elif not given and not found:
            raise DamagedArchive("the file ends within a gzip member")
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        searched = 0
        while (end := self.plain.find(b"\n", searched)) < 0:
            searched = len(self.plain)
            if not self._more():
                if self.plain:
                    raise DamagedArchive("the file ends within a line")
                return None
        line = bytes(self.plain[:end]).rstrip(b"\r")
        del self.plain[: end + 1]
        return line

    def blocks(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.plain and not self._more():
                raise DamagedArchive("the file ends within a record")
            part = bytes(self.plain[:size])
            del self.plain[: len(part)]
            size -= len(part)
            if part:
                yield part


def _fields(inflated: _Inflated) -> dict[str, str]:
    fields, last = {}, None
    while line := inflated.line():
        if line[:1] in b" \t" and last:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, _, value = line.partition(b":")
        last = name.strip().lower().decode("utf-8", "replace")
        fields[last] = value.strip().decode("utf-8", "replace")
    return fields


def read_records(source: BinaryIO) -> Iterator[dict]:
    """Records of one archive in order: their fields, payload size and whether digests hold.

    The payload digest of a response is computed from what follows the HTTP head; a revisit has no
    payload of its own, so that only its block digest is checked. A record without a Content-Length
    or a file that ends early raises ``DamagedArchive``.
    """
    inflated = _Inflated(source)
    while (line := inflated.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise DamagedArchive("a record does not begin with its version")
        fields = _fields(inflated)
        try:
            length = int(fields["content-length"])
        except (KeyError, ValueError) as error:
            raise DamagedArchive("a record has no length") from error
        block, payload, size, head = hashlib.sha1(), hashlib.sha1(), 0, b""
        in_head = fields.get("content-type", "").startswith("application/http")
        for part in inflated.blocks(length):
            block.update(part)
            if in_head:
                head += part
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    continue
                part, in_head = head[end + 4 :], False
            payload.update(part)
            size += len(part)
        own = {
            "block": base64.b32encode(block.digest()).decode(),
            "payload": base64.b32encode(payload.digest()).decode(),
        }
        kinds = ("block",) if fields.get("warc-type") == "revisit" else ("block", "payload")
        stated = {kind: fields.get(f"warc-{kind}-digest", "") for kind in kinds}
        yield {
            "fields": fields, "payload_bytes": size, "payload_digest": own["payload"],
            "digests_hold": all(
                not value or value.rpartition(":")[2] == own[kind] for kind, value in stated.items()
            ),
        }


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(_uri(path))


def _uri(folder: str) -> str:
    """A URI for a plain path or a path after a bare ``file:``."""
    if "://" in folder:
        return folder
    return "file://" + folder.removeprefix("file:")


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_payload: int = MIN_PAYLOAD,
) -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to`` per page.

    Of the pages with equal payloads of at least ``min_payload`` bytes that with the largest id is
    a response and the others revisit it; smaller payloads are all responses. Rows that share the
    largest id are all responses, and rows without an id only where no row of theirs has one. A
    null payload is empty.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Sizes guard against equal digests of payloads that differ in length.
    key = ["digest", "size"]
    rows = rows.withColumn("size", F.octet_length("payload"))
    largest = rows.groupBy(*key).agg(F.max("page_id").alias("largest"))
    planned = join_lookup(rows, largest, key)
    revisit = (F.col("size") >= min_payload) & F.coalesce(
        ~F.col("page_id").eqNullSafe(F.col("largest")), F.lit(False)
    )
    return planned.select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Writes planned records below a shared folder and returns the manifest, read back.

    ``folder`` is a path or URI that every executor can write, like the one named by
    ``spark.checkpoint.dir``.
    """
    spark = ship(planned.sparkSession)
    archives = _uri(folder).rstrip("/") + "/archives"
    _make_folder(archives)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(archives)
        out, done = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, payload, digest, revisit, refers_to = (
                    batch.column(column)[at].as_py() for column in range(6)
                )
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                data = record_bytes(page_id, url, payload, digest, refers_to, revisit)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{archives}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{archives}/{name}", records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()),
             pa.array([x[2] for x in done], pa.int64())],
            ["path", "records", "bytes"],
        )

    manifest = folder.rstrip("/") + "/manifest"
    planned.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


def _make_folder(uri: str) -> None:
    store, path = _filesystem(uri)
    store.create_dir(path, recursive=True)


def read_archives(manifest: DataFrame) -> DataFrame:
    """``RECORDS`` of all archives in a manifest (``path``), one row per record.

    Archives are dealt out one by one and read as a stream. For a revisit the payload columns are
    what the record states of the payload it refers to: its digest, and no size.
    """
    spark = ship(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, base = _filesystem(path)
                with store.open_input_stream(base, compression=None) as source:
                    rows = []
                    for record in read_records(source):
                        rows.append(_row(path, record))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    paths = manifest.select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")
    return paths.mapInArrow(read, RECORDS)


_SCHEMA = pa.schema([
    ("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("digests_hold", pa.bool_()),
])


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _row(path: str, record: dict) -> dict:
    fields = record["fields"]
    revisit = fields.get("warc-type") == "revisit"
    return {
        "path": path, "page_id": _page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
        "refers_to": _page(fields.get("warc-refers-to")) if revisit else None,
        "payload_digest": fields.get("warc-payload-digest", "").rpartition(":")[2]
        if revisit else record["payload_digest"],
        "payload_bytes": None if revisit else record["payload_bytes"],
        "digests_hold": record["digests_hold"],
    }


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload size of revisits taken from the response that they refer to.

    The records are joined with themselves, so they should have been written down before.
    """
    answers = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    joined = join_lookup(records, answers, ["refers_to", "payload_digest"], "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "full_bytes")).drop("full_bytes")


def verified(records: DataFrame) -> DataFrame:
    """``records``; an error is raised for one that does not fit its digests."""
    message = F.concat(F.lit("digests do not hold in "), F.coalesce("path", F.lit("no path")))
    return records.filter(
        F.when(F.col("digests_hold"), True).otherwise(F.raise_error(message).cast("boolean"))
    )


def round_trip(spark: SparkSession, pages: DataFrame, **columns) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and returns the records read back.

    Reading a record that does not fit its digests fails. Every archive is read and inflated once:
    what was read, which is small beside the payloads, is written down first.
    """
    folder = scratch_path(spark, "warc")
    manifest = write_archives(plan_records(pages, **columns), folder)
    verified(read_archives(manifest)).write.parquet(f"{folder}/records")
    return resolved(spark.read.schema(RECORDS).parquet(f"{folder}/records"))
