"""WARC archives with an index, and reads of selected records by byte ranges.

Writing: every task writes one archive file in WARC 1.1, each record a gzip member of its own, and gives one index row per record:
file, offset, length, URL, digest. A record holds an HTTP response; its id comes from the file and the offset, so no two are the same. All records of a
call have one date. Page ids are fields of their own (``Page-ID``, ``Refers-To-Page-ID``). Of
records with equal payloads of at least ``min_dedup_bytes`` bytes the one with the smallest id is the response, the others
are revisits that refer to it and hold no payload. The index is a table, written before anything is read back.

Reading: index rows are dealt out by file and stretch of the file and sorted by offset; neighbouring records are
fetched by one read if the gap between them is small, and a read never holds more than ``READ_BYTES`` unless one record does.

Files are opened through ``pyarrow.fs`` by URI, so the folder may be in any store that it knows. A repeated task writes a new file;
the index names the files of the attempts that counted.

A null payload counts as empty, a record of a null URL has a target under ``urn:no-target:``. Repeated rows give one record each, all of
them responses if their id is the smallest. Rows with a null id are written too, as responses only if no equal payload has an id.
Columns beside id, URL and payload are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.storage import new_folder, stage

INDEX = (
    "page_id bigint, file string, offset bigint, length bigint, url string, payload_bytes bigint, digest string, "
    "record_type string, refers_to bigint"
)
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
STRETCH_BYTES = 32 << 20
END = b"\r\n\r\n"
NO_TARGET = "urn:no-target:"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def with_first(pages: DataFrame, min_dedup_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to, first_url``: the smallest id with the same payload where that is another row's, and its URL.

    Payloads meet by SHA-1 and length. Only digests and ids are aggregated, so a payload that fills a third of the rows costs one
    partial row per task; the join takes the payload of each row to its digest's task, and splits a large one.
    """
    rows = pages.withColumn("_key", F.sha1(F.col("html").cast("binary"))).withColumn("_bytes", F.octet_length("html"))
    first = rows.where(F.col("_bytes") >= min_dedup_bytes).groupBy("_key", "_bytes").agg(
        F.min("page_id").alias("_first"), F.min_by("url", "page_id").alias("_first_url"), F.count("*").alias("_n")
    )
    shared = first.where("_n > 1").drop("_n")
    joined = rows.join(shared, ["_key", "_bytes"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id", "url", F.when(~revisit | F.col("_first").isNull(), F.col("html")).alias("html"),
        F.when(revisit, F.col("_first")).alias("refers_to"), F.when(revisit, F.col("_first_url")).alias("first_url"), F.col("_key").alias("sha1"), F.col("_bytes").alias("n_bytes"),
    )


def target(url: str | None, page_id: int | None) -> str:
    """A URL on one line."""
    return f"{NO_TARGET}{'' if page_id is None else page_id}" if url is None else url.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: uuid.UUID, date: str, page_id, url, payload: bytes, refers_to, first_url, sha1: str, n_bytes: int) -> tuple[bytes, str]:
    """The bytes of one record and its payload digest. A revisit has the head of the HTTP response without its payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}".encode() + END + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target(url, page_id)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Target-URI: {target(first_url, refers_to)}",
            f"WARC-Refers-To-Date: {date}", f"Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(head).encode() + END + block + END, digest


def write(pages: DataFrame, folder: str | None = None, min_dedup_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Write ``page_id, url, html`` to archives in a shared folder; the staged index. ``date`` is that of all records, in UTC to the second; now, if
    none is given."""
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = folder or new_folder(spark) + "/warc"
    rows = with_first(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), min_dedup_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        own = uuid.uuid4()
        name = f"{path.rstrip('/')}/{own.hex}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            found = []
            for page_id, url, html, refers_to, first_url, sha1, n_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = b"" if html is None else html.encode()
                data, digest = record(uuid.uuid5(own, str(offset)), date, page_id, url, payload, refers_to, first_url, sha1, n_bytes)
                data = gzip.compress(data, 1, mtime=0)
                if out is None:
                    out = store.open_output_stream(name, compression=None)
                out.write(data)
                kind = "response" if refers_to is None else "revisit"
                found.append((page_id, name, offset, len(data), url, n_bytes, digest, kind, refers_to))
                offset += len(data)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES, strict=True)], _NAMES)
        if out is not None:
            out.close()

    return stage(rows.mapInArrow(run, INDEX))


_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_TYPES = [{"bigint": pa.int64(), "string": pa.string()}[x.split()[1]] for x in INDEX.split(", ")]


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """The record's fields in lower case, the length of the payload by the HTTP head, and the payload."""
    head, _, rest = data.partition(END)
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(END)
    return fields, int(http.rpartition(b"Content-Length: ")[2]), payload


def coalesced(records: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Reads ``(offset, length, records in it)`` for records sorted by offset."""
    start = end = -1
    held: list[int] = []
    for i, (offset, length) in enumerate(records):
        if held and (offset - end > GAP_BYTES or offset + length - start > READ_BYTES):
            yield start, end - start, held
            held = []
        if not held:
            start = offset
        held.append(i)
        end = max(end, offset + length) if len(held) > 1 else offset + length
    if held:
        yield start, end - start, held


def read(index: DataFrame, root: str) -> DataFrame:
    """The records of the index rows, read from the archives below ``root`` and parsed: ``page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload``. A payload that does not match its digest fails the read."""
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    n = index.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = index.select("file", "offset", "length").repartition(int(n), "file", stretch).sortWithinPartitions("file", "offset")

    def run(batches):
        store, _ = open_store(root)
        for batch in batches:
            files, offsets, lengths = (c.to_pylist() for c in batch.columns)
            begin = 0
            while begin < len(files):
                stop = begin
                while stop < len(files) and files[stop] == files[begin]:
                    stop += 1
                own = list(zip(offsets[begin:stop], lengths[begin:stop], strict=True))
                with store.open_input_file(files[begin]) as source:
                    for start, size, held in coalesced(own):
                        data = source.read_at(size, start)
                        rows = []
                        for i in held:
                            at, length = own[i]
                            head, n_bytes, payload = parse(gzip.decompress(data[at - start : at - start + length]))
                            digest = head["warc-payload-digest"].removeprefix("sha1:")
                            kind = head["warc-type"]
                            if kind == "response" and base32_sha1(payload) != digest:
                                raise ValueError(f"record at {at} of {files[begin]} does not match its digest")
                            page, other = (head.get(k) for k in ("page-id", "refers-to-page-id"))
                            url = head["warc-target-uri"]
                            rows.append((
                                int(page) if page else None, None if url.startswith(NO_TARGET) else url, n_bytes, digest, kind,
                                int(other) if other else None, payload,
                            ))
                        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                begin = stop

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return dealt.mapInArrow(
        run,
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary",
    )
