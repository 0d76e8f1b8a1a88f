"""Web archives in ZIP packages: records are written per page and read back by range.

A package stores (without compression, so that ranges can be read) the member
``archive/data.warc.gz``, one gzip member per record, and ``indexes/index.jsonl`` with
the offset and length of each record. The reader finds both in the central directory
and reads record after record by range; it extracts nothing. A package without an index
is walked from record to record.

Of pages with equal payloads of at least ``LEAST_BYTES`` bytes, that with the smallest
page_id is a response and the others refer to it.

Defined results for odd input: a null html is an empty payload; a null url leaves the
target out; a null page_id is never the one referred to, and such a page is a response
if no page with an id has its payload; rows that repeat the smallest page_id are all
responses; an empty table gives no packages and no rows; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import MB, materialised
from paytally.llm.files import existing_file, new_file
from paytally.llm.zip_directory import data_place, members, read_range

LEAST_BYTES = 100
PACKAGE_BYTES = 16 * MB
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
# Fixed value: the profile of revisits with an equal payload, from the WARC 1.1 text.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
ROWS_PER_BATCH = 512
# Packages are read back in at most this many tasks.
MOST_READERS = 10_000
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def with_record_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, html, digest, refers_to``; ``refers_to`` is null for responses.

    The first page of a payload is found on ids and digests alone, reduced before the
    shuffle; payloads that occur once are left out of what the pages are joined with.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    page = F.col("page_id").cast("long").alias("page_id")
    pages = pages.select(page, "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = pages.where(F.octet_length("html") >= least_bytes)
    repeated = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    marked = pages.join(materialised(repeated, "payloads"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return marked.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id_in(name: str | None) -> int | None:
    text = (name or "<urn:page:none>")[len("<urn:page:") : -1]
    return None if text == "none" else int(text)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, as a gzip member of its own."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        # Only what would break the header line is escaped.
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_name(refers_to)}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(whole, 1, mtime=0)


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record per page into packages below ``folder``; return their ``path``s.

    The list is a written table. A package has the name of the attempt that wrote it;
    only those of attempts that ended well are listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        held: list[bytes] = []
        paths: list[str] = []

        def flush() -> None:
            paths.append(f"{folder}/pages-{part:06d}-{attempt}-{len(paths):06d}.wacz")
            lines, at = [], 0
            for data in held:
                lines.append(json.dumps({"offset": at, "length": len(data)}))
                at += len(data)
            with new_file(paths[-1]) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as zip_:
                for name, data in ((DATA, b"".join(held)), (INDEX, "\n".join(lines).encode())):
                    zip_.writestr(zipfile.ZipInfo(name), data)
            held.clear()

        size = 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                held.append(record(page_id, url, html.encode(), digest, refers_to))
                size += len(held[-1])
                if size >= package_bytes:
                    flush()
                    size = 0
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return materialised(with_record_types(pages).mapInArrow(run, "path string"), "packages")


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of an unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    headers = _headers(head)
    http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
    return headers, _headers(http), payload


def _walked(source, at: int, end: int) -> Iterator[bytes]:
    """Records of a member without an index, by unpacking one after the other."""
    buffer = b""
    while at < end or buffer:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not buffer:
                if at >= end:
                    raise ValueError("a record ends early")
                buffer = read_range(source, at, min(MB, end - at))
                at += len(buffer)
            out.append(unpack.decompress(buffer))
            buffer = unpack.unused_data
        yield b"".join(out)


def records(source) -> Iterator[bytes]:
    """The unpacked records of an open package."""
    found = {m.name: m for m in members(source)}
    for name, member in found.items():
        if not name.startswith("archive/"):
            continue
        if not member.is_stored:
            raise ValueError(f"{name} is compressed; ranges cannot be read")
        begin = data_place(source, member)
        index = found.get(INDEX) if name == DATA else None
        if index is None or not index.is_stored:
            yield from _walked(source, begin, begin + member.size)
            continue
        lines = read_range(source, data_place(source, index), index.size).splitlines()
        for line in lines:
            place = json.loads(line)
            yield gzip.decompress(read_range(source, begin + place["offset"], place["length"]))


def _row(data: bytes) -> tuple:
    headers, http, payload = parsed(data)
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    kind = headers["warc-type"]
    size = int(http["content-length"])
    if kind == "response" and (
        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest
    ):
        raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
    refers_to = _id_in(headers.get("warc-refers-to"))
    page_id, url = _id_in(headers["warc-record-id"]), headers.get("warc-target-uri")
    return page_id, url, size, digest, kind, refers_to


def read(paths: DataFrame) -> DataFrame:
    """One row per record of the packages (``path``s); payloads are checked against their digests.

    A url comes back as it stands in the record: what would break the header line, and
    all but ASCII, is percent-escaped there.
    """
    names = [field.split()[0] for field in READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with existing_file(path) as source:
                    for data in records(source):
                        rows.append(_row(data))
                        if len(rows) == ROWS_PER_BATCH:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    readers = max(1, min(paths.count(), MOST_READERS))
    return paths.select("path").repartition(readers).mapInArrow(run, READ)
