"""WARC records in ZIP packages, range-read without extraction.

A package holds stored members: ``archive/data.warc.gz`` (each record a gzip member
of its own) and ``indexes/index.cdxj`` (a line per record: offset and length). Writing
tasks stream records into packages of bounded size. Reading goes in two Spark stages:
each package's central (or ZIP64) directory and index are parsed into pieces of a few
megabytes, the pieces are dealt evenly over tasks, and each task reads its byte ranges
and parses the records in them, so one large package is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, text_of
from wakeful.llm.files import create, open_random, read_at, shared_folder
from wakeful.llm.zips import STORED, ZipWriter, data_start, directory

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 1 << 30
PIECE_BYTES = 4 << 20
# Fixed values of the WARC format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
FIELDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


# -- records ----------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of ``refers_to`` that holds the HTTP
    headers only (their length field is that of the payload)."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4


def _page(urn: str) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d*)>", urn)[1]
    return int(number) if number else None


def parse(data: bytes) -> tuple:
    """A record's fields in the order of :data:`FIELDS`; a response's payload is held
    against its digest."""
    head, at = _headers(data)
    block = data[at : at + int(head["content-length"])]
    http, start = _headers(block)
    payload, digest = block[start:], head["warc-payload-digest"].removeprefix("sha1:")
    kind = head["warc-type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    url = head.get("warc-target-uri")
    if url is not None:
        url = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
    refers = _page(head["warc-refers-to"]) if "warc-refers-to" in head else None
    return _page(head["warc-record-id"]), url, kind, refers, int(http["content-length"]), digest, payload if kind == "response" else None


# -- writing ----------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """(``page_id``, ``url``, ``payload``, ``refers_to``): of rows with equal payloads
    (by SHA-1 and length) of ``least_bytes`` or more, all but those with the smallest
    id refer to it."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(text_of(payload_col), "UTF-8").alias("payload")
    )
    sha, size = F.sha1("payload"), F.length("payload")
    first = (
        rows.where(size >= least_bytes)
        .groupBy(sha.alias("sha"), size.alias("size"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("sha", "size", "first")
    )
    joined = rows.join(first, (sha == first["sha"]) & (size == first["size"]), "left")
    return joined.select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_warc(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
    zip64: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Write a record per row into ZIP packages; returns their manifest (``path``,
    ``bytes``, ``records``).

    Null payloads are empty ones; a null url is left out; rows with a null id are
    responses unless an identified row has their payload. Rows that repeat the
    smallest id of a group are all responses. No rows: no package. Other columns are
    not looked at.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stem = f"part-{TaskContext.get().partitionId():05d}"
        done: list[tuple] = []
        package = None

        def close() -> None:
            package.end()
            package.begin(INDEX)
            package.write("".join(index).encode())
            package.end()
            package.close()
            out.close()
            done.append((uri, package.at, len(index)))

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    uri, out = create(folder, stem, ".zip")
                    package, index = ZipWriter(out, zip64), []
                    package.begin(ARCHIVE)
                packer = zlib.compressobj(1, wbits=31)
                data = packer.compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"])) + packer.flush()
                line = {"id": row["page_id"], "offset": package.size, "length": len(data)}
                index.append(json.dumps(line, separators=(",", ":")) + "\n")
                package.write(data)
                if package.size >= package_bytes:
                    close()
                    package = None
        if package is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "bytes", "records"), map(list, zip(*done)))))

    records = with_revisits(pages, id_col, url_col, payload_col, least_bytes)
    return cut_lineage(records.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


# -- reading ----------------------------------------------------------------------


def packages_in(spark: SparkSession, folder: str, suffix: str = ".zip") -> DataFrame:
    """(``path``, ``bytes``) of the packages in a folder; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return found.select(F.regexp_replace("path", "^file:/(?!/)", "file:///").alias("path"), F.col("length").alias("bytes"))


def _walk(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of a stored member without an index."""
    at, begun = 0, 0
    unpack = zlib.decompressobj(31)
    while at < size:
        data = read_at(file, start + at, min(1 << 20, size - at))
        at += len(data)
        while data:
            unpack.decompress(data)
            if not unpack.eof:
                break
            data = unpack.unused_data
            yield begun, at - len(data) - begun
            begun, unpack = at - len(data), zlib.decompressobj(31)


def locate(file, size: int) -> Iterator[tuple[int, list[int]]]:
    """Pieces of a package: (absolute offset, lengths of the records that follow each
    other there)."""
    members = {m.name: m for m in directory(file, size)}
    for name, member in members.items():
        if not name.startswith("archive/") or not name.endswith(".warc.gz"):
            continue
        if member.method != STORED:
            raise ValueError(f"{name} is compressed; records can't be located in it")
        start = data_start(file, member)
        listed = members.get(INDEX) if name == ARCHIVE else None
        if listed is not None and listed.method == STORED:
            lines = read_at(file, data_start(file, listed), listed.size).decode().splitlines()
            spans = sorted((x["offset"], x["length"]) for x in map(json.loads, lines))
        else:
            spans = _walk(file, start, member.size)
        first, lengths = None, []
        for offset, length in spans:
            if lengths and (offset != first + sum(lengths) or sum(lengths) >= PIECE_BYTES or len(lengths) >= 4096):
                yield start + first, lengths
                first, lengths = None, []
            first = offset if first is None else first
            lengths.append(length)
        if lengths:
            yield start + first, lengths


def read_warc(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the packages (``path``, ``bytes``), columns :data:`FIELDS`
    (``payload`` null for revisits, and left out without ``payloads``)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as file:
                    for offset, lengths in locate(file, row["bytes"]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["path"]]), pa.array([offset]), pa.array([lengths], pa.list_(pa.int64()))], ["path", "offset", "lengths"]
                        )

    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    width = len(names) if payloads else len(names) - 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                with open_random(piece["path"]) as file:
                    data = memoryview(read_at(file, piece["offset"], sum(piece["lengths"])))
                rows, at = [], 0
                for length in piece["lengths"]:
                    rows.append(parse(zlib.decompress(data[at : at + length], 31))[:width])
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names[:width])

    tasks = max(1, min(packages.count(), 20_000))
    pieces = cut_lineage(
        packages.select("path", "bytes").repartition(tasks).mapInArrow(find, "path string, offset long, lengths array<long>"), "warc-pieces"
    )
    spread = max(1, min(pieces.count(), 20_000))
    return pieces.repartition(spread).mapInArrow(read, ", ".join(FIELDS.split(", ")[:width]))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT html, min(page_id) AS first FROM p GROUP BY html
)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(p.hex, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p JOIN f ON p.html = f.html
"""
