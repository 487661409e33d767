"""WARC archives compressed with Zstandard, written and read back by Spark's tasks.

An archive starts with a skippable frame that holds the (compressed) dictionary; after it, every
record is a frame of its own. Tasks write archives of bounded size into the shared folder and return
their names; only archives so returned are read, so what a lost or repeated attempt left behind does
no harm. The reader decodes one frame at a time and checks frames, headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.folders import staged
from riskloom.llm.memory import lean
from riskloom.operators.joins import lookup_join
from riskloom.session import new_folder

# Fixed values of the formats.
VERSION = "WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

NULL_ID = -(1 << 63)
#: Smaller payloads are never replaced by a reference.
LEAST_SHARED = 1000
#: An archive is closed once it has this many compressed bytes; a longer record has one to itself.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on this many pages at most, whole ones of at most so many bytes.
SAMPLE_PAGES = 512
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Compressed bytes that are fed to the decoder at once.
STEP = 1 << 14

RECORDS = (
    "archive string, page_id long, url string, record_type string, refers_to long, payload binary, "
    "payload_bytes long, payload_digest string, problem string"
)


# --- one record ---------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(identifier: str) -> int | None:
    head, tail = identifier[:12], identifier[12:-1]
    if head != "<urn:x-page:" or identifier[-1:] != ">":
        raise ValueError(f"record id {identifier!r}")
    return None if tail == "null" else int(tail)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value holds no control characters: they, and the percent sign, are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\x7f%" else c for c in value)


def _unclean(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """A response record, or a revisit record that holds the payload's length and digest only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _clean(url)),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
    ]
    if revisit:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"header line {line!r}")
        if name.lower() in found:
            raise ValueError(f"header {name} twice")
        found[name.lower()] = value.strip(" \t")
    return found


def _number(fields: dict[str, str], name: str) -> int:
    value = fields.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"{name} {value!r}")
    return int(value)


def parsed(raw: bytes) -> tuple:
    """Page id, url, type, id of the page it refers to, payload, its length and its digest.

    Raises ValueError where a header is missing or malformed, or a length or digest does not agree.
    """
    version, _, rest = raw.partition(b"\r\n")
    if version.decode() != VERSION:
        raise ValueError(f"version {version[:20]!r}")
    lines, gap, _ = rest.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("headers without end")
    fields = _headers(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise ValueError(f"no {', '.join(sorted(missing))}")
    start = len(version) + 2 + len(lines) + 4
    length = _number(fields, "content-length")
    if raw[start + length :] != b"\r\n\r\n":
        raise ValueError(f"{len(raw) - start - 4} bytes of content, {length} stated")
    block = raw[start : start + length]
    if fields.get("warc-block-digest", _digest(block)) != _digest(block):
        raise ValueError("block digest")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None, None, kind, None, block, length, None
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise ValueError("no HTTP headers")
    stated = _number(_headers(head.partition(b"\r\n")[2]), "content-length")
    digest = fields.get("warc-payload-digest", "")
    if not digest.startswith("sha1:"):
        raise ValueError("no payload digest")
    refers_to = None
    if kind == "response":
        if len(payload) != stated:
            raise ValueError(f"payload of {len(payload)} bytes, {stated} stated")
        if _digest(payload) != digest:
            raise ValueError("payload digest")
    else:
        if payload:
            raise ValueError("revisit with a payload")
        if fields.get("warc-profile") != IDENTICAL or "warc-refers-to" not in fields:
            raise ValueError("revisit without profile or reference")
        refers_to = _page_of(fields["warc-refers-to"])
    url = fields.get("warc-target-uri")
    return (
        _page_of(fields["warc-record-id"]), None if url is None else _unclean(url), kind, refers_to,
        payload if kind == "response" else None, stated, base64.b32decode(digest[5:]).hex(),
    )


# --- one archive --------------------------------------------------------------------------------


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame with the compressed dictionary; nothing without one."""
    packed = zstandard.ZstdCompressor().compress(dictionary) if dictionary else b""
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed if dictionary else b""


def dictionary_of(data: bytes) -> tuple[bytes, int]:
    """The dictionary of an archive and where its first record starts."""
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != DICTIONARY_MAGIC:
        return b"", 0
    end = 8 + struct.unpack("<I", data[4:8])[0]
    if end > len(data):
        raise ValueError("dictionary frame cut short")
    held = data[8:end]
    if held[:4] == struct.pack("<I", FRAME_MAGIC):
        held = zstandard.ZstdDecompressor().decompress(held)
    return held, end


def frames(data: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Of each record's frame: its place, its content and what is wrong with it.

    After a faulty frame the rest cannot be told apart; it is one faulty frame to the end.
    """
    try:
        held, at = dictionary_of(data)
        known = zstandard.ZstdCompressionDict(held) if held else None
    except (ValueError, zstandard.ZstdError) as error:
        yield 0, None, f"dictionary: {error}"
        return
    whole = memoryview(data)
    decoder = zstandard.ZstdDecompressor(dict_data=known)
    while at < len(data):
        start, parts, frame = at, [], decoder.decompressobj()
        try:
            if data[at : at + 4] != struct.pack("<I", FRAME_MAGIC):
                raise ValueError("no frame")
            stated = zstandard.frame_content_size(data[at : at + 18])
            while not frame.eof:
                step = whole[at : at + STEP]
                if not step:
                    raise ValueError("frame cut short")
                parts.append(frame.decompress(step))
                at += len(step) - len(frame.unused_data)
            content = b"".join(parts)
            if stated >= 0 and stated != len(content):
                raise ValueError(f"frame of {len(content)} bytes, {stated} stated")
        except (ValueError, zstandard.ZstdError) as error:
            yield start, None, f"frame at {start}: {error}"
            return
        yield start, content, None


# --- Spark --------------------------------------------------------------------------------------


def trained_dictionary(
    pages: DataFrame, pages_most: int = SAMPLE_PAGES, bytes_most: int = SAMPLE_BYTES
) -> bytes:
    """A dictionary from a bounded sample of whole pages, chosen by a hash; empty if they are too few.

    It only changes how small the archives become.
    """
    # The share is chosen by the number of pages, so that few rows beyond the sample are looked at.
    share = 2 * pages_most / max(pages.count(), 1)
    chosen = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40)) < int(min(share, 1) * (1 << 40))
    payload = F.col("html").cast("string").cast("binary")
    rows = (
        pages.filter(chosen & F.octet_length(F.col("html")).between(1, bytes_most))
        .select(payload.alias("payload")).limit(pages_most).collect()
    )
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r.payload) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def marked(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Pages as page_id, url, payload, with ``keep_id``, the id of the response record of their payload.

    Payloads are equal when length, SHA-1 and a second hash are.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keys = ["n_bytes", "sha1", "hash"]
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({"n_bytes": F.octet_length("payload"), "sha1": F.unhex(F.sha1("payload")), "hash": F.xxhash64("payload")})
    shared = staged(
        rows.filter(F.col("n_bytes") >= least_shared).groupBy(*keys)
        .agg(F.max("page_id").alias("keep_id"), F.min("page_id").alias("least"))
        .filter("least < keep_id").select(*keys, "keep_id"),
        "warc-shared",
    )
    return lookup_join(rows, shared, keys).select(
        "page_id", "url", "payload", F.coalesce("keep_id", "page_id").alias("keep_id")
    )


def _writer(folder: str, dictionary: bytes, archive_bytes: int, date: str) -> Callable:
    from pyarrow.fs import FileSystem

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            ids, urls, payloads, keeps = (batch.column(i) for i in range(4))
            for i in range(len(ids)):
                page, keep = ids[i].as_py(), keeps[i].as_py()
                own = None if page == NULL_ID else page
                yield record(own, urls[i].as_py(), payloads[i].as_py(), keep, page < keep, date)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(folder) if "://" in folder else FileSystem.from_uri(f"file://{folder.removeprefix('file:')}")
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        # One frame a record, with its size and checksum.
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True).compress
        rows = records(batches)
        for first in rows:
            # Every attempt has names of its own.
            name = f"part-{uuid.uuid4().hex}.warc.zst"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(leading_frame(dictionary))
                n_records = 0
                for raw in chain([first], rows):
                    out.write(pack(raw))
                    n_records += 1
                    if out.tell() >= archive_bytes:
                        break
                n_bytes = out.tell()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([n_records], pa.int64()), pa.array([n_bytes], pa.int64())],
                ["name", "n_records", "n_bytes"],
            )

    return run


def write_archives(
    pages: DataFrame, folder: str, dictionary: bytes = b"", least_shared: int = LEAST_SHARED,
    archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); the archives' names and sizes.

    Of rows with equal payloads of at least ``least_shared`` bytes the one with the largest page_id
    is a response and the others revisit it; smaller ones are responses. A null html is empty, a
    null url has no target, a null page_id is below all others and its record is called null. Rows
    that repeat page_id and payload are records of the same kind and name. Other columns are
    ignored. ``folder`` lies where all executors can write: a path or URI that pyarrow can open.
    """
    rows = marked(pages, least_shared).select("page_id", "url", "payload", "keep_id")
    written = rows.mapInArrow(lean(_writer(folder, dictionary, archive_bytes, date)), "name string, n_records long, n_bytes long")
    # Names of attempts that count, fixed before anything is read.
    return staged(written, "warc-names")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            name, rows, held = name.as_py(), [], 0
            for _, raw, problem in frames(content.as_py()):
                found: tuple = (None,) * 7
                if problem is None:
                    try:
                        found = parsed(raw)
                    except ValueError as error:
                        problem = str(error)
                rows.append((name, *found, problem))
                held += len(raw or b"")
                if held >= 4 << 20:
                    yield table(rows)
                    rows, held = [], 0
            if rows:
                yield table(rows)


def read_archives(spark: SparkSession, paths: str | list[str], names: DataFrame | None = None) -> DataFrame:
    """All records of the archives at ``paths``, with the payload of responses.

    With ``names`` (a column ``name``), other archives are left alone. A record that fails a check has
    its fault in ``problem`` and nothing else.
    """
    files = spark.read.format("binaryFile").load(paths)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    if names is not None:
        files = lookup_join(files, names.select(F.col("name").alias("archive")), ["archive"], "left_semi")
    return files.mapInArrow(lean(_records), RECORDS)


def archived(pages: DataFrame, folder: str | None = None, **settings) -> DataFrame:
    """Write ``pages`` to archives and read them back: the rows of :func:`read_archives`.

    A record with a fault fails the query.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    names = write_archives(pages, folder, trained_dictionary(pages), **settings)
    if names.isEmpty():
        return spark.createDataFrame([], RECORDS)
    return read_archives(spark, folder, names).withColumn("payload_bytes", F.when(_sound(F.col("problem")), F.col("payload_bytes")))


def _sound(problem: Column) -> Column:
    return F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
