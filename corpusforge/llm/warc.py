"""Operator 10, WARC archives compressed with Zstandard.

An archive starts with a skippable frame that holds a dictionary, trained on a
bounded sample of the archive's own records; then every record is one frame.
The reader loads the dictionary from that leading frame, decodes frame by
frame, and checks each record's version line, header fields, lengths, end mark
and payload digest.  Records whose payload equals that of a smaller page_id
are revisits, which name that page and hold no payload.

Scale: payloads are compared by digest; a payload that a third of all pages
share is one row after the partial aggregate, and Spark splits its side of the
join.  Archives are written by the tasks into the shared checkpoint folder,
under names that a repeated task writes again with the same content, each
first under another name and then renamed.  They are read back with Spark's
``binaryFile`` source.

Defined results: a null payload is empty; a null URL has no URL header; page_id
null cannot be referred to, so such a page is a revisit of another page's equal
payload, or a response; rows that repeat the smallest page_id are all
responses; extra columns are not read; no pages give no archive and an empty
table.  A record that fails a check comes back with ``error`` set, and so does
one row for every stretch of an archive that is no readable frame (a damaged or
cut off one); the frames behind it are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.operators.plan_utils import materialize
from corpusforge.session import scratch_path

ARCHIVE_BYTES = 32 << 20  # payload bytes in an archive, about
DICTIONARY_BYTES = 16 << 10
SAMPLES = 100  # records that a dictionary is trained on, at most
LEVEL = 3
MIN_REVISIT = 0
# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 14
NUMBER = re.compile("-?[0-9]{1,19}", re.ASCII)

RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
          "refers_to bigint, payload binary, error string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    head["WARC-Payload-Digest"] = f"sha1:{digest}"
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if revisit:
        head |= {"WARC-Profile": IDENTICAL, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page": str(refers_to)}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """A whole archive: dictionary frame, then one frame per record."""
    out, dictionary = [], None
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, records[:SAMPLES], k=256, d=8)
    except zstandard.ZstdError:  # too few or too small records: the archive goes without
        pass
    if dictionary is not None:
        raw = dictionary.as_bytes()
        out.append(DICTIONARY_MAGIC.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join(out + [packer.compress(r) for r in records])


def frames(content: bytes) -> Iterator[bytes | None]:
    """The decoded frames of an archive, one after the other; None stands for a stretch that is no readable frame.

    Behind such a stretch, reading goes on at the next frame that can be read.
    """
    view, at, reader, damaged = memoryview(content), 0, zstandard.ZstdDecompressor(), False
    while at < len(view):
        magic, size = (int.from_bytes(view[at + k:at + k + 4], "little") for k in (0, 4))
        try:
            if magic in SKIPPABLE and at + 8 + size <= len(view):
                if at == 0 and magic == DICTIONARY_MAGIC:
                    raw = bytes(view[8:8 + size])
                    if raw[:4] == zstandard.FRAME_HEADER:  # the dictionary may itself be compressed
                        raw = zstandard.ZstdDecompressor().decompress(raw)
                    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
                at, damaged = at + 8 + size, False
                continue
            record, end = _frame_at(view, at, reader)
        except (zstandard.ZstdError, EOFError):
            if not damaged:
                yield None
            at = content.find(zstandard.FRAME_HEADER, at + 1)
            if at < 0:
                return
            damaged = True
            continue
        yield record
        at, damaged = end, False


def _frame_at(view: memoryview, at: int, reader: zstandard.ZstdDecompressor) -> tuple[bytes, int]:
    """The decoded frame that starts at a place, and where it ends."""
    frame, parts = reader.decompressobj(), []
    while not frame.eof:
        part = view[at:at + CHUNK]
        if not len(part):
            raise EOFError("the archive ends inside a frame")
        parts.append(frame.decompress(part))
        at += len(part)
    return b"".join(parts), at - len(frame.unused_data)


def _number(text: str | None) -> int | None:
    """A whole number of a header, null if it is none or beyond 64 bits."""
    return int(text) if text and NUMBER.fullmatch(text) and abs(int(text)) < 1 << 63 else None


def parse(raw: bytes | None) -> tuple:
    """A record (None: a frame that cannot be read) as a row of :data:`RECORD`; ``error`` names the first check that fails."""
    if raw is None:
        return None, None, None, None, None, None, None, "frame"
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    try:  # names in any case
        fields = {k.decode().strip().lower(): v.decode().strip() for k, _, v in (x.partition(b":") for x in lines)}
    except UnicodeDecodeError:
        return None, None, None, None, None, None, None, "header encoding"
    number = {k: _number(fields.get(k.lower())) for k in ("Content-Length", "X-Page-Id", "X-Refers-To-Page")}
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "")[5:]
    block, end = rest[:-4], rest[-4:]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((x.split(b":")[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), b"")
    size = _number(length.decode("latin-1"))
    checks = {
        "version": version == VERSION,
        "required fields": all(k.lower() in fields for k in REQUIRED),
        "record length": number["Content-Length"] == len(block) and end == b"\r\n\r\n",
        "type": kind in ("response", "revisit"),
        "payload length": size is not None and (kind == "revisit" and not payload or size == len(payload)),
        "payload digest": kind == "revisit" or digest == base32_sha1(payload),
    }
    error = next((k for k, ok in checks.items() if not ok), None)
    return number["X-Page-Id"], fields.get("warc-target-uri"), kind, size, digest, number["X-Refers-To-Page"], payload, error


def planned(pages: DataFrame, page_id: str, url: str, html: str, min_revisit: int) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: which page holds the payload of each."""
    p = pages.select(pages[page_id].cast("bigint").alias("page_id"), pages[url].alias("url"), F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    small = pages.select(pages[page_id].cast("bigint").alias("id"), F.sha1(F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8")).alias("d"))
    first = small.groupBy("d").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisit = (F.octet_length("payload") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return p.join(first, F.col("digest") == F.col("d"), "left").select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"))


def _writer(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        part, number, records, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pd.DataFrame:
            name = f"{folder}/{part:06d}-{number:05d}.warc.zst"
            content, draft = archive(records), f"{name}.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(draft) as f:
                f.write(content)
            fs.move(draft, name)
            return pd.DataFrame({"path": [name], "records": [len(records)], "bytes": [len(content)]})

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                digest = base64.b32encode(bytes.fromhex(r.digest)).decode()
                records.append(record(*(None if pd.isna(x) else x for x in (r.page_id, r.url)), r.payload, digest, None if pd.isna(r.refers_to) else int(r.refers_to)))
                size += len(r.payload)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    number, records, size = number + 1, [], 0
        if records:
            yield flush()

    return run


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = MIN_REVISIT,
                   root: str | None = None) -> str:
    """Writes one record per page; returns the folder of the archives (``root``, or a new one under the checkpoint folder)."""
    spark = pages.sparkSession
    root = root or scratch_path(spark, f"warc-{uuid.uuid4().hex[:12]}")
    root = "/" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root
    fs, folder = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
    fs.create_dir(folder, recursive=True)
    # nullable ids travel as text: pandas would turn them into floats
    rows = planned(pages, page_id, url, html, min_revisit).sortWithinPartitions("digest", "page_id", "url")
    rows = rows.withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    materialize(rows.mapInPandas(_writer(root), "path string, records bigint, bytes bigint"), "warc-manifest")
    return root


def read_archives(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a folder, in the form of :data:`RECORD`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for raw in frames(content):
                    row = parse(raw)
                    rows.append(row if payloads else (*row[:6], None, row[7]))
                    if len(rows) == 200:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(root)
    return files.select("content").mapInPandas(run, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD.split(", ")])
    return pdf.astype({k: "Int64" for k in ("page_id", "payload_bytes", "refers_to")})


def archive_table(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back: one row per page."""
    rows = read_archives(pages.sparkSession, write_archives(pages), payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")
