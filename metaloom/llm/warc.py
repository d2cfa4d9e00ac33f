"""WARC archives: written with an index, and read back through it by coalesced byte ranges.

Each writing task streams its records, one gzip member each, into files of its own in the shared
folder and returns their index rows: file, offset, length, url and digest. Only rows of tasks that
succeed reach the index table, so files of lost attempts are never read. Readers take the index first:
selected records are sorted by place, near ranges are joined into one read, and members are cut out
of it.
"""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import shared_path, stored

FILE_BYTES = 1 << 29
# Ranges closer than GAP are read as one, up to READ_BYTES (or one record, if that is longer).
GAP, READ_BYTES = 1 << 16, 1 << 23
LEVEL = 1

INDEX = ("page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, file string, "
         "offset bigint, length bigint")
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _whole(value):
    return None if value is None else int(value)


def _frame(rows, names):
    """Whole numbers stay exact beside nulls."""
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes", "offset", "length") if c in names})


def _member(fields, block):
    """One record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    record = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _fields(page_id, url, record_type, refers_to, digest, date):
    """WARC header fields; a line break in an address would end its field and is escaped."""
    address = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    again = record_type == "revisit"
    return [("WARC-Type", record_type), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date),
            ("WARC-Target-URI", address), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page_id),
            ("WARC-Refers-To", _record_id(refers_to, digest) if again else None),
            ("X-Refers-To-Page-Id", refers_to if again else None),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None),
            ("Content-Type", "application/http; msgtype=response")]


def _writer(folder, date):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for page, url, kind, refers, payload in zip(batch["page_id"], batch["url"], batch["record_type"],
                                                            batch["refers_to"], batch["payload"]):
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        store.create_dir(root, recursive=True)
                        path = f"{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{root}/{path}", compression=None)
                        info = _member([("WARC-Type", "warcinfo"), ("WARC-Date", date), ("WARC-Filename", path),
                                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    page, refers, digest = _whole(page), _whole(refers), _digest(payload)
                    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            f"Content-Length: {len(payload)}\r\n\r\n").encode()
                    block = head if kind == "revisit" else head + payload
                    member = _member(_fields(page, url, kind, refers, digest, date), block)
                    out.write(member)
                    rows.append((page, url, kind, refers, digest, path, at, len(member)))
                    at += len(member)
                names = [c.split()[0] for c in INDEX.split(", ")]
                yield _frame(rows, names)
        finally:
            if out is not None:
                out.close()
    return write


def with_types(pages: DataFrame, id_col="page_id", html_col="html", min_bytes=0) -> DataFrame:
    """page_id, url, record_type, refers_to, payload (UTF-8 bytes; null is empty).

    Of equal payloads of at least `min_bytes` bytes the largest id is the response and the others refer
    to it; rows that repeat that id are responses too. Where a group has only null ids all are responses.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), "url",
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    hashed = rows.withColumn("_hash", F.unhex(F.sha2("payload", 256)))
    repeated = (hashed.where(F.octet_length("payload") >= min_bytes).groupBy("_hash")
                .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    joined = hashed.join(repeated, "_hash", "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("_first")).alias("refers_to"), "payload")


def write(pages: DataFrame, id_col="page_id", html_col="html", min_bytes=0, date="2024-01-01T00:00:00Z"):
    """Archives all pages; (folder of the archives, index table)."""
    folder = shared_path(pages.sparkSession, "warc")
    rows = with_types(pages, id_col, html_col, min_bytes)
    # Ids travel as text, since pandas has no exact whole numbers beside nulls.
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return folder, stored(rows.mapInPandas(_writer(folder, date), INDEX), "warc-index")


def parsed(record):
    """(header fields, block) of an unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record where the index points")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def coalesced(offsets, lengths, gap=GAP, most=READ_BYTES):
    """[(first, last)] of sorted ranges that are read as one."""
    runs, first = [], 0
    for i in range(1, len(offsets) + 1):
        if (i == len(offsets) or offsets[i] - (offsets[i - 1] + lengths[i - 1]) > gap
                or offsets[i] + lengths[i] - offsets[first] > most):
            runs.append((first, i - 1))
            first = i
    return runs if len(offsets) else []


def _reader(folder, payloads):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for file, part in batch.groupby("file", sort=False):
                offsets, lengths = part["offset"].tolist(), part["length"].tolist()
                urls = part["url"].tolist()
                with store.open_input_file(f"{root}/{file}") as source:
                    for first, last in coalesced(offsets, lengths):
                        base = offsets[first]
                        held = source.read_at(offsets[last] + lengths[last] - base, base)
                        for i in range(first, last + 1):
                            fields, block = parsed(zlib.decompress(
                                held[offsets[i] - base:offsets[i] - base + lengths[i]], 31))
                            rows.append(_read_row(fields, block, urls[i], payloads))
            names = [c.split()[0] for c in RECORD.split(", ")] + (["payload"] if payloads else [])
            yield _frame(rows, names)
    return read


def _read_row(fields, block, url, payloads):
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, page, refers = fields["WARC-Type"], fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    size = int(re.search(rb"(?i)content-length: (\d+)", head)[1])
    if kind == "response" and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"the payload of page {page} is not the one archived")
    row = (None if page is None else int(page), url, kind, None if refers is None else int(refers), size, digest)
    return (*row, payload if kind == "response" else None) if payloads else row


def read(folder, index: DataFrame, payloads=False) -> DataFrame:
    """The records that `index` (all of it, or a selection) points to; with payloads those of responses.

    Ranges are sorted within stretches of a file that fit one read, so long archives are read by many
    tasks. Every payload is checked against its digest.
    """
    near = (index.withColumn("_stretch", F.floor(F.col("offset") / READ_BYTES))
            .repartition("file", "_stretch").sortWithinPartitions("file", "offset")
            .select("file", "offset", "length", "url"))
    return near.mapInPandas(_reader(folder, payloads), RECORD + (", payload binary" if payloads else ""))
