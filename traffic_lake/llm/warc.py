"""WARC archives: written by tasks, read back record by record.

An archive is a file of gzip members, one per record. Files come from Spark's
text sink, which any store that Spark knows can hold and whose commit drops
what failed tasks left; the line end it writes after each record is an empty
gzip member, which gzip readers skip.

The reader is sequential: it inflates a member step by step, frames the record
by its Content-Length and verifies block and payload digests.

Of records with equal payloads of at least ``REVISIT`` bytes, those with the
smallest page_id are responses and the others revisits that refer to it; a NULL
page_id is larger than all others. A NULL payload is empty. Repeated rows are
records of their own. A NULL url has no target. An empty table gives an empty
result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, scratch, stored

#: Payloads of fewer bytes are never revisits.
REVISIT = 100
#: Records of an archive at most, and bytes of payload that fit into it however long its records are.
RECORDS, ARCHIVE_BYTES = 5000, 256 << 20
#: Compressed bytes that the reader looks at in one step.
STEP = 1 << 16

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    verified: bool

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header."""
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def http(self) -> dict[str, str]:
        return fields(self.block.partition(b"\r\n\r\n")[0])


def fields(head: bytes) -> dict[str, str]:
    """Header fields after the first line, names in lower case."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member; ``refers_to`` makes it a revisit, which keeps the HTTP header only."""
    digest = hashlib.sha256(payload).hexdigest()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def members(stream: io.BufferedIOBase, step: int = STEP) -> Iterator[Iterator[bytes]]:
    """The members of a gzip stream, each as an iterator of inflated pieces that has to be used up."""
    left = stream.read(step)
    while left:
        inflater = zlib.decompressobj(wbits=31)

        def pieces():
            nonlocal left
            while True:
                piece = inflater.decompress(left, step)
                left = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
                if piece:
                    yield piece
                if inflater.eof:
                    left = left or stream.read(step)
                    return
                if not left and not (left := stream.read(step)) and not piece:
                    raise ValueError("the archive ends inside a member")

        yield pieces()


def read_records(stream: io.BufferedIOBase, step: int = STEP) -> Iterator[Record]:
    """The records of an archive in order. Wrong framing raises ValueError; wrong digests only clear ``verified``."""
    for member in members(stream, step):
        held = bytearray()
        for piece in member:
            held += piece
            if (at := held.find(b"\r\n\r\n")) >= 0:
                break
        else:
            if held:
                raise ValueError("a record without a header")
            continue  # an empty member
        head = bytes(held[:at])
        if not head.startswith(b"WARC/"):
            raise ValueError("a member that is no record")
        headers = fields(head)
        size, block = int(headers["content-length"]), held[at + 4 :]
        for piece in member:
            block += piece
        if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
            raise ValueError(f"a record of {len(block) - 4} bytes where {size} were announced")
        del block[size:]
        out = Record(headers, bytes(block), True)
        checks = [("warc-block-digest", out.block)]
        if headers.get("warc-type") != "revisit":
            checks.append(("warc-payload-digest", out.payload))
        for name, content in checks:
            if name in headers and headers[name] != "sha256:" + hashlib.sha256(content).hexdigest():
                out.verified = False
        yield out


def write_archives(
    pages: DataFrame, path: str, min_revisit: int = REVISIT, records: int = RECORDS, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``. Equal payloads are found with partial minima of their digests.

    An archive is read as one value, so its records are so few that even the longest payloads make ``ARCHIVE_BYTES`` at most.
    """
    longest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    records = max(1, min(records, ARCHIVE_BYTES // (longest + 1024)))
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    base = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    firsts = stored(
        base.filter(F.length("payload") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        f"{path}-firsts",
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    rows = base.join(firsts.hint("shuffle_hash"), "digest", "left").select("page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to"))

    def compose(batches):
        out = ((record(*row, date),) for b in batches for row in arrow_rows([b], "page_id", "url", "payload", "refers_to"))
        return arrow_out(pa.schema([("member", pa.binary())]), out)

    (
        rows.mapInArrow(compose, "member binary")
        .select(F.col("member").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("maxRecordsPerFile", records)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (NULL for revisits), verified."""

    def read(batches):
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("payload", pa.binary()),
                ("verified", pa.bool_()),
            ]
        )

        def rows():
            for batch in batches:
                for (content,) in arrow_rows([batch], "content"):
                    for r in read_records(io.BytesIO(content)):
                        h = r.headers
                        yield (
                            page_of(h["warc-record-id"]),
                            h.get("warc-target-uri"),
                            h["warc-type"],
                            page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None,
                            int(r.http["content-length"]),
                            h["warc-payload-digest"].removeprefix("sha256:"),
                            r.payload if h["warc-type"] == "response" else None,
                            r.verified,
                        )

        return arrow_out(schema, rows())

    kind = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, verified boolean"
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to new archives and read back."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
