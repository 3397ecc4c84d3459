"""WARC archives of page captures, and their records put together again by capture.

Writing: a capture becomes three records: request, response (or revisit, where a
payload is that of another capture) and metadata. The request's record id is
new for each capture; response and metadata name it in `WARC-Concurrent-To`.
Spark's text writer writes the archives, since a record ends as a line does, by
a fixed separator: the two line ends that the format asks for. So any file
system that Spark knows can hold them, and only finished tasks leave files.

Reading: archives are parsed by the lengths in their headers, and the records
of a capture are joined on the identifier that they are concurrent to: one
nested row per capture.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.work import ship, stored, unused

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = "map<string,string>"
RECORD = f"type string, id string, concurrent string, headers {HEADERS}, http {HEADERS}, block binary, payload binary"


@dataclass(frozen=True)
class Archives:
    """Payloads shorter than `least_revisit` bytes are stored each time. `records` bounds the size of an archive.

    Up to `broadcast` digests that several ids share, some 20 MB, go to all
    executors, so that payloads need not be moved; more are joined by a shuffle.
    """

    least_revisit: int = 1000
    records: int = 30_000
    broadcast: int = 200_000
    date: str = "2024-01-01T00:00:00Z"


# --- writing ---------------------------------------------------------------------------------


def with_originals(pages: DataFrame, how: Archives, id: str, payload: str, out: str) -> DataFrame:
    """`pages` with a struct column `out`: bytes, digest (SHA-1), refers_to.

    Of equal payloads of at least `least_revisit` bytes the largest id is the
    original, and refers_to of the others is that id. Rows that repeat the
    original's id and payload are originals too. A null id refers to the
    original if there is one with an id. Only digests are grouped; rows are then
    joined with the digests that several ids share.
    """
    size, sha, sha1, original = unused(pages, "size", "sha", "sha1", "original")
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.withColumn(size, F.octet_length(data).cast("long")).withColumn(sha, F.sha2(data, 256)).withColumn(sha1, F.sha1(data))
    large = rows.where(F.col(size) >= how.least_revisit).select(F.col(sha).alias("digest"), F.col(id).alias("id"))
    shared = (
        large.groupBy("digest")
        .agg(F.max("id").alias("id"), F.min("id").alias("least"), F.count("id").alias("known"), F.count(F.lit(1)).alias("n"))
        .where("id is not null and (id <> least or known < n)")
        .select(F.struct("digest", "id").alias(original))
    )
    shared = stored(shared, "shared")
    if shared.limit(how.broadcast + 1).count() <= how.broadcast:
        shared = F.broadcast(shared)
    same = (F.col(sha) == F.col(f"{original}.digest")) & (F.col(size) >= how.least_revisit)
    other = F.when(~F.col(id).eqNullSafe(F.col(f"{original}.id")), F.col(f"{original}.id"))
    return (
        rows.join(shared, same, "left")
        .withColumn(out, F.struct(F.col(size).alias("bytes"), F.col(sha1).alias("digest"), other.alias("refers_to")))
        .drop(size, sha, sha1, original)
    )


def urn(kind: str, id: Column) -> Column:
    return F.concat(F.lit(f"<urn:{kind}:"), F.coalesce(id.cast("string"), F.lit("")), F.lit(">"))


def record(kind: str | Column, headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record as text, without the separator that ends it. Headers that are null are left out."""
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind)]
    for name, value in headers:
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(END, *lines), F.lit(RECORD_END), block)


def header_value(text: Column) -> Column:
    """A value for one header line: line ends inside it would end the line."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]", " ")


def write(pages: DataFrame, folder: str, how: Archives = Archives(), id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write archives of all captures to a new folder. Null payloads are empty ones, null ids and URLs empty headers."""
    (about,) = unused(pages, "about")
    rows = with_originals(pages, how, id, payload, about).select(
        F.col(id).cast("string").alias("page"),
        header_value(F.col(url)).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
        F.col(f"{about}.bytes").alias("bytes"),
        F.col(f"{about}.digest").alias("digest"),
        F.col(f"{about}.refers_to").cast("string").alias("refers_to"),
        F.uuid().alias("capture"),
    )
    request_id = F.concat(F.lit("<urn:uuid:"), F.col("capture"), F.lit(">"))
    date = F.lit(how.date)
    target = F.col("url")
    path = F.coalesce(F.nullif(F.regexp_extract("url", r"://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    asked = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    revisit = F.col("refers_to").isNotNull()
    records = F.array(
        record(
            "request",
            [("WARC-Record-ID", request_id), ("WARC-Date", date), ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=request")],
            asked,
        ),
        record(
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            [
                ("WARC-Record-ID", urn("page", F.col("page"))),
                ("WARC-Concurrent-To", request_id),
                ("WARC-Date", date),
                ("WARC-Target-URI", target),
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
                ("WARC-Refers-To", F.when(revisit, urn("page", F.col("refers_to")))),
                ("Content-Type", "application/http; msgtype=response"),
            ],
            F.when(revisit, answer).otherwise(F.concat(answer, F.col("payload"))),
        ),
        record(
            "metadata",
            [
                ("WARC-Record-ID", F.concat(F.lit("<urn:metadata:"), F.col("capture"), F.lit(">"))),
                ("WARC-Concurrent-To", request_id),
                ("WARC-Date", date),
                ("WARC-Target-URI", target),
                ("Content-Type", "application/warc-fields"),
            ],
            F.concat_ws(END, F.concat(F.lit("page: "), F.col("page")), F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string"))),
        ),
    )
    (
        rows.select(F.explode(records).alias("record"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", how.records)
        .text(folder)
    )


# --- reading ---------------------------------------------------------------------------------


class Stream:
    """Bytes of a gzipped (one member or many) or plain archive, unpacked as they are asked for."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.at, self.step, self.held = memoryview(data), 0, step, bytearray()
        self.packed = data[:2] == b"\x1f\x8b"
        self.unpacker = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.packed and self.unpacker.eof:
            rest = self.unpacker.unused_data
            self.at -= len(rest)
            self.unpacker = zlib.decompressobj(31)
        if self.at >= len(self.data):
            return False
        part = self.data[self.at : self.at + self.step]
        self.at += len(part)
        self.held += self.unpacker.decompress(part) if self.packed else part
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError(f"archive ends {n - len(self.held)} bytes short")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next mark, which is taken too; None at the end."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held.strip():
                    raise ValueError("archive ends inside a record's header")
                return None
        return self.take(at + len(mark))[:at]


def fields(head: bytes) -> dict[str, str]:
    """Header lines after the first, by name in lower case; lines that begin with white space continue the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def parsed(data: bytes) -> Iterator[dict]:
    """The records of an archive. Payload is the entity of an HTTP message, or the whole block of other records."""
    stream = Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not re.match(rb"WARC/\d", head):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        headers = fields(head)
        block = stream.take(int(headers["content-length"]))
        stream.take(len(RECORD_END))
        http, payload = {}, block
        if headers.get("content-type", "").startswith("application/http"):
            top, _, payload = block.partition(b"\r\n\r\n")
            http = fields(top)
        yield {
            "type": headers.get("warc-type"),
            "id": headers.get("warc-record-id"),
            "concurrent": headers.get("warc-concurrent-to"),
            "headers": list(headers.items()),
            "http": list(http.items()),
            "block": None if http else block,
            "payload": payload,
        }


RECORD_ARROW = pa.schema(
    [
        ("type", pa.string()),
        ("id", pa.string()),
        ("concurrent", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("http", pa.map_(pa.string(), pa.string())),
        ("block", pa.binary()),
        ("payload", pa.binary()),
    ]
)


def read(spark: SparkSession, folder: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """One row per record of the archives in a folder; `block` is null for HTTP messages, whose parts are in `http` and `payload`."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for found in parsed(content.as_py()):
                    held.append(found)
                    size += len(found["payload"]) + 500
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (the identifier its records are concurrent to), request, response, metadata.

    A request without an answer is a capture without response, and records
    whose request is missing are a capture without request. A response or
    metadata record that is concurrent to nothing is left out, since no capture has it.
    """

    fields = ["type", "id", "headers", "http", "block", "payload"]
    fields += [c for c in ("bytes", "sha1") if c in records.columns]

    def part(names: tuple[str, ...], out: str) -> DataFrame:
        key = F.col("id") if out == "request" else F.col("concurrent")
        wanted = records.where(F.col("type").isin(*names))
        return wanted.select(key.alias("capture"), F.struct(*fields).alias(out)).where("capture is not null")

    whole = part(("response", "revisit"), "response").join(part(("metadata",), "metadata"), "capture", "full_outer")
    return part(("request",), "request").join(whole, "capture", "full_outer").select("capture", "request", "response", "metadata")


def summaries(records: DataFrame) -> DataFrame:
    """The records with `bytes` and `sha1` of their payloads, and without the payloads of HTTP messages."""
    data = F.col("payload")
    kept = F.when(F.size("http") == 0, data)
    return records.withColumns({"bytes": F.octet_length(data).cast("long"), "sha1": F.sha1(data), "payload": kept})


def page_of(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, r"\A<urn:page:(.*)>\z", 1), F.lit(""))


def digests(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of each capture of `summaries`.

    Length and digest of a response are those of the payload that was read; of a
    revisit, which has none, those that its headers give for the full payload.
    """
    answer = "response.headers"
    revisit = F.col("response.type") == "revisit"
    told = lambda name: F.element_at(F.col(answer), name)
    page = F.regexp_extract(F.decode("metadata.payload", "UTF-8"), r"(?m)^page: (.*?)\r?$", 1)
    return found.where("response is not null").select(
        F.nullif(page, F.lit("")).cast("long").alias("page_id"),
        F.when(revisit, F.element_at(F.col("response.http"), "content-length").cast("long"))
        .otherwise(F.col("response.bytes"))
        .alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(told("warc-payload-digest"), r"\Asha1:", "")).otherwise(F.col("response.sha1")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        page_of(told("warc-refers-to")).cast("long").alias("refers_to"),
        told("warc-target-uri").alias("url"),
    )
