"""WARC archives: pages to request, response (or revisit) and metadata records, and back to captures.

Writing, every capture becomes three records of one archive file; request and metadata name the
response in WARC-Concurrent-To. Of equal payloads one is a response, the others are revisits that
refer to it. Files are gzipped WARC/1.1 in the shared folder, written by Spark's text writer: a
record is a row, and the blank lines that end it are the row separator.

Reading, files are parsed one record at a time by their Content-Length, and a capture is assembled by
joining its records through their concurrent-to identifiers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import left_join_hot, store
from tidemark.session import shared_dir

#: Production parameters: smallest payload that is deduplicated; payload bytes a file is planned to hold.
MIN_REVISIT_BYTES = 100
FILE_BYTES = 32 << 20

# The parts of a WARC file.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
           "payload_digest string, fields map<string,string>, payload_bytes long, read_digest string, block binary")


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines ``name: value``, without those whose value is null; ends in line breaks are spaces."""
    return F.concat(*[F.coalesce(F.concat(F.lit(name + ": "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit("\r\n")),
                                 F.lit("")) for name, value in fields])


def _record(kind: Column | str, record_id: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = _lines(("WARC-Type", kind), ("WARC-Record-ID", record_id), *fields,
                  ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit(VERSION + "\r\n"), head, F.lit("\r\n"), block)


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\0", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest and refers_to (the response's page_id, for revisits)."""
    payload = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", payload.alias("payload"),
                          F.octet_length(payload).cast("long").alias("payload_bytes"),
                          F.sha2(payload, 256).alias("digest"))
    groups = store(marked.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes")
                   .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "op4_groups")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = left_join_hot(marked, groups, ["digest", "payload_bytes"], "n", max(1, total))
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return found.select("page_id", "url", "payload", "payload_bytes", "digest",
                        F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z",
               min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write the captures of ``pages`` (page_id, url, html) as WARC files under ``path``.

    Of payloads of ``min_bytes`` bytes or more that are equal, that of the smallest page_id is the
    response (all rows with it are); the others are revisits without payload. A null html is an
    empty payload, a null url an empty target; an id that is null isn't the smallest.
    """
    marked = mark_revisits(pages, min_bytes)
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    one = F.monotonically_increasing_id().cast("string")  # tells repeated rows apart
    revisit = F.col("refers_to").isNotNull()
    url = F.coalesce("url", F.lit(""))
    # A response's id follows from its page and payload, so revisits know it; only its own copies share it.
    rows = marked.select("*", one.alias("row"), name.alias("name"), url.alias("target"))
    shared = _urn(F.lit("response"), F.col("name"), F.col("digest"))
    ids = rows.withColumn("response_id", F.when(revisit, _urn(F.lit("revisit"), F.col("name"), F.col("row"))).otherwise(shared))
    ids = ids.select("*", _urn(F.lit("request"), F.col("name"), F.col("row")).alias("request_id"),
                     _urn(F.lit("metadata"), F.col("name"), F.col("row")).alias("metadata_id"),
                     F.when(revisit, _urn(F.lit("response"), F.col("refers_to").cast("string"), F.col("digest"))).alias("refers_to_id"))
    when, target = ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("target"))
    path_of = F.regexp_replace(F.col("target"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    request = _record("request", F.col("request_id"), F.concat(
        F.lit("GET "), F.when(path_of == "", F.lit("/")).otherwise(F.regexp_replace(path_of, r"[\r\n ]+", "%20")),
        F.lit(" HTTP/1.1\r\n\r\n")), when, target, ("WARC-Concurrent-To", F.col("response_id")),
        ("Content-Type", F.lit("application/http; msgtype=request")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"),
                    F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    response = _record(F.when(revisit, "revisit").otherwise("response"), F.col("response_id"), http, when, target, digest,
                       ("WARC-Refers-To", F.col("refers_to_id")), ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
                       ("Content-Type", F.lit("application/http; msgtype=response")))
    metadata = _record("metadata", F.col("metadata_id"), _lines(
        ("page-id", F.col("page_id").cast("string")), ("payload-bytes", F.col("payload_bytes").cast("string")),
        ("refers-to-page", F.col("refers_to").cast("string"))), when, target,
        ("WARC-Concurrent-To", F.col("response_id")), ("Content-Type", F.lit("application/warc-fields")))
    size = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()[0]
    records = ids.repartition(max(1, -(-size // file_bytes)), "row").select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


class _Reader:
    """Bytes of a (gzipped) file, decompressed as they are asked for."""

    def __init__(self, raw: bytes):
        self._raw, self._at, self._gzip = raw, 0, raw[:2] == b"\x1f\x8b"
        self._inflate = zlib.decompressobj(31) if self._gzip else None
        self._held = bytearray()

    def _more(self) -> bool:
        if self._at >= len(self._raw):
            return False
        piece = self._raw[self._at:self._at + (1 << 16)]
        self._at += len(piece)
        if not self._gzip:
            self._held += piece
            return True
        while piece:  # members follow one another
            self._held += self._inflate.decompress(piece)
            piece = self._inflate.unused_data
            if self._inflate.eof:
                self._inflate = zlib.decompressobj(31)
        return True

    def head(self) -> bytes | None:
        """What comes before the next empty line, which is taken too; None at the end. Line ends that
        closed the record before are skipped."""
        while True:
            del self._held[:len(self._held) - len(self._held.lstrip(b"\r\n"))]
            if self._held or not self._more():
                break
        start = 0
        while (end := self._held.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self._held) - 3)
            if not self._more():
                return None
        out = bytes(self._held[:end])
        del self._held[:end + 4]
        return out

    def take(self, n: int) -> bytes:
        while len(self._held) < n and self._more():
            pass
        if len(self._held) < n:
            raise ValueError("a WARC record is shorter than its Content-Length")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out


def parse_records(raw: bytes, with_blocks: bool = True) -> Iterator[dict]:
    """The records of one archive file, in order."""
    reader = _Reader(raw)
    while (head := reader.head()) is not None:
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = reader.take(int(fields.get("content-length", 0)))
        kind, payload = fields.get("warc-type", ""), None
        if fields.get("content-type", "").startswith("application/http") and kind in ("response", "request", "revisit"):
            payload = block.partition(b"\r\n\r\n")[2]
        body = block if payload is None else payload
        yield {"type": kind, "record_id": fields.get("warc-record-id"), "concurrent_to": fields.get("warc-concurrent-to"),
               "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
               "payload_digest": fields.get("warc-payload-digest"),
               "fields": {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode(
                   "utf-8", "replace").split("\r\n")) if k} if kind == "metadata" else None,
               "payload_bytes": len(body), "read_digest": hashlib.sha256(body).hexdigest(),
               "block": block if with_blocks else None}


def read_records(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """One row per record of the WARC files under ``path``; ``block`` is null if not asked for."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                rows, held = [], 0
                for record in parse_records(raw, with_blocks):
                    rows.append(record)
                    held += len(record["block"] or b"") + 512
                    if held > 4 << 20:
                        yield pd.DataFrame(rows)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(parse, _RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: response, request and metadata, each a record or null.

    A capture is a response or revisit; a request or metadata record belongs to it if either names the
    other in concurrent_to. Of several candidates the one with the smallest record_id is taken, so a
    capture is one row. Repeated responses (equal record_id) and others' records without response
    are handled: the first response's copies are captures each, records without response are left out.
    """
    names = records.columns
    main = records.filter(F.col("type").isin("response", "revisit", "resource"))
    others = records.filter(F.col("type").isin("request", "metadata"))
    own = others.select("type", F.coalesce("concurrent_to", "record_id").alias("link"), F.struct(*names).alias("record"))
    pick = own.groupBy("link", "type").agg(F.min_by("record", "record.record_id").alias("record"))
    parts = pick.groupBy("link").agg(*[F.first(F.when(F.col("type") == kind, F.col("record")), True).alias(kind)
                                       for kind in ("request", "metadata")])
    keyed = main.select(F.struct(*names).alias("response"), F.col("record_id").alias("link"))
    by_named = main.filter("concurrent_to IS NOT NULL").select("record_id", F.col("concurrent_to").alias("link"))
    named = (by_named.join(parts, "link").groupBy("record_id")
             .agg(F.min_by("request", "link").alias("request_2"), F.min_by("metadata", "link").alias("metadata_2"))
             .withColumnRenamed("record_id", "link"))
    return (keyed.join(parts, "link", "left").join(named, "link", "left")
            .select("response", F.coalesce("request", "request_2").alias("request"),
                    F.coalesce("metadata", "metadata_2").alias("metadata")))


def resolve(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of captures of ``write_warc``.

    A revisit takes size, digest and page of the response that it refers to by record id; its own
    digest header must agree, else the digest is null, as it is where the response is missing.
    """
    flat = store(read.select(
        F.col("response.record_id").alias("record_id"), F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("target"), F.col("metadata.fields")["page-id"].cast("long").alias("page_id"),
        F.col("response.payload_digest").alias("said"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.read_digest").alias("payload_digest")), "op4_captures")
    counts = flat.filter("target IS NOT NULL").groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    targets = store(flat.filter("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.struct("page_id", "payload_bytes", "payload_digest").alias("of"))
        .join(counts, "target").groupBy("target").agg(F.first("of").alias("of"), F.first("n").alias("n")), "op4_targets")
    joined = left_join_hot(flat, targets, ["target"], "n", flat.count())
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("of.payload_digest")).otherwise(F.col("payload_digest"))
    return joined.select(
        "page_id", F.when(revisit, F.col("of.payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(F.concat(F.lit("sha256:"), digest) == F.col("said"), digest).alias("payload_digest"),
        "record_type", F.when(revisit, F.col("of.page_id")).alias("refers_to"))


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC files in the shared folder and read their captures, without blocks."""
    path = shared_dir(pages.sparkSession, "llm", "op4_warc")
    write_warc(pages, path)
    return captures(read_records(pages.sparkSession, path, with_blocks=False))
