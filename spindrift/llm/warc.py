"""Web archives: one gzip member per record, written by Spark and read back record by record.

Archives are written with Spark's own writer, so they go to any store and a lost executor's file is
written anew. That writer ends every row with a separator; the separator here is a zero byte, which
takes the place of the last byte of a member (the high byte of its size). Where that is not zero, in
records from 16 MiB, an empty member follows, whose size is zero. So an archive is members and
nothing else, as every reader of gzip expects.

The writer can only count rows. A record that takes more than its share of a file is followed by
rows of empty members, so that files are bounded by bytes as well as by records.

The reader walks through an archive once: it inflates a member bit by bit, reads the header, takes
as many bytes as the header announces, and holds them against the digests.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.llm.shared import bounded, fresh_path, record_batch, texts_as_bytes

#: Fixed values of the format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
#: A member that holds nothing.
_NOTHING = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
_ID = "urn:x-page:"

LEAST_REVISIT_BYTES = 100
RECORDS_PER_FILE = 20_000
FILE_BYTES = 64 << 20
_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload", pa.binary())])
_ROWS_SQL = ("page_id long, url string, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long, payload binary")


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def member(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """A record as a gzip member of its own."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers),
             b"Content-Length: %d" % len(block)]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + _END) + packer.compress(block + _END) + packer.flush()


def rows_of(packed: bytes, share: int) -> list[bytes]:
    """A member as rows that lack their last byte, a zero, one for every ``share`` bytes or part of it."""
    rows = [packed if packed[-1] == 0 else packed + _NOTHING]
    rows += [_NOTHING] * ((len(packed) - 1) // share)
    return [row[:-1] for row in rows]


def read(chunks: Iterable[bytes]) -> Iterator[Record]:
    """Records of an archive that comes in chunks of any size.

    Empty members and zero bytes between members are passed over. Raises ValueError where a member
    is cut short, framing is wrong or a digest does not fit.
    """
    source, rest = iter(chunks), b""
    while True:
        rest = rest.lstrip(b"\0")
        while not rest:
            chunk = next(source, None)
            if chunk is None:
                return
            rest = bytes(chunk).lstrip(b"\0")
        inflater, parts, have, head, need = zlib.decompressobj(31), [], 0, None, None
        while not inflater.eof:
            if not rest:
                chunk = next(source, None)
                if chunk is None:
                    raise ValueError("the archive ends within a record")
                rest = bytes(chunk)
            parts.append(inflater.decompress(rest))
            have += len(parts[-1])
            rest = inflater.unused_data if inflater.eof else b""
            if head is None and (len(parts) > 1 or _END in parts[0]):
                parts = [b"".join(parts)]
                cut = parts[0].find(_END)
                if cut >= 0:
                    head = _headers(parts[0][:cut])
                    need = cut + len(_END) + int(head["content-length"]) + len(_END)
            if need is not None and have > need:
                raise ValueError("a record is longer than its header says")
        if not have:
            continue
        if head is None or have != need:
            raise ValueError("a record is shorter than its header says")
        whole = b"".join(parts)
        if not whole.endswith(_END):
            raise ValueError("a record has no end")
        record = Record(head, whole[whole.find(_END) + len(_END):-len(_END)])
        expected = head.get("warc-block-digest")
        if expected and expected != "sha256:" + hashlib.sha256(record.block).hexdigest():
            raise ValueError(f"digest of {head.get('warc-record-id')} does not fit its block")
        yield record


def _headers(head: bytes) -> dict[str, str]:
    first, *lines = head.split(b"\r\n")
    if first != VERSION:
        raise ValueError("not an archive record")
    pairs = (line.decode().split(": ", 1) for line in lines)
    return {k.lower(): v for k, v in pairs}


def _page(reference: str | None) -> int | None:
    name = (reference or "").removeprefix(f"<{_ID}").removesuffix(">")
    return None if name in ("", "none") else int(name)


def _reference(page_id: int | None) -> str:
    return f"<{_ID}{'none' if page_id is None else page_id}>"


def write_archives(df: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url",
                   html: str = "html", date: str = "1970-01-01T00:00:00Z",
                   least_revisit_bytes: int = LEAST_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE,
                   file_bytes: int = FILE_BYTES) -> None:
    """Write one record per page.

    Of records with equal payloads of ``least_revisit_bytes`` or more, the one with the smallest id
    is the response and the others revisit it, without the payload; rows that repeat that id are
    responses too. A null page has an empty payload; a null id is never the smallest unless there
    is no other; other columns are ignored. A file holds at most ``records_per_file`` records and
    ``file_bytes`` bytes, its last record beyond that at most.
    """
    if not 0 < records_per_file <= file_bytes:
        raise ValueError("a file needs a record, and a record a byte")
    share = file_bytes // records_per_file

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "payload", 4 << 20):
            out = []
            rows = zip(*(batch[c].to_pylist() for c in ("id", "url", "digest", "size", "first", "kind")))
            for (i, u, digest, size, first, kind), payload in zip(rows, texts_as_bytes(batch["payload"])):
                block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         b"Content-Length: %d\r\n\r\n" % size) + payload
                headers = [("WARC-Type", kind), ("WARC-Record-ID", _reference(i)), ("WARC-Date", date)]
                if u is not None:
                    headers.append(("WARC-Target-URI", u.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
                headers += [("WARC-Payload-Digest", f"sha256:{digest}"),
                            ("WARC-Payload-Length", str(size)),
                            ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
                            ("Content-Type", "application/http; msgtype=response")]
                if kind == "revisit":
                    headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _reference(first))]
                out += rows_of(member(headers, block), share)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    pages = df.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                      payload.alias("payload")).withColumns({
        "digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    firsts = pages.where(F.col("size") >= least_revisit_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisit = F.coalesce(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    records = pages.join(firsts, "digest", "left").withColumn(
        "kind", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "payload", F.when(~revisit, F.col("payload")))
    (records.mapInArrow(build, "member binary").select(F.col("member").cast("string"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(path))


def read_archives(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """One row per record: id, url, size and digest of the full payload, kind, the response that a
    revisit refers to, and the payload of a response (null without ``payloads``)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for content in batch["content"]:
                body = memoryview(content.as_buffer())
                for record in read(body[i:i + (1 << 16)] for i in range(0, len(body), 1 << 16)):
                    head = record.headers
                    payload = record.block[record.block.index(_END) + len(_END):]
                    digest = head["warc-payload-digest"].removeprefix("sha256:")
                    kind = head["warc-type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {head['warc-record-id']} does not fit its digest")
                    url = head.get("warc-target-uri")
                    url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    keep = payloads and kind == "response"
                    rows.append((_page(head["warc-record-id"]), url, int(head["warc-payload-length"]),
                                 digest, kind, _page(head.get("warc-refers-to")), payload if keep else None))
                    held += len(payload) if keep else 0
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield record_batch(_ROWS, zip(*rows))
                        rows, held = [], 0
        if rows:
            yield record_batch(_ROWS, zip(*rows))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, _ROWS_SQL)


def archived(df: DataFrame, **parameters) -> DataFrame:
    """Write the pages into archives in the shared folder and read them back, without payloads."""
    spark = df.sparkSession
    path = fresh_path(spark, "archives")
    write_archives(df, path, **parameters)
    return read_archives(spark, path, payloads=False).drop("payload")
