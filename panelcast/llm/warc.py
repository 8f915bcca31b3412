"""WARC archives with a shared Zstandard dictionary.

Every archive starts with the dictionary in a skippable frame; each record
follows as a frame of its own, compressed with that dictionary, so that single
records can be read by their offset.  Spark's text writer puts the frames into
files: it writes strings as they are, and its line separator is set to an
empty skippable frame, which every Zstandard reader passes over.  So archives
go through Spark's own commit to any store that Spark can write.

Payloads that were seen before become revisit records.  The dictionary is
trained on a bounded sample of the records themselves.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import hash_sample
from ..session import checkpoint_dir, write_stage

MIN_REVISIT = 1000  # bytes of payload from which an equal one is a revisit
SAMPLE_RECORDS = 400  # records that train the dictionary
SAMPLE_BYTES = 32 << 10  # of each record in the sample; records themselves are always whole
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

# fixed values of the formats
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"  # skippable frame that holds the dictionary
EMPTY_FRAME = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"  # skippable frame of length 0
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
CRLF = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # name-based ids of URLs

_RECORD = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def digest_label(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def build_record(page_id, url, payload: bytes, size: int, sha1: bytes, refers_to) -> bytes:
    """One WARC 1.1 record; a revisit (``refers_to`` set) holds no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    revisit = refers_to is not None
    block = http if revisit else http + payload
    uri = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "about:blank")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # the pages carry no date; a fixed one keeps archives reproducible
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest_label(sha1)),
        ("WARC-Block-Digest", digest_label(hashlib.sha1(block).digest())),
        ("Page-ID", "" if page_id is None else str(page_id)),
        ("Page-Payload-Length", str(size)),
    ]
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE), ("Page-Refers-To", str(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return head + CRLF + block + CRLF + CRLF


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.split(b"\r\n\r\n", 1)[1]


def parse_record(data: bytes) -> Record:
    """Parsed record; its length and block digest must hold."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(headers["Content-Length"])
    block = rest[:size]
    if rest[size:] != CRLF + CRLF or digest_label(hashlib.sha1(block).digest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return Record(headers, block)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary of the samples; too few samples give them raw, none an empty one."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary


def frames(archive: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of each compressed frame after the skippable ones."""
    at = 0
    while at < len(archive):
        magic = archive[at : at + 4]
        if magic[1:] == DICTIONARY_MAGIC[1:] and 0x50 <= magic[0] <= 0x5F:
            at += 8 + int.from_bytes(archive[at + 4 : at + 8], "little")
            continue
        if magic != ZSTD_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        # frames carry no length: walk the header, the blocks and the checksum
        begin, flags = at, archive[at + 4]
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = False
        while not last:
            header = int.from_bytes(archive[at : at + 3], "little")
            last, kind, size = bool(header & 1), header >> 1 & 3, header >> 3
            at += 3 + (1 if kind == 1 else size)
        at += 4 * (flags >> 2 & 1)
        yield begin, at


def read_archive(archive: bytes) -> Iterator[Record]:
    """Records of one archive, in order."""
    dictionary = b""
    if archive[:4] == DICTIONARY_MAGIC:
        dictionary = archive[8 : 8 + int.from_bytes(archive[4:8], "little")]
    engine = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    view = memoryview(archive)
    for a, b in frames(archive):
        yield parse_record(engine.decompress(view[a:b]))


def _archive_rows(dictionary: bytes):
    """One archive per task: the dictionary frame, then a frame per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        engine = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True, write_content_size=True)
        begun = False
        for batch in batches:
            if len(batch) and not begun:
                yield pa.RecordBatch.from_arrays([pa.array([dictionary_frame(dictionary)], pa.binary())], names=["frame"])
                begun = True
            out, held = [], 0
            for page_id, url, payload, size, sha1, refers_to in zip(*(c for c in batch.columns)):
                record = build_record(page_id.as_py(), url.as_py(), payload.as_py() or b"", size.as_py(), sha1.as_py(), refers_to.as_py())
                out.append(engine.compress(record))
                held += len(out[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    return run


def write_archives(
    pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """Write one record per row under ``path``, one archive per partition.

    The payload is the text in UTF-8; null is empty.  Of rows with equal
    payloads of ``min_revisit`` bytes or more, the largest id is the response
    and the others revisit it; rows that repeat that id are responses too, and
    a row with a null id revisits any other.  Smaller payloads are responses.
    An empty table writes no record.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.when(F.octet_length(payload) > 0, payload).alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.unhex(F.sha1(payload)).alias("sha1"),
        F.unhex(F.sha2(payload, 256)).alias("key"),  # equality by SHA-256 and length; SHA-1 is only the record's label
    )
    copies = (
        slim.filter(F.col("size") >= min_revisit)
        .groupBy("key", "size")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "size", "original")
    )
    copies = write_stage(copies, "warc-copies")
    marked = slim.join(copies, ["key", "size"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    )
    # a bounded sample of the records by hash order; of long records, their first part.  The
    # records are chosen by their ids, so no other payload leaves its task
    sample = (
        hash_sample(slim, ["page_id", "url"], SAMPLE_RECORDS, seed=1).limit(SAMPLE_RECORDS)
        .select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "size", "sha1")
    )
    # build records for training from the sample rows
    samples = [build_record(r.page_id, r.url, bytes(r.payload or b""), r.size, bytes(r.sha1), None) for r in sample.collect()]
    dictionary = train_dictionary(samples)
    frames_ = marked.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "sha1", "refers_to")
    (
        frames_.mapInArrow(_archive_rows(dictionary), "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.mode("overwrite")
        .option("lineSep", EMPTY_FRAME.decode("latin-1"))
        .text(path)
    )


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _RECORD.split(", ")]
    for batch in batches:
        for archive in batch.column(0):
            rows, held = [], 0
            for record in read_archive(archive.as_buffer().to_pybytes()):
                h = record.headers
                payload = record.payload if h["WARC-Type"] == "response" else None
                sha1 = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:"))
                size = int(h["Page-Payload-Length"])
                if payload is not None and (len(payload) != size or hashlib.sha1(payload).digest() != sha1):
                    raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
                refers = h.get("Page-Refers-To")
                rows.append((int(h["Page-ID"]) if h["Page-ID"] else None, h["WARC-Type"], int(refers) if refers else None, size, sha1.hex(), payload))
                held += size if payload is not None else 0
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, payload) of every record under ``path``.

    Lengths and digests of blocks and payloads are verified on reading;
    ``payload`` is null for revisits.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read_rows, _RECORD)


def archive_path(spark: SparkSession) -> str:
    """A new folder for archives under the shared folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/panelcast-stages/warc-{uuid.uuid4().hex[:12]}"
