"""WARC archives in Zstandard: a writer and a reader that validates what it reads.

An archive is a series of Zstandard frames: a skippable frame with the dictionary, then one
frame for each record. Spark writes and reads the files (text writer, binaryFile reader), so
any store Spark reaches will do, and the commit protocol covers lost tasks. The text writer
puts a separator after each row; here that is an empty skippable frame, which every reader
of Zstandard passes over. Bytes stay bytes: a binary value cast to string is not recoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import scratch_path, stage
from .skew import spread_join

#: Fixed values of the formats.
_DICT_FRAME, _SEPARATOR = 0x184D2A5D, "P*M\x18\0\0\0\0"
_SKIPPABLE, _ZSTD = range(0x184D2A50, 0x184D2A60), 0xFD2FB528
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"

#: The dictionary is made from so many payloads at most, so many bytes of each.
DICT_ROWS, DICT_BYTES_EACH, DICT_SIZE = 400, 16_384, 64 << 10
#: Uncompressed bytes of an archive, about.
ARCHIVE_BYTES = 48 << 20
_IDS = uuid.UUID("6f1f7c52-50a4-5d1e-8000-000000000000").int


class WarcError(ValueError):
    """A record or archive that is not as the format says."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(number: int | None) -> str:
    """The URN of a record; its last 64 bits are the number. Records without a number share one that has none."""
    return f"<urn:uuid:{uuid.UUID(int=(_IDS >> 64 << 64) | number % 2**64) if number is not None else uuid.UUID(int=0)}>"


def number_of(urn: str) -> int | None:
    value = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    low = value % 2**64
    return None if value == 0 else low - 2**64 if low >= 2**63 else low


def record(number: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit of the record `refers_to` without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    clean = "".join(c for c in url or "" if c > " " and c != "\x7f")
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", record_id(number)),
        ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", clean or "about:blank"),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", _REVISIT)]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + _END


def parse(data: bytes) -> dict:
    """The fields of one whole record, checked: version, required fields, lengths, digest of a response."""
    head, found, rest = data.partition(_END)
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"no header field: {line[:80]!r}")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise WarcError(f"fields missing: {sorted(missing)}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + len(_END):
        raise WarcError("the length is not that of the block")
    if not rest.endswith(_END):
        raise WarcError("no end of record")
    block = rest[: -len(_END)]
    out = {"type": fields["warc-type"], "number": number_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
           "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"), "refers_to": None, "payload": None, "bytes": None}
    if out["type"] in ("response", "revisit"):
        http, end, payload = block.partition(_END)
        sizes = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        if not end or len(sizes) != 1:
            raise WarcError("no HTTP header with one length")
        out["bytes"] = int(sizes[0].partition(b":")[2])
        if out["type"] == "revisit":
            if "warc-refers-to" not in fields or payload:
                raise WarcError("a revisit names its response and holds no payload")
            out["refers_to"] = number_of(fields["warc-refers-to"])
        else:
            if len(payload) != out["bytes"]:
                raise WarcError("the payload's length is not that in its header")
            if out["digest"] and digest_of(payload) != out["digest"]:
                raise WarcError("the payload's digest is not that in its header")
            out["payload"] = payload
    return out


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at `at` ends: its header, then blocks up to the last."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        if at + 3 > len(data):
            raise WarcError("the archive ends within a frame")
        block = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            at += 4 * (flags >> 2 & 1)
            if at > len(data):
                raise WarcError("the archive ends within a frame")
            return at


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decoded one frame at a time with the dictionary that leads it."""
    data, at, first = memoryview(archive), 0, True
    plain = zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise WarcError("the archive ends within a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in _SKIPPABLE:
            body = bytes(data[at + 8 : at + 8 + size])
            if len(body) != size:
                raise WarcError("the archive ends within a frame")
            if magic == _DICT_FRAME and first:
                if body[:4] == struct.pack("<I", _ZSTD):
                    body = plain.decompressobj().decompress(body)
                plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        elif magic == _ZSTD:
            end = _frame_end(data, at)
            yield plain.decompressobj().decompress(data[at:end])
            at = end
        else:
            raise WarcError("no Zstandard frame")
        first = False


def _dictionary(payloads: list[bytes]) -> bytes | None:
    """A dictionary for payloads like these; None if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_SIZE, payloads).as_bytes()
    except zstandard.ZstdError:
        return None


def train_on(pages: DataFrame, rows: int) -> bytes | None:
    """A dictionary from about `DICT_ROWS` of the `rows` rows (number, url, payload), drawn by a hash."""
    drawn = F.pmod(F.xxhash64("number", "url", F.length("payload")), F.lit(1 << 30)) * rows < DICT_ROWS * (1 << 30)
    sample = pages.where((F.length("payload") > 0) & drawn).select(F.substring("payload", 1, DICT_BYTES_EACH).alias("p"))
    return _dictionary([bytes(r.p) for r in sample.limit(2 * DICT_ROWS).collect()])


def write_archives(records: DataFrame, path: str, trained: bytes | None) -> None:
    """Writes the rows (number, url, payload, refers_to), one archive for each partition, below `path`."""

    def packed(batches):
        known = zstandard.ZstdCompressionDict(trained) if trained else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
        if trained:
            frame = zstandard.ZstdCompressor().compress(trained)
            yield pa.RecordBatch.from_arrays([pa.array([struct.pack("<II", _DICT_FRAME, len(frame)) + frame])], ["frame"])
        for batch in batches:
            rows = zip(*[batch.column(i) for i in range(4)])
            out = [pack.compress(record(n.as_py(), u.as_py(), p.as_py() or b"", r.as_py())) for n, u, p, r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = records.select("number", "url", "payload", "refers_to").mapInArrow(packed, "frame binary")
    packed_rows = rows.select(F.col("frame").cast("string").alias("value"))
    packed_rows.write.option("lineSep", _SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below `path`: type, number, url, digest, refers_to, bytes, payload.

    A record that is not as the format says stops the job. `bytes` is the payload's whole
    length, also of a revisit, whose payload is null. Other types than response and revisit
    come with null bytes and payload.
    """

    def parsed(batches):
        names = ["type", "number", "url", "digest", "refers_to", "bytes", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for data in frames(content.as_py()):
                    rows.append(parse(data))
                    size += len(data)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        parsed, "type string, number long, url string, digest string, refers_to long, bytes long, payload binary"
    )


def with_revisits(pages: DataFrame, partitions: int) -> DataFrame:
    """(number, url, payload, refers_to) of (number, url, payload) in that many partitions: equal payloads are stored once.

    Of rows with equal payloads those with the largest number are responses and the others
    refer to it. Rows without a number are responses and are referred to by none. Payloads
    move once, to the partition in which they stay; who refers to whom is found out on keys.
    """
    keyed = pages.withColumn("key", F.sha2("payload", 256))
    keys = stage(keyed.select("number", F.unhex("key").alias("key")), "keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("number").alias("largest")).where("n > 1")
    revisits = spread_join(keys, shared, "key", spread_by="number").where("number < largest")
    revisits = revisits.select("number", F.lower(F.hex("key")).alias("key"), "largest").distinct()
    left, right = (df.repartition(partitions, "number", "key") for df in (keyed, revisits))
    out = left.join(right.toDF("r_number", "r_key", "largest"), F.expr("number = r_number AND key = r_key"), "left")
    return out.select("number", "url", "payload", F.col("largest").alias("refers_to"))


def archive(pages: DataFrame, path: str) -> None:
    """Writes pages (page_id, url, html) as archives below `path`.

    A null html is an empty payload; a null url is written as about:blank; rows that repeat a
    page_id are each written. A payload of any length is one record. An empty table makes
    one archive without records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("number"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("payload")), F.lit(0))).first()
    archives = max(1, -(-size // ARCHIVE_BYTES), min(size >> 21, 64))
    write_archives(with_revisits(rows, archives), path, train_on(rows, max(n, 1)))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    archive(spark.read.parquet(f"{folder}/pages.parquet"), path)
    return read_archives(spark, path).select(
        F.col("number").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )


ORACLE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS p, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(sha1(p), ''),
    lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS b FROM payloads)
SELECT page_id, CAST(octet_length(encode(p)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(b, CAST(i * 5 + j + 1 AS BIGINT), 1) AS INTEGER) * (1 << (4 - CAST(j AS INTEGER))))) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM bits
"""
