"""WARC archives with one Zstandard frame per record and a shared dictionary.

A dictionary is trained on a bounded sample of the records and stored, as the
public WARC-with-Zstandard profile describes, in a skippable frame that opens
every archive; each record is then a frame of its own, so an archive can be read
from any record. Equal payloads of at least ``MIN_REVISIT`` bytes are stored
once: the smallest page id keeps the payload and the others become revisits.

Files are written by Spark's text sink (any store Spark can write, committed
by task): a row holds the frames of some megabytes of records, and the row separator
is an empty skippable frame, which readers pass over. A file takes a fixed number of
rows, so an archive is at most about 256 MB (or one record) however large the
partition; each begins with the dictionary.

Defined cases: null html is empty; a page without id is kept with a null id (and
is never the one that others refer to); a null url is written as an empty target;
a url with control characters or blanks at an end is written percent-encoded under a
header that says so, any other one as it is: every url comes back as it was;
repeated ids: every row with the smallest id of its payload is a response; rows that
repeat id and payload have record ids of their own, and revisits refer to the first; an
empty table gives no archive and no rows; too few records to train on give
archives without a dictionary.
"""

from __future__ import annotations

import hashlib
import re
import struct
import urllib.parse
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Payloads of fewer bytes are always stored.
MIN_REVISIT = 100
#: Records (about) that the dictionary is trained on, whole; pages of more bytes are
#: not drawn, which only affects compression. And the dictionary's size.
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 131072
DICTIONARY_BYTES = 65536
#: Bytes of frames in a row of the text sink, and rows of an archive.
ROW_BYTES, ARCHIVE_ROWS = 1 << 22, 64
LEVEL = 3

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables have no capture time.
DATE = "1970-01-01T00:00:00Z"

RECORD_FIELDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def plan_records(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to, copy): refers_to is set for revisits,
    copy (a number of its own) for rows that repeat another's id and payload.

    Only (id, digest, size) is grouped; the payloads meet the short list of
    revisits and repeated rows in one join on (page id, digest), so a payload that a
    third of the pages share is not a join key.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("place", F.monotonically_increasing_id())
    keys = (rows.select("page_id", "payload_digest", "place", F.octet_length("payload").alias("size"))
            .groupBy("page_id", "payload_digest")
            .agg(F.min("place").alias("first_place"), F.count("*").alias("n"), F.max("size").alias("size")))
    # Null ids group with each other here, but are never the one referred to.
    first = (keys.where(F.col("size") >= MIN_REVISIT).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("ids"))
             .where("ids > 1 AND first_id IS NOT NULL").drop("ids"))
    facts = (keys.join(first, "payload_digest", "left")
             .select(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"),
                     F.expr("CASE WHEN first_id IS NOT NULL AND NOT page_id <=> first_id THEN first_id END").alias("refers_to"),
                     F.expr("CASE WHEN n > 1 THEN first_place END").alias("first_place"))
             .where("refers_to IS NOT NULL OR first_place IS NOT NULL"))
    return (rows.join(facts, F.expr("page_id <=> r_id AND payload_digest = r_digest"), "left")
            .select("page_id", "url", "payload", "payload_digest", "refers_to",
                    F.expr("CASE WHEN place <> first_place THEN place END").alias("copy")))


def train_dictionary(pages: DataFrame, id_col="page_id", url_col="url", html_col: str = "html",
                     records: int = SAMPLE_RECORDS) -> bytes:
    """A dictionary from about ``records`` whole records as they are archived, chosen by a hash of their text (b'' if too few)."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("i"), F.col(url_col).cast("string").alias("u"),
                        F.col(html_col).cast("string").cast("binary").alias("b")).where(F.octet_length("b") <= SAMPLE_BYTES)
    rate = min(1.0, records / max(1, rows.count()))
    spread = F.pmod(F.xxhash64("b", F.lit(5)), F.lit(1 << 30))
    drawn = rows.where(spread < int(rate * (1 << 30)) + 1).limit(2 * records).collect()
    samples = [framed(record_bytes(r["i"], r["u"], bytes(r["b"]), hashlib.sha256(r["b"]).hexdigest(), None))
               for r in drawn if r["b"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def framed(parts: tuple[bytes, bytes]) -> bytes:
    return parts[0] + parts[1] + b"\r\n\r\n"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, copy=None) -> tuple[bytes, bytes]:
    """(WARC header with its blank line, block) of one record."""
    ident = "" if page_id is None else str(page_id)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1",
             f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{record_uuid(ident, digest, copy)}>",
             f"WARC-Date: {DATE}",
             *target_lines(url or ""),
             f"WARC-Payload-Digest: sha256:{digest}",
             f"Page-Id: {ident}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}",
                  f"WARC-Refers-To: <urn:uuid:{record_uuid(str(refers_to), digest)}>",
                  f"Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode(), block


ENCODED = "Target-URI-Encoding: percent"
_ODD = re.compile(r"[\x00-\x1f\x7f]|^\s|\s$")


def target_lines(url: str) -> list[str]:
    """The target's header; a url that no header line can hold is percent-encoded, and said to be."""
    if _ODD.search(url):
        return [f"WARC-Target-URI: {urllib.parse.quote(url, safe='')}", ENCODED]
    return [f"WARC-Target-URI: {url}"]


def record_uuid(ident: str, digest: str, copy=None) -> uuid.UUID:
    name = f"{ident} {digest}" if copy is None else f"{ident} {digest} {copy}"
    return uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=4)


def write_archives(records: DataFrame, path: str, dictionary: bytes) -> None:
    """Write the planned records as archives under ``path``, one or more per partition."""
    def run(batches):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        frames, size, done = [], 0, 0

        def row():
            # The sink opens a file every ARCHIVE_ROWS rows of a task.
            lead = [head] if done % ARCHIVE_ROWS == 0 else []
            return pa.RecordBatch.from_arrays([pa.array([b"".join(lead + frames)], pa.binary())], names=["frame"])

        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers, copy = (c[i].as_py() for c in columns)
                frames.append(packer.compress(framed(record_bytes(page_id, url, payload, digest, refers, copy))))
                size += len(frames[-1])
                if size > ROW_BYTES:
                    yield row()
                    frames, size, done = [], 0, done + 1
        if frames:
            yield row()

    (records.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("frame"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", ARCHIVE_ROWS).text(path))


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, from its header and block sizes."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    size = 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    at += size
    while True:
        head = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * (flags >> 2 & 1)


def read_frames(data):
    """Each record's bytes, one frame at a time; the leading dictionary is used, other skippable frames passed."""
    view, at = memoryview(data), 0
    unpacker = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC and at == 0:
                shared = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
                unpacker = zstandard.ZstdDecompressor(dict_data=shared)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"not a Zstandard frame at byte {at}")
        end = frame_end(view, at)
        yield unpacker.decompress(view[at:end])
        at = end


def parse_record(raw: bytes) -> tuple:
    """The fields of RECORD_FIELDS; a stored payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of page {fields['Page-Id']} does not match its digest")
    ident, refers, target = fields["Page-Id"], fields.get("Refers-To-Page-Id"), fields["WARC-Target-URI"]
    return (int(ident) if ident else None, size, digest, fields["WARC-Type"],
            int(refers) if refers else None, urllib.parse.unquote(target) if "Target-URI-Encoding" in fields else target,
            None if revisit else payload)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; without ``payload`` it is checked, not returned."""
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for raw in read_frames(content.as_buffer()):
                    row = parse_record(raw)
                    rows.append(row if payload else (*row[:-1], None))
                    size += len(raw) if payload else 512
                    if size > 1 << 22:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_FIELDS)


def _batch(rows):
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=RECORD_FIELDS.fieldNames())


def archive(pages: DataFrame, path: str) -> DataFrame:
    """Write every page to archives under ``path`` and read them back, without the payloads."""
    dictionary = train_dictionary(pages)
    write_archives(plan_records(pages), path, dictionary)
    return read_archives(pages.sparkSession, path, payload=False)


ORACLE_SQL = f"""
WITH x AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM x WHERE payload_bytes >= {MIN_REVISIT}
      GROUP BY payload_digest)
SELECT x.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, x.payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM x LEFT JOIN f ON x.payload_digest = f.payload_digest"""
