"""WARC archives whose records are Zstandard frames that share a dictionary.

A file is a skippable frame with the dictionary, then one frame for each record, so any record can
be read alone with the dictionary at the file's start.  The dictionary is trained on a bounded
sample of records; without enough of them files have none.

A record is

    WARC/1.1, named fields, an empty line, the block, two line ends

and its block is an HTTP response: header fields, then the payload.  A revisit record has the header
fields alone, whose Content-Length still is the payload's, and names the record it refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import map_batches, staged

SKIPPABLE = 0x184D2A5D  # magic number of the frame that holds the dictionary
_LINE = b"\r\n"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str, copy: str = "") -> str:
    """A page's record id; ``copy`` tells revisits of one page and payload apart."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}{copy and ':' + copy}>"


def page_of(record: str) -> int | None:
    page = record.split(":")[2]
    return int(page) if page else None


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_bytes(kind: str, name: str, url: str | None, date: str, digest: str, size: int,
                 payload: bytes, refers_to: str | None = None) -> bytes:
    """One record; ``size`` is the full payload's, ``payload`` is empty in revisits."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {size}\r\n\r\n").encode() + payload
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "urn:none", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        *([("WARC-Profile", _SAME), ("WARC-Refers-To", refers_to)] if refers_to else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"WARC/1.1\r\n" + head + _LINE + block + _LINE * 2


def _fields(lines: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines.decode().split("\r\n") if x)


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Named fields, HTTP header fields and payload; what doesn't fit is an error."""
    head, _, rest = data.partition(_LINE * 2)
    version, _, lines = head.partition(_LINE)
    fields = _fields(lines)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if version != b"WARC/1.1" or len(block) != size or rest[size:] != _LINE * 2:
        raise ValueError("not one whole record")
    if fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"damaged block of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(_LINE * 2)
    header = _fields(http.partition(_LINE)[2])
    if fields["WARC-Type"] == "response":
        digest = f"sha1:{base32(hashlib.sha1(payload).digest())}"
        if digest != fields["WARC-Payload-Digest"] or len(payload) != int(header["Content-Length"]):
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return fields, header, payload


def dictionary_of(records: list[bytes], size: int) -> bytes:
    """A dictionary of about ``size`` bytes, or nothing where there is too little to learn from."""
    if len(records) < 16 or sum(map(len, records)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b""


def _skippable(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def _read_dictionary(file) -> bytes:
    """The dictionary at the start of a file, which is left at the first record."""
    head = file.read(8)
    if len(head) == 8 and struct.unpack("<II", head)[0] == SKIPPABLE:
        return file.read(struct.unpack("<II", head)[1])
    file.seek(0)
    return b""


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its SHA-1 and its size."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"))


def decided(rows: DataFrame, least_revisit: int = 0, most_broadcast: int = 100_000) -> DataFrame:
    """``rows`` (as ``_payloads`` returns them) with is_revisit and refers_to, a page_id.

    Of the rows with one payload of at least ``least_revisit`` bytes, that with the smallest
    page_id (nulls last, then by url) is the response and the others revisit it.  Only a
    table of repeated digests is joined, as a broadcast up to ``most_broadcast`` rows, so
    payloads don't move where few of them repeat.  Equal first rows are counted and put apart.
    """
    by_page = (
        rows.where(F.col("size") >= least_revisit).groupBy("digest", "page_id", "url")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "copies")
    repeated = staged(
        by_page.groupBy("digest").agg(F.min(first).alias("f"), F.sum("copies").alias("n"))
        .where("n > 1").select("digest", F.lit(True).alias("known"), F.col("f.page_id").alias("first_id"),
                               F.col("f.url").alias("first_url"), F.col("f.copies").alias("copies")),
        "repeated")
    n, most_copies = repeated.agg(F.count(F.lit(1)), F.max("copies")).first()
    if n == 0:
        return rows.select("*", F.lit(False).alias("is_revisit"), F.lit(None).cast("long").alias("refers_to"))
    joined = rows.join(F.broadcast(repeated) if n <= most_broadcast else repeated, "digest", "left")
    is_first = F.expr("known IS NULL OR page_id <=> first_id AND url <=> first_url")
    columns = [*rows.columns, "is_revisit", "refers_to"]
    single = joined if most_copies == 1 else joined.where(
        ~is_first | F.coalesce(F.col("copies"), F.lit(1)).eqNullSafe(1))
    out = single.select(
        *rows.columns, (~is_first).alias("is_revisit"),
        F.when(~is_first, F.col("first_id")).alias("refers_to"))
    if most_copies > 1:
        some = [F.any_value(c).alias(c) for c in rows.columns if c != "digest"]
        equal = (
            joined.where(is_first & (F.col("copies") > 1)).groupBy("digest")
            .agg(*some, F.count(F.lit(1)).alias("n"))
            .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n"))))
        out = out.unionByName(
            equal.withColumns({
                "is_revisit": F.col("i") > 1, "refers_to": F.when(F.col("i") > 1, F.col("page_id")),
                "payload": F.when(F.col("i") == 1, F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))})
            .select(*columns))
    return out


def train(rows: DataFrame, date: str, most_sampled: int, most_record: int, size: int) -> bytes:
    """A dictionary from at most ``most_sampled`` records with payloads of at most ``most_record``
    bytes, chosen by their digests' hashes among different payloads."""
    count = rows.count()
    chosen = F.pmod(F.xxhash64("digest"), F.lit(max(1, count // most_sampled))) == 0
    sampled = (
        rows.where(chosen & (F.col("size") <= most_record)).groupBy("digest")
        .agg(F.min("page_id").alias("page_id"), F.min("url").alias("url"),
             F.any_value("payload").alias("payload"))
        .orderBy("digest").limit(most_sampled).collect())
    records = []
    for x in sampled:
        digest, payload = base32(bytes(x["digest"])), bytes(x["payload"])
        records.append(record_bytes(
            "response", record_id(x["page_id"], digest), x["url"], date, digest, len(payload), payload))
    return dictionary_of(records, size)


def write_archives(pages: DataFrame, folder: str, least_revisit: int = 0,
                   date: str = "2000-01-01T00:00:00Z", level: int = 6, most_sampled: int = 512,
                   most_record: int = 1 << 15, dictionary_size: int = 1 << 16) -> list[dict]:
    """Writes a record for each row of ``pages`` (page_id, url, html); returns the manifest.

    ``folder`` must be reachable by all executors (a URI that Arrow's file systems know).  The
    payload is the html in UTF-8, empty where it is null.  Null and repeated page_ids are rows of
    their own, a null url becomes ``urn:none``, an empty table gives no files, other columns are
    ignored.  ``date`` stands for the time of capture, which the table doesn't have.  The manifest
    has an entry for each file (path, records), from tasks that succeeded only; each row is
    written where it was read.
    """
    rows = _payloads(pages)
    dictionary = train(rows, date, most_sampled, most_record, dictionary_size)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=level)
        press = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)
        system, root = _open(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system.create_dir(root, recursive=True)
        out, n = None, 0
        for batch in batches:
            for page_id, url, payload, digest, size, revisit, refers_to in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = system.open_output_stream(
                        f"{root}/{name}.warc.zst", compression=None, buffer_size=1 << 20)
                    out.write(_skippable(dictionary) if dictionary else b"")
                code = base32(digest)
                if revisit:
                    record = record_bytes("revisit", record_id(page_id, code, f"{name}-{n}"), url, date,
                                          code, size, b"", record_id(refers_to, code))
                else:
                    record = record_bytes(
                        "response", record_id(page_id, code), url, date, code, size, payload)
                out.write(press.compress(record))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{
                "path": f"{folder}/{name}.warc.zst", "records": n}])

    records = decided(rows, least_revisit).select(
        "page_id", "url", "payload", "digest", "size", "is_revisit", "refers_to")
    files = map_batches(records, write, "path STRING, records LONG").collect()
    return [x.asDict() for x in sorted(files, key=lambda x: x["path"])]


def read_frames(file, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive, each decompressed alone."""
    dictionary = _read_dictionary(file)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    context = zstandard.ZstdDecompressor(dict_data=shared)
    data = file.read(chunk)
    while data:
        frame, parts = context.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the last record is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else file.read(chunk)
        yield b"".join(parts)
        data = data or file.read(chunk)


_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()),
])


def read_archives(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """All records of the archives, a task per file: page_id, url (as it is written), payload (null
    in revisits), payload_bytes and payload_digest (of the full payload), record_type, refers_to.

    Checksums, lengths and digests are checked; what doesn't fit is an error.
    """
    schema = ("page_id LONG, url STRING, payload BINARY, payload_bytes LONG, payload_digest STRING,"
              " record_type STRING, refers_to LONG")
    if not manifest:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number in (x for batch in batches for x in batch.column(0).to_pylist()):
            system, path = _open(manifest[number]["path"])
            rows, held, n = [], 0, 0
            with system.open_input_file(path) as file:
                for data in read_frames(file):
                    fields, header, payload = parse_record(data)
                    revisit = fields["WARC-Type"] == "revisit"
                    rows.append({
                        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
                        "payload": None if revisit else payload,
                        "payload_bytes": int(header["Content-Length"]),
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "record_type": fields["WARC-Type"],
                        "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None})
                    held, n = held + len(payload) + 200, n + 1
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                        rows, held = [], 0
            if n != manifest[number]["records"]:
                raise ValueError(f"{path} doesn't fit the manifest")
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return map_batches(spark.range(0, len(manifest), 1, len(manifest)), read, schema)
