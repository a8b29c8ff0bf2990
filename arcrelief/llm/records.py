"""Token ids in length-delimited binary record files with offset indexes.

A file is a run of records, each framed as

    length of the payload   8 bytes, little endian
    masked crc32            4 bytes, of the length's bytes
    payload                 doc_id (8 bytes, signed), 1 byte flags, ids
    masked crc32            4 bytes, of the payload

where the flags hold the bytes of an id (2 or 4) and, at bit 3, that doc_id is null.  A crc is
masked by a rotation and an added constant, as checksums of data that itself holds checksums
are weak.  Beside each file stands an index, one little-endian 8-byte offset for each record,
so that a reader can fetch records in any order.

Files follow each other in ascending doc_id order, and so do the records of a file.  A task
names its files by its attempt; only files reported by tasks that succeeded come into the
manifest, so retries and speculative attempts leave at most unused files behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens

_LENGTH, _CRC, _HEAD = "<Q", "<I", "<qB"
_NULL_ID = 8
_MASK = 0xA282EAD8


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = struct.pack(
        _HEAD, doc_id or 0, width | (_NULL_ID if doc_id is None else 0)
    ) + ids
    length = struct.pack(_LENGTH, len(payload))
    return b"".join(
        (length, struct.pack(_CRC, masked_crc(length)),
         payload, struct.pack(_CRC, masked_crc(payload)))
    )


def read_frame(file, offset: int | None = None) -> tuple[int | None, np.ndarray]:
    """The record at the offset, or the next one; a damaged record is an error."""
    if offset is not None:
        file.seek(offset)
    head = file.read(12)
    length = head[:8]
    if len(head) != 12 or struct.unpack(_CRC, head[8:])[0] != masked_crc(length):
        raise ValueError(f"damaged record length at {offset}")
    size = struct.unpack(_LENGTH, length)[0]
    body = file.read(size + 4)
    payload = body[:size]
    if len(body) != size + 4 or struct.unpack(_CRC, body[size:])[0] != masked_crc(payload):
        raise ValueError(f"damaged record at {offset}")
    doc_id, flags = struct.unpack_from(_HEAD, payload)
    ids = np.frombuffer(payload, f"<u{flags & 7}", offset=9).astype("<u4")
    return (None if flags & _NULL_ID else doc_id), ids


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_records(docs: DataFrame, folder: str, vocabulary: str = tokens.BYTE_BPE,
                  end_id: int = 2) -> list[dict]:
    """Encodes ``docs`` (doc_id, text) and writes the files; returns the manifest.

    ``folder`` must be reachable by all executors (a URI that Arrow's file systems know).
    The manifest has one entry for each file, in order: path, records, ids and the ids of
    all files before it.  Rows are range partitioned by doc_id; ties are ordered by the text's
    hash, null ids come first, null texts are empty and give the end id alone.  No rows
    give an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        end = int(end_id).to_bytes(encoder.width, "little")
        system, root = _open(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system.create_dir(root, recursive=True)
        offsets, n_ids, place, out = [], 0, 0, None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}.rec", buffer_size=1 << 20)
                ids = encoder.encode(text) + end
                record = frame(doc_id, ids, encoder.width)
                out.write(record)
                offsets.append(place)
                place += len(record)
                n_ids += len(ids) // encoder.width
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        yield pa.RecordBatch.from_pylist([{
            "part": context.partitionId(), "name": name, "records": len(offsets), "ids": n_ids,
        }])

    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    files = rows.mapInArrow(write, "part LONG, name STRING, records LONG, ids LONG").collect()
    manifest, before = [], 0
    for x in sorted(files, key=lambda x: x["part"]):  # one entry for each partition
        manifest.append({"path": f"{folder}/{x['name']}", "records": x["records"],
                         "ids": x["ids"], "before": before})
        before += x["ids"]
    return manifest


def read_records(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """All records: doc_id, start (ids of all records before it) and ids, a task per file."""
    schema = "doc_id LONG, start LONG, ids BINARY"
    if not manifest:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number in (x for batch in batches for x in batch.column(0).to_pylist()):
            entry = manifest[number]
            system, path = _open(entry["path"])
            with system.open_input_file(f"{path}.idx") as index:
                offsets = np.frombuffer(index.read(), "<u8").tolist()
            if len(offsets) != entry["records"]:
                raise ValueError(f"{path}.idx doesn't fit the manifest")
            start, rows, held = entry["before"], [], 0
            with system.open_input_file(f"{path}.rec") as file:
                for offset in offsets:
                    doc_id, ids = read_frame(file, offset)
                    rows.append({"doc_id": doc_id, "start": start, "ids": ids.tobytes()})
                    start += len(ids)
                    held += len(ids)
                    if held > 1 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ROWS)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return spark.range(0, len(manifest), 1, len(manifest)).mapInArrow(read, schema)


_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
