"""Token ids in length-delimited binary record files with an offset index.

A record file holds, for each sequence in order:

    u64 length of the payload | u32 masked checksum of those 8 bytes | payload | u32 masked checksum of the payload

with a payload of i64 doc_id, u8 1 if doc_id is null, u8 bytes per id (2 if every id of the
vocabulary has room in them, else 4), and the ids; all little-endian.
The index beside it holds, for each record, u64 offset and u64 whole size. A checksum is the
CRC-32 (that of zlib) turned right by 15 bits plus 0xa282ead8, so that a stored checksum
doesn't check itself.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_ranges, new_folder, place, small_batches, text_or_empty
from .tokens import PieceEncoder, maker

END = 2
#: Files that one task reads back.
FILES_PER_TASK = 4
_HEAD, _SUM, _DOC, _SPOT = "<QI", "<I", "<qBB", "<QQ"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return size + struct.pack(_SUM, masked(size)) + payload + struct.pack(_SUM, masked(payload))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; raises ValueError if a length or checksum is wrong."""
    size, check = struct.unpack_from(_HEAD, data)
    if masked(data[:8]) != check or len(data) != size + 16:
        raise ValueError("a record's length is damaged")
    payload = data[12 : 12 + size]
    if masked(payload) != struct.unpack_from(_SUM, data, 12 + size)[0]:
        raise ValueError("a record's payload is damaged")
    return payload


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    # Hadoop says file:/a where others say file:///a.
    uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


class RecordFile:
    """Reads the records of one file by number, in any order, through its index."""

    def __init__(self, uri: str):
        self._fs, self._path = store(uri)
        with self._fs.open_input_stream(self._path + ".idx") as f:
            self.spots = list(struct.iter_unpack(_SPOT, f.read()))
        self._file = self._fs.open_input_file(self._path)

    def __len__(self) -> int:
        return len(self.spots)

    def read(self, i: int) -> tuple[int | None, bytes]:
        """doc_id of record i and its ids as unsigned 32-bit integers."""
        offset, size = self.spots[i]
        payload = unframe(self._file.read_at(size, offset))
        doc, null, width = struct.unpack_from(_DOC, payload)
        ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_DOC)).astype("<u4").tobytes()
        return None if null else doc, ids

    def close(self) -> None:
        self._file.close()


def write_records(docs: DataFrame, path: str, folder: str, end: int = END, rows_per_file: int = 8000) -> DataFrame:
    """Encode every text and write it below `folder`, one file for each range of rows, written by a task of its own.

    Returns one row per file: part (files ascend with doc_id), uri, n_records, n_tokens. Rows of
    one doc_id come in order of their texts, and a range can end between them. A file is written under a name of its task attempt and renamed when it is whole, so a task
    that runs again replaces it by the same bytes.
    """
    small_batches(docs.sparkSession, 500)
    rows = (
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), *place())
        .repartitionByRange(n_ranges(docs, rows_per_file), "key", "mark")
        .sortWithinPartitions("key", "mark", "text")
        .select("doc_id", "text")
    )

    def run(batches):
        import uuid

        from pyspark import TaskContext

        encoder = maker(PieceEncoder, path)
        width = 2 if max(encoder.library.get_vocab_size(), end + 1) <= 1 << 16 else 4
        last = end.to_bytes(width, "little")
        system, base = store(folder)
        at, records, tokens, offset, data, index = TaskContext.get().partitionId(), 0, 0, 0, None, None
        own, name = f"{base}/part-{at:08d}.{uuid.uuid4().hex}", f"part-{at:08d}"
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                if data is None:
                    system.create_dir(base)
                    data, index = system.open_output_stream(own), system.open_output_stream(own + ".idx")
                narrow = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
                framed = frame(struct.pack(_DOC, doc or 0, doc is None, width) + narrow + last)
                data.write(framed)
                index.write(struct.pack(_SPOT, offset, len(framed)))
                offset += len(framed)
                records += 1
                tokens += len(ids) // 4 + 1
        if data is not None:
            data.close()
            index.close()
            for suffix in ("", ".idx"):
                system.move(own + suffix, f"{base}/{name}{suffix}")
            yield pa.RecordBatch.from_pylist([{"part": at, "uri": f"{folder}/{name}", "n_records": records, "n_tokens": tokens}])

    return rows.mapInArrow(run, "part long, uri string, n_records long, n_tokens long")


def read_records(files: DataFrame) -> DataFrame:
    """Rows (uri, base) to the records of those files: doc_id, start, n_tokens, ids_crc32.

    `base` is the number of ids in all files before. Every checksum is checked.
    """

    def run(batches):
        for batch in batches:
            for uri, base in zip(*(c.to_pylist() for c in batch.columns)):
                file, rows = RecordFile(uri), []
                for i in range(len(file)):
                    doc, ids = file.read(i)
                    rows.append((doc, base, len(ids) // 4, zlib.crc32(ids)))
                    base += len(ids) // 4
                file.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4,
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.select("uri", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_to_records(docs: DataFrame, path: str, folder: str | None = None, end: int = END) -> DataFrame:
    """Write all documents as records in ascending doc_id order, then read the files back.

    Returns doc_id, start (ids of all documents before), n_tokens (with the end id), ids_crc32.
    A null text is empty: its record holds the end id alone. Null doc_ids come first, equal
    ones in order of their texts. Other columns are ignored; an empty table writes no file
    and gives an empty result. Only one row per file comes to the driver.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    files = sorted(write_records(docs, path, folder, end).collect(), key=lambda r: r.part)
    rows, base = [], 0
    for f in files:
        rows.append((f.uri, base))
        base += f.n_tokens
    listed = spark.createDataFrame(rows, "uri string, base long")
    return read_records(listed.repartition(max(1, -(-len(rows) // FILES_PER_TASK))))
