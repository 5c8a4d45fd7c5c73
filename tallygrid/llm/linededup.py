"""Line deduplication: content-defined chunks of lines, and whole runs of lines around them.

Chunks end where a rolling hash over line hashes leaves no rest, so their boundaries move with the
lines wherever these stand. The first and the last chunk of a repeated passage hold lines
from around it, though, and a passage can lie within one chunk; so by chunks alone a
passage stays in part. Beside the chunks, therefore, each line also begins and ends a run of the fewest
lines that hold 50 words: such a run depends on its own lines only, and a passage of that size
is covered by runs inside it.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import get, put
from .common import fresh, new_folder, saved, small_batches

#: A chunk ends after a line at which the rolling hash of the last two lines leaves no rest.
DIVISOR = 3
_TURN = 1_000_003
_PRIME = 2_147_483_647
#: Words that a repeated run of lines holds at least, if it is no chunk.
PASSAGE = 50
#: Digests of repeated ranges in a file.
PER_FILE = 500_000


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """The lines cut into ranges (from, to): a range ends where the rolling hash says so, and after the last line.

    The rolling hash goes over the hashes of a line and the one before it.
    """
    hashes = [int.from_bytes(hashlib.md5(x).digest()[:4], "big") for x in lines]
    ends = [i for i in range(1, len(lines)) if (hashes[i - 1] * _TURN + hashes[i]) % _PRIME % DIVISOR == 0]
    cuts = [0, *(i + 1 for i in ends if i + 1 < len(lines)), len(lines)]
    return list(zip(cuts, cuts[1:]))


def passages(lines: list[bytes]) -> list[tuple[int, int]]:
    """Ranges of lines (from, to) that go if they are repeated, each once.

    Chunks of several lines with any word, from each line the fewest lines on that hold 50 words,
    and up to each line the fewest lines back that do. Every line of a run of 50 words or more
    lies in a range within the run. Words are runs of bytes other than ASCII white space.
    """
    ends = [0]
    for line in lines:
        ends.append(ends[-1] + len(line.split()))
    out = {(a, b) for a, b in chunks(lines) if b - a > 1 and ends[b] > ends[a]}
    b = 0
    for a in range(len(lines)):
        while b <= len(lines) and ends[b] - ends[a] < PASSAGE:
            b += 1
        if b > len(lines):
            break
        out.add((a, b))
    a = len(lines)
    for b in range(len(lines), 0, -1):
        a = min(a, b)
        while a >= 0 and ends[b] - ends[a] < PASSAGE:
            a -= 1
        if a < 0:
            break
        out.add((a, b))
    return sorted(out)


def _row_key() -> list[Column]:
    """nul, doc, mark: what a row is among others. Rows with null doc_id come last, in order of a hash of the text."""
    mark = F.xxhash64("text")
    return [
        F.col("doc_id").isNull().alias("nul"),
        F.coalesce(F.col("doc_id").cast("long"), mark).alias("doc"),
        mark.alias("mark"),
    ]


def _digest(data: bytes) -> bytes:
    """128 bits of the bytes of a range, by which ranges meet; whether they are equal their bytes tell."""
    return hashlib.blake2b(data, digest_size=16).digest()


_RANGE = "h1 long, h2 long, nul boolean, doc long, mark long, start int, stop int"


def _passage_rows(rows: DataFrame) -> DataFrame:
    """Rows (nul, doc, mark, text) to (h1, h2, nul, doc, mark, start, stop): each range of lines, by its digest."""
    names = [c.split()[0] for c in _RANGE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches):
        for batch in batches:
            out = []
            for nul, doc, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                for a, b in passages(lines):
                    out.append((*struct.unpack(">qq", _digest(b"\n".join(lines[a:b]))), nul, doc, mark, a, b))
                    if len(out) >= 4000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, _RANGE)


def _write_repeated(repeated: DataFrame, folder: str) -> int:
    """Digests of repeated ranges, each with the place of the first, as sorted arrays; returns in how many files."""
    files = max(1, min(65_536, -(-repeated.count() // PER_FILE)))

    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            h = batch.column("h1").to_numpy().view(np.uint64)
            f = _file_of(h, files)
            for k in np.unique(f):
                parts.setdefault(int(k), []).append(batch.filter(pa.array(f == k)))
        for k, found in parts.items():
            table = pa.Table.from_batches(found)
            order = np.argsort(table.column("h1").to_numpy().view(np.uint64), kind="stable")
            columns = {c: table.column(c).to_numpy(zero_copy_only=False)[order] for c in table.column_names}
            put(folder, f"first-{k}", columns | {"h1": columns["h1"].view(np.uint64), "nul": columns["nul"].astype(np.uint8)})
            yield pa.RecordBatch.from_arrays([pa.array([len(order)], pa.int64())], names=["n"])

    file = F.shiftright(F.shiftrightunsigned("h1", 48) * files, 16).cast("int")
    repeated.repartitionById(files, file).mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return files


def _file_of(h: np.ndarray, files: int) -> np.ndarray:
    return ((h >> np.uint64(48)) * np.uint64(files)) >> np.uint64(16)


def _firsts(folder: str, files: int, digests: list[bytes]) -> dict[bytes, tuple]:
    """(nul, doc, mark, start, stop) of the first range of each of the digests that are repeated."""
    told = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2)
    h1, h2 = told[:, 0].astype(np.uint64), told[:, 1].astype(np.uint64).view(np.int64)
    order = np.argsort(h1, kind="stable")
    cuts, out = np.searchsorted(_file_of(h1[order], files), np.arange(files + 1)), {}
    for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        part, file = order[cuts[k] : cuts[k + 1]], get(folder, f"first-{k}")
        if file is None:
            continue
        at = np.searchsorted(file["h1"], h1[part])
        for i, spot in zip(part.tolist(), at.tolist()):
            # Digests that agree in their first half stand one behind the other.
            while spot < len(file["h1"]) and file["h1"][spot] == h1[i]:
                if file["h2"][spot] == h2[i]:
                    out[digests[i]] = (bool(file["nul"][spot]), *(int(file[c][spot]) for c in ("doc", "mark", "start", "stop")))
                    break
                spot += 1
    return out


def _compared(rows: DataFrame, folder: str, files: int) -> DataFrame:
    """Rows (nul, doc, mark, text) to the ranges whose bytes are compared, with these: those that come first, own true, and those that
    would go for one before."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    names = [*(c.split()[0] for c in _RANGE.split(", ")), "own", "data"]

    def run(batches):
        for batch in batches:
            ranges, digests = [], []
            for nul, doc, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                for a, b in passages(lines):
                    data = b"\n".join(lines[a:b])
                    digests.append(_digest(data))
                    ranges.append((nul, doc, mark, a, b, data))
                if len(digests) >= 20_000:
                    yield from told(ranges, digests)
                    ranges, digests = [], []
            if digests:
                yield from told(ranges, digests)

    def told(ranges, digests):
        first, out, size = _firsts(folder, files, digests), [], 0
        for d, (nul, doc, mark, a, b, data) in zip(digests, ranges):
            if (f := first.get(d)) is None:
                continue
            own = f == (nul, doc, mark, a, b)
            if own or f[:3] < (nul, doc, mark) or (f[:3] == (nul, doc, mark) and f[4] <= a):
                out.append((*struct.unpack(">qq", d), nul, doc, mark, a, b, own, data))
                size += len(data)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, f"{_RANGE}, own boolean, data binary")


def dedup_lines(docs: DataFrame, counted: str | None = "n_removed") -> DataFrame:
    """Every document without the lines of passages that come earlier: all columns of `docs`, and `counted`.

    A passage is a chunk of several lines, or a run of lines of 50 words or more in all.
    Earlier is a document of lesser doc_id, or the same one above, where the two do not
    overlap; so every line that goes has an equal one that stays. Rows with null doc_id are
    documents of their own after all others, in order of a hash of the text; of equal ones,
    and of rows that repeat a doc_id and text, each keeps what the first keeps; rows of one
    doc_id and different texts come in order of that hash. Lines that stay are joined by line
    breaks; a document without any line left gets the empty text; a null text stays null.
    `counted` is the number of lines that went; a column of `docs` so named is replaced; with
    None there is none. Ranges meet by the 128-bit BLAKE2b of their bytes, and a range goes only if its bytes are those of the
    first one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.drop(counted) if counted else docs
    folder = new_folder(spark, "lines")
    rows = plain.where("text is not null").select(*_row_key(), "text")
    place = F.struct("nul", "doc", "mark", "start", "stop")
    found = _passage_rows(rows).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = saved(found.select("h1", "h2", "first.*"))
    files = _write_repeated(repeated, folder)
    compared = f"{folder}/compared"
    _compared(rows, folder, files).write.parquet(compared)
    told = spark.read.parquet(compared)
    # Rows that repeat a doc_id and text tell the same of a first range.
    first = saved(told.where("own").groupBy("h1", "h2").agg(F.first("data").alias("first_data")))
    equal = told.where("not own").join(first, ["h1", "h2"]).where(F.col("data") == F.col("first_data"))
    keys = fresh(plain, "nul", "doc", "mark", "ranges")
    drop = equal.groupBy("nul", "doc", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("ranges")).toDF(*keys)
    names = plain.columns
    text_at, width = names.index("text"), len(names)
    joined = plain.withColumns(dict(zip(keys, _row_key()))).join(drop, keys[:3], "left")

    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for text, ranges in zip(batch.column(text_at).to_pylist(), batch.column(width).to_pylist()):
                gone = set()
                if text is not None and ranges:
                    lines = text.split("\n")
                    for r in ranges:
                        gone.update(range(r["start"], r["stop"]))
                    text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
                texts.append(text)
                removed.append(len(gone))
            arrays = [*batch.columns[:width], pa.array(removed, pa.int64())][: len(schema)]
            arrays[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    schema = T.StructType([*plain.schema.fields, *([T.StructField(counted, T.LongType())] if counted else [])])
    return joined.select(*names, keys[3]).mapInArrow(run, schema)


def drop_passages(docs: DataFrame) -> DataFrame:
    """As `dedup_lines`, with the columns of `docs` only."""
    return dedup_lines(docs, None)
