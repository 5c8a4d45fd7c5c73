"""Alignment of two tokenizers over the same bytes, by relations.

The tokens of each side are exploded with their places, and the running sum of their lengths says where each ends. Both
sides are joined on document and end: an end that both have is a cut. The running count of cuts is
the number of the group that a token lies in. The last tokens of a group end together; they are a link.

Tokens of neither vocabulary reach over a single space between characters that are no white space, and what stands
before such a space does not change how the rest is cut. So a corpus is aligned by its different stretches
between such spaces: each is encoded once and goes through the relations once, with the number of times that it
occurs. What comes out is kept as sorted hash arrays, from which the rows of documents are put together.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import get, put
from .common import new_folder, remove_folder, saved, small_batches
from .tokens import CACHE, PieceEncoder, byte_letters, maker
from .tokens import _KNOWN as KNOWN
from .tokens import _ranks as ranks

#: The one character that the second vocabulary does not give back: it has it for a space.
LOST = "▁"
#: Where texts are cut into stretches.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than spaces and line breaks.
_RARE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Different stretches that a task counts at once, those of a file, and those that a worker keeps.
COUNTED, PER_FILE, KEPT = 300_000, 200_000, 200_000
#: A token as one number: its side from this bit on, its id from that bit on, its length in bytes below.
_SIDE, _ID = 48, 16


def stretches(text: str) -> list[str]:
    """The stretches of a text that is not empty, each without the space before it."""
    if "  " in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace() or _RARE.search(text):
        return _CUT.split(text)
    return text.split(" ")


class Vocabularies(NamedTuple):
    """Files of both: a byte-level one (A), the same as ranks with the pattern by which it cuts texts, and a sentencepiece model (B)."""

    a: str
    a_ranks: str
    a_pattern: str
    b: str


class Encoders:
    """Ids and byte lengths of both vocabularies for texts that a space goes before."""

    def __init__(self, files: Vocabularies):
        import sentencepiece

        self._a = PieceEncoder(files.a)
        self._fast = ranks(files.a_ranks, files.a_pattern)
        self._b = sentencepiece.SentencePieceProcessor(model_file=files.b)
        shown = {c: b for b, c in enumerate(byte_letters())}
        said = {i: t for t, i in self._a.library.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [bytes(shown[c] for c in said.get(i, "")) if all(c in shown for c in said.get(i, "")) else b"" for i in range(max(said) + 1)]
        piece = self._b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self._b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self._b.get_piece_size())]

    def _encode_a(self, text: str) -> list[int]:
        """By the ranks where every character is one on which both engines cut alike, else by the library's own cut."""
        if not KNOWN.search(text):
            return self._fast.encode_ordinary(text)
        if len(self._a) > CACHE // 8:
            self._a.clear()
        return np.frombuffer(b"".join([self._a[p] for p in self._a.cut(text)]), "<u4").tolist()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text by both; raises if the tokens of one are not the bytes of a space and the text."""
        a_ids = [self._encode_a(" " + t) for t in texts]
        b_ids = self._b.encode(texts, num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for t, a, b in zip(texts, a_ids, b_ids):
            data = b" " + t.encode()
            if b"".join(map(a_bytes, a)) != data or b"".join(map(b_bytes, b)) != data:
                raise ValueError(f"a vocabulary does not give back {t[:80]!r}")
        return a_ids, b_ids


def usable(text: str | None) -> bool:
    """Whether a text has tokens: neither null nor empty nor with the character that the second vocabulary loses."""
    return bool(text) and LOST not in text


def encoded(texts: DataFrame, files: Vocabularies) -> DataFrame:
    """Rows (key, n, piece), the pieces texts with which `usable` is true, to (key, n, tokens), first those of A, then of B."""
    small_batches(texts.sparkSession)

    def run(batches):
        encoders = maker(Encoders, files)
        numbers = [(side << _SIDE) + (np.arange(len(data), dtype=np.int64) << _ID) + np.array([len(x) for x in data]) for side, data in enumerate((encoders.a_bytes, encoders.b_bytes))]
        for batch in batches:
            a, b = encoders.encode(batch.column(2).to_pylist())
            sizes_a, sizes_b = (np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b))
            ends = np.cumsum(sizes_a + sizes_b)
            # Every text's tokens of A stand before those of B.
            is_b = np.repeat(np.tile([False, True], len(a)), np.stack([sizes_a, sizes_b], axis=1).ravel())
            flat = np.zeros(len(is_b), np.int64)
            for mask, side, number in ((~is_b, a, numbers[0]), (is_b, b, numbers[1])):
                flat[mask] = number[np.array([i for ids in side for i in ids], dtype=np.int64)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["key", "n", "tokens"])

    return texts.select("key", "n", "piece").mapInArrow(run, "key long, n long, tokens array<long>")


def aligned(tokens: DataFrame) -> DataFrame:
    """Rows (key, n, tokens) to (key, n, end, a, b, grp, head): one for each byte offset where a token of A or of B ends, counted from
    the space before the text, with these tokens' ids or null, and the number of the group. Where both end there is a link.
    head is true for the first token of A, so once for each text of a key.

    Texts are dealt out by key; what comes of them is joined where it is, if rows that are dealt out by key may be joined on
    key and end (`spark.sql.requireAllClusterKeysForCoPartition` false). Rows of a key stand in order of their ends.
    """
    # A few bytes become many rows, so more parts than a shuffle has else.
    parts = 4 * int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tokens.repartition(parts, "key")

    def side(k: int, name: str) -> DataFrame:
        rows = dealt.select("key", "n", F.posexplode("tokens").alias("pos", "t")).where(F.shiftright("t", _SIDE) == k)
        end = F.sum(F.col("t").bitwiseAND((1 << _ID) - 1)).over(Window.partitionBy("key").orderBy("pos")).cast("int")
        number = F.shiftright("t", _ID).bitwiseAND((1 << (_SIDE - _ID)) - 1).cast("int")
        return rows.select(*(F.col(c).alias(f"{c}_{name}") for c in ("key", "n", "pos")), number.alias(name), end.alias(f"end_{name}"))

    both = side(0, "a").join(side(1, "b"), (F.col("key_a") == F.col("key_b")) & (F.col("end_a") == F.col("end_b")), "full_outer")
    of = lambda c: F.coalesce(f"{c}_a", f"{c}_b").alias(c)
    head = F.coalesce(F.col("pos_a") == 0, F.lit(False)).alias("head")
    rows = both.select(of("key"), of("n"), of("end"), "a", "b", head).repartition(parts, "key")
    cut = (F.col("a").isNotNull() & F.col("b").isNotNull()).cast("int")
    upto = F.sum(cut).over(Window.partitionBy("key").orderBy("end"))
    return rows.withColumn("grp", (upto - cut).cast("int")).sortWithinPartitions("key", "end")


_FOLDED = "key long, n long, n_a long, n_b long, n_groups long, groups string, links array<long>, heads long"


#: Ids as text.
_SAID = [str(i) for i in range(1 << 16)]


def _folded(batches):
    """Rows of `aligned`, those of a key one behind the other, to one row for each key: key, n, n_a, n_b, n_groups,
    groups (joined by semicolons), links (A id and B id in one number) and heads, how many texts have the key."""
    names = [c.split()[0] for c in _FOLDED.split(", ")]

    def blocks():
        """Columns of whole keys, many rows at once; the last key of a block waits for the next one."""
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("key", "n", "a", "b")] + [batch.column("head").to_numpy(zero_copy_only=False)])
            n += batch.num_rows
            if n >= 50_000:
                columns = [np.concatenate(c) for c in zip(*held)]
                cut = int(np.append(-1, np.flatnonzero(columns[0] != columns[0][-1]))[-1]) + 1
                if cut:
                    yield [c[:cut] for c in columns]
                held, n = [[c[cut:] for c in columns]], n - cut
        if n:
            yield [np.concatenate(c) for c in zip(*held)]

    for key, n, a, b, head in blocks():
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        said, links, a_ids, b_ids = [], [], [], []
        ends = [*heads[1:].tolist(), len(key)]
        groups, sizes, at = [], [], 0
        a_all, b_all = a.tolist(), b.tolist()
        for end in ends:
            for x, y in zip(a_all[at:end], b_all[at:end]):
                if y < 0:
                    a_ids.append(_SAID[x])
                elif x < 0:
                    b_ids.append(_SAID[y])
                else:
                    if a_ids or b_ids:
                        said.append(f"{','.join([*a_ids, _SAID[x]])}|{','.join([*b_ids, _SAID[y]])}")
                        a_ids, b_ids = [], []
                    else:
                        said.append(f"{_SAID[x]}|{_SAID[y]}")
                    links.append(x << 32 | y)
            groups.append(";".join(said))
            sizes.append(len(said))
            said, at = [], end
        sums = [np.add.reduceat(c.astype(np.int64), heads) for c in (a >= 0, b >= 0, head)]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(links, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(key[heads]), pa.array(n[heads]), pa.array(sums[0]), pa.array(sums[1]), pa.array(sizes, pa.int64()), pa.array(groups, pa.string()), lists, pa.array(sums[2])], names=names)


def pair_counts(links: DataFrame) -> DataFrame:
    """Links (a, b, n) to (a, b, count, best): how often a pair is linked, and whether no other of its b is more often.

    Tokens that end together are one the end of the other. So there are no more pairs than tokens have bytes, about
    half a million for both vocabularies, however large the corpus is.
    """
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _key(piece: str, seed: int) -> int:
    return (xxhash.xxh64_intdigest(piece.encode(), seed) ^ 1 << 63) - (1 << 63)


def _piece_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(key, n, piece): the different stretches of all usable texts, and how often each occurs."""

    def run(batches):
        found: Counter = Counter()

        def sent():
            pieces, n = list(found), list(found.values())
            for i in range(0, len(pieces), 50_000):
                part = pieces[i : i + 50_000]
                keys = pa.array([_key(p, seed) for p in part], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(part, pa.string()), pa.array(n[i : i + 50_000], pa.int64())], names=["key", "piece", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if usable(text):
                    found.update(stretches(text))
            if len(found) > COUNTED:
                yield from sent()
                found.clear()
        yield from sent()

    return docs.select("text").mapInArrow(run, "key long, piece string, n long").groupBy("key", "piece").agg(F.sum("n").alias("n"))


_STORED = ("n_a", "n_b", "n_groups", "n_best", "count_sum")


def _file_of(h: np.ndarray, files: int) -> np.ndarray:
    return ((h >> np.uint64(48)) * np.uint64(files)) >> np.uint64(16)


def _write_pieces(whole: DataFrame, folder: str, files: int) -> int:
    """Rows (key, n_a, n_b, n_groups, groups, links) to files in order of the keys, with what the pair counts
    give for their links; returns how many there are."""

    def run(batches):
        pairs, parts = get(folder, "pairs"), {}
        for batch in batches:
            f = _file_of(batch.column("key").to_numpy().view(np.uint64), files)
            for k in np.unique(f):
                parts.setdefault(int(k), []).append(batch.filter(pa.array(f == k)))
        for k, found in parts.items():
            table = pa.Table.from_batches(found)
            h = table.column("key").to_numpy().view(np.uint64)
            order = np.argsort(h)
            table = table.take(pa.array(order)).combine_chunks()
            links = table.column("links").combine_chunks()
            starts = links.offsets.to_numpy()[:-1] - links.offsets[0].as_py()
            at = np.searchsorted(pairs["pair"], links.flatten().to_numpy())
            said = [x.encode() for x in table.column("groups").to_pylist()]
            out = {c: table.column(c).to_numpy() for c in _STORED[:3]}
            out |= {"n_best": np.add.reduceat(pairs["best"][at].astype(np.int64), starts), "count_sum": np.add.reduceat(pairs["count"][at], starts), "end": np.cumsum([len(x) for x in said], dtype=np.int64)}
            put(folder, f"groups-{k}", {"bytes": np.frombuffer(b"".join(said), np.uint8)})
            put(folder, f"pieces-{k}", {"key": h[order], **{c: x.astype(np.min_scalar_type(x.max())) for c, x in out.items()}})
            yield pa.RecordBatch.from_arrays([pa.array([len(h)], pa.int64())], names=["pieces"])

    file = F.shiftright(F.shiftrightunsigned("key", 48) * files, 16).cast("int")
    return whole.select("key", *_STORED[:3], "groups", "links").repartitionById(files, file).mapInArrow(run, "pieces long").agg(F.sum("pieces")).first()[0] or 0


def _write_pairs(counted: DataFrame, folder: str) -> None:
    """The pair counts as one sorted array; there are no more of them than both vocabularies have bytes."""
    found = counted.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "count", "best").orderBy("pair").toArrow()
    put(folder, "pairs", {"pair": found["pair"].to_numpy(), "count": found["count"].to_numpy(), "best": found["best"].to_numpy(zero_copy_only=False).astype(np.uint8)})


class Pieces:
    """What the alignment of each stretch came to, looked up in the files and kept for the next texts."""

    def __init__(self, folder: str, files: int, seed: int):
        self._folder, self._files, self._seed = folder, files, seed
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.groups: list[bytes] = []
        self._values = np.zeros((1024, len(_STORED)), np.int64)

    def values(self, slots) -> np.ndarray:
        return self._values[slots]

    def slots(self, cut: list[list[str]]) -> list[list[int]]:
        """The slots of the stretches of each text. They are stretches of the corpus, whose keys are all different."""
        out = [list(map(self.slot.get, pieces)) for pieces in cut]
        missing = {p for pieces, mine in zip(cut, out) if None in mine for p, s in zip(pieces, mine) if s is None}
        if not missing:
            return out
        if len(self.slot) + len(missing) > KEPT and self.slot:
            self.clear()
            return self.slots(cut)
        self._look_up(list(missing))
        return [list(map(self.slot.__getitem__, pieces)) if None in mine else mine for pieces, mine in zip(cut, out)]

    def _look_up(self, new: list[str]) -> None:
        h = np.array([xxhash.xxh64_intdigest(p.encode(), self._seed) for p in new], np.uint64)
        order = np.argsort(h)
        cuts = np.searchsorted(_file_of(h[order], self._files), np.arange(self._files + 1))
        while len(self._values) < len(self.groups) + len(new):
            self._values = np.concatenate([self._values, np.zeros_like(self._values)])
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = order[cuts[k] : cuts[k + 1]]
            main, data = get(self._folder, f"pieces-{k}"), memoryview(get(self._folder, f"groups-{k}")["bytes"])
            at = np.searchsorted(main["key"], h[part])
            first = len(self.groups)
            begins = np.where(at > 0, main["end"][at - 1], 0).tolist()
            self.groups += [data[i:j].tobytes() for i, j in zip(begins, main["end"][at].tolist())]
            self.slot.update(zip([new[i] for i in part.tolist()], range(first, len(self.groups))))
            self._values[first : len(self.groups)] = np.stack([main[c][at] for c in _STORED], axis=1)


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def align_corpus(docs: DataFrame, files: Vocabularies, folder: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every whole text.

    A encodes a space and the text, B adds the
    space. Special strings in texts are plain text. The digest is that of all groups, `a1,a2|b1;a3|b2,b3`. A link's count is
    how many links of the corpus hold its ids; best are those whose count is the highest of their B id, ties too.
    Null and empty texts, and those with U+2581, which B turns into a space, have no tokens: zeros and
    an empty string for the digest. Rows are answered one by one, repeated ones count each time; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or new_folder(spark, "alignment")
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        for seed in range(100):
            rows = aligned(encoded(_piece_counts(docs, seed), files)).select("key", "n", "a", "b", "head")
            whole = _written(rows.mapInArrow(_folded, _FOLDED), f"{folder}/whole")
            n_pieces, most = whole.agg(F.count("*"), F.max("heads")).first()
            if (most or 1) == 1:
                break
            remove_folder(spark, f"{folder}/whole")  # two stretches have one key: another seed
        else:
            raise RuntimeError("no seed gives every stretch a key of its own")
    finally:
        spark.conf.set(setting, before)
    links = whole.select("n", F.explode("links").alias("l")).select(F.shiftright("l", 32).cast("int").alias("a"), F.col("l").bitwiseAND((1 << 32) - 1).cast("int").alias("b"), "n")
    _write_pairs(pair_counts(links), folder)
    files = max(1, min(65_536, -(-n_pieces // PER_FILE)))
    _write_pieces(whole, folder, files)
    remove_folder(spark, f"{folder}/whole")

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        table = Pieces(folder, files, seed)
        for batch in batches:
            cut = [stretches(t) if usable(t) else [] for t in batch.column(1).to_pylist()]
            each = table.slots(cut)
            groups = table.groups.__getitem__
            slots = [s for mine in each for s in mine]
            digests = [hashlib.sha256(b";".join(map(groups, mine))).hexdigest() if mine else "" for mine in each]
            sums = np.zeros((len(cut), len(_STORED)), np.int64)
            sizes = np.array([len(p) for p in cut], np.int64)
            if slots:
                some = sizes > 0
                sums[some] = np.add.reduceat(table.values(slots), (np.cumsum(sizes) - sizes)[some], axis=0)
            a, b, n_groups, best, count = np.ascontiguousarray(sums.T)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (a, b, n_groups, n_groups, best, count)), pa.array(digests, pa.string())], names=names)

    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def align_texts(docs: DataFrame, files: Vocabularies) -> DataFrame:
    """The groups themselves, text by text: key, doc_id, grp, end (in bytes, from the space before the text), a and b (ids in order).

    Whole texts go through the relations. Texts without tokens have no row; rows of one doc_id are told apart by `key`.
    """
    texts = docs.where("text <> ''").where(~F.contains("text", F.lit(LOST))).select(F.col("doc_id").cast("long"), F.col("text").alias("piece"))
    told = saved(texts.withColumn("key", F.monotonically_increasing_id()))
    rows = aligned(encoded(told.select("key", F.lit(1).cast("long").alias("n"), "piece"), files))
    ids = lambda c: F.array_compact(F.transform(F.array_sort(F.collect_list(F.struct("end", c))), lambda x: x[c])).alias(c)
    return rows.groupBy("key", "grp").agg(F.max("end").alias("end"), ids("a"), ids("b")).join(told.drop("piece"), "key").select("key", "doc_id", "grp", "end", "a", "b")
