"""Near copies of the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8.

SimHash comes first: fingerprints, tree and radius are those of `simhash`, and what it links is
compared exactly and joined. Copies that lie farther apart than its radius are found without loss by
prefixes: with all shingles in one order, two sets of that similarity share one of their first
n - ceil(0.8 n) + 1. Rows meet by the shingles of their prefixes, those that are
frequent in a sample last in the order. What SimHash has joined is not compared again; of the rest a fingerprint of parities
gives a bound by which most pairs fall; the others are compared exactly. In a large group all are compared with one of
them first. Then those that are not linked with the most of their group are compared with all that share a shingle:
at once if they are few, else by shingle, each with the nearest first.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, components, fresh, saved, shingle_hashes, small_batches, word_hashes
from .simhash import fingerprint_links, simhash

WORDS = 5
#: Similarity at which documents are near copies, as a fraction.
NUM, DEN = 4, 5
#: Members of a group up to which all pairs are compared at once.
FEW = 32
#: Members of large groups, not yet linked with the most of their group, that come to the driver and go to all tasks at the most, and the
#: bytes of their prefixes and parities.
FEW_LEFT, FEW_BYTES = 20_000, 64 << 20
#: Rows that a sample holds about, the count at which a shingle of it is frequent, and the most that are told apart.
SAMPLE, FREQUENT, MOST_FREQUENT = 20_000, 8, 200_000


def shingles(text: str) -> np.ndarray:
    """The different hashes of the five-word shingles of a text, ascending; of all its words if they are fewer."""
    return np.unique(shingle_hashes(word_hashes(text), WORDS))


def prefix(found: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles, first ones first, of which a set of similarity 0.8 or more has one in its prefix too."""
    n = len(found)
    last = np.zeros(n, dtype=np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        last = np.where(frequent[at] == found, rank[at] + 1, 0)
    order = np.lexsort((found, last))
    return found[order[: n - -(-NUM * n // DEN) + 1]]


def parities(found: np.ndarray) -> bytes:
    """A bit for each value of the hashes modulo a power of two, their number or more: whether an odd number has it."""
    bits = 64
    while bits < len(found):
        bits *= 2
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has: each differing parity needs one."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    la, lb = len(a) * 8, len(b) * 8
    while la > lb:
        la //= 2
        x = (x >> la) ^ (x & ((1 << la) - 1))
    while lb > la:
        lb //= 2
        y = (y >> lb) ^ (y & ((1 << lb) - 1))
    return (x ^ y).bit_count()


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, ascending, and their rank by count. They set the order only: any order is right."""
    share = max(1, docs.count() // SAMPLE)

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["sh"])

    sample = docs.where("text is not null").select("text").where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    counts = sample.mapInArrow(run, "sh long").groupBy("sh").count().where(F.col("count") >= FREQUENT)
    top = counts.orderBy(F.desc("count"), "sh").limit(MOST_FREQUENT).toPandas()
    values = top["sh"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - 1 - np.arange(len(values)))[order]


def _mark():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _key(doc_id, mark, names=("nul", "id", "mark")):
    """Columns without null that say which row it is."""
    return [c.alias(x) for c, x in zip((doc_id.isNull(), F.coalesce(doc_id, mark), mark), names)]


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, node, fp, n, prefix, bits) of each row; node is a 64-bit hash of its shingles, fp its SimHash fingerprint."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(_frequent(docs))

    def run(batches):
        frequent, rank = order.value
        for batch in batches:
            nodes, prints, sizes, heads, bits = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text or "")
                prints.append(simhash(text or ""))
                nodes.append(int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True))
                sizes.append(len(found))
                bits.append(parities(found))
                heads.append(prefix(found, frequent, rank).view(np.int64) if len(found) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(np.array(prints, dtype=np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int32()), pa.array(heads, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "mark", "node", "fp", "n", "prefix", "bits"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), _mark().alias("mark"), "text")
    return rows.mapInArrow(run, "doc_id long, mark long, node long, fp long, n int, prefix array<long>, bits binary")


def simhash_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (u, v) of nodes that SimHash links: those of one fingerprint with the least of them, and what the tree finds within its radius."""
    points = saved(classes.groupBy("fp").agg(F.min("node").alias("node")))
    same = classes.select("fp", F.col("node").alias("v")).join(points.withColumnRenamed("node", "u"), "fp").where("u <> v").select("u", "v")
    return saved(same.unionByName(fingerprint_links(points).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))))


def _not_joined(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are of different groups."""
    named = pairs.distinct().join(groups.toDF("u", "ru"), "u", "left").join(groups.toDF("v", "rv"), "v", "left")
    return named.where(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select("u", "v")


# ---------------------------------------------------------------- groups of a shingle


def _groups(batches):
    """Runs of equal first column of sorted batches, each as its columns in whole."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        cuts = np.flatnonzero(np.diff(columns[0])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(columns[0])]):
            part = [c[a:b] for c in columns]
            if held and held[-1][0][0] != part[0][0]:
                yield [np.concatenate(c) for c in zip(*held)] if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(c) for c in zip(*held)] if len(held) > 1 else held[0]


def _may(n1, at1, n2, at2):
    """Whether sets whose first common shingle stands at these places can reach the similarity."""
    most = np.minimum(n1 - at1, n2 - at2)
    return most * (NUM + DEN) >= NUM * (n1 + n2)


def _sent(pairs: list[tuple[np.ndarray, np.ndarray]]):
    if pairs:
        u, v = (np.concatenate(x) for x in zip(*pairs))
        for i in range(0, len(u), 10_000):
            a, b = u[i : i + 10_000], v[i : i + 10_000]
            yield a, b


def _grid(node, n, at):
    """Pairs of a small group that can reach the similarity."""
    x, y = np.nonzero(_may(n[:, None], at[:, None], n[None, :], at[None, :]) & (node[:, None] < node[None, :]))
    return node[x], node[y]


def _first_pairs(batches):
    """All pairs of a small group; of a large one the pairs with one member, and its members with null v."""
    held, size = [], 0

    def flush():
        rows = [np.concatenate(c) for c in zip(*held)]
        for i in range(0, len(rows[0]), 10_000):
            sh, u, v, n, at = (c[i : i + 10_000] for c in rows)
            member = at >= 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(sh), pa.array(u), pa.array(v, mask=member), pa.array(n), pa.array(at)], names=["sh", "u", "v", "n", "at"]
            )

    def add(sh, u, v, n, at):
        k = len(u)
        full = lambda x, kind: np.full(k, x, kind) if np.isscalar(x) else x.astype(kind)
        held.append((full(sh, np.int64), u, full(v, np.int64), full(n, np.int32), full(at, np.int32)))
        return k

    for sh, node, n, at in _groups(batches):
        if len(node) < 2:
            continue
        n, at = n.astype(np.int64), at.astype(np.int64)
        if len(node) <= FEW:
            u, v = _grid(node, n, at)
            size += add(0, u, v, 0, -1)
        else:
            # Another member for each shingle: the least by a mix of both.
            with np.errstate(over="ignore"):
                mixed = (node.view(np.uint64) ^ sh[:1].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            p = int(np.argmin(mixed ^ (mixed >> np.uint64(31))))
            fits = _may(n, at, n[p], at[p]) & (node != node[p])
            low, high = np.minimum(node[fits], node[p]), np.maximum(node[fits], node[p])
            size += add(0, low, high, 0, -1) + add(sh, node, 0, n, at)
        if size > 50_000:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _folded(rows: np.ndarray) -> np.ndarray:
    """Parities of half as many bits: those of the hashes modulo the lesser power of two."""
    half = rows.shape[1] // 2
    return rows[:, :half] ^ rows[:, half:]


def _apart(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """`least_apart` of each of some rows of parities with each of others."""
    while mine.shape[1] > others.shape[1]:
        mine = _folded(mine)
    while others.shape[1] > mine.shape[1]:
        others = _folded(others)
    out = np.zeros((len(mine), len(others)), dtype=np.int64)
    for w in range(mine.shape[1]):
        out += np.bitwise_count(mine[:, w, None] ^ others[None, :, w])
    return out


def _last_pairs(batches, nearest: bool = False):
    """Pairs of a large group that are not linked yet and that no bound rules out, by size, place and parities.

    Two members of the label that most have need no look, so the others are compared with all.
    With `nearest` each of the others tells only the one that seems nearest; if there is any pair, so is there one of these.
    """
    for _, node, n, at, label, bits in _groups(batches):
        if len(node) < 2 or not (label != label[0]).any():
            continue
        n, at = n.astype(np.int64), at.astype(np.int64)
        names, counts = np.unique(label, return_counts=True)
        most = names[np.argmax(counts)]
        widths = np.array([len(x) for x in bits])
        kinds = {w: np.flatnonzero(widths == w) for w in np.unique(widths)}
        rows = {w: np.frombuffer(b"".join(bits[k]), "<u8").reshape(len(k), -1) for w, k in kinds.items()}
        found = []
        for w, mine in kinds.items():
            inside = np.flatnonzero(label[mine] != most)
            share, other = np.full(len(inside), np.inf), np.zeros(len(inside), dtype=np.int64)
            for v, others in kinds.items():
                step = max(1, 500_000 // len(others))
                for i in range(0, len(inside), step):
                    part = inside[i : i + step]
                    x = mine[part]
                    fits = _may(n[x, None], at[x, None], n[None, others], at[None, others]) & (label[x, None] != label[None, others])
                    if not nearest:
                        # Of two members outside the label of most, the pair is told once.
                        fits &= (label[None, others] == most) | (node[x, None] < node[None, others])
                    if not fits.any():
                        continue
                    apart, both = _apart(rows[w][part], rows[v]), n[x, None] + n[None, others]
                    fits &= apart * (NUM + DEN) <= (DEN - NUM) * both
                    if nearest:
                        far = np.where(fits, apart / both, np.inf)
                        best = far.argmin(axis=1)
                        least = far[np.arange(len(part)), best]
                        nearer = least < share[i : i + step]
                        share[i : i + step][nearer], other[i : i + step][nearer] = least[nearer], others[best[nearer]]
                    else:
                        p, q = np.nonzero(fits)
                        if len(p):
                            found.append((node[x[p]], node[others[q]]))
                            if sum(len(f[0]) for f in found) > 20_000:
                                yield from _told(found)
                                found = []
            if nearest and np.isfinite(share).any():
                known = np.isfinite(share)
                found.append((node[mine[inside[known]]], node[other[known]]))
        yield from _told(found)


def _told(found):
    for a, b in _sent([(np.minimum(a, b), np.maximum(a, b)) for a, b in found]):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])


def _pairs_with(few: list[tuple]):
    """A function of batches (node, n, prefix, bits, label): pairs with the few (the same columns) that share a shingle of
    both prefixes, have another label and are ruled out by no bound. A pair is told once."""
    spots: dict[int, list[int]] = {}
    for i, (_, _, prefix, _, _) in enumerate(few):
        for sh in prefix:
            spots.setdefault(sh, []).append(i)
    mine = {x[0] for x in few}

    def run(batches):
        for batch in batches:
            u, v = [], []
            for node, n, prefix, bits, label in zip(*(c.to_pylist() for c in batch.columns)):
                for i in {i for sh in prefix for i in spots.get(sh, ())}:
                    other, m, _, other_bits, other_label = few[i]
                    if label == other_label or min(n, m) * (NUM + DEN) < NUM * (n + m) or (node in mine and node > other):
                        continue
                    if least_apart(bits, other_bits) * (NUM + DEN) <= (DEN - NUM) * (n + m):
                        u.append(min(node, other))
                        v.append(max(node, other))
            yield from _told([(np.array(u, dtype=np.int64), np.array(v, dtype=np.int64))] if u else [])

    return run


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose shingles reach the similarity, compared exactly."""
    small = classes.select("node", "n", "bits")
    marked = (
        pairs.distinct()
        .join(small.toDF("u", "nu", "bu"), "u")
        .join(small.toDF("v", "nv", "bv"), "v")
        .select("u", "v", "nu", "nv", "bu", "bv")
    )

    def near(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[2:]]
            fits = [least_apart(a, b) * (NUM + DEN) <= (DEN - NUM) * (n + m) for n, m, a, b in zip(*columns)]
            yield batch.select(["u", "v"]).filter(pa.array(fits, pa.bool_()))

    pairs = saved(marked.mapInArrow(near, "u long, v long"))
    ends = saved(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    key = ["node", *_key(F.col("best.doc_id"), F.col("best.mark"))]
    if ends.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        nodes = F.broadcast(classes.join(F.broadcast(ends), "node").select(*key))
    else:
        nodes = classes.join(ends, "node").select(*key)

    def run(batches):
        for batch in batches:
            sets = [shingles(t or "").view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "sh"])

    texts = docs.select(*_key(F.col("doc_id").cast("long"), _mark()), "text")
    texts = texts.join(nodes, ["nul", "id", "mark"]).select("node", "text")
    # Rows that repeat a doc_id and text are one.
    sets = saved(texts.mapInArrow(run, "node long, sh array<long>").dropDuplicates(["node"]))
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("sh").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("sh").alias("b")), "v"
    )
    common = F.size(F.array_intersect("a", "b"))
    return saved(both.where(common * (NUM + DEN) >= NUM * (F.size("a") + F.size("b"))).select("u", "v"))


def keep_distinct(docs: DataFrame) -> DataFrame:
    """One document of each group that links of five-word similarity 0.8 or more join, with all columns.

    The one of least doc_id stays; rows with null doc_id come after all others, in order of a
    hash of the text, and go like them. Texts without words are copies of each other, and a
    null text is one. Of rows that repeat a doc_id and text one stays; rows of one doc_id and
    different texts are each judged by their text. An empty table gives an empty result.
    Sets of shingles are told apart by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    best = F.struct(F.col("doc_id").isNull().alias("nul"), "doc_id", "mark")
    classes = saved(
        _prints(docs).groupBy("node").agg(F.min(best).alias("best"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"), F.min("fp").alias("fp"))
    )
    links = _links(simhash_pairs(classes), docs, classes)
    groups = bounded(components(links))
    rows = classes.select(F.posexplode("prefix").alias("at", "sh"), "node", "n").select("sh", "node", "n", "at")
    by_shingle = lambda f, *more: f.repartition("sh").sortWithinPartitions("sh", *more)
    found = saved(by_shingle(rows).mapInArrow(_first_pairs, "sh long, u long, v long, n int, at int"))
    links = links.unionByName(_links(_not_joined(found.where("v is not null").select("u", "v"), groups), docs, classes))
    groups = bounded(components(links))
    large = found.where("v is null").select("sh", F.col("u").alias("node"), "n", "at")
    for nearest in (True, True, False) if not large.isEmpty() else ():
        named = saved(large.join(groups, "node", "left").select("sh", "node", "n", "at", F.coalesce("root", "node").alias("label")))
        counts = named.groupBy("sh", "label").agg(F.count("*").alias("c")).groupBy("sh").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels"))
        most = saved(counts.where("labels > 1").select("sh", F.col("top.label").alias("most")))
        few = saved(named.join(most, "sh").where("label <> most").select("node", "label").distinct())
        if few.isEmpty():
            break
        size = F.size("prefix") * 8 + F.octet_length("bits")
        held = classes.join(F.broadcast(few), "node") if few.limit(FEW_LEFT + 1).count() <= FEW_LEFT else None
        if held is not None and held.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= FEW_BYTES:
            # Of two members that are not linked one at least is not of the label that most have. Few such: all are compared with these.
            told = [tuple(r) for r in held.select("node", "n", "prefix", "bits", "label").collect()]
            labelled = classes.join(groups, "node", "left").select("node", "n", "prefix", "bits", F.coalesce("root", "node").alias("label"))
            more = saved(labelled.mapInArrow(_pairs_with(told), "u long, v long").distinct())
            links = links.unionByName(_links(more, docs, classes))
            groups = bounded(components(links))
            break
        # Members tell the nearest one of another label first, twice: that joins most labels, so that few pairs are left to be
        # told in full. The parities go along, so that only pairs which they do not rule out are told.
        with_bits = named.join(most, "sh", "left_semi").join(classes.select("node", "bits"), "node").select("sh", "node", "n", "at", "label", "bits")
        more = saved(by_shingle(with_bits).mapInArrow(functools.partial(_last_pairs, nearest=nearest), "u long, v long").distinct())
        if more.isEmpty():
            break
        links = links.unionByName(_links(more, docs, classes))
        groups = bounded(components(links))
    keys = fresh(docs, "nul", "id", "mark")
    firsts = (
        classes.select("node", "best")
        .join(groups, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(*_key(F.col("best.doc_id"), F.col("best.mark"), keys))
    )
    names = docs.columns
    mine = docs.select("*", *_key(F.col("doc_id").cast("long"), _mark(), keys))
    return mine.join(firsts, keys, "left_semi").dropDuplicates(keys).select(*names)
