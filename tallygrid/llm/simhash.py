"""Near-duplicate documents by SimHash, found exactly with a vantage-point tree over Hamming distance.

Only different fingerprints are compared, each with the least doc_id that has it. The upper
levels of the tree cut the space into shards: at a node, fingerprints within the radius of its
vantage point go inside, others outside. Each fingerprint belongs to one shard, and also asks
every shard that a ball of the linking distance around it touches (triangle bounds), so every
linked pair meets in the home shard of each of its ends. Within a shard the tree goes on in
memory. A shard reports, for each cluster that it sees, links from its members to the least
one only; these connect the same fingerprints as all pairs would.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import get, put
from .common import components, fresh, new_folder, saved, small_batches

#: Differing bits at which fingerprints still link.
RADIUS = 2
WORDS = 3
SEED = 42
#: Members of a shard that the tree aims at, shards of its first levels at the most, and members above which a shard is cut again.
SHARD = 4096
MOST_SHARDS = 8192
CROWD = 32_768
#: Fingerprints sampled for each shard to place its vantage points; so 65,536 come to the driver at the most.
SAMPLE_PER_SHARD = 8
#: Members of a node under which all are compared.
LEAF = 96


def simhash(text: str) -> int:
    """The 64-bit fingerprint: a bit is set if over half of the shingle hashes have it.

    Shingles are runs of three words, repeats included, of the text with A-Z in lower case;
    words are runs of bytes other than ASCII white space. Fewer words: one shingle of all; no
    word: zero. A hash is XXH64 of the shingle in UTF-8, words joined by one space, seed 42.
    """
    from xxhash import xxh64_digest as digest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        return int.from_bytes(digest(b" ".join(words), SEED), "big")
    join = b" ".join
    total = len(words) - WORDS + 1
    sums = np.zeros(64, dtype=np.int64)
    for at in range(0, total, 16384):
        end = min(total, at + 16384)
        hashes = b"".join([digest(join(x), SEED) for x in zip(words[at:end], words[at + 1 : end + 1], words[at + 2 : end + 2])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        sums += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(sums * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every text. A null text has no word."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            made = np.array([simhash(t or "") for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- the tree


def _split(sample: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve a sample best; None if its fingerprints are all one."""
    best = None
    for p in sample[: min(len(sample), 5)]:
        d = np.bitwise_count(sample ^ p)
        mu = int(np.median(d))
        if mu >= d.max():
            mu = int(d.max()) - 1
        if mu < 0:
            continue
        # Few near the boundary, and halves of about equal size.
        inside = (d <= mu).mean()
        near = ((d > mu - RADIUS) & (d <= mu + RADIUS)).mean()
        cost = near + 2 * abs(inside - 0.5)
        if best is None or cost < best[0]:
            best = (cost, p, mu)
    return best and best[1:]


def build_tree(sample: np.ndarray, shards: int):
    """Nested (point, radius, inside, outside) with shard numbers as leaves, and how many there are."""
    count = 0

    def node(part: np.ndarray, wanted: int):
        nonlocal count
        found = _split(part) if wanted > 1 and len(part) > 3 else None
        if found is None:
            count += 1
            return count - 1
        point, mu = found
        inside = np.bitwise_count(part ^ point) <= mu
        n = max(1, min(wanted - 1, round(wanted * float(inside.mean()))))
        return point, mu, node(part[inside], n), node(part[~inside], wanted - n)

    return node(np.unique(sample), shards), count


def route(tree, fps: np.ndarray, home: np.ndarray | None = None):
    """Yields (shard, positions, whether it is their home) for all shards that the fingerprints reach; without `home` each has one."""
    todo = [(tree, np.arange(len(fps)), np.ones(len(fps), dtype=bool) if home is None else home)]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at, home
            continue
        point, mu, inner, outer = node
        d = np.bitwise_count(fps[at] ^ point).astype(np.int64)
        inside, outside = d - RADIUS <= mu, d + RADIUS > mu
        todo.append((inner, at[inside], home[inside] & (d[inside] <= mu)))
        todo.append((outer, at[outside], home[outside] & (d[outside] > mu)))


def _least_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the clusters of u[i] and v[i], in place; a label is the least position of a cluster."""
    while True:
        a, b = labels[u], labels[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (low != high).any():
            return
        np.minimum.at(labels, high, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def shard_clusters(fps: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Cluster labels over a shard: members are compared with all that reach it."""
    labels = np.arange(len(fps))
    todo = [(np.flatnonzero(home), np.arange(len(fps)))]
    while todo:
        members, asking = todo.pop()
        if not len(members) or len(asking) < 2:
            continue
        if len(members) > LEAF:
            part = fps[members]
            found = _split(part[:: max(1, len(part) // 256)])
            if found is not None:
                point, mu = found
                dm, da = np.bitwise_count(part ^ point), np.bitwise_count(fps[asking] ^ point).astype(np.int64)
                inside = dm <= mu
                if inside.any() and not inside.all():
                    todo.append((members[inside], asking[da - RADIUS <= mu]))
                    todo.append((members[~inside], asking[da + RADIUS > mu]))
                    continue
        step = max(1, 2_000_000 // len(asking))
        for i in range(0, len(members), step):
            rows = members[i : i + step]
            x, y = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[asking][None, :]) <= RADIUS)
            _least_labels(labels, rows[x], asking[y])
    return labels


_DEALT = "shard long, fp long, node long, home boolean"
#: Shards of one that is cut again, at the most, fingerprints that are sampled of it, and how often crowds are cut; what is crowded
#: then lies within few bits and is compared as it is.
_AGAIN, _SAMPLE, _ROUNDS = 256, 2048, 12


def _routed(tree, batch, shard, home=None):
    """Rows of a batch (fp, node) in all shards that they reach, under the numbers that `shard` gives."""
    fps = batch.column("fp").to_numpy().view(np.uint64)
    for number, at, mine in route(tree, fps, home):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), shard(number), dtype=np.int64)), pa.array(fps[at].view(np.int64)), batch.column("node").take(pa.array(at)), pa.array(mine)],
            names=["shard", "fp", "node", "home"],
        )


def _cut_crowds(dealt: DataFrame, crowd: int) -> DataFrame:
    """Shards of more home members than `crowd` cut by trees of their own, until none is left that a tree can cut, or some rounds are over.

    Each tree is built by one task from a bounded sample of its shard and lies in the shared folder, where the tasks that deal
    out the shard's rows find it; so neither the number of shards nor their trees are bounded by the driver.
    """
    spark = dealt.sparkSession
    folder = new_folder(spark, "trees")
    whole = None  # shards that no tree cuts
    for _ in range(_ROUNDS):
        crowds = dealt.where("home").groupBy("shard").agg(F.count("*").alias("members")).where(F.col("members") > crowd)
        if whole is not None:
            crowds = crowds.join(whole, "shard", "left_anti")
        crowds = saved(crowds)
        if crowds.isEmpty():
            return dealt

        def build(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            fps = np.sort(table.column("fp").to_numpy().view(np.uint64))
            wanted = -(-table.column("members")[0].as_py() // (crowd // 8 or 1))
            tree, leaves = build_tree(fps, max(2, min(_AGAIN, wanted)))
            put(folder, f"tree-{shard}", {"bytes": np.frombuffer(pickle.dumps(tree), np.uint8)})
            return pa.table({"shard": pa.array([shard], pa.int64()), "leaves": pa.array([leaves], pa.int64())})

        place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("fp"), "fp"))
        sample = dealt.where("home").join(crowds, "shard").withColumn("place", place).where(F.col("place") <= _SAMPLE).select("shard", "fp", "members")
        built = saved(sample.groupBy("shard").applyInArrow(build, "shard long, leaves long"))
        stay = built.where("leaves = 1").select("shard")
        whole = stay if whole is None else saved(whole.unionByName(stay))
        cut = built.where("leaves > 1").select("shard")
        if cut.isEmpty():
            return dealt

        def deal(batches):
            for batch in batches:
                shards = batch.column("shard").to_numpy()
                for k in np.unique(shards).tolist():
                    tree = pickle.loads(get(folder, f"tree-{k}")["bytes"].tobytes())
                    part = batch.filter(pa.array(shards == k))
                    yield from _routed(tree, part, lambda number: k * _AGAIN + number + MOST_SHARDS, part.column("home").to_numpy(zero_copy_only=False))

        rest = dealt.join(cut, "shard", "left_anti")
        more = dealt.join(cut, "shard", "left_semi").repartition("shard").sortWithinPartitions("shard").mapInArrow(deal, _DEALT)
        dealt = saved(rest.select("shard", "fp", "node", "home").unionByName(more))
    return dealt


def fingerprint_links(classes: DataFrame, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) among the nodes of (fp, node), fp all different, that connect what is within the radius.

    A sample of bounded size, the least by hash, comes to the driver to place the vantage points of the first levels. Shards that
    are crowded all the same are cut again, each by a tree from its own sample.
    """
    n = classes.count()
    shards = max(1, min(MOST_SHARDS, -(-n // shard)))
    sample = [r.fp for r in classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(shards * SAMPLE_PER_SHARD).collect()]
    tree, _ = build_tree(np.array(sample, dtype=np.int64).view(np.uint64), shards)

    def deal(batches):
        for batch in batches:
            yield from _routed(tree, batch, lambda number: number)

    def link(batch: pa.Table) -> pa.Table:
        order = np.argsort(batch.column("node").to_numpy(), kind="stable")
        fps = batch.column("fp").to_numpy()[order].view(np.uint64)
        nodes = batch.column("node").to_numpy()[order]
        labels = shard_clusters(fps, batch.column("home").to_numpy()[order])
        u = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"u": pa.array(nodes[u]), "v": pa.array(nodes[labels[u]])})

    dealt = _cut_crowds(saved(classes.select("fp", "node").mapInArrow(deal, _DEALT)), crowd)
    return dealt.groupBy("shard").applyInArrow(link, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every document.

    component_id is the least doc_id that links of at most two differing bits reach, the
    document's own included. A null text has no word and the fingerprint zero. Repeated rows
    are one class and keep their rows; documents with null doc_id keep null as component_id
    unless another document of their component has one. Other columns are ignored; an empty
    table gives an empty result.
    """
    prints = saved(fingerprints(docs))
    classes = saved(
        prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    )
    if classes.isEmpty():
        roots = classes.select("fp", F.col("node").alias("component_id"))
    else:
        # Fingerprints that only rows without doc_id have could link others: they get nodes below every id.
        orphans = prints.where("doc_id is null").select("fp").distinct().join(classes, "fp", "left_anti")
        orphans = orphans.withColumn("node", F.xxhash64("fp"))
        if orphans.isEmpty():
            joined = components(fingerprint_links(classes))
            roots = classes.join(joined, classes.node == joined.node, "left").select(
                "fp", F.coalesce("root", classes.node).alias("component_id")
            )
        else:
            nodes = saved(
                classes.select("fp", F.col("node").alias("doc")).unionByName(orphans.select("fp", F.lit(None).cast("long").alias("doc")))
                .withColumn("node", F.col("fp"))
            )
            joined = components(fingerprint_links(nodes.select("fp", "node")))
            rooted = nodes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
            least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
            roots = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(roots, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that have the least doc_id of their component, with all columns.

    Of rows that repeat this doc_id one stays, the least by text. Rows with null doc_id stay.
    """
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    (place,) = fresh(docs, "place")
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").select(*docs.columns)
    named = named.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(place) == 1)
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))
