"""Shared plumbing of the training-data operators: tables, checkpoints, ranges, components."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes handed to Python at once; a longer text is a batch of its own.
ARROW_ROWS = 1000
ARROW_BYTES = 32 << 20
#: Dimension tables at or under this many rows may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` under `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches of this session by rows and bytes, unless somebody has bounded them more.

    The frames are worked out later than they are made, so the bounds stay.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir` of the session.

    Only where it is unset and Spark runs in one process, as in tests, a temporary folder is set.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        # Spark puts a folder of its own below the one that is set.
        return os.path.dirname(folder.rstrip("/"))
    folder = context.getConf().get("spark.checkpoint.dir") or ""
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallygrid-")
    context.setCheckpointDir(folder)
    return folder


def saved(frame: DataFrame) -> DataFrame:
    """Cut the lineage of `frame` with a reliable checkpoint in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def bounded(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`frame`, of narrow rows that are cheap to count, marked for a broadcast if it has no more than `rows`."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own, by the file system that Spark has for it."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(context._jsc.hadoopConfiguration()).delete(there, True)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that `frame` does not have, in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    mark = "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


# ---------------------------------------------------------------- ranges of doc_id


LOWEST = -(2**63)
#: Ranges that a table is cut into at the most; beyond, ranges grow.
MOST_RANGES = 200_000


def place() -> list[Column]:
    """key, mark: by what rows are cut into ranges of doc_id, null first, and of text: its first 64 code points."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"), F.substring(text_or_empty(), 1, 64).alias("mark")]


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def n_ranges(docs: DataFrame, rows_per_range: int) -> int:
    """In how many ranges of about so many rows `docs` is cut."""
    return max(1, min(MOST_RANGES, -(-docs.count() // rows_per_range)))


def range_heads(docs: DataFrame, ranges: int) -> list[tuple[int, str]]:
    """The first (key, mark) of each of about so many consecutive ranges of rows; that much comes to the driver."""
    dealt = docs.select(*place()).repartitionByRange(ranges, "key", "mark")
    heads = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("key", "mark")).alias("h")).select("h.key", "h.mark")
    found = heads.toArrow()
    return sorted(set(zip(found.column("key").to_pylist(), found.column("mark").to_pylist())))


# ---------------------------------------------------------------- components


#: Different edges up to which a graph is settled by one task; more are settled in rounds.
FEW_EDGES = 200_000


def _settled(batches):
    """(node, root) of all nodes but the roots, from batches of edges (u, v)."""
    import pyarrow as pa

    above: dict = {}
    kind = None

    def root(x):
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    for batch in batches:
        kind = batch.schema.field(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                above[max(a, b)] = min(a, b)
    nodes = list(above)
    for i in range(0, len(nodes), 10_000):
        part = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], names=["node", "root"])


def components(edges: DataFrame, u: str = "u", v: str = "v", most_rounds: int = 60, few: int = FEW_EDGES) -> DataFrame:
    """Connected components of a graph: (node, root), root the least node reachable.

    Up to `few` edges, which are counted, are settled by one task, as rounds over them would move little but
    the files and tasks of their shuffles. More: large-star and small-star steps in turn, until no edge changes. Each step is two shuffles
    of the edges; the least neighbour is found by partial aggregation, so a hub's edges never
    meet in one task other than in a join that adaptive execution can split. Nodes without
    an edge to another node are not returned. Null ends are dropped.
    """
    edges = (
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u > v")
        .distinct()
    )
    edges = saved(edges)
    if edges.limit(few + 1).count() <= few:
        schema = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).schema
        return saved(edges.coalesce(1).mapInArrow(_settled, schema))
    seen = None
    for _ in range(most_rounds):
        # Large star: every greater neighbour of a node goes to the node's least neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every lesser neighbour, and the node itself, goes to the least one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = (
            linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = saved(small)
        now = edges.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s"),
        ).first()
        now = (now.n, now.s)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# ---------------------------------------------------------------- word hashes


def word_hashes(text: str):
    """64-bit hashes of the words of a text, A-Z in lower case, as a numpy array.

    Words are runs of bytes other than ASCII white space.
    """
    import numpy as np
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in text.encode("utf-8", "surrogatepass").lower().split()], dtype=np.uint64)


def shingle_hashes(words, size: int):
    """Hashes of all runs of `size` words; of the whole sequence if there are fewer; none for none."""
    import numpy as np

    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = (out ^ words[j : n - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out

